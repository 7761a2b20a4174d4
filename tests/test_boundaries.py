"""Boundaries: worked values, a plain walk as the reference, and edge cases."""

import random

import numpy as np
import pytest

from chunkscan.operators.boundaries import boundaries, boundaries_unique, open_after, walks
from chunkscan.operators.splits import assign_split, split_frame, splits_of


def walk(keys, n, mode="exact"):
    """Ends of chunks by reading sorted keys one after the other."""
    keys = sorted(k for k in keys if k is not None)
    step, ends, open_ = (n if mode == "exact" else n + 1), [], 0
    for at, k in enumerate(keys):
        open_ += 1
        if open_ >= step and (at + 1 == len(keys) or keys[at + 1] != k):
            ends.append(k)
            open_ = 0
    if mode == "exact" and ends and open_ == 0:
        ends.pop()
    return ends


def table(spark, keys, kind="long"):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], f"k {kind}, i long")


def found(df, n, mode="exact", f=boundaries):
    return [r["boundary"] for r in f(df, "k", n, mode).orderBy("idx").collect()]


CASES = [
    (range(1, 101), 10, list(range(10, 100, 10)), list(range(11, 100, 11))),
    ([*range(1, 11), *range(1000001, 1000011)], 10, [10], [1000001]),
    ([1 << i for i in range(11)], 3, [4, 32, 256], [8, 128]),
    (range(1, 11), 10, [], []),
    (range(1, 6), 100, [], []),
    ([], 5, [], []),
    (range(1, 26), 10, [10, 20], [11, 22]),
    (range(1, 101), 20, [20, 40, 60, 80], [21, 42, 63, 84]),
]


@pytest.mark.parametrize("keys,n,exact,skip", CASES)
def test_worked_values(spark, keys, n, exact, skip):
    df = table(spark, list(keys))
    assert found(df, n) == exact
    assert found(df, n, "skip") == skip
    assert found(df, n, f=boundaries_unique) == exact


def test_string_keys(spark):
    names = "Alice Bob Charlie Dave Eve Frank Grace Heidi Ivan Judy".split()
    df = table(spark, names, "string")
    assert found(df, 3) == ["Charlie", "Frank", "Ivan"]
    assert found(df, 3, "skip") == ["Dave", "Heidi"]


@pytest.mark.parametrize("seed", range(4))
def test_random_keys(spark, seed):
    rng = random.Random(seed)
    keys = [rng.choice([None, *range(rng.choice([3, 40, 400]))]) for _ in range(rng.choice([30, 300]))] + [7] * rng.choice([0, 50])
    n = rng.choice([1, 2, 7, 30])
    for mode in ("exact", "skip"):
        ends = walk(keys, n, mode)
        assert found(table(spark, keys), n, mode) == ends
    df = table(spark, keys)
    rows = assign_split(df, "k", n).collect()
    assert len(rows) == len(keys)
    bounds = walk(keys, n)
    assert all(r["_chunk"] == (0 if r["k"] is None else sum(b < r["k"] for b in bounds)) for r in rows)
    parts = [s.read(df).count() for s in splits_of("t", "k", bounds)]
    assert sum(parts) == len(keys)


def test_open_after_matches_walk():
    rng = np.random.default_rng(5)
    for _ in range(50):
        counts, step = rng.integers(1, 6, rng.integers(0, 40)), int(rng.integers(1, 12))
        want, ends = [], []
        for open_ in range(step):
            ended = 0
            for c in counts:
                open_ += int(c)
                if open_ >= step:
                    open_, ended = 0, ended + 1
            want.append(open_)
            ends.append(ended)
        assert open_after(counts, step).tolist() == want
        assert walks(counts, step)[1].tolist() == ends


def test_many_chunks_join_by_key(spark):
    df = table(spark, list(range(1000)))
    rows = assign_split(df, "k", 3).collect()
    assert all(r["_chunk"] == r["k"] // 3 for r in rows)


def test_empty_and_null_keys_give_one_split(spark):
    for keys in ([], [None, None]):
        rows = split_frame(table(spark, keys), "t", "k", 5).collect()
        assert [(r["split_id"], r["split_start"], r["split_end"]) for r in rows] == [("t#0", None, None)]


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        boundaries(table(spark, [1]), "k", 0)
    with pytest.raises(ValueError):
        boundaries(table(spark, [1]), "k", 1, "other")
