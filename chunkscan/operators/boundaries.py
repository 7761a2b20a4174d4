"""Chunk boundaries from the rows themselves.

With chunk size n, ``exact`` ends a chunk at the key of its n-th row, ``skip`` at that of its
(n+1)-th; rows of one key never part, and NULL keys do not count. A chunk's end depends on where the
one before ended, so the walk is a chain. It runs on the cluster all the same: the key histogram is
range-partitioned once; each partition tells how many rows are open at its end for each number open
at its start; composing these, a few numbers a partition, gives all true starts; then every
partition walks its own keys. No step gathers keys on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkscan.scratch import cut
from chunkscan.sources.relations import JdbcRelation


#: Bytes of partitions' summaries that the driver takes at once.
GATHERED = 64 << 20


def key_min_max(df: DataFrame, key: str) -> DataFrame:
    """One row: min_key, max_key over non-NULL keys."""
    return df.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def _step(n: int, mode: str) -> int:
    if n < 1:
        raise ValueError("the chunk size must be at least 1")
    if mode not in ("exact", "skip"):
        raise ValueError(f"unknown mode {mode!r}")
    return n if mode == "exact" else n + 1


def ends_within(counts: np.ndarray, open_: int, step: int) -> tuple[list[int], int]:
    """Places of keys that end a chunk, given the rows open before, and the rows open after."""
    total = np.cumsum(counts)
    places, base = [], -open_
    while len(total):
        at = int(np.searchsorted(total, base + step))
        if at == len(total):
            break
        places.append(at)
        base = int(total[at])
    return places, (int(total[-1]) if len(total) else 0) - base


def walks(counts: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """For 0, 1, ... step-1 rows open before: the rows open after all keys, and the number of ends among them."""
    total = np.cumsum(counts)
    size = len(total)
    if not size:
        return np.arange(step), np.zeros(step, np.int64)
    # Once a chunk ended at key j, the next end is fixed; pointers are doubled up to the last end.
    jump = np.searchsorted(total, total + step)
    last = np.where(jump < size, jump, np.arange(size))
    hops = (jump < size).astype(np.int64)
    while True:
        further = last[last]
        if (further == last).all():
            break
        hops, last = hops + hops[last], further
    first = np.searchsorted(total, step - np.arange(step))
    some, at = first < size, np.minimum(first, size - 1)
    after = total[-1] - total[last]
    return np.where(some, after[at], np.arange(step) + total[-1]), np.where(some, hops[at] + 1, 0)


def open_after(counts: np.ndarray, step: int) -> np.ndarray:
    """The first part of ``walks``."""
    return walks(counts, step)[0]


def _histogram(df: DataFrame, key: str) -> DataFrame:
    """(part, k, c): keys in order within and across parts, cut so that the parts stay."""
    slots = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hist = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("c"))
    ordered = hist.repartitionByRange(slots, "k").sortWithinPartitions("k")
    return cut(ordered.select(F.spark_partition_id().alias("part"), "k", "c"), eager=False)


def _starts(hist: DataFrame, step: int) -> tuple[dict[int, int], dict[int, int], int]:
    """Rows open at each part's start, ends within each part, and the rows open after all."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, counts = [], []
        for b in batches:
            parts.append(np.asarray(b.column(0)))
            counts.append(np.asarray(b.column(1)))
        if parts and sum(map(len, counts)):
            c = np.concatenate(counts)
            alone = bool((c == 1).all())
            after, ends = (b"", b"") if alone else (x.astype(np.int64).tobytes() for x in walks(c, step))
            yield pa.record_batch({"part": pa.array([int(np.concatenate(parts)[0])], pa.int32()), "rows": pa.array([int(c.sum())], pa.int64()), "after": pa.array([after], pa.binary()), "ends": pa.array([ends], pa.binary())})

    found: dict[int, int] = {}
    closed: dict[int, int] = {}
    open_ = 0
    told = hist.select("part", "c").mapInArrow(tell, "part int, rows long, after binary, ends binary")
    # One row a partition, of 16 bytes a row of a chunk at most: gathered at once if that is little, else one after the other.
    little = hist.rdd.getNumPartitions() * step * 16 <= GATHERED
    for row in sorted(told.collect(), key=lambda r: r["part"]) if little else told.orderBy("part").toLocalIterator():
        found[row["part"]] = open_
        if row["after"]:
            closed[row["part"]] = int(np.frombuffer(bytes(row["ends"]), np.int64)[open_])
            open_ = int(np.frombuffer(bytes(row["after"]), np.int64)[open_])
        else:
            closed[row["part"]], open_ = divmod(open_ + row["rows"], step)
    return found, closed, open_


def _numbered(hist: DataFrame, starts: dict[int, int], step: int, ends_only: bool) -> DataFrame:
    """(part, nth, k): ends of chunks numbered within their part; or all keys with the ends before them."""
    schema = hist.select(F.col("part"), F.lit(0).cast("long").alias("nth"), F.col("k")).schema

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, seen = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            part = int(b.column(0)[0].as_py())
            open_ = starts[part] if open_ is None else open_
            places, open_ = ends_within(np.asarray(b.column(2)), open_, step)
            if ends_only:
                nth, rows = np.arange(seen, seen + len(places)), b.take(pa.array(places, pa.int64()))
            else:
                nth, rows = seen + np.searchsorted(np.array(places, np.int64), np.arange(b.num_rows), "left"), b
            seen += len(places)
            yield pa.record_batch([rows.column(0), pa.array(nth, pa.int64()), rows.column(1)], names=["part", "nth", "k"])

    return hist.mapInArrow(walk, schema)


def _offset(numbered: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``nth`` counted over all parts."""
    before, total = {}, 0
    for part in sorted(counts):
        before[part] = total
        total += counts[part]
    if not before:
        return numbered.select(F.col("nth").alias("idx"), "k")
    shift = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    return numbered.select((F.col("nth") + shift[F.col("part")]).cast("long").alias("idx"), "k")


class Boundaries:
    """The ends of a column's chunks: ``frame`` (idx, k), ``count``, and each key's chunk."""

    def __init__(self, df: DataFrame, key: str, n: int, mode: str = "exact"):
        step = _step(n, mode)
        self._hist = _histogram(df, key)
        self._open, self._counts, rest = _starts(self._hist, step)
        self._step = step
        self.count = sum(self._counts.values())
        frame = _offset(_numbered(self._hist, self._open, step, True), self._counts)
        # Exact: an end after which nothing follows is none.
        if mode == "exact" and rest == 0 and self.count:
            self.count -= 1
            frame = frame.where(F.col("idx") < self.count)
        self.frame = frame

    def values(self) -> list[Any]:
        """All ends in order; as many as chunks, for those who plan one task a chunk."""
        return [r["k"] for r in sorted(self.frame.collect(), key=lambda r: r["idx"])]

    def keys(self) -> DataFrame:
        """(k, idx): each distinct key and its chunk."""
        every = _offset(_numbered(self._hist, self._open, self._step, False), self._counts)
        return every.select("k", F.least("idx", F.lit(self.count).cast("long")).alias("idx"))


def boundaries(df: DataFrame, key: str, n: int, mode: str = "exact") -> DataFrame:
    """(idx, boundary) for each closed chunk of ``df`` by ``key``."""
    return Boundaries(df, key, n, mode).frame.select("idx", F.col("k").alias("boundary"))


def boundaries_unique(df: DataFrame, key: str, n: int, mode: str = "exact") -> DataFrame:
    """The same for a key without repeats: every ``step``-th row, numbered by partition and within it."""
    step = _step(n, mode)
    slots = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k")).repartitionByRange(slots, "k").sortWithinPartitions("k")
    placed = cut(keys.select("k", F.monotonically_increasing_id().alias("at")))
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r[0], r[1]) for r in placed.groupBy(part.alias("p")).count().collect())  # one row a partition
    before, total = [], 0
    for p, c in sizes:
        before += [F.lit(p), F.lit(total)]
        total += c
    if not before:
        return placed.select(F.col("at").alias("idx"), F.col("k").alias("boundary"))
    row = (F.create_map(*before)[part] + within + 1).cast("long")
    ends = (row % step == 0) & (row < total) if mode == "exact" else row % step == 0
    return placed.where(ends).select(((row / step).cast("long") - 1).alias("idx"), F.col("k").alias("boundary"))


def boundaries_jdbc(relation: JdbcRelation, table: str, key: str, n: int, mode: str = "exact") -> list[Any]:
    """The same by walking an index of a database over one connection: one short query a chunk, least and greatest key once."""
    step = _step(n, mode)
    try:
        low, high = relation.min_max(table, key)
        if low is None:
            return []
        found: list[Any] = []
        while True:
            end = relation.next_key(table, key, found[-1] if found else None, step - 1)
            # The database compares keys; its order of strings need not be Python's.
            if end is None or mode == "exact" and end == high:
                return found
            found.append(end)
    finally:
        relation.close()


def longest_chunk(df: DataFrame, key: str) -> DataFrame:
    """Rows of the commonest key: how far a chunk can exceed the chunk size."""
    return df.groupBy(key).count().agg(F.max("count").alias("longest_run"))


def arithmetic_chunks(df: DataFrame, key: str, chunks: int) -> DataFrame:
    """(chunk, n_rows) of ``chunks`` equal key ranges between least and greatest key, empty ones too: what data-driven ends replace."""
    low, high = key_min_max(df, key).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "chunk long, n_rows long")
    width = (high - low) / chunks
    place = F.lit(0).cast("long") if not width else F.least(F.floor((F.col(key) - low) / F.lit(float(width))), F.lit(chunks - 1)).cast("long")
    counts = df.where(F.col(key).isNotNull()).groupBy(place.alias("chunk")).agg(F.count(F.lit(1)).alias("n_rows"))
    return df.sparkSession.range(chunks).select(F.col("id").alias("chunk")).join(counts, "chunk", "left").select("chunk", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"))


def ordered(frame: DataFrame) -> DataFrame:
    """(idx, start, end) of chunks in order, the open last one included; ``frame`` is (idx, k)."""
    ends = frame.select("idx", F.col("k").alias("end"))
    starts = frame.select((F.col("idx") + 1).alias("idx"), F.col("k").alias("start"))
    spine = frame.select("idx").union(frame.agg(F.coalesce(F.max("idx") + 1, F.lit(0).cast("long")).alias("idx")))
    return spine.join(starts, "idx", "left").join(ends, "idx", "left").select("idx", "start", "end")


__all__ = ["Boundaries", "arithmetic_chunks", "boundaries", "boundaries_jdbc", "boundaries_unique", "ends_within", "key_min_max", "longest_chunk", "open_after", "ordered", "walks"]
