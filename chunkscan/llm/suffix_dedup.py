"""Repeated windows by a depth-limited radix sort of suffixes, most significant digits first.

Suffixes are ordered only through a threshold of tokens, so suffixes that stay equal after all passes
are exactly the repeated windows. Two such sorts are made: through 400 bytes, for what is removed, and
through 50 words, for the passages that a text shares with another document.

A suffix is moved by its representative: the least-hashed gram that starts among its first ``sample``
tokens. Neighbouring suffixes have one representative, so about half of ``sample`` of them are one row;
equal suffixes have the same one at the same offset. Passes read ever more leading tokens:

1. The digit of a row is the tokens from its representative on, as many as all its suffixes hold
   (81 bytes). Each digit is counted; rows alone with theirs leave.
2. What is left is split at offsets of ``block`` suffixes and by the tokens that these have in common
   (337 bytes). Where rows of a group agree in all their suffixes, these are repeated at once; where
   some do not, one of each kind goes on.
3. The last pass is on single suffixes through the threshold, only next to the edges of repeated
   passages.

Groups are counted by aggregation, not gathered, so a passage may occur any number of times. A digit
is held as a 64-bit hash; what decides in the end is 128 bits. Equal texts are one text with a count
from the start, by 128 bits of SHA-256.

Odd cases: null and empty texts have no tokens; texts shorter than a window lose nothing; rows
repeated with one id count as separate documents, so long ones lose everything; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkscan.llm.common import cut, delete, shared_dir
from chunkscan.llm.hashing import BYTE_VALUES, Stretches, mix, word_hashes

_PLACE = np.uint64((1 << 22) - 1)


@dataclass(frozen=True)
class Order:
    """``length``: the threshold. ``gram``: tokens that are hashed to choose a representative. ``across``: only repeats in other documents count.

    ``chunk``: tokens handled at once, and bytes parted into words at once; a longer text goes in overlapping segments.
    """

    length: int
    sample: int
    block: int
    gram: int
    words: bool = False
    across: bool = False
    chunk: int = 1 << 20

    @property
    def digit(self) -> int:
        return self.length - self.sample + 1

    def tokens(self, raws: list[bytes]) -> list[np.ndarray]:
        if not self.words:
            return [np.frombuffer(raw, np.uint8) for raw in raws]
        out: list[np.ndarray] = []
        lo = 0
        while lo < len(raws):
            if len(raws[lo]) > self.chunk:
                out.append(np.concatenate([word_hashes([piece])[0] for piece in _pieces(raws[lo], self.chunk)]))
                lo += 1
                continue
            hi, size = lo, 0
            while hi < len(raws) and size + len(raws[hi]) <= self.chunk:
                size += len(raws[hi])
                hi += 1
            hashes, counts = word_hashes(raws[lo:hi])
            out += np.split(hashes, np.cumsum(counts)[:-1])
            lo = hi
        return out

    def stretches(self, tokens: np.ndarray, bases: int = 2) -> Stretches:
        values = (tokens, mix(tokens + np.uint64(1))) if self.words else (BYTE_VALUES[0][tokens], BYTE_VALUES[1][tokens])
        return Stretches(values[:bases])


def _pieces(raw: bytes, size: int) -> Iterator[bytes]:
    """Parts of about ``size`` bytes, cut where a word ends."""
    at = 0
    while at < len(raw):
        to = at + size
        while to < len(raw) and raw[to] not in b" \t\n\x0b\x0c\r":
            to += 1
        yield raw[at:to]
        at = to


BYTES = Order(400, 320, 64, 24)
WORDS = Order(50, 40, 8, 4, words=True, across=True)


def representatives(order: Order, texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Rows of neighbouring suffixes: which text, the first and last start, where their representative is, the digit."""
    parts = []
    bunch: list[tuple[int, int, np.ndarray]] = []
    size = 0
    for t, tokens in enumerate(texts):
        for at in range(0, len(tokens) - order.length + 1, order.chunk):
            piece = tokens[at : at + order.chunk + order.length - 1]
            if size + len(piece) > order.chunk and bunch:
                parts.append(_representatives(order, bunch))
                bunch, size = [], 0
            bunch.append((t, at, piece))
            size += len(piece)
    if bunch:
        parts.append(_representatives(order, bunch))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else tuple(np.zeros(0, np.int64) for _ in range(5))


def _representatives(order: Order, bunch: list[tuple[int, int, np.ndarray]]) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(b) for _, _, b in bunch])
    data = np.concatenate([b for _, _, b in bunch])
    begin = np.cumsum(sizes) - sizes
    held = order.stretches(data, 1)
    at = np.arange(len(data) - order.gram + 1)
    gram = held.get(0, at, at + order.gram)
    ranked = (gram & ~_PLACE) | at.astype(np.uint64)  # of equal grams the leftmost
    width = order.sample
    padded = np.full(-(-len(ranked) // width) * width + width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(ranked)] = ranked
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, 1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    starts = np.concatenate([np.arange(b, b + n - order.length + 1) for b, n in zip(begin, sizes)])
    place = (np.minimum(right[starts], left[starts + width - 1]) & _PLACE).astype(np.int64)
    edge = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1))
    first, last, place = starts[edge], starts[np.append(edge[1:], len(starts)) - 1], place[edge]
    which = np.searchsorted(begin, first, "right") - 1
    shift = np.array([at for _, at, _ in bunch])[which] - begin[which]
    digit = held.get(0, place, place + order.digit).view(np.int64)
    return np.array([t for t, _, _ in bunch])[which], first + shift, last + shift, place + shift, digit


def _first_digit(order: Order):
    """Rows (key, first, last, place, digit) of texts (key, text)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for lo in range(0, len(pdf), 512):
                part = pdf.iloc[lo : lo + 512]
                text, first, last, place, digit = representatives(order, order.tokens([bytes(t) for t in part["text"]]))
                yield pd.DataFrame({"key": part["key"].to_numpy()[text], "first": first, "last": last, "place": place, "digit": digit})

    return run


def _gathered(parts: Iterator[dict[str, np.ndarray]], key: str = "key", rows: int = 100_000) -> Iterator[pd.DataFrame]:
    """Columns of many texts in one frame; ``key`` is one value a part."""
    held: list[dict] = []
    size = 0

    def out() -> pd.DataFrame:
        columns = {c: np.concatenate([p[c] for p in held]) for c in held[0] if c != key}
        keys = np.empty(len(held), object)
        keys[:] = [p[key] for p in held]
        return pd.DataFrame({key: np.repeat(keys, [len(p["first"]) for p in held])} | columns)

    for part in parts:
        held.append(part)
        size += len(part["first"])
        if size >= rows:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _segments(order: Order, frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Of each text with rows (first, last, ...): its key, where a segment begins, hashes of its stretches, and the segment's rows in order."""
    for pdf in frames:
        texts = order.tokens([bytes(t) for t in pdf["text"]])
        for key, tokens, *columns in zip(pdf["key"], texts, *(pdf[c] for c in pdf.columns[2:])):
            rows = np.stack(columns, 1)
            rows = rows[np.argsort(rows[:, 0], kind="stable")]
            a = 0
            while a < len(rows):  # rows do not overlap
                at = rows[a, 0]
                b = max(a + 1, int(np.searchsorted(rows[:, 1], at + order.chunk)))
                yield key, at, order.stretches(tokens[at : rows[b - 1, 1] + order.length]), rows[a:b]
                a = b


def _second_digit(order: Order):
    """Rows (node, content, key, first, last): group, what their suffixes hold together, and where, for stretches of offsets."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for key, at, held, rows in _segments(order, frames):
            first, last, place, digit = rows.T
            near, far = place - last, place - first
            j0, count = near // order.block, far // order.block - near // order.block + 1
            row = np.repeat(np.arange(len(rows)), count)
            j = j0[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            lo, hi = np.maximum(near[row], j * order.block), np.minimum(far[row], (j + 1) * order.block - 1)
            p = place[row] - at
            core = held.get(0, p - j * order.block, p - (j + 1) * order.block + 1 + order.length)
            node = mix(digit.view(np.uint64)[row] + mix(core + j.astype(np.uint64)))
            content = mix(held.get(1, p - hi, p - lo + order.length) + lo.astype(np.uint64) * np.uint64(4096) + hi.astype(np.uint64))
            yield {"key": key, "node": node.view(np.int64), "content": content.view(np.int64), "first": p - hi + at, "last": p - lo + at}

    return lambda frames: _gathered(run(frames))


def _windows(order: Order):
    """A row (w0, w1, key, first) for each suffix that starts in the stretches given."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for key, at, held, rows in _segments(order, frames):
            first, n = rows[:, 0], rows[:, 1] - rows[:, 0] + 1
            x = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) - at
            yield {"key": key, "w0": held.get(0, x, x + order.length).view(np.int64), "w1": held.get(1, x, x + order.length).view(np.int64), "first": x + at}

    return lambda frames: _gathered(run(frames))


def _repeated(texts: DataFrame, order: Order, passing: list[str]) -> DataFrame:
    """(key, los, his): by text, the stretches of its tokens that windows which occur elsewhere cover."""
    raw = texts.select("key", "text")
    # A text's rows are some for every ``block`` of its own tokens at most, so no more than the text.
    met = lambda rows, *names: raw.join(rows.groupBy("key").agg(*[F.collect_list(n).alias(n) for n in names]).hint("merge"), "key")
    rows = cut(raw.mapInPandas(_first_digit(order), "key binary, first long, last long, place long, digit long"), passing)
    # Cut, so that the join reads both sides by shuffle and a frequent digit can be split among tasks.
    groups = cut(rows.groupBy("digit").count().where("count > 1").select("digit"), passing)
    alive = rows.join(groups.hint("merge"), "digit")
    split = cut(met(alive, "first", "last", "place", "digit").mapInPandas(_second_digit(order), "node long, content long, key binary, first long, last long"), passing)

    here = F.xxhash64("key", "first")
    elsewhere = F.min(F.xxhash64("key")) != F.max(F.xxhash64("key")) if order.across else F.count(F.lit(1)) > 1
    kinds = split.groupBy("node", "content").agg(elsewhere.alias("done"), F.min(here).alias("one"))
    nodes = kinds.groupBy("node").agg(F.count(F.lit(1)).alias("kinds"))
    told = cut(kinds.join(nodes, "node").where("done OR kinds > 1"), passing)
    on = (F.col("kinds") > 1) & (~F.col("done") | (here == F.col("one")))
    marked = cut(split.join(told.hint("merge"), ["node", "content"]).select("key", "first", "last", "done", on.alias("on")), passing)
    single = cut(met(marked.where("on"), "first", "last").mapInPandas(_windows(order), "w0 long, w1 long, key binary, first long"), passing)
    twice = cut(single.groupBy("w0", "w1").agg(elsewhere.alias("done")).where("done").select("w0", "w1"), passing)
    found = single.join(twice.hint("merge"), ["w0", "w1"]).select("key", F.col("first").alias("lo"), (F.col("first") + order.length).alias("hi"))
    return _joined(marked.where("done").select("key", F.col("first").alias("lo"), (F.col("last") + order.length).alias("hi")).union(found))


def _joined(spans: DataFrame) -> DataFrame:
    """(key, los, his): spans that overlap or touch become one."""
    by_key = Window.partitionBy("key").orderBy("lo", "hi")
    reach = F.max("hi").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    begun = spans.withColumn("new", (F.coalesce(reach, F.lit(-1).cast("long")) < F.col("lo")).cast("long"))
    numbered = begun.withColumn("nth", F.sum("new").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("key", "nth").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    pairs = F.array_sort(F.collect_list(F.struct("lo", "hi")))
    return whole.groupBy("key").agg(pairs.alias("s")).select("key", F.col("s.lo").alias("los"), F.col("s.hi").alias("his"))


def _remove(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        rows = []
        for key, raw, copies, los, his, wlos, whis in zip(*(pdf[c] for c in ("key", "text", "copies", "los", "his", "wlos", "whis"))):
            raw = bytes(raw)
            n = len(raw)
            if copies > 1:
                spans, words = [(0, n)] * (n >= BYTES.length), len(raw.split())
                words = words if words >= WORDS.length else 0
            else:
                spans = list(zip(los.tolist(), his.tolist())) if los is not None else []
                words = int((whis - wlos).sum()) if wlos is not None else 0
            kept, at = hashlib.sha256(), 0
            for a, b in spans:
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            rows.append((key, n, sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [a for a, _ in spans], [b for _, b in spans], words))
        yield pd.DataFrame(rows, columns=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends", "n_shared_words"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row.

    doc_id, n_bytes, n_removed, n_spans, kept_sha256, the spans' starts and ends in bytes; n_shared_words: words in runs of
    50 or more that stand in another document too; shares_passage: whether there are any.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    source = docs.select(F.col(id_col).alias("doc_id"), _key(raw).alias("key"), raw.alias("text"))
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = source.groupBy("key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    # Bucketed by key, so that the passes bring their rows to the texts and the texts stay.
    name = f"texts_{uuid.uuid4().hex}"
    path, passing, held = f"{shared_dir(spark)}/{name}", [], []
    try:
        distinct.repartition(slots, "key").write.bucketBy(slots, "key").sortBy("key").option("path", path).option("compression", "zstd").saveAsTable(name)
        texts = spark.table(name)
        hits = []
        for order in (BYTES, WORDS):
            hits.append(cut(_repeated(texts, order, passing), held))
            delete(spark, passing)
        words = hits[1].select("key", F.col("los").alias("wlos"), F.col("his").alias("whis"))
        schema = "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>, n_shared_words long"
        both = texts.join(hits[0].hint("merge"), "key", "left").join(words.hint("merge"), "key", "left")
        judged = cut(both.select("key", "text", "copies", "los", "his", "wlos", "whis").mapInPandas(_remove, schema))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(spark, [path, *passing, *held])
    return source.select("doc_id", "key").join(judged.hint("merge"), "key").drop("key").withColumn("shares_passage", F.col("n_shared_words") > 0)


def _key(raw: Column) -> Column:
    return F.substring(F.unhex(F.sha2(raw, 256)), 1, 16)
