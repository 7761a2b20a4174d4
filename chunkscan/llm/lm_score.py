"""Scores of texts under a log-bilinear language model fitted by noise-contrastive estimation.

Tokens are words, ASCII letters in lower case, and one end a text. Tokens are told apart by 64-bit
hashes. Units of the model are the end, every word with at least ``LEAST`` training tokens, and
buckets of all rarer words by hash, one for each ``BUCKET`` of their training tokens; so units grow
with the corpus. In a bucket a word's share is its count plus one.

A unit is scored after the ``CONTEXT`` units before it. Units are leaves of a tree; at each of its
``LEVELS`` levels a node has a log-bilinear score among its sisters, and a softmax over these few
normalises exactly, at a cost of the cube root of the units.

Noise-contrastive estimation makes one pass over all windows of the training rows, in ``ROUNDS``
parts. Each task goes through its rows in steps of ``BATCH`` windows, runs of ``RUN`` neighbours
drawn from all over a chunk; after each part, changes are averaged by how many steps made them. Every worker holds all units' numbers, some 400 bytes a unit
while it learns.

Counts of the ``HEAD`` commonest words, a fixed bound, go to all workers; other words of a text meet
their counts in a join, where no key is frequent.

Odd cases: null and empty texts are one end; rows without an id are scored, not learnt from; with
nothing to learn from every count is 0; rows repeated with one id are all counted; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkscan.llm.common import cut, setting
from chunkscan.llm.hashing import word_hashes

#: Units of a model made without counts; numbers a unit; words with counts that all workers hold.
CLASSES, DIMENSION, HEAD = 2048, 24, 1 << 20
#: Words before a word that it depends on; count from which a word is a unit; training tokens a bucket of rarer words.
CONTEXT, LEAST, BUCKET = 3, 64, 1024
LEVELS, ROUNDS, BLOCK = 3, 3, 4096
END = 1
#: The end's place among the hashes.
END_HASH = np.uint64(0x656E64)
STEPS, BATCH, NOISE, RATE = 1500, 2048, 2, 0.05
#: Neighbouring windows that go into one step together.
RUN = 8
#: Bytes of text handled at once; distinct tokens that a task gathers before it passes them on.
CHUNK, GATHER = 1 << 21, 2_000_000
#: Bytes of text hashed at once, whose arrays stay in a CPU's cache.
PIECE = 1 << 16
#: Bytes from which a frame that goes to a worker is full; Spark's own bounds are 10,000 rows and 64 MB.
FRAME = 8 << 20


def _chunks(pdf: pd.DataFrame) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, hashes of its tokens with ends, and tokens by row."""
    pieces, raws, held, size, lo = [], [], 0, 0, 0
    for hi, text in enumerate([*pdf["text"], None], 0):
        raw = (text or "").encode("utf-8", "surrogatepass").lower()
        full = hi > lo and (hi == len(pdf) or size + len(raw) > CHUNK)
        if raws and (full or held + len(raw) > PIECE):
            hashes, counts = word_hashes(raws)
            pieces.append((np.insert(hashes, np.cumsum(counts), END_HASH), counts + 1))
            raws, held = [], 0
        if full:
            yield lo, hi, *map(np.concatenate, zip(*pieces))
            pieces, size, lo = [], 0, hi
        raws.append(raw)
        held += len(raw) + 1
        size += len(raw) + 1


def _add_up(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first, axis=0) if len(first) else values


def _count_tokens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(h, c, every): of each token, its count in training rows and in all rows of some stretch."""
    keys, values, size = [], [], 0

    def out() -> pd.DataFrame:
        k, v = _add_up(np.concatenate(keys), np.concatenate(values))
        return pd.DataFrame({"h": k.view(np.int64), "c": v[:, 0], "every": v[:, 1]})

    for pdf in frames:
        learn = ~pdf["held_out"].to_numpy(bool)
        for lo, hi, tokens, counts in _chunks(pdf):
            for mask, column in ((np.repeat(learn[lo:hi], counts), [1, 1]), (np.repeat(~learn[lo:hi], counts), [0, 1])):
                k, n = np.unique(tokens[mask], return_counts=True)
                keys.append(k)
                values.append(n[:, None] * np.array(column))
                size += len(k)
        if size > GATHER:
            merged = _add_up(np.concatenate(keys), np.concatenate(values))
            keys, values, size = [merged[0]], [merged[1]], len(merged[0])
            if size > GATHER // 2:
                yield out()
                keys, values, size = [], [], 0
    if keys:
        yield out()


def _distinct(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens in order, and the place of each token among them."""
    codes, distinct = pd.factorize(tokens)
    order = np.argsort(distinct)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], place[codes]


def _find(distinct: np.ndarray, words: np.ndarray, ids: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit of each token, and which bucket of rare words it is in (-1: none); both arrays sorted."""
    at = np.minimum(np.searchsorted(words, distinct), len(words) - 1)
    own = words[at] == distinct
    bucket = np.where(own, -1, distinct.view(np.int64) % len(buckets))
    return np.where(own, ids[at], buckets[bucket]), bucket


def _before(units: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """The ``CONTEXT`` units before each token, nearest first; ends stand before a first word."""
    place = np.arange(len(units)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = np.full((len(units), CONTEXT), end, units.dtype)
    for j in range(CONTEXT):
        inside = place > j
        out[inside, j] = units[np.flatnonzero(inside) - j - 1]
    return out


def _runs(units: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows in runs of ``RUN``: lines of ``CONTEXT`` units before a run and its own; and which of these are tokens.

    Before each text stand ``CONTEXT`` ends, of which the last may be the end of the text before.
    """
    gaps = np.repeat(np.cumsum(counts) - counts, CONTEXT - 1)
    fill = -(len(units) + len(gaps) - (CONTEXT - 1)) % RUN
    stream = np.concatenate([[end], np.insert(units, gaps, end), np.full(fill, end)])
    real = np.concatenate([[False], np.insert(np.ones(len(units), bool), gaps, False), np.zeros(fill, bool)])
    lines = np.lib.stride_tricks.sliding_window_view(stream, CONTEXT + RUN)[::RUN]
    return lines, real[CONTEXT:].reshape(len(lines), RUN)


def _order(rows: np.ndarray) -> np.ndarray:
    """Places of ``rows`` in order, by numpy's radix sort of 16-bit digits."""
    order = np.argsort((rows & 0xFFFF).astype(np.uint16), kind="stable")
    high = rows >> 16
    while high.any():
        order = order[np.argsort((high & 0xFFFF).astype(np.uint16)[order], kind="stable")]
        high >>= 16
    return order


def _scatter(rows: np.ndarray, grads: np.ndarray, scale: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``rows`` and the sums of their gradients.

    With ``scale``, each line of ``grads`` is for equally many rows in turn, times their ``scale``, which is itself the last column.
    """
    order = _order(rows)
    at = rows[order]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    lines = np.take(grads, order // (len(rows) // len(grads)), axis=0)
    if scale is not None:
        scale = scale[order]
        lines *= scale[:, None]
    # Pairs of floats are added as one complex number, which takes half the time.
    sums = np.add.reduceat(lines.view(np.complex64), first, axis=0).view(np.float32)
    return at[first], sums if scale is None else np.column_stack([sums, np.add.reduceat(scale, first)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.negative(np.maximum(x, -30, out=x), out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class LogBilinear:
    """Units in the order of their counts are leaves of a tree of ``LEVELS`` levels with ``fan`` children a node.

    A node n scores t_n . (sum_j C_j r_vj) + b_n among its sisters. Its bias is the last column of t.
    """

    def __init__(self, words: np.ndarray, ids: np.ndarray, buckets: np.ndarray | None = None, mass: np.ndarray | None = None, end: int = END):
        rng = np.random.default_rng(11)
        self.words, self.ids, self.end = words, ids, end
        self.buckets = np.zeros(1, np.int64) if buckets is None else buckets
        self.mass(np.ones(CLASSES) if mass is None else mass)
        self.r = rng.normal(0, 0.1, (self.units, DIMENSION)).astype(np.float32)
        self.c = np.stack([np.eye(DIMENSION, dtype=np.float32) / (j + 1) for j in range(CONTEXT)])

    def mass(self, mass: np.ndarray) -> None:
        """Sets the tree's biases to the log share of each node among its sisters."""
        rng = np.random.default_rng(12)
        self.units = len(mass)
        self.fan = max(2, next(f for f in range(1, self.units + 2) if f**LEVELS >= self.units))
        levels = []
        for level in range(LEVELS):
            start = np.arange(0, self.units, self.fan ** (LEVELS - 1 - level))
            own = np.add.reduceat(mass + 0.5, start)
            parent = np.arange(len(own)) // self.fan
            bias = np.log(own / np.bincount(parent, own)[parent])
            levels.append(np.column_stack([rng.normal(0, 0.1, (len(own), DIMENSION)), bias]).astype(np.float32))
        self.t, self.edges = np.concatenate(levels), np.cumsum([0, *map(len, levels)])

    def parts(self) -> list[np.ndarray]:
        return [self.r, self.t, self.c.reshape(CONTEXT, -1)]

    def learn(self, before: np.ndarray, unit: np.ndarray, squares: list[np.ndarray], rate: float, rng: np.random.Generator, seen: list[np.ndarray] | None = None) -> None:
        """One step over single windows."""
        self.learn_runs(np.column_stack([before[:, ::-1], unit]), np.ones((len(unit), 1), bool), squares, rate, rng, seen)

    def learn_runs(self, stream: np.ndarray, real: np.ndarray, squares: list[np.ndarray], rate: float, rng: np.random.Generator, seen: list[np.ndarray] | None = None) -> None:
        """One Adagrad step, with one sum of squares a row, of noise-contrastive estimation: at each level the true node against ``NOISE`` of its sisters,
        drawn for each window, at the top level against the mean of all draws.

        A line of ``stream`` holds ``CONTEXT`` units and the units of a run of windows, of which those that are ``real`` count.
        A unit of a run is looked up, and changed, once for all windows that it stands before.
        """
        length, near = real.shape[1], stream[:, :-1]
        around, mixing = np.take(self.r, near.ravel(), axis=0), np.hstack(self.c)
        mixed = (around @ mixing).reshape(*near.shape, CONTEXT, DIMENSION)
        lines, unit = np.flatnonzero(real), stream[:, CONTEXT:][real]
        wide = np.ones((len(unit), DIMENSION + 1), np.float32)
        wide[:, :DIMENSION] = sum(mixed[:, CONTEXT - 1 - j : CONTEXT - 1 - j + length, j] for j in range(CONTEXT)).reshape(-1, DIMENSION)[lines]
        width, count, every = 1 + NOISE, len(unit), np.arange(len(unit))
        rows, x = np.empty((count, (LEVELS - 1) * width), np.int64), np.empty((count, (LEVELS - 1) * width), np.float32)
        for level in range(1, LEVELS):
            start, size = int(self.edges[level]), int(self.edges[level + 1] - self.edges[level])
            node = unit // self.fan ** (LEVELS - 1 - level)
            first = node // self.fan * self.fan
            sisters = np.minimum(size - first, self.fan)[:, None]
            noise = (rng.random((count, NOISE), np.float32) * sisters).astype(np.int64)
            at = (level - 1) * width
            rows[:, at] = node + start
            rows[:, at + 1 : at + width] = np.minimum(noise, sisters - 1) + (first + start)[:, None]
            x[:, at : at + width] = np.log(sisters / NOISE)
        got = np.take(self.t, rows, axis=0)
        x += np.einsum("bkd,bd->bk", got, wide)
        g = -_sigmoid(x)
        g[:, ::width] += 1
        # The top level has few nodes, common to all windows: by products of whole matrices, each counts as often as it is drawn on average.
        top, node = self.t[: self.edges[1]], unit // self.fan ** (LEVELS - 1)
        spread = wide @ top.T
        spread += np.float32(np.log(len(top) / NOISE))
        true = 1 - _sigmoid(spread)[every, node]
        spread *= np.float32(-NOISE / len(top))
        spread[every, node] += true
        g_hidden = spread @ top[:, :DIMENSION] + np.matmul(g[:, None, :], got)[:, 0, :DIMENSION]
        below = _scatter(rows.ravel(), np.ascontiguousarray(wide[:, :DIMENSION]), g.ravel())
        g_t = np.append(np.arange(len(top)), below[0]), np.concatenate([spread.T @ wide, below[1]])
        g_run = np.zeros((real.size, DIMENSION), np.float32)
        g_run[lines] = g_hidden
        g_mixed = np.zeros_like(mixed)
        for j in range(CONTEXT):
            g_mixed[:, CONTEXT - 1 - j : CONTEXT - 1 - j + length, j] = g_run.reshape(*real.shape, DIMENSION)
        g_mixed = g_mixed.reshape(len(around), -1)
        g_c = (around.T @ g_mixed).reshape(DIMENSION, CONTEXT, DIMENSION).swapaxes(0, 1).reshape(CONTEXT, -1)
        steps = [_scatter(near.ravel(), g_mixed @ mixing.T), g_t, (np.arange(CONTEXT), g_c)]
        for k, (part, square, (rows, g)) in enumerate(zip(self.parts(), squares, steps)):
            g /= len(unit)
            total = square[rows] + np.einsum("rd,rd->r", g, g) / g.shape[1]
            square[rows] = total
            g *= (rate / np.sqrt(total))[:, None]
            g += np.take(part, rows, axis=0)
            part[rows] = g
            if seen is not None:
                seen[k][rows] += 1

    def squares(self) -> list[np.ndarray]:
        return [np.full(len(x), 1e-6, np.float32) for x in self.parts()]

    def copied(self) -> "LogBilinear":
        """Own numbers to learn with; words and their units stay shared."""
        out = copy.copy(self)
        out.r, out.t, out.c = self.r.copy(), self.t.copy(), self.c.copy()
        return out

    def fit(self, cells: np.ndarray, counts: np.ndarray) -> "LogBilinear":
        """Learns from counts of pairs (cell: unit before times ``CLASSES``, plus unit); farther places hold the end."""
        rng = np.random.default_rng(13)
        before, word = cells // CLASSES, cells % CLASSES
        self.mass(np.bincount(word, counts, CLASSES))
        if not len(cells):
            return self
        cum, squares = np.cumsum(counts, dtype=np.float64), self.squares()
        for step in range(STEPS):
            pick = np.searchsorted(cum, rng.random(BATCH) * cum[-1], "right")
            around = np.full((BATCH, CONTEXT), self.end)
            around[:, 0] = before[pick]
            self.learn(around, word[pick], squares, RATE * (1 - step / STEPS) + 1e-3, rng)
        return self

    def hidden(self, before: np.ndarray) -> np.ndarray:
        out = np.ones((len(before), DIMENSION + 1), np.float32)
        mixing = self.c.reshape(-1, DIMENSION)
        for lo in range(0, len(before), BLOCK):  # of a size that stays in a CPU's cache
            out[lo : lo + BLOCK, :DIMENSION] = np.take(self.r, before[lo : lo + BLOCK], axis=0).reshape(-1, len(mixing)) @ mixing
        return out

    def log_p(self, before: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """log10 P(unit | units before), normalised: a softmax among sisters at each level."""
        out, order = np.zeros(len(unit)), _order(unit)
        unit, wide = unit[order], self.hidden(np.take(before, order, axis=0))
        ones, lines = np.ones(self.fan, np.float32), np.arange(BLOCK)
        share = np.empty(len(unit), np.float32)
        for level in range(LEVELS):
            t = self.t[self.edges[level] : self.edges[level + 1]]
            node = unit // self.fan ** (LEVELS - 1 - level)
            parent = node // self.fan
            edges = [*np.flatnonzero(np.append(True, parent[1:] != parent[:-1])).tolist(), len(unit)]
            place = node - parent * self.fan
            for lo, hi in zip(edges[:-1], edges[1:]):
                first = int(parent[lo]) * self.fan
                sisters = t[first : first + self.fan].T
                for at in range(lo, hi, BLOCK):
                    to = min(at + BLOCK, hi)
                    x = wide[at:to] @ sisters
                    if x.max() > 80 or x.min() < -80:  # exp would not hold it: each line's top is taken off
                        x = np.maximum(x - x.max(1, keepdims=True), -80)
                    np.exp(x, out=x)
                    share[at:to] = x[lines[: to - at], place[at:to]] / (x @ ones[: x.shape[1]])
            out += np.log(share)
        out[order] = out.copy()
        return out / np.log(10)

    def table(self) -> np.ndarray:
        """log10 P(unit | unit before it, ends before that) of all pairs."""
        around = np.full((self.units, CONTEXT), self.end)
        around[:, 0] = np.arange(self.units)
        return np.stack([self.log_p(around, np.full(self.units, u)) for u in range(self.units)], 1)


def _train(shared, rate: float):
    """Rows (part, block, blob): of each part's rows that a task changed, steps that did and change times steps."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, model = shared.value.parts(), shared.value.copied()
        squares = model.squares()
        seen = [np.zeros(len(x), np.float32) for x in start]
        rng = np.random.default_rng(17)
        for pdf in frames:
            for _, _, tokens, counts in _chunks(pdf):
                distinct, back = _distinct(tokens)
                unit = _find(distinct, model.words, model.ids, model.buckets)[0][back]
                stream, real = _runs(unit, counts, model.end)
                mixed = rng.permutation(len(stream))
                for lo in range(0, len(stream), BATCH // RUN):
                    model.learn_runs(stream[mixed[lo : lo + BATCH // RUN]], real[mixed[lo : lo + BATCH // RUN]], squares, rate, rng, seen)
        for k, (x, old, n) in enumerate(zip(model.parts(), start, seen)):
            for b in range(0, len(x), BLOCK):
                m = n[b : b + BLOCK, None]
                if m.any():
                    yield pd.DataFrame({"part": [k], "block": [b // BLOCK], "blob": [np.hstack([m, (x[b : b + BLOCK] - old[b : b + BLOCK]) * m]).astype("<f4").tobytes()]})

    return run


def _merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, "<f4").astype(np.float64) for x in sorted(map(bytes, pdf["blob"])))
    return pd.DataFrame({"part": [key[0]], "block": [key[1]], "blob": [total.astype("<f4").tobytes()]})


def _bounded(spark: SparkSession):
    """Frames of texts hold ``FRAME`` bytes and one row more at most, however long the rows are."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(FRAME))


def fit_model(model: LogBilinear, texts: DataFrame) -> LogBilinear:
    """One pass over all windows of the training rows in ``ROUNDS`` parts; after each, the tasks' changes are averaged."""
    sc, kind = texts.sparkSession.sparkContext, "part int, block int, blob binary"
    for k in range(ROUNDS):
        shared = sc.broadcast(model)
        some = texts.where(~F.col("held_out") & (F.pmod(F.xxhash64("text", F.lit("round")), F.lit(ROUNDS)) == k))
        some = some.select("text").coalesce(sc.defaultParallelism)
        merged = some.mapInPandas(_train(shared, RATE * (1 - k / ROUNDS)), kind).groupBy("part", "block").applyInPandas(_merge, kind)
        parts = model.parts()
        for part, block, blob in merged.toLocalIterator():
            x = parts[part][block * BLOCK : (block + 1) * BLOCK]
            got = np.frombuffer(bytes(blob), "<f4").reshape(len(x), -1)
            x += got[:, 1:] / np.maximum(got[:, :1], 1)
        shared.unpersist()
    return model


def score_texts(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    texts = source.select("held_out", "text")
    with _bounded(spark):
        counts = cut(texts.mapInPandas(_count_tokens, "h long, c long, every long").groupBy("h").agg(F.sum("c").alias("c"), F.sum("every").alias("every")))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()

    # The head: all tokens from a count up that at most HEAD tokens reach, from a histogram of a few hundred rows.
    level = F.floor(F.log2("every") * 16).cast("int")
    reached, floor_ = 0, None
    for bucket, n in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        if reached + n > HEAD:
            break
        reached, floor_ = reached + n, bucket
    head = counts.where(level >= floor_) if floor_ is not None else counts.where("false")
    got = head.select("h", "c").toArrow()
    hashes, known = got.column("h").to_numpy().view(np.uint64), got.column("c").to_numpy()
    order = np.argsort(hashes)
    hashes, known = hashes[order], known[order]
    del got

    own = counts.where(F.col("c") >= LEAST).where(F.col("h") != int(END_HASH)).select("h", "c").toArrow()
    words, mass = own.column("h").to_numpy().view(np.uint64), own.column("c").to_numpy()
    del own
    end_count = counts.where(F.col("h") == int(END_HASH)).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    words, mass = np.append(words, END_HASH), np.append(mass, end_count)
    size = max(1, (total - int(mass.sum())) // BUCKET)
    rare_words = counts.where((F.col("c") > 0) & (F.col("c") < LEAST) & (F.col("h") != int(END_HASH)))
    got = rare_words.groupBy(F.pmod("h", F.lit(size)).alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).toArrow()
    in_bucket, kinds = np.zeros(size, np.int64), np.zeros(size, np.int64)
    in_bucket[got.column("k").to_numpy()], kinds[got.column("k").to_numpy()] = got.column("c").to_numpy(), got.column("n").to_numpy()
    mass = np.concatenate([mass, in_bucket])
    ranked = np.lexsort((np.append(words, np.arange(size, dtype=np.uint64)), -mass))
    place = np.empty(len(mass), np.int64)
    place[ranked] = np.arange(len(mass))
    order = np.argsort(words)
    model = LogBilinear(words[order], place[: len(words)][order], place[len(words) :], mass[ranked], int(place[len(words) - 1]))
    if total:
        with _bounded(spark):
            model = fit_model(model, texts)
    log_base, log_bucket = float(np.log10(total + distinct + 1)), np.log10(in_bucket + kinds + 1.0)
    shared = spark.sparkContext.broadcast((hashes, known, model, log_bucket))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, known, model, log_bucket = shared.value
        log_known = np.log10(known + 1.0)
        for pdf in frames:
            for lo, hi, tokens, sizes in _chunks(pdf):
                distinct, back = _distinct(tokens)
                at = np.minimum(np.searchsorted(hashes, distinct), max(len(hashes) - 1, 0))
                inside = hashes[at] == distinct if len(hashes) else np.zeros(len(distinct), bool)
                rare = np.where(inside, log_known[at], 0) if len(hashes) else np.zeros(len(distinct))
                seen = inside & (known[at] > 0) if len(hashes) else inside
                unit, bucket = _find(distinct, model.words, model.ids, model.buckets)
                # A rare word's count may be out of the head; the join below then adds it.
                share = np.where(bucket >= 0, rare - log_bucket[bucket], 0)
                inside, rare, seen, share, unit = inside[back], rare[back], seen[back], share[back], unit[back]
                lm = model.log_p(_before(unit, sizes, model.end), unit) + share
                first = np.cumsum(sizes) - sizes
                lost = np.split(tokens[~inside].view(np.int64), np.cumsum(np.add.reduceat(~inside, first, dtype=np.int64))[:-1])
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].to_numpy()[lo:hi], "held_out": pdf["held_out"].to_numpy()[lo:hi], "n_tokens": sizes,
                    "n_known": np.add.reduceat(seen, first, dtype=np.int64), "base": np.add.reduceat(rare, first), "lm": np.add.reduceat(lm, first), "lost": lost,
                })

    scored = source.mapInPandas(score, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base double, lm double, lost array<long>")
    with _bounded(spark):
        scored = cut(scored.withColumn("rid", F.monotonically_increasing_id()))
    lost = scored.select("rid", F.explode("lost").alias("h"))
    tail = counts.where(level < floor_) if floor_ is not None else counts
    met = lost.join(tail.where("c > 0").select("h", "c").hint("merge"), "h")
    more = met.groupBy("rid").agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count(F.lit(1)).alias("also"))
    both = scored.drop("lost").join(more, "rid", "left")
    extra = F.coalesce("more", F.lit(0.0))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * log_base).alias("base_score"), (F.col("lm") + extra).alias("score"),
    )
