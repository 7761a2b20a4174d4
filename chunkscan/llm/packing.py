"""Best-fit packing by a configuration linear program over the length histogram.

1. Each text becomes token ids and an end id; a longer one than the capacity is cut into pieces.
2. The histogram of piece lengths, at most one entry for each length up to the capacity, goes to the
   driver. Columns of the linear program are configurations: multisets of lengths that fit. Each length's
   pieces are to be covered, with as little total use of columns as can be.
3. Multiplicative weights solve it: each length has a weight, which shrinks by exp(-``RATE``) for the
   share of its pieces that a round covers. Weights times lengths are prices; a knapsack dynamic program
   over the capacity prices every room, and the round's answer is a set of columns led by it that uses no
   piece twice. A round covers no length more than once, so the mean of the rounds'
   answers is the fractional solution; prices also bound the optimum from below (the dual).
4. Columns are rounded by decreasing use: what is whole, then one more for what is left over, as far as
   pieces are left. The program is solved again for the pieces that remain, later with columns that leave
   some tokens free (``SLACK``); a last remainder is packed by decreasing best fit.
5. The plan is a bounded list of (configuration, times). The k-th piece of a length, counted by
   partition and then within it, finds its sequence and offset by arithmetic on that list.

Odd cases: null and empty texts are one end id; rows repeated with one id are packed each; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import gc
import os
import zlib
from collections import Counter
from collections.abc import Iterator
from struct import pack
from unicodedata import category, is_normalized, normalize

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkscan.llm.common import cut, remembered

CAPACITY, END_ID = 4096, 1
#: Pricing rounds of a linear program; free tokens that a column of each of the programs may have; rooms are priced anew so often a round.
ROUNDS, SLACK, FRESH = 6, (0, 0, 0, 2, 64, 4096), 12
#: How sharply weights follow what was covered; how much longer pieces are preferred at first; loss by free tokens.
RATE, BIAS, WASTE = 0.02, 0.05, 4.0
#: Words, and stems of words, whose ids a worker remembers.
REMEMBERED, STEMS = 1_000_000, 1_000_000
#: Marks that may close a word and that no contraction starts with.
CLOSING = ".,;:!?*#$%&|"
#: str.split() parts words here, the tokenizer does not; such texts are encoded whole.
ODD_SPACE = "\x1c\x1d\x1e\x1f"
#: What follows the Latin letters.
LATIN_END = "\u0250"


def _byte_signs() -> dict[int, int]:
    """The sign that stands for each byte: printable ones for themselves, the others counted from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(hidden)}


BYTE_SIGNS = _byte_signs()


def _parted(stem: str) -> bool:
    """Whether the tokenizer parts ``stem`` from marks after it: normalised and in lower case it ends in a letter or number."""
    return stem[-1].isalnum() if stem.isascii() else category(normalize("NFC", stem).lower()[-1])[0] in "LN"


class WordEncoder:
    """Ids as little-endian uint32 bytes. The tokenizer drops white space and never joins across it, so words are encoded once each.

    It also parts letters and digits from what follows them, so closing marks are encoded on their own,
    and it lowers case, so words in ASCII are looked up in lower case.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Latin letters in lower case pass all steps before the merges unchanged, so they go straight there."""
        out: dict[str, bytes] = {}
        merge, slow = self.tokenizer.model.tokenize, []
        for w in words:
            if w.isascii() and w.isalpha() and w.islower():
                raw = w
            elif w and w.isalpha() and w.islower() and max(w) < LATIN_END and is_normalized("NFC", w):
                raw = w.encode().decode("latin-1").translate(BYTE_SIGNS)
            else:
                slow.append(w)
                continue
            ids = [t.id for t in merge(raw)]
            out[w] = pack(f"<{len(ids)}I", *ids)
        out.update(zip(slow, self._encode(slow)))
        return [out[w] for w in words]

    def _learn(self, words: set[str]) -> None:
        known, stems, later, new = self.known, self.stems, [], set()
        for word in words:
            stem = word.rstrip(CLOSING)
            tail = ""
            if len(stem) != len(word):
                if stem and _parted(stem):
                    tail = word[len(stem) :]
                else:
                    stem = word
            if stem.isascii() and "<|" not in stem:  # special tokens are matched as written
                stem = stem.lower()
            ids = stems.get(stem)
            if ids is not None and not tail:
                known[word] = ids
            elif ids is not None and tail in stems:
                known[word] = ids + stems[tail]
            else:
                later.append((word, stem, tail))
                new.add(stem)
                new.add(tail)
        fresh = list(new.difference(stems))
        stems.update(zip(fresh, self._encode_words(fresh)))
        for word, stem, tail in later:
            known[word] = stems[stem] + stems[tail] if tail else stems[stem]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if len(self.stems) > STEMS:
            self.stems.clear()
        split = [(t or "").split() for t in texts]
        self._learn(set().union(*split).difference(self.known))
        get = self.known.__getitem__
        out = [b"".join(map(get, ws)) for ws in split]
        odd = [i for i, t in enumerate(texts) if t and any(c in t for c in ODD_SPACE)]
        for i, ids in zip(odd, self._encode([texts[i] for i in odd])):
            out[i] = ids
        return out


def _encoder(path: str) -> WordEncoder:
    """One a worker process, so that what it knows outlives a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return remembered(f"tokens:{path}", lambda: WordEncoder(path))


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids (little-endian uint32)."""
    end = np.array([end_id], "<u4").tobytes()

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(tokenizer_path)
        gc.disable()  # there are no cycles here, and passes over a million words cost time
        try:
            for pdf in frames:
                for lo in range(0, len(pdf), 256):
                    part = pdf.iloc[lo : lo + 256]
                    rows = []
                    for doc_id, ids in zip(part["doc_id"], encoder.encode(part["text"].tolist())):
                        ids += end
                        for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                            one = ids[at : at + 4 * capacity]
                            rows.append((doc_id, k, at // 4, len(one) // 4, zlib.crc32(one), one))
                    yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
        finally:
            gc.enable()  # the worker goes on with other stages

    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInPandas(pieces, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, ids binary")


Config = tuple[tuple[int, int], ...]


def _price(value: np.ndarray, waste: float) -> np.ndarray:
    """Unbounded knapsack: the best worth with which pieces fill each room, at a loss of ``waste`` for a token left free."""
    capacity = len(value) - 1
    best = np.zeros(capacity + 1)
    for room in range(1, capacity + 1):
        best[room] = max((value[1 : room + 1] + best[room - 1 :: -1]).max(), best[room - 1] - waste)
    return best


def _next(worth: np.ndarray, best: np.ndarray, free: np.ndarray, rest: int, pairs: bool, least: float) -> int:
    """The piece that goes next into a room: the dearest by the prices of rooms or, with ``pairs``, one that fills it alone or with another (0: none)."""
    if pairs:
        if free[rest]:
            return rest
        both = worth[1:rest] + worth[rest - 1 : 0 : -1]
        if rest % 2 == 0 and free[rest // 2] < 2:
            both[rest // 2 - 1] = -np.inf
        if len(both) and both.max() > -np.inf:
            return int(both.argmax()) + 1
    total = worth[1 : rest + 1] + best[rest - 1 :: -1]
    n = int(total.argmax()) + 1
    return n if total[n - 1] >= least else 0


def _answer(left: np.ndarray, value: np.ndarray, best: np.ndarray, waste: float, slack: int) -> dict[Config, int]:
    """Sequences with at most ``slack`` free tokens that use no piece twice: from the longest length down, the dearest completion of the room.

    Prices of rooms grow stale as lengths are used up. A completion that so comes to nothing is tried once more with pieces that are
    surely there; if that fails too, rooms are priced anew, at most ``FRESH`` times, or the pieces wait for the next round and get dearer.
    """
    capacity = len(left) - 1
    free, worth, out = left.copy(), value.copy(), {}
    spent, often, pairs = 0, max(1, np.count_nonzero(left) // FRESH), False
    for length in np.flatnonzero(left)[::-1]:
        while free[length]:
            took: Counter = Counter()
            rest, n = capacity, int(length)
            while n:
                took[n] += 1
                free[n] -= 1
                if not free[n]:
                    worth[n] = -np.inf
                rest -= n
                n = _next(worth, best, free, rest, pairs, -waste * (slack + 1)) if rest else 0
            if rest > slack:
                for n, c in took.items():
                    free[n] += c
                    worth[n] = value[n]
                if pairs and spent < often:
                    pairs = False
                    break
                if pairs:
                    best, spent = _price(worth, waste), 0
                pairs = not pairs
                continue
            pairs = False
            more = min(int(free[n]) // c for n, c in took.items())
            out[tuple(sorted(took.items(), reverse=True))] = 1 + more
            for n, c in took.items():
                free[n] -= c * more
                if not free[n]:
                    worth[n] = -np.inf
                    spent += 1
    return out


def solve_program(left: np.ndarray, slack: int = 0) -> tuple[dict[Config, float], float]:
    """Columns with at most ``slack`` free tokens and how often each is used, not rounded, and a lower bound of the number of sequences."""
    capacity = len(left) - 1
    size = np.arange(capacity + 1) / capacity
    weight, use, bound = 1 + BIAS * size, Counter(), float((left * size).sum())  # sizes are prices that bound it, too
    for _ in range(ROUNDS):
        price = size * weight
        value = np.where(left > 0, price, -np.inf)
        best = _price(value, WASTE / capacity)
        bound = max(bound, float((left * price).sum() / _price(value, 0.0)[capacity]))
        covered = np.zeros(capacity + 1)
        for config, times in _answer(left, value, best, WASTE / capacity, slack).items():
            use[config] += times
            for n, c in config:
                covered[n] += c * times
        weight *= np.exp(-RATE * covered / np.maximum(left, 1))
    return {c: n / ROUNDS for c, n in use.items()}, bound


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Config, int]]:
    """(configuration, times) pairs that use up the histogram exactly."""
    return _plan(histogram, capacity)[0]


def _plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[Config, int]], int, float]:
    """The plan, how many pieces the linear programs placed, and the first one's bound."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    plan: Counter = Counter()

    def use_up(config: Config, times: int) -> None:
        plan[config] += times
        for n, c in config:
            left[n] -= c * times

    bounds, whole = [], int(left.sum())
    for slack in SLACK:
        if not left.any():
            break
        use, bound = solve_program(left, min(slack, capacity))
        bounds.append(bound)
        for config, x in sorted(use.items(), key=lambda u: (-u[1], u[0])):
            times = min(int(np.ceil(x)), min(int(left[n]) // c for n, c in config))
            if times:
                use_up(config, times)
    placed = whole - int(left.sum())
    while left.any():
        took, rest = Counter(), capacity
        while True:
            fitting = np.flatnonzero(left[: rest + 1])[::-1]
            n = next((int(x) for x in fitting if left[x] > took[int(x)]), 0)
            if not n:
                break
            took[n] += min(int(left[n]) - took[n], rest // n) if took else 1
            rest = capacity - sum(a * b for a, b in took.items())
        use_up(tuple(sorted(took.items(), reverse=True)), min(int(left[n]) // c for n, c in took.items()))
    return sorted(plan.items(), key=lambda x: (-x[1], x[0])), placed, bounds[0] if bounds else 0.0


def _segments(plan: list) -> pd.DataFrame:
    """For each length, where its k-th pieces go: k in [lo, hi) to sequence base + (k - lo) div each, at offset + length * rest."""
    used: Counter = Counter()
    rows, base = [], 0
    for config, times in plan:
        offset = 0
        for length, each in config:
            rows.append((length, used[length], used[length] + each * times, base, each, offset))
            used[length] += each * times
            offset += length * each
        base += times
    return pd.DataFrame(rows, columns=["length", "lo", "hi", "base", "each", "at"]).astype("int64")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length`` and the rid of a cut) and sequence_id and offset."""
    spark = pieces.sparkSession
    part = F.shiftright("rid", 33)
    numbered = pieces.withColumn("part", part)
    counts = cut(numbered.groupBy("part", "length").count())
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("count")).collect()}  # one row a length, so capacity rows at most
    if not histogram:
        return pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    # Bounded by the columns that ROUNDS * len(SLACK) answers of at most some capacity each can have, whatever the number of rows.
    segments = spark.createDataFrame(pa.Table.from_pandas(_segments(plan_packing(histogram, capacity)), preserve_index=False))
    by_length = segments.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "base", "each", "at"))).alias("segs"))
    before = counts.selectExpr("part", "length", "sum(count) OVER (PARTITION BY length ORDER BY part) - count AS before")
    within = numbered.selectExpr("*", "row_number() OVER (PARTITION BY part, length ORDER BY rid) - 1 AS nth")
    # A merge join: the table of partitions and lengths grows with the corpus.
    k = within.join(before.hint("merge"), ["part", "length"]).withColumn("k", F.col("before") + F.col("nth"))
    found = k.join(F.broadcast(by_length), "length").withColumn("seg", F.expr("filter(segs, s -> s.lo <= k AND k < s.hi)[0]"))
    nth = F.expr("k - seg.lo")
    return found.withColumn("sequence_id", F.expr("seg.base + (k - seg.lo) DIV seg.each")).withColumn("offset", F.col("seg.at") + F.col("length") * (nth % F.col("seg.each"))).drop("part", "before", "nth", "k", "segs", "seg")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for."""
    pieces = tokenize(docs, tokenizer_path, id_col, text_col, capacity, end_id)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    kept = cut(pieces.select(*names, F.monotonically_increasing_id().alias("rid")))
    return place(kept, capacity).select(*names[:5], "sequence_id", "offset", *names[5:])
