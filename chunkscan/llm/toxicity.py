"""Toxicity by a support vector machine on a subsequence string kernel with Nystrom landmarks.

Units of a sentence are its words; letters set apart by spaces ("i d i o t") join into one unit, and
inside a unit punctuation vanishes, digits stand for the letters they imitate and accents fall away.
The kernel of two units sums, over all subsequences of three letters within a span of six, the
products of their weights ``DECAY`` ** (span - 3), and is normalised to 1 for equal units; gaps and
inserted letters only lower it. ``landmarks`` units span the Nystrom features
K_mm^(-1/2) k(x, landmarks), on which a linear SVM is trained with the hinge loss.

Labels belong to texts, insults to sentences, so training is by multiple instances: the units that
mark the toxic sentences are the positives; units of clean texts, those hardest to tell apart
included, are the negatives. A text scores by its highest unit through a logistic fitted on labels.

Fit on a bounded sample: at most about ``PER_CLASS`` labelled training texts of each class, in one
task. Scoring covers all rows and whole texts.

Odd cases: a null or empty text has the score of a text without units; a null label or id is not
learnt from; repeated labels of one id count as toxic if one is; without labels of both classes all
scores are 0; other columns are not looked at.
"""

from __future__ import annotations

import pickle
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkscan.llm.common import remembered

PER_CLASS = 1500
LANDMARKS = 1000
PENALTY = 1e-6
DECAY = 0.6
LETTERS, SPAN, WIDTH, CODES = 3, 6, 24, 32
#: Units scored at once, and scores that a worker remembers.
BLOCK, REMEMBERED = 10_000, 600_000
SPACED = re.compile(r"(?<!\S)(?:\w[ ]){3,}\w(?!\S)")
SENTENCE = re.compile(r"[.!?\n]+")
#: Digits that imitate letters (fixed values).
IMITATED = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
#: Offsets of the second and third letter of a subsequence.
GAPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def _code_table() -> np.ndarray:
    """Code of each character: 1 to 26 for Latin letters, 27 to 31 for others, 0 for none."""
    table = np.zeros(0x3000, np.int32)
    for point in range(len(table)):
        char = chr(point)
        char = IMITATED.get(char, char)
        base = unicodedata.normalize("NFKD", char)[:1]
        if "a" <= base <= "z":
            table[point] = ord(base) - 96
        elif char.isalnum():
            table[point] = 27 + point % 5
    return table


CODE = _code_table()


def units(text: str) -> set[str]:
    """Distinct units of a text, as written but in lower case."""
    low = text.lower()
    found = set(low.split())
    found.update(m.group().replace(" ", "") for m in SPACED.finditer(low))
    return found


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of letter codes, ``WIDTH`` wide, and which word each row is of; long words give overlapping rows."""
    points = np.frombuffer("\n".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = points == 10
    code = np.where(points < len(CODE), CODE[np.minimum(points, len(CODE) - 1)], 27 + (points % 5).astype(np.int32))
    word = np.cumsum(ends)
    live = (code > 0) & ~ends
    code, word = code[live], word[live]
    size = np.bincount(word, minlength=len(words))
    start = np.cumsum(size) - size
    half = WIDTH // 2
    pieces = np.maximum(1, -(-(size - half) // half))
    owner = np.repeat(np.arange(len(words)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = (start[owner] + nth * half)[:, None] + np.arange(WIDTH)
    inside = at < (start + size)[owner][:, None]
    padded = np.append(code, 0)
    return np.where(inside, padded[np.where(inside, at, len(code))], 0), owner


def subsequences(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all subsequences (0: none) and their weights; equal ones of a row are merged."""
    parts, weights = [], []
    for a, b in GAPS:
        x, y, z = rows[:, : WIDTH - b], rows[:, a : WIDTH - b + a], rows[:, b:]
        parts.append(np.where(z > 0, (x * CODES + y) * CODES + z, 0))
        weights.append(np.full(WIDTH - b, DECAY ** (b - 2)))
    code = np.concatenate(parts, 1)
    used = int((rows > 0).sum(1).max()) if len(rows) else 0
    if used < WIDTH:  # columns that no row of this block reaches
        keep = np.concatenate([np.arange(WIDTH - b) + b < used for _, b in GAPS])
        code, weight = code[:, keep], np.concatenate(weights)[keep]
    else:
        weight = np.concatenate(weights)
    if not code.shape[1]:
        return np.zeros((len(rows), 1), np.int32), np.zeros((len(rows), 1), np.float32)
    order = np.argsort(code, axis=1)
    code = np.take_along_axis(code, order, 1)
    value = weight.astype(np.float32)[order] * (code > 0)
    again = code[:, 1:] == code[:, :-1]
    if again.any():
        total = np.cumsum(value, 1, dtype=np.float64)
        last = np.append(~again, np.ones((len(code), 1), bool), 1)
        before = np.where(last, total, 0)
        before = np.maximum.accumulate(np.pad(before, ((0, 0), (1, 0)))[:, :-1], 1)
        value = np.where(last, total - before, 0).astype(np.float32)
    return code, value


class KernelSVM:
    """``weights``: what each subsequence adds to the decision, the landmarks' part folded in."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), bias
        self.slope, self.shift = 1.0, 0.0
        self.key = uuid.uuid4().hex

    def decide(self, words: list[str]) -> np.ndarray:
        out = np.empty(len(words), np.float32)
        by_size = sorted(range(len(words)), key=lambda i: len(words[i]))
        for lo in range(0, len(words), BLOCK):
            part = by_size[lo : lo + BLOCK]
            rows, owner = letters([words[i] for i in part])
            code, value = subsequences(rows)
            norm = np.sqrt((value * value).sum(1))
            got = (value * self.weights[code]).sum(1) / np.maximum(norm, 1e-6)
            best = np.full(len(part), -np.inf, np.float32)
            np.maximum.at(best, owner, got.astype(np.float32))
            out[part] = best + self.bias
        return out

    def score(self, top: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * top + self.shift, -30, 30)))


def _first_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Subsequences and normalised weights, one row a word (the first of a long one)."""
    rows, owner = letters(words)
    code, value = subsequences(rows[np.searchsorted(owner, np.arange(len(words)))])
    return code, value / np.maximum(np.sqrt((value * value).sum(1, keepdims=True)), 1e-6)


class _Marks:
    """Landmarks as rows over the subsequences that occur in any of them."""

    def __init__(self, words: list[str]):
        code, value = _first_rows(words)
        self.column = np.full(CODES**LETTERS, -1)
        used = np.unique(code[value > 0])
        self.column[used] = np.arange(len(used))
        self.used = used
        self.rows = self._fill(code, value)

    def _fill(self, code: np.ndarray, value: np.ndarray) -> np.ndarray:
        at = self.column[code]
        live = (at >= 0) & (value > 0)
        out = np.zeros((len(code), len(self.used)), np.float32)
        out[np.nonzero(live)[0], at[live]] = value[live]
        return out

    def kernel(self, words: list[str]) -> np.ndarray:
        parts = [self._fill(*_first_rows(words[lo : lo + 2000])) @ self.rows.T for lo in range(0, len(words), 2000)]
        return np.concatenate(parts)

    def weights(self, beta: np.ndarray) -> np.ndarray:
        out = np.zeros(CODES**LETTERS, np.float32)
        out[self.used] = beta @ self.rows
        return out


def _disturbed(words: list[str], rng: np.random.Generator) -> list[str]:
    """Each word once more with one letter put in, as a writer who hides it would."""
    out = []
    for w in words:
        at = int(rng.integers(1, max(2, len(w))))
        out.append(w[:at] + (w[at - 1] if rng.random() < 0.3 else chr(97 + int(rng.integers(26)))) + w[at:])
    return out


def _svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM by Newton steps on the squared hinge loss, both classes of equal weight."""
    n, m = x.shape
    cost = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    w, active = np.zeros(m + 1), np.ones(n, bool)
    for _ in range(40):
        left, right = np.diag(np.append(np.full(m, PENALTY), 1e-9)), np.zeros(m + 1)
        margin = np.empty(n)
        for lo in range(0, n, 2000):  # by blocks, so that the copies stay small
            rows = np.flatnonzero(active[lo : lo + 2000]) + lo
            z = np.concatenate([x[rows], np.ones((len(rows), 1))], 1, dtype=np.float64)
            za = z * cost[rows, None]
            left += z.T @ za
            right += za.T @ y[rows]
        w = np.linalg.solve(left, right)
        for lo in range(0, n, 2000):
            margin[lo : lo + 2000] = y[lo : lo + 2000] * (x[lo : lo + 2000] @ w[:-1] + w[-1])
        now = margin < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], float(w[-1])


def _surprise(in_toxic: int, in_clean: int, n_toxic: int, n_clean: int) -> float:
    """Chernoff bound of minus the log of the chance that so large a share of a unit's texts is toxic."""
    n, expected = in_toxic + in_clean, n_toxic / (n_toxic + n_clean)
    share = in_toxic / n
    if share <= max(expected, 0.75 * n_toxic / (0.75 * n_toxic + 0.25 * n_clean)):
        return 0.0
    rest = (1 - share) * np.log((1 - share) / (1 - expected)) if share < 1 else 0.0
    return n * (share * np.log(share / expected) + rest)


ROUNDS, POSITIVES = 5, 1500


def train(texts: list[str], toxic: np.ndarray, seed: int = 7) -> KernelSVM | None:
    """Fits on labelled texts."""
    n_pos, n_neg = int(toxic.sum()), int((~toxic).sum())
    if not n_pos or not n_neg:
        return None
    rng = np.random.default_rng(seed)
    held: tuple[Counter, Counter] = (Counter(), Counter())
    pool: dict[str, str] = {}  # one copy of each unit
    found = [{pool.setdefault(u, u) for u in units(t)} for t in texts]
    for us, label in zip(found, toxic):
        held[int(label)].update(us)
    every = len(held[1].keys() | held[0].keys())
    marking = [u for u, c in held[1].items() if len(u) >= LETTERS and _surprise(c, held[0][u], n_pos, n_neg) > np.log(20 * every)]
    marking.sort(key=lambda u: (-held[1][u], u))
    if not marking:
        marking = sorted(held[1], key=lambda u: (-_surprise(held[1][u], held[0][u], n_pos, n_neg), u))[:20]
    marks_set = set(marking)
    clean = sorted(u for u in held[0] if u not in marks_set)
    if not clean:
        return None
    # The toxic sentences' marking units, as often as they mark one.
    witnesses: Counter = Counter()
    for text, label in zip(texts, toxic):
        if label:
            for sentence in SENTENCE.split(text.lower()):
                witnesses.update(marks_set.intersection(units(sentence)))
    positive = [u for u in marking if witnesses[u]] or marking
    frequent = sorted(clean, key=lambda u: (-held[0][u], u))[: LANDMARKS // 3]
    weight = np.array([np.sqrt(witnesses[u] + 1) for u in positive])
    drawn = [positive[i] for i in rng.choice(len(positive), POSITIVES, p=weight / weight.sum())]
    hidden = _disturbed(drawn, rng)
    landmarks = set(positive[: LANDMARKS // 3]) | set(frequent) | set(hidden[: LANDMARKS // 6])
    landmarks |= {clean[i] for i in rng.permutation(len(clean))[: LANDMARKS - len(landmarks)]}
    marks = _Marks(sorted(landmarks))
    values, vectors = np.linalg.eigh((marks.rows @ marks.rows.T).astype(np.float64))
    live = values > 1e-4
    half = (vectors[:, live] / np.sqrt(values[live]) @ vectors[:, live].T).astype(np.float32)
    pos = marks.kernel(drawn + hidden) @ half
    fresh = sorted(set(frequent) | {clean[i] for i in rng.permutation(len(clean))[:6000]})
    seen, neg, model = set(fresh), marks.kernel(fresh) @ half, None
    for _ in range(ROUNDS):
        x = np.concatenate([pos, neg])
        y = np.concatenate([np.ones(len(pos)), -np.ones(len(neg))])
        theta, bias = _svm(x, y)
        model = KernelSVM(marks.weights(half @ theta), bias)
        hard = [clean[i] for i in np.argsort(-model.decide(clean))[:2500]]
        fresh = [u for u in hard if u not in seen]
        if not fresh:
            break
        seen.update(fresh)
        neg = np.concatenate([neg, marks.kernel(fresh) @ half])
    # Toxic texts without any marking unit are taken for mislabelled: no unit of theirs was learnt.
    told = np.array([not label or not marks_set.isdisjoint(us) for us, label in zip(found, toxic)])
    model.slope, model.shift = _logistic(tops(model, found)[told], toxic[told])
    return model


def tops(model: KernelSVM, found: list[set[str]]) -> np.ndarray:
    """Highest decision among each text's units; that of no unit is the bias."""
    every = sorted(set().union(*found)) if found else []
    known = dict(zip(every, model.decide(every).tolist())) if every else {}
    return np.array([max((known[u] for u in us), default=model.bias) for us in found])


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps."""
    mean, scale = x.mean(), x.std() + 1e-6
    z, theta = np.stack([(x - mean) / scale, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ theta))
        g = z.T @ (y - p) - 0.1 * theta
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(2)
        theta += np.linalg.solve(h, g)
    return float(theta[0] / scale), float(theta[1] - theta[0] * mean / scale)


def _known(key: str) -> dict[str, float]:
    """Decisions that this worker process remembers of a model."""
    return remembered(f"decisions:{key}", dict)


def fit_toxicity(docs: DataFrame, labels: DataFrame, train_fold: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> KernelSVM | None:
    """Fits on labelled rows where ``train_fold``, an expression on ``doc_id``, holds."""
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y")).where(train_fold & F.col("doc_id").isNotNull() & F.col("y").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r[0]: r[1] for r in marked.groupBy((F.col("y") > 0).alias("t")).count().collect()}
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("y") > 0, min(1.0, PER_CLASS / counts.get(True, 1))).otherwise(min(1.0, PER_CLASS / counts.get(False, 1)))
    drawn = marked.where(draw < share)  # about 2 * PER_CLASS rows at most, hence broadcast
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "y": []}), *frames]).sort_values(["doc_id", "text"])
        model = train(got["text"].tolist(), (got["y"] > 0).to_numpy())
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    # One task trains, so that the driver gets a model of 130 KB and no texts.
    rows = texts.join(F.broadcast(drawn), "doc_id").repartition(1).mapInPandas(fit, "model binary").collect()
    return pickle.loads(bytes(rows[0][0])) if rows else None


def predict_toxicity(docs: DataFrame, model: KernelSVM | None, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    source = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            s = _scores(model, pdf["text"].tolist())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "score": s, "predicted": (s >= 0.5).astype(np.int32)})

    id_type = docs.schema[id_col].dataType.simpleString()
    return source.mapInPandas(score, f"doc_id {id_type}, held_out boolean, score double, predicted int")


def _scores(model: KernelSVM | None, texts: list[str | None]) -> np.ndarray:
    if model is None:
        return np.zeros(len(texts))
    known = _known(model.key)
    top = np.empty(len(texts))
    for lo in range(0, len(texts), 256):
        if len(known) > REMEMBERED:
            known.clear()
        found = [units(t) if t else set() for t in texts[lo : lo + 256]]
        new = list(set().union(*found).difference(known))
        if new:
            known.update(zip(new, model.decide(new).tolist()))
        get = known.__getitem__
        top[lo : lo + len(found)] = [max(map(get, us), default=model.bias) for us in found]
    return model.score(top)


def drop_toxic(docs: DataFrame, model: KernelSVM | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; all columns as they are."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array(_scores(model, texts) < 0.5))

    return docs.mapInArrow(clean, docs.schema)
