"""Language identification by a byte convolutional network, trained in numpy.

A text is cut into windows of ``WINDOW`` bytes, each overlapping the next by the widest filter less
one, so every byte n-gram of the whole text is seen. Filters of widths 2, 3 and 4 slide over a
window, ``tanh`` of each filter's maximum goes into a softmax over the languages; a text's
probabilities are the mean over its windows.

Fit on a bounded sample: about ``PER_LANGUAGE`` training documents of each language, ``WINDOWS_EACH``
windows drawn from the whole of each, so that a very long text does not outweigh all others. Prediction covers all rows and whole texts.

Odd cases: a text that is null or has no letter (Unicode category L, in training and here) gets ``und`` with score 0; rows with a null language
or id are not learnt from; with nothing to learn from all rows get ``und``; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 16
PER_LANGUAGE, WINDOWS_EACH = 600, 4
EPOCHS, BATCH, RATE = 4, 64, 0.01
#: Windows handled at once when predicting.
BLOCK = 128
NONE = "und"


def windows(raw: bytes) -> np.ndarray:
    """All windows of a text as rows of bytes, the last one padded with zeros."""
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(raw) - (WINDOW - step)) // step))
    padded = np.zeros((n - 1) * step + WINDOW, np.uint8)
    padded[: len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step]


class ByteCNN:
    """``tables[w][j]``: what byte b at place j of a filter of width w adds, (256, filters)."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.tables = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)
        self._pairs: dict | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pairs": None}

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = 7) -> "ByteCNN":
        """Adam on cross entropy; a filter's gradient reaches only the bytes under its maximum."""
        rng = np.random.default_rng(seed)
        params = [*self.tables.values(), self.out, self.bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        t = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                rows = order[lo : lo + BATCH]
                xb, yb, n = x[rows], y[rows], len(rows)
                pooled, places = [], []
                for w, table in self.tables.items():
                    span = WINDOW - w + 1
                    act = sum(table[j][xb[:, j : j + span]] for j in range(w))
                    places.append(act.argmax(1))
                    pooled.append(np.take_along_axis(act, places[-1][:, None], 1)[:, 0])
                hidden = np.tanh(np.concatenate(pooled, 1))
                logit = hidden @ self.out + self.bias
                p = np.exp(logit - logit.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(n), yb] -= 1
                p /= n
                back = (p @ self.out.T) * (1 - hidden**2)
                grads = []
                for k, (w, table) in enumerate(self.tables.items()):
                    g, part = np.zeros_like(table), back[:, k * FILTERS : (k + 1) * FILTERS]
                    for j in range(w):
                        np.add.at(g[j], (np.take_along_axis(xb, places[k] + j, 1), np.arange(FILTERS)), part)
                    grads.append(g)
                grads += [hidden.T @ p, p.sum(0)]
                t += 1
                for param, m, v, g in zip(params, first, second, grads):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    param -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        return self

    def _ready(self) -> dict:
        """Tables by pairs of bytes: one look-up then serves two places of a filter."""
        if self._pairs is None:
            two = lambda a, b: (a[:, None] + b[None, :]).reshape(65536, FILTERS)
            t = self.tables
            self._pairs = {2: [(0, two(*t[2]))], 3: [(0, two(t[3][0], t[3][1])), (2, t[3][2])], 4: [(0, two(t[4][0], t[4][1])), (2, two(t[4][2], t[4][3]))]}
        return self._pairs

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities by window."""
        parts = []
        for lo in range(0, len(x), BLOCK):
            xb = x[lo : lo + BLOCK].astype(np.int32)
            pair = xb[:, :-1] << 8 | xb[:, 1:]
            pooled = []
            for w, terms in self._ready().items():
                span = WINDOW - w + 1
                act = None
                for at, table in terms:
                    code = (pair if len(table) > 256 else xb)[:, at : at + span]
                    got = table.take(code.ravel(), axis=0)
                    act = got if act is None else np.add(act, got, out=act)
                pooled.append(act.reshape(len(xb), span, FILTERS).max(1))
            logit = np.tanh(np.concatenate(pooled, 1)) @ self.out + self.bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            parts.append(p / p.sum(1, keepdims=True))
        return np.concatenate(parts)


def fit_language_model(docs: DataFrame, train: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> ByteCNN | None:
    """Fits on rows where ``train`` holds; None if there is nothing to learn from."""
    usable = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & F.col(id_col).isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(lang_col).count().collect()}
    if not counts:
        return None
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, PER_LANGUAGE / n))])
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20)) / float(1 << 20)
    sample = usable.where(draw < share[F.col(lang_col)]).select(F.col(id_col).alias("i"), F.col(lang_col).alias("y"), F.col(text_col).alias("x")).toPandas().sort_values(["i", "y", "x"])
    languages = sorted(counts)
    rng = np.random.default_rng(7)
    xs, ys = [], []
    for lang, text in zip(sample["y"], sample["x"]):
        w = windows(text.encode())
        xs.append(w[rng.permutation(len(w))[:WINDOWS_EACH]])
        ys += [languages.index(lang)] * len(xs[-1])
    return ByteCNN(languages).fit(np.concatenate(xs), np.array(ys))


def predict_language(docs: DataFrame, model: ByteCNN | None, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score."""
    source = docs.select(F.col(id_col).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            lang, best = np.full(len(pdf), NONE, object), np.zeros(len(pdf))
            pending: list[tuple[int, np.ndarray]] = []
            size = 0

            def flush() -> None:
                if not pending:
                    return
                p = model.predict(np.concatenate([w for _, w in pending]))
                ends = np.cumsum([0, *(len(w) for _, w in pending)])
                means = np.add.reduceat(p, ends[:-1]) / np.diff(ends)[:, None]
                for (row, _), m in zip(pending, means):
                    lang[row], best[row] = model.languages[m.argmax()], min(1.0, float(m.max()))
                pending.clear()

            for row, text in enumerate(pdf["text"]):
                if model is None or text is None or not any(map(str.isalpha, text)):
                    continue
                pending.append((row, windows(text.encode("utf-8", "surrogatepass"))))
                size += len(pending[-1][1])
                if size >= 4096:
                    flush()
                    size = 0
            flush()
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "lang_pred": lang, "score": best})

    id_type = docs.schema[id_col].dataType.simpleString()
    return source.mapInPandas(score, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")
