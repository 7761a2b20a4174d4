"""Small tables with odd rows, and plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

WORDS = "river stone under lantern quiet harbour seven wooden bridge morning copper window garden winter silver letter candle meadow orchard signal".split()


def text(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(n))


def documents(seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, key, h): copies, near copies, nulls, empties, a long text, clashing columns."""
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", "   ", "one", "two words", "é", "\x00\x1f odd\x1c space", "a" * 900, "ab " * 400]
    passage = text(rng, 90)
    base = text(rng, 120)
    for _ in range(12):
        words = base.split()
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        texts.append(" ".join(words))
    texts += [base, base, base.replace(" ", "\n\t"), base.upper()]
    texts += [text(rng, rng.randint(1, 200)) for _ in range(20)]
    texts += [f"{text(rng, 20)} {passage} {text(rng, 20)}" for _ in range(4)]
    texts.append(text(rng, 6000))
    rng.shuffle(texts)
    rows = [(i, t, rng.choice(["en", "fr", None]), "s", len(t or ""), "k", 0) for i, t in enumerate(texts)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, h int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def near(rows: list[tuple]) -> dict[int, tuple[int, int]]:
    """doc_id -> (size of its set, its component), by comparing all pairs."""
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(a: int) -> int:
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def repeats(rows: list[tuple], length: int) -> dict[int, tuple]:
    """doc_id -> (bytes, removed, spans, sha256 of the rest), window by window."""
    raws = {i: (t or "").encode() for i, t, *_ in rows}
    seen = Counter(b[k : k + length] for b in raws.values() for k in range(len(b) - length + 1))
    out = {}
    for i, b in raws.items():
        gone = bytearray(len(b) + 1)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out[i] = (len(b), sum(gone[: len(b)]), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def shared_words(rows: list[tuple], length: int) -> dict[int, int]:
    """doc_id -> words in runs of ``length`` that another row holds too."""
    words = {i: (t or "").encode().split() for i, t, *_ in rows}
    seen: dict[tuple, set] = {}
    for i, w in words.items():
        for k in range(len(w) - length + 1):
            seen.setdefault(tuple(w[k : k + length]), set()).add(i)
    out = {}
    for i, w in words.items():
        hit: set[int] = set()
        for k in range(len(w) - length + 1):
            if len(seen[tuple(w[k : k + length])]) > 1:
                hit.update(range(k, k + length))
        out[i] = len(hit)
    return out


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_spans(t: str) -> list[tuple[int, int, int]]:
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 16]
    return sorted(found)


def fold(i: int, n: int) -> int:
    return zlib.crc32(str(i).encode()) % n


def windows_hit(docs: list[tuple], items: list[tuple], size: int = 10) -> dict[int, tuple[int, int, set]]:
    """doc_id -> (words, hit words, items), by sliding every window over every text."""
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(upper))
    wins = [(i, tuple(w[k : k + size])) for i, t, *_ in items if (w := split(t)) for k in range(max(1, len(w) - size + 1))]
    out = {}
    for d, t, *_ in docs:
        w, hit, found = split(t), set(), set()
        for i, win in wins:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    found.add(str(i))
        out[d] = (len(w), len(hit), found)
    return out
