"""Hashes of stretches and of words by sums of powers modulo 2**64, in numpy."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(987654321)
#: What each byte counts, by either of two bases.
BYTE_VALUES = _rng.integers(1, 1 << 63, (2, 256), np.uint64) | np.uint64(1)
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95 | 1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64) for _ in range(4)]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of both bases and of their inverses modulo 2**64."""
    while len(_powers[0]) < n:
        size = len(_powers[0])
        for k in range(4):
            base = _BASES[k // 2] if k % 2 == 0 else pow(_BASES[k // 2], -1, 1 << 64)
            _powers[k] = np.concatenate([_powers[k], _powers[k] * np.uint64(pow(base, size, 1 << 64))])
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Stretches:
    """Hashes of any stretch of some values, by base 0 or 1."""

    def __init__(self, values: tuple[np.ndarray, ...]):
        n = len(values[0])
        tables = _power_tables(n + 1)
        self.back, self.total = [], []
        for k, v in enumerate(values):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(v * tables[2 * k][:n], out=total[1:])
            self.back.append(tables[2 * k + 1])
            self.total.append(total)

    def get(self, k: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.total[k][hi] - self.total[k][lo]) * self.back[k][lo])


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and how many words each text has."""
    data = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    gap = _SPACE[data]
    whole = Stretches((np.where(gap, np.uint64(0), BYTE_VALUES[0][data]),))
    edge = np.flatnonzero(np.diff(gap, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    hashes = whole.get(0, starts, ends)
    bounds = np.cumsum([len(r) + 1 for r in raws])
    at = np.searchsorted(starts, bounds)
    return hashes, np.diff(at, prepend=0)
