"""Which splits a key range needs."""

from __future__ import annotations

from typing import Any

from chunkscan.operators.splits import Split


def prune(splits: list[Split], low: Any = None, high: Any = None) -> list[Split]:
    """Splits that can hold a key in [low, high]; None is no bound. With a bound, NULL keys do not matter."""
    return [s for s in splits if (low is None or not s.has_end or s.end >= low) and (high is None or not s.has_start or s.start < high)]
