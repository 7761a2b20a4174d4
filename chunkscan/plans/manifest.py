"""A scan's state as versioned JSON: which splits are to do, done, and how far."""

from __future__ import annotations

import base64
import datetime as dt
import decimal
import json
from collections import deque
from collections.abc import Iterable
from typing import Any

from chunkscan.operators.splits import Split

VERSION = 1


def _pack(value: Any) -> Any:
    if value is None or isinstance(value, (bool, int, str)):
        return value
    if isinstance(value, float):
        return {"float": value.hex()}
    if isinstance(value, decimal.Decimal):
        return {"decimal": str(value)}
    if isinstance(value, dt.datetime):
        return {"timestamp": value.isoformat()}
    if isinstance(value, dt.date):
        return {"date": value.isoformat()}
    if isinstance(value, (bytes, bytearray)):
        return {"binary": base64.b64encode(bytes(value)).decode()}
    raise TypeError(f"a bound cannot be of type {type(value).__name__}")


_UNPACK = {"float": float.fromhex, "decimal": decimal.Decimal, "timestamp": dt.datetime.fromisoformat, "date": dt.date.fromisoformat, "binary": base64.b64decode}


def _unpack(value: Any) -> Any:
    if isinstance(value, dict):
        ((kind, text),) = value.items()
        return _UNPACK[kind](text)
    return value


def split_to_json(split: Split) -> dict[str, Any]:
    return {"id": split.split_id, "table": split.table, "key": split.key, "start": _pack(split.start), "end": _pack(split.end), "offset": split.offset}


def split_from_json(found: dict[str, Any]) -> Split:
    return Split(found["id"], found["table"], found["key"], _unpack(found["start"]), _unpack(found["end"]), found["offset"])


class Manifest:
    """Splits still to read, in order. One that is taken and fails goes back to the front."""

    def __init__(self, pending: Iterable[Split] = (), complete: bool = False):
        self.pending: deque[Split] = deque(pending)
        #: Whether all tables have been cut; if not, a restored scan starts over.
        self.complete = complete
        self.taken: dict[str, Split] = {}

    def take(self) -> Split | None:
        if not self.pending:
            return None
        split = self.pending.popleft()
        self.taken[split.split_id] = split
        return split

    def progress(self, split_id: str, rows: int) -> None:
        """``rows`` more rows of a taken split are read."""
        self.taken[split_id] = self.taken[split_id].advanced(rows)

    def finish(self, split_id: str) -> None:
        del self.taken[split_id]

    def give_back(self, split_ids: Iterable[str]) -> None:
        """Taken splits back to the front, in the order given."""
        self.pending.extendleft(reversed([self.taken.pop(i) for i in split_ids]))

    def dumps(self) -> str:
        """Taken splits count as pending: a restored scan has to finish them."""
        todo = [*self.taken.values(), *self.pending]
        return json.dumps({"version": VERSION, "complete": self.complete, "pending": [split_to_json(s) for s in todo]})

    @classmethod
    def loads(cls, text: str) -> Manifest:
        found = json.loads(text)
        if found.get("version") != VERSION:
            raise ValueError(f"unknown manifest version {found.get('version')!r}")
        return cls(map(split_from_json, found["pending"]), found["complete"])
