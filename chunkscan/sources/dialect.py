"""SQL text by kind of database."""

from __future__ import annotations

import datetime as dt
import decimal
from abc import ABC, abstractmethod
from typing import Any


class Dialect(ABC):
    """Statements with ``?`` for values that the driver binds; ``literal`` is for predicates that it does not."""

    quote = '"'

    def quote_identifier(self, name: str) -> str:
        return self.quote + name.replace(self.quote, self.quote * 2) + self.quote

    def quote_table(self, full_name: str) -> str:
        """Parts at the first dot; further dots belong to the table's name."""
        return ".".join(map(self.quote_identifier, full_name.split(".", 1)))

    def min_max_query(self, table: str, key: str) -> str:
        k = self.quote_identifier(key)
        return f"SELECT MIN({k}), MAX({k}) FROM {self.quote_table(table)}"

    def next_boundary_query(self, table: str, key: str, start: Any, skip: int, nullable: bool = False) -> str:
        """The key at place ``skip``, from 0, after ``start`` (None: of all rows, or of those with a key if it is ``nullable``)."""
        k = self.quote_identifier(key)
        where = f" WHERE {k} > ?" if start is not None else f" WHERE {k} IS NOT NULL" if nullable else ""
        return f"SELECT {k} FROM {self.quote_table(table)}{where} ORDER BY {k} {self.one_row_at(skip)}"

    def split_scan_query(self, table: str, key: str, start: Any, end: Any, columns: str = "*", limit: int = 0, offset: int = 0) -> str:
        k = self.quote_identifier(key)
        parts = [f"{k} > ?"] * (start is not None) + [f"{k} <= ?"] * (end is not None)
        where = " WHERE " + " AND ".join(parts) if parts else ""
        return f"SELECT {columns} FROM {self.quote_table(table)}{where}{self.page(limit, offset)}"

    @abstractmethod
    def one_row_at(self, place: int) -> str: ...

    @abstractmethod
    def page(self, limit: int, offset: int) -> str:
        """Clause with its leading blank, or nothing."""

    @abstractmethod
    def table_list_query(self) -> str: ...

    @abstractmethod
    def primary_key_query(self, database: str, table: str) -> str: ...

    @abstractmethod
    def column_meta_query(self, database: str, table: str) -> str: ...

    def text(self, value: str) -> str:
        """A string literal; quotes are doubled."""
        return "'" + value.replace("'", "''") + "'"

    def timestamp(self, value: dt.datetime) -> str:
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"

    def literal(self, value: Any) -> str:
        if isinstance(value, bool):
            return "TRUE" if value else "FALSE"
        if isinstance(value, (int, decimal.Decimal)):
            return str(value)
        if isinstance(value, float):
            return repr(value)
        if isinstance(value, dt.datetime):
            return self.timestamp(value)
        if isinstance(value, dt.date):
            return f"DATE '{value:%Y-%m-%d}'"
        if isinstance(value, str):
            return self.text(value)
        raise TypeError(f"no literal for {type(value).__name__}")


class MySqlDialect(Dialect):
    quote = "`"

    def one_row_at(self, place: int) -> str:
        return f"LIMIT {place}, 1"

    def page(self, limit: int, offset: int) -> str:
        if limit <= 0 and offset <= 0:
            return ""
        # MySQL has no OFFSET without LIMIT.
        return f" LIMIT {limit if limit > 0 else (1 << 63) - 1}" + (f" OFFSET {offset}" if offset > 0 else "")

    def table_list_query(self) -> str:
        return "SELECT TABLE_NAME FROM information_schema.TABLES WHERE TABLE_SCHEMA = ? AND TABLE_TYPE = 'BASE TABLE' ORDER BY TABLE_NAME"

    def primary_key_query(self, database: str, table: str) -> str:
        return f"SELECT COLUMN_NAME FROM information_schema.KEY_COLUMN_USAGE WHERE TABLE_SCHEMA = {self.text(database)} AND TABLE_NAME = {self.text(table)} AND CONSTRAINT_NAME = 'PRIMARY' ORDER BY ORDINAL_POSITION LIMIT 1"

    def column_meta_query(self, database: str, table: str) -> str:
        return f"SELECT COLUMN_NAME, DATA_TYPE, COLUMN_TYPE FROM information_schema.COLUMNS WHERE TABLE_SCHEMA = {self.text(database)} AND TABLE_NAME = {self.text(table)} ORDER BY ORDINAL_POSITION"

    def text(self, value: str) -> str:
        """MySQL reads backslashes in strings, so they are doubled too."""
        return super().text(value.replace("\\", "\\\\"))


class AnsiDialect(Dialect):
    """OFFSET ... FETCH paging, information_schema."""

    def one_row_at(self, place: int) -> str:
        return f"OFFSET {place} ROWS FETCH NEXT 1 ROWS ONLY"

    def page(self, limit: int, offset: int) -> str:
        return (f" OFFSET {offset} ROWS" if offset > 0 else "") + (f" FETCH NEXT {limit} ROWS ONLY" if limit > 0 else "")

    def table_list_query(self) -> str:
        return "SELECT table_name FROM information_schema.tables WHERE table_schema = ? AND table_type = 'BASE TABLE' ORDER BY table_name"

    def primary_key_query(self, database: str, table: str) -> str:
        return (
            "SELECT k.column_name FROM information_schema.table_constraints c JOIN information_schema.key_column_usage k"
            " ON k.constraint_name = c.constraint_name AND k.table_schema = c.table_schema AND k.table_name = c.table_name"
            f" WHERE c.constraint_type = 'PRIMARY KEY' AND c.table_schema = {self.text(database)} AND c.table_name = {self.text(table)}"
            " ORDER BY k.ordinal_position FETCH FIRST 1 ROWS ONLY"
        )

    def column_meta_query(self, database: str, table: str) -> str:
        return f"SELECT column_name, data_type, data_type FROM information_schema.columns WHERE table_schema = {self.text(database)} AND table_name = {self.text(table)} ORDER BY ordinal_position"


class PostgresDialect(AnsiDialect):
    pass


class DerbyDialect(AnsiDialect):
    def timestamp(self, value: dt.datetime) -> str:
        return f"TIMESTAMP('{value:%Y-%m-%d %H:%M:%S.%f}')"

    def literal(self, value: Any) -> str:
        if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
            return f"DATE('{value:%Y-%m-%d}')"
        return super().literal(value)


_DIALECTS: dict[str, type[Dialect]] = {"mysql": MySqlDialect, "ansi": AnsiDialect, "postgresql": PostgresDialect, "derby": DerbyDialect}


def register_dialect(name: str, kind: type[Dialect]) -> None:
    _DIALECTS[name] = kind


def dialect_named(name: str) -> Dialect:
    if name not in _DIALECTS:
        raise ValueError(f"unknown dialect {name!r}; known: {', '.join(sorted(_DIALECTS))}")
    return _DIALECTS[name]()
