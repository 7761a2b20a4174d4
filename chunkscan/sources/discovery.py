"""Which tables a scan reads and by which key each is cut."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from chunkscan.sources.options import ScanOptions
from chunkscan.sources.relations import Relation

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TableInfo:
    """Equal if name and key are."""

    database: str = field(compare=False)
    table: str = field(compare=False)
    full_name: str
    split_key: str
    key_type: str = field(compare=False)


def listed(options: ScanOptions) -> list[str]:
    """Full names of an explicit list, in its order; a name without a dot is in the database."""
    names = [x if "." in x else f"{options.database}.{x}" for x in options.table_list]
    if len(set(names)) != len(names):
        raise ValueError("a table is listed twice; its rows would be read twice")
    return names


def matching(relation: Relation, pattern: str) -> list[str]:
    """Full names of the base tables that a Java regular expression matches as a whole, by name."""
    names = [f"{relation.database}.{t}" for t in relation.tables()]
    regex = relation.spark.sparkContext._jvm.java.util.regex.Pattern.compile(pattern)
    return [n for n in names if regex.matcher(n).matches()]


def split_key(relation: Relation, table: str, override: str | None = None) -> str:
    """The override, else the first primary key column, else the first column."""
    if override:
        return override
    key = relation.primary_key(table)
    if key:
        return key[0]
    columns = relation.df(table).columns
    if not columns:
        raise ValueError(f"{table} has no columns")
    log.warning("%s has no primary key; it is cut by its first column", table)
    return columns[0]


def discover_tables(relation: Relation, options: ScanOptions) -> list[TableInfo]:
    """Tables by pattern or list; none is an error."""
    names = matching(relation, options.table_pattern) if options.table_pattern else listed(options)
    if not names:
        raise ValueError("no table found")
    found = []
    for name in names:
        database, table = name.split(".", 1)
        key = split_key(relation, table, options.split_key_column)
        kinds = dict(relation.df(table).dtypes)
        if key not in kinds:
            raise ValueError(f"{name} has no column {key}")
        found.append(TableInfo(database, table, name, key, kinds[key]))
    return found


def as_frame(relation: Relation, tables: list[TableInfo]) -> DataFrame:
    rows = [(t.database, t.table, t.full_name, t.split_key, t.key_type) for t in tables]
    return relation.spark.createDataFrame(rows, "database_name string, table_name string, full_name string, split_key string, key_type string")


def column_metadata(relation: Relation, table: str) -> DataFrame:
    """Names and types of a table's columns, in order from 1."""
    rows = [(k, name, kind) for k, (name, kind) in enumerate(relation.df(table).dtypes, 1)]
    return relation.spark.createDataFrame(rows, "ordinal int, column_name string, data_type string")
