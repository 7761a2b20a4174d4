"""Where tables come from: a folder of Parquet tables, Spark's catalog, or a database."""

from __future__ import annotations

import datetime as dt
import decimal
import time
from abc import ABC, abstractmethod
from collections.abc import Callable, Mapping
from typing import Any, TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkscan.sources.dialect import Dialect, dialect_named
from chunkscan.sources.options import ScanOptions

T = TypeVar("T")


class Relation(ABC):
    """Tables of one database; ``table`` is without the database's name."""

    spark: SparkSession
    database: str

    @abstractmethod
    def tables(self) -> list[str]:
        """Base tables by name, no views."""

    @abstractmethod
    def df(self, table: str) -> DataFrame: ...

    @abstractmethod
    def primary_key(self, table: str) -> list[str]:
        """Columns in key order; empty without a key."""


class ParquetRelation(Relation):
    """``folder``/<table>.parquet, with declared keys."""

    def __init__(self, spark: SparkSession, folder: str, database: str, keys: Mapping[str, list[str]] | None = None, names: list[str] | None = None):
        self.spark, self.folder, self.database, self.keys, self.names = spark, folder, database, dict(keys or {}), names

    def tables(self) -> list[str]:
        if self.names is not None:
            return sorted(self.names)
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(self.folder)
        names = [s.getPath().getName() for s in where.getFileSystem(conf).listStatus(where)]
        return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet"))

    def df(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def primary_key(self, table: str) -> list[str]:
        return self.keys.get(table, [])


class CatalogRelation(Relation):
    """A database of Spark's catalog."""

    def __init__(self, spark: SparkSession, database: str = "default", keys: Mapping[str, list[str]] | None = None):
        self.spark, self.database, self.keys = spark, database, dict(keys or {})

    def tables(self) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(self.database) if t.tableType not in ("VIEW", "TEMPORARY"))

    def df(self, table: str) -> DataFrame:
        return self.spark.table(f"`{self.database}`.`{table}`")

    def primary_key(self, table: str) -> list[str]:
        return self.keys.get(table, [])


class FrameRelation(Relation):
    """DataFrames by name."""

    def __init__(self, spark: SparkSession, database: str, frames: Mapping[str, DataFrame], keys: Mapping[str, list[str]] | None = None):
        self.spark, self.database, self.frames, self.keys = spark, database, dict(frames), dict(keys or {})

    def tables(self) -> list[str]:
        return sorted(self.frames)

    def df(self, table: str) -> DataFrame:
        return self.frames[table]

    def primary_key(self, table: str) -> list[str]:
        return self.keys.get(table, [])


class JdbcRelation(Relation):
    """Tables of a database behind Spark's JDBC source; metadata through the same drivers."""

    def __init__(self, spark: SparkSession, options: ScanOptions):
        self.spark, self.options, self.database = spark, options, options.database
        self.dialect: Dialect = dialect_named(options.dialect)
        self._connection: Any = None

    def retry(self, work: Callable[[], T]) -> T:
        """Runs driver-side database work, again up to ``max_retries`` times if it fails."""
        for left in range(self.options.max_retries, -1, -1):
            try:
                return work()
            except Exception:
                if not left:
                    raise
                time.sleep(0.2)
        raise AssertionError

    def _connect(self) -> Any:
        jvm = self.spark.sparkContext._jvm
        jvm.org.apache.spark.util.Utils.classForName(self.options.driver_class, True, True)
        props = jvm.java.util.Properties()
        for name, value in (("user", self.options.username), ("password", self.options.password)):
            if value is not None:
                props.setProperty(name, value)
        return jvm.java.sql.DriverManager.getConnection(self.options.url, props)

    def _metadata(self, read: Callable[[Any], T]) -> T:
        def work() -> T:
            connection = self._connect()
            try:
                return read(connection.getMetaData())
            finally:
                connection.close()

        return self.retry(work)

    def ask(self, sql: str, *values: Any) -> tuple[Any, ...] | None:
        """The first row of a statement whose ``?`` are bound to ``values``. The connection stays open for the next, until ``close``."""

        def work() -> tuple[Any, ...] | None:
            if self._connection is None:
                self._connection = self._connect()
            try:
                statement = self._connection.prepareStatement(sql)
                statement.setMaxRows(1)
                for place, value in enumerate(values, 1):
                    statement.setObject(place, self._bound(value))
                rows = statement.executeQuery()
                width = rows.getMetaData().getColumnCount()
                found = tuple(_plain(rows.getObject(c)) for c in range(1, width + 1)) if rows.next() else None
                statement.close()
                return found
            except Exception:
                self.close()
                raise

        return self.retry(work)

    def close(self) -> None:
        if self._connection is not None:
            connection, self._connection = self._connection, None
            connection.close()

    def _bound(self, value: Any) -> Any:
        """``value`` as the gateway can hand it to a driver."""
        sql = self.spark.sparkContext._jvm.java.sql
        if isinstance(value, dt.datetime):
            return sql.Timestamp.valueOf(value.isoformat(" "))
        if isinstance(value, dt.date):
            return sql.Date.valueOf(value.isoformat())
        if isinstance(value, int) and not -(1 << 63) <= value < 1 << 63:
            return decimal.Decimal(value)
        return value

    def _array(self, *values: str) -> Any:
        out = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.java.lang.String, len(values))
        for k, v in enumerate(values):
            out[k] = v
        return out

    def _place(self) -> tuple[str | None, str | None]:
        """Catalog and schema that hold the tables."""
        return (self.database, None) if self.options.dialect == "mysql" else (None, self.database)

    def tables(self) -> list[str]:
        def read(meta: Any) -> list[str]:
            rows, found = meta.getTables(*self._place(), "%", self._array("TABLE")), []
            while rows.next():
                found.append(rows.getString("TABLE_NAME"))
            return sorted(found)

        return self._metadata(read)

    def primary_key(self, table: str) -> list[str]:
        def read(meta: Any) -> list[str]:
            rows, found = meta.getPrimaryKeys(*self._place(), table), []
            while rows.next():
                found.append((rows.getShort("KEY_SEQ"), rows.getString("COLUMN_NAME")))
            return [name for _, name in sorted(found)]

        return self._metadata(read)

    def columns(self, table: str) -> list[tuple[str, str]]:
        """Names and the database's names of their types, in order."""

        def read(meta: Any) -> list[tuple[str, str]]:
            rows, found = meta.getColumns(*self._place(), table, "%"), []
            while rows.next():
                found.append((rows.getInt("ORDINAL_POSITION"), rows.getString("COLUMN_NAME"), rows.getString("TYPE_NAME")))
            return [(name, kind) for _, name, kind in sorted(found)]

        return self._metadata(read)

    def full_name(self, table: str) -> str:
        return self.dialect.quote_table(f"{self.database}.{table}")

    def df(self, table: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options.connection()).option("dbtable", self.full_name(table)).load()

    def chunks(self, table: str, predicates: list[str]) -> DataFrame:
        """One partition a predicate."""
        named = self.options.connection()
        return self.spark.read.jdbc(named.pop("url"), self.full_name(table), predicates=predicates, properties=named)

    def min_max(self, table: str, key: str) -> tuple[Any, Any]:
        found = self.ask(self.dialect.min_max_query(f"{self.database}.{table}", key))
        return found if found is not None else (None, None)

    def next_key(self, table: str, key: str, start: Any, skip: int) -> Any:
        """The key at place ``skip`` after ``start``, or None. NULL keys do not count."""
        sql = self.dialect.next_boundary_query(f"{self.database}.{table}", key, start, skip, nullable=True)
        found = self.ask(sql) if start is None else self.ask(sql, start)
        return None if found is None else found[0]


def _plain(value: Any) -> Any:
    """A driver's value as a Python one; numbers and strings already are."""
    if not hasattr(value, "getClass"):
        return bytes(value) if isinstance(value, bytearray) else value
    kind, text = value.getClass().getName(), value.toString()
    if kind == "java.math.BigInteger":
        return int(text)
    if kind in ("java.sql.Date", "java.time.LocalDate"):
        return dt.date.fromisoformat(text)
    if kind in ("java.sql.Timestamp", "java.time.LocalDateTime"):
        return dt.datetime.fromisoformat(text)
    raise TypeError(f"a key cannot be of type {kind}")
