"""SQL: ``CREATE TEMPORARY VIEW v USING chunkscan OPTIONS ('url' '/tables', 'database' 'db', 'table-list' 't', 'chunk-size' '8096')``.

``sql(spark, statement)`` puts a scan by Spark's own readers under the view's name: databases and all
stores that Spark reads, with columns and filters pushed down. It is the way for large tables.

After ``register(spark)``, plain ``spark.sql`` takes the statement too. That source runs in Python
workers: it reads Parquet files that they can open, one task a chunk; filters on the key leave out
chunks, and filters and declared columns reach the Parquet reader. Spark does not tell such a source
which columns a query needs, so all declared ones are read, and each table's key is counted in one
process.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from chunkscan.operators.boundaries import ends_within
from chunkscan.operators.scan import ChunkedScan
from chunkscan.scratch import prepare
from chunkscan.sources.options import ScanOptions

NAME = "chunkscan"


def _files(options: ScanOptions) -> list[str]:
    """Paths of the tables. A pattern is matched here by Python's regular expressions, as a whole."""
    if options.table_pattern:
        names = sorted(n.removesuffix(".parquet") for n in os.listdir(options.url) if n.endswith(".parquet"))
        names = [n for n in names if re.fullmatch(options.table_pattern, f"{options.database}.{n}")]
    else:
        names = [n.split(".", 1)[-1] for n in options.table_list]
        if len(set(names)) != len(names):
            raise ValueError("a table is listed twice; its rows would be read twice")
    if not names:
        raise ValueError("no table found")
    return [f"{options.url}/{n}.parquet" for n in names]


class Chunk(InputPartition):
    def __init__(self, path: str, key: str, start: Any, end: Any, sole: bool):
        super().__init__(None)
        self.path, self.key, self.start, self.end, self.sole = path, key, start, end, sole


class ChunkSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def _options(self) -> ScanOptions:
        return ScanOptions.from_ddl({k.lower(): v for k, v in self.options.items() if k.lower() != "path"})

    def schema(self) -> StructType:
        return from_arrow_schema(ds.dataset(_files(self._options())[0]).schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        return ChunkReader(self._options(), schema)


_COMPARE = {EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal}


class ChunkReader(DataSourceReader):
    def __init__(self, options: ScanOptions, schema: StructType):
        self.options, self.declared, self.pushed = options, schema, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        names = set(self.declared.fieldNames())
        for f in filters:
            if type(f) in _COMPARE and len(f.attribute) == 1 and f.attribute[0] in names:
                self.pushed.append((f.attribute[0], _COMPARE[type(f)].__name__, f.value))
            elif not isinstance(f, IsNotNull):
                yield f
                continue
            # Spark checks again: declared types may differ from the files'.
            yield f

    def _condition(self, schema: pa.Schema) -> ds.Expression | None:
        out = None
        for name, compare, value in self.pushed:
            place = self.declared.fieldNames().index(name)
            one = getattr(pc, compare)(ds.field(schema.field(place).name), pa.scalar(value, schema.field(place).type))
            out = one if out is None else out & one
        return out

    def partitions(self) -> list[InputPartition]:
        found: list[InputPartition] = []
        step = self.options.chunk_size + (self.options.boundary_mode == "skip")
        for path in _files(self.options):
            table = ds.dataset(path)
            key = self.options.split_key_column or table.schema.names[0]
            keys = table.to_table([key]).column(key).drop_null().combine_chunks()
            counts = pa.table({"k": keys}).group_by("k").aggregate([("k", "count")]).sort_by("k")
            places, rest = ends_within(counts.column("k_count").to_numpy(), 0, step)
            if self.options.boundary_mode == "exact" and rest == 0:
                places = places[:-1]
            ends = counts.column("k").take(pa.array(places, pa.int64())).to_pylist()
            chunks = [Chunk(path, key, a, b, not ends) for a, b in zip([None, *ends], [*ends, None])]
            found += [c for c in chunks if self._wanted(c, table.schema)]
        return found

    def _wanted(self, chunk: Chunk, schema: pa.Schema) -> bool:
        """Whether filters on the key leave anything of a chunk."""
        for name, compare, value in self.pushed:
            if schema.field(self.declared.fieldNames().index(name)).name != chunk.key:
                continue
            if chunk.end is not None and (compare in ("equal", "greater_equal") and chunk.end < value or compare == "greater" and chunk.end <= value):
                return False
            if chunk.start is not None and compare in ("equal", "less", "less_equal") and chunk.start >= value:
                return False
        return True

    def read(self, chunk: Chunk) -> Iterator[pa.RecordBatch]:
        table = ds.dataset(chunk.path)
        key, where = ds.field(chunk.key), self._condition(table.schema)
        if chunk.end is not None:
            part = key <= chunk.end
            part = part | key.is_null() if chunk.start is None else part & (key > chunk.start)
            where = part if where is None else where & part
        elif chunk.start is not None:
            where = key > chunk.start if where is None else where & (key > chunk.start)
        names = table.schema.names[: len(self.declared.fields)]
        target = to_arrow_schema(self.declared)
        for batch in table.to_batches(columns=names, filter=where):
            columns = [c if c.type == f.type else pc.cast(c, f.type, safe=False) for c, f in zip(batch.columns, target)]
            yield pa.record_batch(columns, schema=pa.schema([pa.field(f.name, f.type) for f in target]))


def register(spark: SparkSession) -> None:
    """Makes ``USING chunkscan`` known to a session, with filters pushed to it."""
    prepare(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ChunkSource)


def create_view(spark: SparkSession, name: str, options: dict[str, str], schema: StructType | None = None) -> None:
    """A temporary view on a chunked scan by Spark's own readers."""
    ChunkedScan(ScanOptions.from_ddl(options), schema=schema).load(spark).createOrReplaceTempView(name)


def sql(spark: SparkSession, statement: str) -> DataFrame:
    """``spark.sql``, but a temporary view ``USING chunkscan`` is a scan by Spark's own readers. Declared columns type it by position."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    if plan.nodeName() != "CreateTempViewUsing" or plan.provider().lower() != NAME:
        return spark.sql(statement)
    given = spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(plan.options())
    declared = plan.userSpecifiedSchema()
    schema = StructType.fromJson(json.loads(declared.get().json())) if declared.isDefined() else None
    df = ChunkedScan(ScanOptions.from_ddl({k.lower(): v for k, v in dict(given).items()}), schema=schema).load(spark)
    name = plan.tableIdent().table()
    if getattr(plan, "global")():
        (df.createOrReplaceGlobalTempView if plan.replace() else df.createGlobalTempView)(name)
    else:
        (df.createOrReplaceTempView if plan.replace() else df.createTempView)(name)
    return spark.createDataFrame([], StructType([]))


__all__ = ["NAME", "ChunkSource", "create_view", "register", "sql"]
