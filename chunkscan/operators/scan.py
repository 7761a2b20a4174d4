"""Chunked scans of one table or many."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chunkscan.functions.schema import typed_projection
from chunkscan.operators.boundaries import Boundaries, boundaries_jdbc
from chunkscan.operators.splits import Split, assign_split, merged, splits_of
from chunkscan.plans.manifest import Manifest
from chunkscan.plans.pruning import prune
from chunkscan.sources.discovery import TableInfo, discover_tables
from chunkscan.sources.options import ScanOptions
from chunkscan.sources.relations import JdbcRelation, ParquetRelation, Relation


#: Tasks of one database scan; of more splits, neighbours share a query.
TASKS = 10_000


def plan_splits(relation: Relation, table: TableInfo, options: ScanOptions) -> list[Split]:
    """A table's splits: a database's key is walked, other keys are counted on the cluster."""
    if isinstance(relation, JdbcRelation):
        ends = boundaries_jdbc(relation, table.table, table.split_key, options.chunk_size, options.boundary_mode)
    else:
        ends = Boundaries(relation.df(table.table), table.split_key, options.chunk_size, options.boundary_mode).values()
    return splits_of(table.full_name, table.split_key, ends)


def scan_splits(relation: Relation, table: TableInfo, splits: list[Split], tasks: int = TASKS) -> DataFrame:
    """The rows of ``splits``, each once; of a partly read one those after its offset.

    A database gets one query a split, or for groups of neighbours if there are more splits than
    ``tasks``; filters and columns are still pushed to it. Files are read by one scan over the key
    ranges that neighbouring splits make up.
    """
    whole, begun = [s for s in splits if not s.offset], [s for s in splits if s.offset]
    if isinstance(relation, JdbcRelation):
        size = -(-len(whole) // tasks)
        ranges = whole if size < 2 else [m for k in range(0, len(whole), size) for m in merged(whole[k : k + size])]
        rows = relation.chunks(table.table, [s.predicate(relation.dialect) for s in ranges] or ["1 = 0"])
    else:
        rows = relation.df(table.table)
        rows = rows.where(reduce(lambda a, b: a | b, [s.condition() for s in merged(whole)], F.lit(False)))
    return reduce(DataFrame.union, [s.read(relation.df(table.table)) for s in begun], rows)


def scan_table(relation: Relation, table: TableInfo, options: ScanOptions, chunk_column: str | None = None, low: object = None, high: object = None) -> DataFrame:
    """All rows of a table, each once. ``low`` and ``high``: only splits that can hold keys between them are planned.

    A database is read by one query a split. Files are read by one scan, whose own parts are its
    tasks; ``chunk_column`` then tells each row's chunk.
    """
    key = table.split_key
    if isinstance(relation, JdbcRelation):
        splits = prune(plan_splits(relation, table, options), low, high)
        df = scan_splits(relation, table, splits)
        if chunk_column:
            place = reduce(lambda c, s: c.when(s.condition(), F.lit(int(s.split_id.rpartition("#")[2])).cast("long")), splits, F)
            df = df.withColumn(chunk_column, place)
    else:
        df = relation.df(table.table)
        if chunk_column:
            df = assign_split(df, key, options.chunk_size, options.boundary_mode, chunk_column)
    if low is not None:
        df = df.where(F.col(f"`{key}`") >= F.lit(low))
    return df if high is None else df.where(F.col(f"`{key}`") <= F.lit(high))


class ChunkedScan:
    """A bounded scan of all tables that the options name."""

    def __init__(self, options: ScanOptions, relation: Relation | None = None, schema: StructType | None = None):
        self.options, self.relation, self.schema = options, relation, schema

    def _relation(self, spark) -> Relation:
        if self.relation is not None:
            return self.relation
        if self.options.url.startswith("jdbc:"):
            return JdbcRelation(spark, self.options)
        return ParquetRelation(spark, self.options.url, self.options.database)

    def tables(self, spark) -> list[TableInfo]:
        return discover_tables(self._relation(spark), self.options)

    def _shaped(self, df: DataFrame, source: str | None, table: TableInfo, chunk: str | None = None) -> DataFrame:
        if self.schema is not None:
            if not chunk:
                df = typed_projection(df, self.schema)
            else:
                width = len(self.schema.fields)
                if width > len(df.columns) - 1:
                    raise ValueError(f"{width} columns are declared, {table.full_name} has {len(df.columns) - 1}")
                df = typed_projection(df, StructType([*self.schema.fields, df.schema[chunk]]), [*range(width), len(df.columns) - 1])
        return df.withColumn(source, F.lit(table.full_name)) if source else df

    def load(self, spark, source_column: str | None = None, chunk_column: str | None = None) -> DataFrame:
        """Rows of all tables; columns by position and, if a schema is declared, of its types."""
        relation = self._relation(spark)
        return reduce(DataFrame.union, [self._shaped(scan_table(relation, t, self.options, chunk_column), source_column, t, chunk_column) for t in self.tables(spark)])

    def manifest(self, spark) -> Manifest:
        """All splits of all tables, still to read."""
        relation = self._relation(spark)
        return Manifest([s for t in self.tables(spark) for s in plan_splits(relation, t, self.options)], complete=True)

    def _rows(self, spark, splits: list[Split], source_column: str | None) -> DataFrame:
        relation, tables = self._relation(spark), self.tables(spark)
        strange = {s.table for s in splits} - {t.full_name for t in tables}
        if strange:
            raise ValueError(f"the manifest names other tables: {', '.join(sorted(strange))}")
        return reduce(DataFrame.union, [self._shaped(scan_splits(relation, t, [s for s in splits if s.table == t.full_name]), source_column, t) for t in tables])

    def resume(self, spark, manifest: Manifest, source_column: str | None = None) -> DataFrame:
        """Rows that a manifest has still to read, taken splits included; one of tables not wholly cut starts over."""
        if not manifest.complete:
            return self.load(spark, source_column)
        return self._rows(spark, [*manifest.taken.values(), *manifest.pending], source_column)

    def drain(self, spark, manifest: Manifest, sink: Callable[[DataFrame], None], at_once: int = 1024, save: Callable[[str], None] | None = None, source_column: str | None = None) -> None:
        """Hands pending splits to ``sink``, ``at_once`` in one DataFrame, until none is left.

        A group that ``sink`` took is finished; one that failed goes back to the front and its error
        goes up. ``save`` gets the state after each, as text that ``Manifest.loads`` reads. The state
        is saved after the rows are: who stops between the two gets that group again.
        """
        if at_once < 1:
            raise ValueError("at_once must be at least 1")
        if not manifest.complete:
            fresh = self.manifest(spark)
            manifest.pending, manifest.taken, manifest.complete = fresh.pending, {}, True
        manifest.give_back(list(manifest.taken))
        while manifest.pending:
            group = [manifest.take() for _ in range(min(at_once, len(manifest.pending)))]
            try:
                sink(self._rows(spark, group, source_column))
            except BaseException:
                manifest.give_back([s.split_id for s in group])
                if save:
                    save(manifest.dumps())
                raise
            for s in group:
                manifest.finish(s.split_id)
            if save:
                save(manifest.dumps())
