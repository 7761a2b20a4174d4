"""Splits: what part of a table one task reads."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkscan.operators.boundaries import Boundaries, ordered
from chunkscan.sources.dialect import Dialect


@dataclass(frozen=True)
class Split:
    """Rows of ``table`` with ``start`` < key <= ``end``; None is no bound. The first split also has the NULL keys."""

    split_id: str
    table: str
    key: str
    start: Any = None
    end: Any = None
    offset: int = 0

    @property
    def has_start(self) -> bool:
        return self.start is not None

    @property
    def has_end(self) -> bool:
        return self.end is not None

    def condition(self) -> Column:
        k = F.col(f"`{self.key}`")
        parts = [k > F.lit(self.start)] if self.has_start else []
        parts += [k <= F.lit(self.end)] if self.has_end else []
        if not parts:
            return F.lit(True)
        both = reduce(lambda a, b: a & b, parts)
        return both if self.has_start else both | k.isNull()

    def predicate(self, dialect: Dialect) -> str:
        """The same as SQL text for a database."""
        k = dialect.quote_identifier(self.key)
        parts = [f"{k} > {dialect.literal(self.start)}"] if self.has_start else []
        parts += [f"{k} <= {dialect.literal(self.end)}"] if self.has_end else []
        both = " AND ".join(parts)
        return "1 = 1" if not parts else both if self.has_start else f"({both} OR {k} IS NULL)"

    def read(self, df: DataFrame, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
        """The split's rows; with an offset, those after it in the order of the key and then all other columns."""
        out = df.where(self.condition())
        if self.offset:
            rest = [c for c in df.columns if c != self.key]
            out = out.orderBy(F.col(f"`{self.key}`").asc_nulls_first(), *[F.col(f"`{c}`") for c in rest]).offset(self.offset)
        if columns is not None:
            out = out.select(*columns)
        return out if limit is None else out.limit(limit)

    def advanced(self, rows: int) -> Split:
        return replace(self, offset=self.offset + rows)


def splits_of(table: str, key: str, ends: list[Any]) -> list[Split]:
    """Splits between sorted ends, the open last one included."""
    return [Split(f"{table}#{k}", table, key, a, b) for k, (a, b) in enumerate(zip([None, *ends], [*ends, None]))]


def merged(splits: list[Split]) -> list[Split]:
    """The same rows in as few splits as can be: neighbours become one. Offsets are not allowed."""
    out: list[Split] = []
    for s in sorted(splits, key=lambda s: int(s.split_id.rpartition("#")[2])):
        if s.offset:
            raise ValueError("a split that is partly read does not merge")
        if out and out[-1].has_end and s.has_start and out[-1].end == s.start:
            out[-1] = replace(out[-1], end=s.end)
        else:
            out.append(s)
    return out


def split_frame(df: DataFrame, table: str, key: str, n: int, mode: str = "exact", bounds: Boundaries | None = None) -> DataFrame:
    """(split_id, idx, table_name, split_key, split_start, split_end, split_offset)."""
    bounds = bounds or Boundaries(df, key, n, mode)
    return ordered(bounds.frame).select(
        F.concat(F.lit(f"{table}#"), F.col("idx")).alias("split_id"), "idx", F.lit(table).alias("table_name"), F.lit(key).alias("split_key"),
        F.col("start").alias("split_start"), F.col("end").alias("split_end"), F.lit(0).cast("long").alias("split_offset"),
    )


#: Ends up to which the chunk of a row is a comparison tree in generated code; more meet the rows in a join by key.
TREE = 128


def _tree(key: Column, ends: list[Any], lo: int, hi: int) -> Column:
    """Number of ends below the key, by halving."""
    if lo == hi:
        return F.lit(lo).cast("long")
    mid = (lo + hi) // 2
    return F.when(key <= F.lit(ends[mid]), _tree(key, ends, lo, mid)).otherwise(_tree(key, ends, mid + 1, hi))


def assign_split(df: DataFrame, key: str, n: int, mode: str = "exact", name: str = "_chunk", bounds: Boundaries | None = None) -> DataFrame:
    """``df`` and the number of each row's chunk; rows with a NULL key are in the first."""
    bounds = bounds or Boundaries(df, key, n, mode)
    k = F.col(f"`{key}`")
    if bounds.count <= TREE:
        ends = bounds.values()
        return df.withColumn(name, F.when(k.isNull(), F.lit(0).cast("long")).otherwise(_tree(k, ends, 0, len(ends))))
    chunk = bounds.keys().select(F.col("k").alias("_split_key"), F.col("idx").alias(name))
    joined = df.join(chunk, k == F.col("_split_key"), "left").drop("_split_key")
    return joined.withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def split_row_counts(df: DataFrame, table: str, key: str, n: int, mode: str = "exact") -> DataFrame:
    """(split_id, n_rows) of splits that have rows."""
    counts = assign_split(df.select(key), key, n, mode).groupBy("_chunk").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.select(F.concat(F.lit(f"{table}#"), F.col("_chunk")).alias("split_id"), "n_rows")
