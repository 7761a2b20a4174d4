"""Rows as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def format_row(df: DataFrame, columns: list[str] | None = None, separator: str = "|", null: str = "NULL") -> Column:
    """A column: the values as text, separated."""
    names = columns or df.columns
    return F.concat_ws(separator, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null)) for c in names])
