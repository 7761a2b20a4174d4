"""Declared schemas: columns by position, values converted, failures NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType, T.YearMonthIntervalType, T.DayTimeIntervalType)
_TIME = getattr(T, "TimeType", None)


def convert(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as the declared type; what does not fit is NULL. Decimals round half up.

    Whole numbers declared as intervals are months or milliseconds.
    """
    if have == want:
        return value
    whole = isinstance(have, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if isinstance(want, T.YearMonthIntervalType) and whole:
        return F.make_ym_interval(F.lit(0), value.cast("int"))
    if isinstance(want, T.DayTimeIntervalType) and whole:
        return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (value / F.lit(1000)).cast("decimal(18,6)"))
    if _TIME is not None and isinstance(want, _TIME) and isinstance(have, (T.TimestampType, T.TimestampNTZType)):
        return value.cast("timestamp_ntz").cast(want)
    if isinstance(want, T.BinaryType) and not isinstance(have, T.BinaryType):
        return value.cast("string").cast("binary")
    if isinstance(want, T.BooleanType) and isinstance(have, (T.FloatType, T.DoubleType, T.DecimalType)) or whole and isinstance(want, T.BooleanType):
        return value != F.lit(0)
    if isinstance(want, T.DateType) and whole:
        return F.date_add(F.lit("1970-01-01").cast("date"), value.cast("int"))
    return value.try_cast(want)


def check_declared(schema: T.StructType) -> None:
    """Nested and other types that a database row cannot hold are refused before anything runs."""
    for f in schema.fields:
        if not isinstance(f.dataType, _PLAIN) and not (_TIME is not None and isinstance(f.dataType, _TIME)):
            raise TypeError(f"column {f.name}: type {f.dataType.simpleString()} cannot be declared; declare string")


def typed_projection(df: DataFrame, schema: T.StructType, places: list[int] | None = None) -> DataFrame:
    """Column i of ``schema`` from column i of ``df`` (or ``places[i]``), whatever its name; extra columns are left out."""
    check_declared(schema)
    places = list(range(len(schema.fields))) if places is None else places
    if any(p >= len(df.columns) for p in places):
        raise ValueError(f"{len(schema.fields)} columns are declared, the table has {len(df.columns)}")
    unique = df.toDF(*[f"_{k}" for k in range(len(df.columns))])
    columns = []
    for f, p in zip(schema.fields, places):
        columns.append(convert(F.col(f"_{p}"), df.schema.fields[p].dataType, f.dataType).alias(f.name))
    return unique.select(*columns)
