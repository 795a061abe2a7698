"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: str | Column) -> Column:
    """Exact money, so that sums do not depend on the order of the rows."""
    return as_column(value).cast(MONEY)


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return F.try_divide(
        as_column(numerator).cast("double"), as_column(denominator).cast("double")
    )


def percent(numerator: str | Column, denominator: str | Column) -> Column:
    return ratio(numerator, denominator) * 100


def finite(value: str | Column) -> Column:
    """NaN and infinities become NULL."""
    col = as_column(value)
    return F.when(F.isnan(col) | col.isin(float("inf"), float("-inf")), None).otherwise(col)


def is_float(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_datetime(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def floor_days(start: str | Column, end: str | Column) -> Column:
    """Whole days from ``start`` to ``end``, rounded down (-18 h is -1)."""
    begin, finish = as_column(start), as_column(end)
    calendar_days = F.datediff(finish, begin)
    overshoot = F.timestamp_add("DAY", calendar_days, begin) > finish
    return (calendar_days - overshoot.cast("int")).cast("long")


def hash_percent(key: str | Column) -> Column:
    """A stable number in 0..99 from a key, the same on every run and engine."""
    digest = F.substring(F.md5(as_column(key).cast("string")), 1, 8)
    return F.conv(digest, 16, 10).cast("long") % 100


def calendar_parts(df: DataFrame, column: str) -> DataFrame:
    """Replace a date column by its year, month, day and weekday (Monday is 0)."""
    day = F.col(column)
    return df.withColumns(
        {
            f"{column}_year": F.year(day),
            f"{column}_month": F.month(day),
            f"{column}_day": F.dayofmonth(day),
            f"{column}_weekday": F.weekday(day),
        }
    ).drop(column)
