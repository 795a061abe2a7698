"""Table cleaning and missing-value treatment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.functions.columns import finite, is_float, numeric_columns, string_columns
from salescope.operators.ordered import exact_quantiles
from salescope.session import durable
from salescope.sources.schema import StarSchema

UNKNOWN = "Unknown"


def clean_dataframe(df: DataFrame) -> DataFrame:
    """Distinct rows, then ``clean_columns``."""
    return clean_columns(df.dropDuplicates())


def clean_columns(df: DataFrame) -> DataFrame:
    """Infinities to NULL, text dates parsed, text trimmed.

    A column is a date when its name contains "date"; text that is no date
    becomes NULL.  NULL text stays NULL.
    """
    changes = {}
    for field in df.schema.fields:
        if is_float(field.dataType):
            changes[field.name] = finite(field.name)
        elif isinstance(field.dataType, T.StringType):
            trimmed = F.trim(field.name)
            is_date = "date" in field.name.lower()
            changes[field.name] = F.try_to_timestamp(trimmed) if is_date else trimmed
    return df.withColumns(changes) if changes else df


def clean_star(star: StarSchema) -> StarSchema:
    return StarSchema(**{name: clean_dataframe(df) for name, df in star.tables().items()})


def clean_ml_dataframe(df: DataFrame, targets: Sequence[str] = ()) -> DataFrame:
    """Distinct rows; numeric gaps get the median (not in targets), text gaps "Unknown".

    The distinct rows are written out, because the search for gaps, the medians
    and whatever is fitted on the result all read them again.
    """
    rows = df.dropDuplicates()
    floats = {f.name: finite(f.name) for f in rows.schema.fields if is_float(f.dataType)}
    rows = durable(rows.withColumns(floats) if floats else rows)
    return fill_missing(rows, numeric_medians(rows, targets), targets)


def clean_feature_dataset_raw(df: DataFrame) -> DataFrame:
    return clean_ml_dataframe(df)


def numeric_medians(df: DataFrame, targets: Sequence[str] = ()) -> dict[str, float]:
    """Medians of the numeric columns that have gaps (one row reaches the driver)."""
    numeric = [c for c in numeric_columns(df) if c not in targets]
    if not numeric:
        return {}
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in numeric]).first()
    columns = [c for c in numeric if gaps[c]]
    if not columns:
        return {}
    found = exact_quantiles(df, columns, {"m": 0.5}).first()
    return {c: found[f"{c}_m"] for c in columns if found[f"{c}_m"] is not None}


def fill_missing(
    df: DataFrame, medians: Mapping[str, float], targets: Sequence[str] = ()
) -> DataFrame:
    """A whole-number column becomes double if its median is not whole."""
    changes = {}
    for name, value in medians.items():
        dtype = df.schema[name].dataType
        fits = isinstance(dtype, T.IntegralType) and float(value).is_integer()
        as_type = dtype if fits or not isinstance(dtype, T.IntegralType) else T.DoubleType()
        changes[name] = F.coalesce(F.col(name).cast(as_type), F.lit(value).cast(as_type))
    for name in string_columns(df):
        if name not in targets:
            changes[name] = F.coalesce(F.col(name), F.lit(UNKNOWN))
    return df.withColumns(changes) if changes else df
