"""From a cleaned data set to numeric model columns.

Everything learnt from the data (columns to drop, categories, bounds) is fitted
once and then applied with plain column expressions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.columns import (
    calendar_parts,
    is_datetime,
    numeric_columns,
    string_columns,
)
from salescope.operators.ordered import exact_quantiles, ordered_scan
from salescope.operators.profiling import column_profile
from salescope.plans.datasets import LEAKAGE_COLUMNS, TARGETS, protected_columns
from salescope.session import durable

# ---- fixed values ----
HIGH_CARDINALITY = 0.95
LOW_VARIANCE = 0.99
CLIP_LOWER = 0.01
CLIP_UPPER = 0.99
MAX_ONE_HOT = 10
ID_SUFFIXES = ("_id", "_sk")
ID_NAMES = ("id", "sales_id")
# ---- end of fixed values ----
UNKNOWN_CODE = -1.0  # a value the fit has not seen


def identifier_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c.lower().endswith(ID_SUFFIXES) or c.lower() in ID_NAMES]


def remove_identifier_columns(df: DataFrame) -> DataFrame:
    return df.drop(*identifier_columns(df.columns))


def remove_leakage_columns(df: DataFrame, name: str) -> DataFrame:
    return df.drop(*LEAKAGE_COLUMNS.get(name, []))


def remove_datetime_columns(df: DataFrame, protected: Sequence[str] = ()) -> DataFrame:
    return df.drop(
        *[f.name for f in df.schema.fields if is_datetime(f.dataType) and f.name not in protected]
    )


def one_hot_columns(column: str, values: Sequence[str]) -> dict[str, Column]:
    """An indicator per known value; an unknown value is zero in all of them."""
    return {
        f"{column}_{v}": F.coalesce((F.col(column) == v).cast("double"), F.lit(0.0)) for v in values
    }


def code_table(df: DataFrame, column: str) -> DataFrame:
    """``(column, code)``: 0, 1, 2 ... in the order of the sorted values."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    scan = ordered_scan(values, [F.col(column)], row_number="__row")
    return scan.select(column, (F.col("__row") - 1).cast("double").alias("__code"))


@dataclass(frozen=True)
class Bounds:
    """Clip limits of a column; after clipping they are its minimum and maximum too."""

    low: float
    high: float

    def clipped(self, column: str) -> Column:
        return F.least(F.greatest(F.col(column).cast("double"), F.lit(self.low)), F.lit(self.high))

    def scaled(self, column: str) -> Column:
        """0..1; a constant column becomes 0."""
        width = self.high - self.low
        if width == 0:
            return F.when(F.col(column).isNotNull(), F.lit(0.0))
        return (self.clipped(column) - self.low) / width


@dataclass(frozen=True)
class Preprocessor:
    """A fitted chain for one data set; ``keys`` pass through unchanged."""

    name: str
    keys: tuple[str, ...]
    dropped: tuple[str, ...]
    one_hot: Mapping[str, tuple[str, ...]]
    codes: Mapping[str, DataFrame]
    bounds: Mapping[str, Bounds] = field(default_factory=dict)

    def encode(self, df: DataFrame) -> DataFrame:
        out = df.drop(*self.dropped)
        for column, table in self.codes.items():
            known = F.coalesce(F.col("__code"), F.lit(UNKNOWN_CODE))
            out = out.join(table, column, "left").withColumn(column, known).drop("__code")
        for column, values in self.one_hot.items():
            out = out.withColumns(one_hot_columns(column, values)).drop(column)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        encoded = self.encode(df)
        scaled = {c: b.scaled(c) for c, b in self.bounds.items() if c in encoded.columns}
        return encoded.withColumns(scaled) if scaled else encoded

    def feature_columns(self, df: DataFrame) -> list[str]:
        """Model inputs of a transformed frame."""
        skip = set(self.keys) | set(TARGETS.get(self.name, [])) | {"split"}
        skip |= {f.name for f in df.schema.fields if is_datetime(f.dataType)}
        return [c for c in df.columns if c not in skip]


def fit_preprocessor(name: str, df: DataFrame, extra_keys: Sequence[str] = ()) -> Preprocessor:
    """Learn the chain for data set ``name`` from ``df`` (the training rows).

    What reaches the driver is bounded by the number of columns: one profile
    row each, at most ten categories each and two percentiles each.
    """
    protected = protected_columns(name)
    keys = [*identifier_columns(df.columns), *[c for c in extra_keys if c in df.columns]]
    rest = remove_datetime_columns(remove_leakage_columns(df.drop(*keys), name), list(protected))
    text = set(string_columns(rest))
    one_hot_candidates: list[str] = []
    coded: list[str] = []
    dropped = [c for c in df.columns if c not in keys and c not in rest.columns]
    # Protected figures are kept whatever they hold, so they are not profiled.
    profiled = [c for c in rest.columns if c in text or c not in protected]
    profile = column_profile(rest.select(*profiled)).collect() if profiled else []
    for p in profile:
        values = p.distinct_values + (1 if p.nulls else 0)
        constant = values <= 1 or p.top_count >= p.row_count * LOW_VARIANCE
        spread = p.column_name in text and p.distinct_values >= p.row_count * HIGH_CARDINALITY
        if p.column_name not in protected and (constant or spread):
            dropped.append(p.column_name)
        elif p.column_name in text:
            small = p.distinct_values <= MAX_ONE_HOT
            (one_hot_candidates if small else coded).append(p.column_name)
    one_hot = {c: tuple(v) for c, v in _categories(rest, sorted(one_hot_candidates)).items()}
    draft = Preprocessor(
        name=name,
        keys=tuple(keys),
        dropped=tuple(dropped),
        one_hot=one_hot,
        codes={c: code_table(rest, c) for c in sorted(coded)},
    )
    encoded = draft.encode(df)
    indicators = {label for c, vs in one_hot.items() for label in one_hot_columns(c, vs)}
    scalable = [
        c
        for c in numeric_columns(encoded)
        if c not in protected and c not in indicators and c not in keys
    ]
    if not scalable:
        return draft
    limits = exact_quantiles(encoded, scalable, {"lo": CLIP_LOWER, "hi": CLIP_UPPER}).first()
    bounds = {
        c: Bounds(limits[f"{c}_lo"], limits[f"{c}_hi"])
        for c in scalable
        if limits[f"{c}_lo"] is not None
    }
    return Preprocessor(name, draft.keys, draft.dropped, one_hot, draft.codes, bounds)


def _categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted values of columns known to have at most ``MAX_ONE_HOT`` of them."""
    if not columns:
        return {}
    row = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def preprocess(name: str, df: DataFrame, fit_on: str = "train") -> tuple[DataFrame, Preprocessor]:
    """Fit on the training rows (``split`` column) or on ``all`` rows, apply to all."""
    rows = df
    if fit_on == "train" and "split" in df.columns:
        rows = df.filter("split = 'train'")
    fitted = fit_preprocessor(name, rows.drop("split"))
    return fitted.transform(df), fitted


def encode_categories(df: DataFrame, max_one_hot: int = MAX_ONE_HOT) -> DataFrame:
    """Indicators for text columns with few values, sorted codes for the others."""
    text = string_columns(df)
    distinct = {}
    if text:
        profile = column_profile(df.select(*text)).collect()
        distinct = {p.column_name: p.distinct_values for p in profile}
    few = [c for c in text if distinct.get(c, 0) <= max_one_hot]
    one_hot = _categories(df, few)
    many = [c for c in text if c not in few]
    coded = Preprocessor(
        "", (), (), {c: tuple(v) for c, v in one_hot.items()}, {c: code_table(df, c) for c in many}
    )
    return coded.encode(df)


def clip_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Clip columns to their own 1st and 99th percentile."""
    limits = exact_quantiles(df, columns, {"lo": CLIP_LOWER, "hi": CLIP_UPPER}).first()
    return df.withColumns(
        {c: Bounds(limits[f"{c}_lo"], limits[f"{c}_hi"]).clipped(c) for c in columns}
    )


def minmax_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns to 0..1; a constant column becomes 0."""
    low_high = df.agg(
        F.struct(
            *[F.min(F.col(c).cast("double")).alias(f"lo_{c}") for c in columns],
            *[F.max(F.col(c).cast("double")).alias(f"hi_{c}") for c in columns],
        )
    ).scalar()
    out = {}
    for c in columns:
        low, high = low_high.getField(f"lo_{c}"), low_high.getField(f"hi_{c}")
        col = F.col(c).cast("double")
        out[c] = F.when(col.isNotNull(), F.coalesce(F.try_divide(col - low, high - low), F.lit(0.0)))
    return df.withColumns(out)


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns to mean 0 and population deviation 1; a constant column becomes 0."""
    moments = df.agg(
        F.struct(
            *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(F.col(c).cast("double")).alias(f"dev_{c}") for c in columns],
        )
    ).scalar()
    out = {}
    for c in columns:
        col = F.col(c).cast("double")
        centred = col - moments.getField(f"mean_{c}")
        scaled = F.try_divide(centred, moments.getField(f"dev_{c}"))
        out[c] = F.when(col.isNotNull(), F.coalesce(scaled, F.lit(0.0)))
    return df.withColumns(out)


def _values(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a column."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return [r[0] for r in values.orderBy(column).collect()]


def sparse_indicators(
    df: DataFrame, columns: Sequence[str], name: str = "indicators"
) -> tuple[DataFrame, DataFrame]:
    """Indicators of any number of values, as the positions of the ones.

    Returns ``df`` with ``name``, the ascending positions in place of ``columns``, and
    the dictionary ``(position, column_name, value)``: columns in the given order,
    values sorted.  Neither passes through the driver.  A null has no position.
    """
    cells = [F.struct(F.lit(n).alias("n"), F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for n, c in enumerate(columns)]
    values = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").filter("value IS NOT NULL").distinct()
    scan = ordered_scan(values, [F.col("n"), F.col("value")], row_number="__row")
    dictionary = durable(scan.select((F.col("__row") - 1).alias("position"), "column_name", "value"))
    out = df
    for n, column in enumerate(columns):
        own = dictionary.filter(F.col("column_name") == column)
        own = own.select(F.col("value").alias(f"__value_{n}"), F.col("position").alias(f"__at_{n}"))
        out = out.join(own, F.col(column).cast("string") == F.col(f"__value_{n}"), "left").drop(f"__value_{n}")
    places = F.array_compact(F.array(*[F.col(f"__at_{n}") for n in range(len(columns))]))
    out = out.withColumn(name, places).drop(*columns, *[f"__at_{n}" for n in range(len(columns))])
    return out, dictionary


def prepare(
    df: DataFrame,
    dates: Sequence[str] = (),
    categories: Sequence[str] = (),
    numbers: Sequence[str] = (),
    scaling: str = "standard",
    codes: Sequence[str] = (),
) -> DataFrame:
    """Calendar parts, indicators, codes and scaling of chosen columns in one go.

    ``categories`` get one indicator per value, however many there are, and their
    values pass through the driver.  A column with very many values belongs in
    ``codes``, which gives it one column of sorted codes, or to
    ``sparse_indicators``.  Any ``scaling`` but "standard" means min-max.
    """
    for column in dates:
        df = calendar_parts(df, column)
    for column in categories:
        df = df.withColumns(one_hot_columns(column, _values(df, column))).drop(column)
    if codes:
        df = Preprocessor("", (), (), {}, {c: code_table(df, c) for c in codes}).encode(df)
    if numbers:
        df = standard_scale(df, numbers) if scaling == "standard" else minmax_scale(df, numbers)
    return df
