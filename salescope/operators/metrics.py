"""Single figures, grouped figures and joins of sales data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.operators.aggregates import builtin, grouped
from salescope.operators.ordered import exact_quantiles

EQUALITY_FILTERS = (
    "store_sk",
    "sales_sk",
    "sales_id",
    "customer_sk",
    "product_sk",
    "salesperson_sk",
    "campaign_sk",
)


def total(df: DataFrame, column: str, name: str = "total") -> DataFrame:
    return df.agg(builtin("sum", column).alias(name))


def count(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    return df.agg(builtin("count", column).alias(name))


def unique_count(df: DataFrame, column: str, name: str = "unique_count") -> DataFrame:
    return df.agg(builtin("nunique", column).alias(name))


def average(df: DataFrame, column: str, name: str = "average") -> DataFrame:
    return df.agg(builtin("mean", column).alias(name))


def median(df: DataFrame, column: str, name: str = "median") -> DataFrame:
    return grouped(df, [], {name: (column, "median")})


def standard_deviation(df: DataFrame, column: str, name: str = "std") -> DataFrame:
    return df.agg(builtin("std", column).alias(name))


def summary_statistics(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, median, std, min, max, p25 and p75, in all or per group."""
    by = list(by)
    plain = grouped(
        df, by, {name: (column, name) for name in ("count", "mean", "std", "min", "max")}
    )
    plain = plain.withColumns({c: F.col(c).cast("double") for c in ("min", "max")})
    points = {"p25": 0.25, "median": 0.5, "p75": 0.75}
    spread = exact_quantiles(df, [column], points, by=by)
    spread = spread.select(*by, *[F.col(f"{column}_{p}").alias(p) for p in points])
    if by:
        out = plain.join(spread, by, "left")
    else:
        row = spread.select(F.struct(*spread.columns).alias("q")).scalar()
        out = plain.withColumns({p: row.getField(p) for p in points})
    return out.select(*by, "count", "mean", "median", "std", "min", "max", "p25", "p75")


def aggregate_metric(df: DataFrame, group: str, metric: str, agg: str = "sum") -> DataFrame:
    return grouped(df, [group], {metric: (metric, agg)})


def aggregate_multiple_metrics(
    df: DataFrame, group: str | Sequence[str], metrics: Mapping[str, str | Sequence[str]]
) -> DataFrame:
    """Several metrics per group; the result columns are ``<column>_<aggregate>``."""
    keys = [group] if isinstance(group, str) else list(group)
    specs = {}
    for column, aggs in metrics.items():
        for agg in [aggs] if isinstance(aggs, str) else aggs:
            specs[f"{column}_{agg}"] = (column, agg)
    return grouped(df, keys, specs)


def basket_size(df: DataFrame, order_id: str) -> DataFrame:
    known = df.filter(F.col(order_id).isNotNull())
    return known.groupBy(order_id).agg(F.count(F.lit(1)).alias("basket_size"))


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive; 1.0 when there is no positive."""
    positives = F.count_if(F.col(label) == 1)
    negatives = F.count_if(F.col(label) == 0)
    return df.agg(F.coalesce(F.try_divide(negatives, positives), F.lit(1.0)).alias("class_weight"))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    columns: Sequence[str],
) -> DataFrame:
    """Left join that adds some columns of a lookup table.

    The lookup is pruned to what is needed; whether it is broadcast is left to
    Spark, which knows its size.  When the two keys share a name that name
    appears once.
    """
    picked = right.select(F.col(right_key).alias("__key"), *[c for c in columns if c != right_key])
    return left.join(picked, left[left_key] == F.col("__key"), "left").drop("__key")


def store_sales(
    sales: DataFrame,
    *,
    date_min: str | None = None,
    date_max: str | None = None,
    **equals,
) -> DataFrame:
    """Sales lines that match every given key and an inclusive date range, by date."""
    unknown = set(equals) - set(EQUALITY_FILTERS)
    if unknown:
        raise ValueError(f"cannot filter on {', '.join(sorted(unknown))}")
    conditions: list[Column] = [
        F.col(name) == F.lit(value) for name, value in equals.items() if value is not None
    ]
    if date_min is not None:
        conditions.append(F.col("sales_date") >= F.lit(date_min).cast("timestamp_ntz"))
    if date_max is not None:
        conditions.append(F.col("sales_date") <= F.lit(date_max).cast("timestamp_ntz"))
    for condition in conditions:
        sales = sales.filter(condition)
    return sales.orderBy("sales_date", "sales_sk")
