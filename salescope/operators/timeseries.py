"""Period aggregates and operators on period series.

A period series has one row per calendar period, so its length is bounded by
the calendar and not by the sales volume.  That is why what builds on one may
use a window without a partition key, in one task; callers say so by ``series``.
Growth, rolling means and slopes of any other frame run over range partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from salescope.operators.aggregates import grouped
from salescope.operators.ordered import ordered_scan, over_previous

# frequency -> (step of the calendar, unit periods are truncated to)
FREQUENCIES = {
    "D": ("interval 1 day", "day"),
    "W": ("interval 7 days", "week"),
    "ME": ("interval 1 month", "month"),
    "QE": ("interval 3 months", "quarter"),
    "YE": ("interval 1 year", "year"),
}
ZERO_WHEN_EMPTY = ("sum", "count", "nunique")


def period_start(day: Column, freq: str) -> Column:
    if freq == "D":
        return day
    return F.trunc(day, FREQUENCIES[freq][1])


def period_end(start: Column, freq: str) -> Column:
    """Last day of the period that begins on ``start``; weeks end on Sunday."""
    step = FREQUENCIES[freq][0]
    return F.date_sub((start + F.expr(step)).cast("date"), 1)


def aggregate_time_period(
    df: DataFrame,
    date: str,
    value: str,
    freq: str = "ME",
    agg: str = "sum",
    name: str | None = None,
) -> DataFrame:
    """``(period, <name>)`` per period end, periods without rows included.

    An empty period has sum and count 0 and every other aggregate NULL.
    """
    return aggregate_periods(df, date, {name or value: (value, agg)}, freq)


def aggregate_periods(
    df: DataFrame, date: str, specs: dict[str, tuple[str, str]], freq: str = "ME"
) -> DataFrame:
    """Several named aggregates per period; see ``aggregate_time_period``."""
    start = period_start(F.to_date(date), freq)
    filled = fill_periods(grouped(df.withColumn("__start", start), ["__start"], specs), freq)
    values = [
        F.coalesce(F.col(n), F.lit(0)).alias(n) if agg in ZERO_WHEN_EMPTY else F.col(n)
        for n, (_, agg) in specs.items()
    ]
    return filled.select(period_end(F.col("__start"), freq).alias("period"), *values)


def fill_periods(series: DataFrame, freq: str) -> DataFrame:
    """Add the missing periods of a ``__start`` series, with NULL values.

    Each period also emits the empty ones up to the next period, so the
    calendar costs no self-join.
    """
    step = F.expr(FREQUENCIES[freq][0])
    following = F.lead("__start").over(Window.orderBy("__start"))
    values = [c for c in series.columns if c != "__start"]
    ends = series.withColumn("__end", F.coalesce(F.date_sub(following, 1), F.col("__start")))
    gaps = ends.select(
        *series.columns, F.explode(F.sequence("__start", "__end", step)).alias("__slot")
    )
    present = F.col("__slot") == F.col("__start")
    return gaps.select(
        F.col("__slot").alias("__start"), *[F.when(present, F.col(v)).alias(v) for v in values]
    )


def growth_rate(df: DataFrame, order: Sequence[str], value: str, name: str, series: bool = False) -> DataFrame:
    """Change over the previous row in percent; NULL after a zero."""

    def change(window: WindowSpec) -> dict[str, Column]:
        previous = F.lag(value).over(window).cast("double")
        return {name: F.try_divide(F.col(value).cast("double") - previous, previous) * 100}

    return _over_previous(df, order, 1, change, series)


def rolling_average(
    df: DataFrame, order: Sequence[str], value: str, name: str, window: int = 3, series: bool = False
) -> DataFrame:
    """Mean of the last ``window`` rows, NULL unless all of them have a value."""

    def mean(ordered: WindowSpec) -> dict[str, Column]:
        frame = ordered.rowsBetween(1 - window, Window.currentRow)
        total = F.sum(F.col(value)).over(frame).cast("double")
        return {name: F.when(F.count(value).over(frame) == window, total / window)}

    return _over_previous(df, order, window - 1, mean, series)


def _over_previous(df, order, reach, columns, series):
    """``series`` promises one row per calendar period; then one task is enough."""
    if series:
        return df.withColumns(columns(Window.orderBy(*order)))
    return over_previous(df, [F.col(c) for c in order], reach, columns)


def trend_slope(
    df: DataFrame, order: Sequence[str], value: str, name: str = "slope", series: bool = False
) -> DataFrame:
    """Least-squares slope per step of the non-null values, one row."""
    known = df.filter(F.col(value).isNotNull())
    if series:
        known = known.withColumn("__row", F.row_number().over(Window.orderBy(*order)))
    else:
        known = ordered_scan(known, [F.col(c) for c in order], row_number="__row")
    step = (F.col("__row") - 1).cast("double")
    points = known.select(step.alias("x"), F.col(value).cast("double").alias("y"))
    return points.agg(F.regr_slope("y", "x").alias(name))


def with_trend_slope(df: DataFrame, order: Sequence[str], value: str, name: str = "slope") -> DataFrame:
    """The same slope on every row of the series, without evaluating the series twice.

    The windows run over a period series, whose length is the number of periods.
    """
    whole = Window.partitionBy(F.lit(0))
    known = F.col(value).isNotNull()
    step = F.sum(known.cast("long")).over(whole.orderBy(*order)) - 1
    x = F.when(known, step.cast("double"))
    numbered = df.withColumn("__x", x)
    slope = F.regr_slope(F.col(value).cast("double"), F.col("__x")).over(whole)
    return numbered.withColumn(name, slope).drop("__x")
