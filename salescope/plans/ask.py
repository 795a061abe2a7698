"""Metrics from a few words: ``ask("top customers", df, ...)``.

The most specific phrase of the task decides, whole words only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.operators import delivery, distribution, metrics
from salescope.operators import timeseries as ts

# ---- fixed values: the phrases a task may contain and what they ask for ----
PHRASES = {
    "total": "total",
    "sum": "total",
    "count": "count",
    "average": "average",
    "mean": "average",
    "median": "median",
    "distribution": "summary",
    "histogram": "histogram",
    "box plot": "box",
    "trend": "time_series",
    "over time": "time_series",
    "monthly": "time_series",
    "by": "aggregate",
    "per": "aggregate",
    "pareto": "pareto",
    "top": "top",
    "concentration": "concentration",
    "vs": "correlation",
    "relationship": "correlation",
    "correlation": "correlation",
    "delivery time": "delivery_duration",
    "delivery delay": "delivery_delay",
    "delivery rate": "delivery_status",
    "growth": "growth",
    "change": "growth",
}
# ---- end of fixed values ----

# Where several phrases occur, the one that says most wins: what kind of answer
# before which single figure, and "by" or "per" only over the single figures.
SPECIFIC_FIRST = (
    "delivery_status",
    "delivery_duration",
    "delivery_delay",
    "growth",
    "pareto",
    "concentration",
    "correlation",
    "top",
    "histogram",
    "box",
    "summary",
    "time_series",
    "aggregate",
    "median",
    "average",
    "count",
    "total",
)
FIGURE_AGGREGATES = {"median": "median", "average": "mean", "count": "count", "total": "sum"}


def found_intents(task: str) -> set[str]:
    text = task.lower()
    return {
        intent for phrase, intent in PHRASES.items() if re.search(rf"\b{re.escape(phrase)}\b", text)
    }


def resolve(task: str) -> str:
    found = found_intents(task)
    for intent in SPECIFIC_FIRST:
        if intent in found:
            return intent
    raise ValueError(f"no known metric in: {task}")


def ask(
    task: str,
    df: DataFrame,
    column: str | None = None,
    group: str | None = None,
    date: str | None = None,
    *,
    agg: str | None = None,
    freq: str = "ME",
    top_n: int = 10,
) -> DataFrame:
    """Answer ``task`` over ``df`` as a DataFrame that has not run yet."""
    intent = resolve(task)

    def need(**given):
        missing = [name for name, value in given.items() if value is None]
        if missing:
            raise ValueError(f"{intent} needs {', '.join(missing)}")

    if intent == "delivery_duration":
        return delivery.delivery_duration(df)
    if intent in ("delivery_delay", "delivery_status"):
        delayed = delivery.delivery_delay(df)
        return delayed if intent == "delivery_delay" else delivery.delivery_status_rates(delayed)
    need(column=column)
    if intent in FIGURE_AGGREGATES:
        figures = {
            "total": metrics.total,
            "count": metrics.count,
            "average": metrics.average,
            "median": metrics.median,
        }
        return figures[intent](df, column)
    if intent == "summary":
        return metrics.summary_statistics(df, column)
    if intent == "histogram":
        return distribution.histogram(df, column)
    if intent == "box":
        return distribution.box_stats(df, column)
    if intent == "time_series":
        need(date=date)
        return ts.aggregate_time_period(df, date, column, freq, agg or "sum")
    if intent == "growth":
        need(date=date)
        series = ts.aggregate_time_period(df, date, column, freq, agg or "sum")
        return ts.growth_rate(series, ["period"], column, "growth_pct", series=True)
    if intent == "concentration" and group is None:
        # rows are the entities; they need an order among equal values
        entities = df.select(column, F.xxhash64(*df.columns).alias("__key"))
        return distribution.concentration_analysis(entities, column, "__key")
    need(group=group)
    if intent == "aggregate":
        named = [a for i, a in FIGURE_AGGREGATES.items() if i in found_intents(task)]
        return metrics.aggregate_metric(df, group, column, agg or (named[0] if named else "sum"))
    if intent == "pareto":
        return distribution.pareto_table(df, group, column)
    if intent == "top":
        return distribution.top_n(df, group, column, top_n)
    if intent == "concentration":
        sums = distribution.exact_sums(df, group, column)
        return distribution.concentration_analysis(sums, column, group)
    return distribution.correlation(df, column, group)


def kpi(df: DataFrame, column: str, metric: str = "total") -> DataFrame:
    return ask(metric, df, column)


def compare(df: DataFrame, column: str, group: str, agg: str = "sum") -> DataFrame:
    return ask("by", df, column, group, agg=agg)


def trend(df: DataFrame, column: str, date: str, freq: str = "ME") -> DataFrame:
    return ask("trend", df, column, date=date, freq=freq)


def top_n(df: DataFrame, column: str, group: str, n: int = 10) -> DataFrame:
    return ask("top", df, column, group, top_n=n)
