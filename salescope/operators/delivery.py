"""Delivery times, delays and service level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.columns import floor_days


def delivery_duration(
    df: DataFrame,
    purchased: str = "purchase_date",
    delivered: str = "delivered_date",
    name: str = "delivery_days",
) -> DataFrame:
    """Whole days from purchase to delivery, rounded down."""
    return df.withColumn(name, floor_days(purchased, delivered))


def delivery_delay(
    df: DataFrame,
    actual: str = "actual_date",
    estimated: str = "estimated_date",
    name: str = "delay_days",
) -> DataFrame:
    """Whole days after (positive) or before (negative) the promised date."""
    return df.withColumn(name, floor_days(estimated, actual))


def delivery_status_rates(df: DataFrame, delay: str = "delay_days") -> DataFrame:
    """Percent late, on time and early among known delays, and the mean delay; one row."""
    days = F.col(delay)
    known = F.count(days)

    def rate(condition):
        return F.round(F.try_divide(F.count_if(condition), known) * 100, 2)

    return df.agg(
        rate(days > 0).alias("late_pct"),
        rate(days == 0).alias("on_time_pct"),
        rate(days < 0).alias("early_pct"),
        F.round(F.try_divide(F.sum(days), known), 2).alias("average_delay"),
    )
