"""Weighted scores over several metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weighted_score(
    df: DataFrame,
    metrics: Sequence[str],
    weights: Sequence[float] | None = None,
    name: str = "score",
) -> DataFrame:
    """Sum of the min-max scaled metrics times their weights (equal by default).

    A NULL metric, and one that is the same in all rows, adds nothing.
    """
    weights = list(weights) if weights is not None else [1 / len(metrics)] * len(metrics)
    if len(weights) != len(metrics):
        raise ValueError("one weight per metric is needed")
    bounds = df.agg(
        F.struct(
            *[F.min(F.col(m).cast("double")).alias(f"lo_{m}") for m in metrics],
            *[F.max(F.col(m).cast("double")).alias(f"hi_{m}") for m in metrics],
        )
    ).scalar()
    parts = []
    for metric, weight in zip(metrics, weights):
        low, high = bounds.getField(f"lo_{metric}"), bounds.getField(f"hi_{metric}")
        scaled = F.try_divide(F.col(metric).cast("double") - low, high - low)
        parts.append(F.coalesce(scaled * F.lit(float(weight)), F.lit(0.0)))
    return df.withColumn(name, reduce(add, parts))
