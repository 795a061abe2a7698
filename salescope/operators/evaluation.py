"""Prediction quality as plain aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.columns import ratio
from salescope.operators.ordered import average_ranks
from salescope.session import durable


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(rmse, mae, r2)``, one row."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    known = df.filter(y.isNotNull() & p.isNotNull())
    residual = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    return known.agg(
        F.sqrt(ratio(residual, F.count(y))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - ratio(residual, spread)).alias("r2"),
    )


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """``(accuracy, roc_auc)`` of a 0/1 label and a score, one row.

    The exact area under the ROC curve follows from the ranks of the positives;
    NULL when only one class is present.
    """
    counts = durable(
        df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("s"))
        .agg(
            F.count(F.lit(1)).alias("w"),
            F.count_if(F.col(label) == 1).alias("pos"),
        )
    )
    ranks = counts.join(average_ranks(counts, "s", "w", "rank"), "s")
    hit = F.when(F.col("s") > threshold, F.col("pos")).otherwise(F.col("w") - F.col("pos"))
    positives, rows = F.sum("pos").cast("double"), F.sum("w").cast("double")
    above = F.sum(F.col("rank") * F.col("pos")) - positives * (positives + 1) / 2
    return ranks.agg(
        ratio(F.sum(hit), rows).alias("accuracy"),
        ratio(above, positives * (rows - positives)).alias("roc_auc"),
    )
