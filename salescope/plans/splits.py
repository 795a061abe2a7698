"""Deterministic train / test splits, as a ``split`` column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.columns import hash_percent
from salescope.operators.ordered import ordered_scan

SPLIT_KEYS = {"churn": "customer_sk", "ltv": "customer_sk", "demand": "product_sk"}
TRAIN_PERCENT = 80


def split_by_hash(df: DataFrame, key: str, train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """Random split on a row key, or group split on a group key.

    All rows of a key land on one side, the same one in every run.
    """
    train = hash_percent(key) < train_percent
    return df.withColumn("split", F.when(train, "train").otherwise("test"))


def split_by_time(
    df: DataFrame, order: Sequence[str], train_percent: int = TRAIN_PERCENT
) -> DataFrame:
    """The first part of the rows in time order trains, the rest tests."""
    scan = ordered_scan(
        df,
        [F.col(c) for c in order],
        row_number="__row",
        totals={"__rows": F.lit(1).cast("long")},
    )
    train = F.col("__row") <= F.expr(f"__rows * {train_percent} div 100")
    return scan.withColumn("split", F.when(train, "train").otherwise("test")).drop("__row", "__rows")


def cap_rows(df: DataFrame, order: Sequence[str], max_rows: int) -> DataFrame:
    """Mark rows beyond the first ``max_rows`` as ``unused``; nothing is dropped."""
    scan = ordered_scan(df, [F.col(c) for c in order], row_number="__row")
    out = scan if "split" in df.columns else scan.withColumn("split", F.lit("used"))
    beyond = F.col("__row") > max_rows
    return out.withColumn("split", F.when(beyond, "unused").otherwise(F.col("split"))).drop("__row")


def split_dataset(name: str, df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The split each model data set uses: forecast by time, the others by key.

    The row cap is off unless asked for.  A capped time split takes the
    earliest rows and divides those.
    """
    if name == "forecast":
        if max_rows is None:
            return split_by_time(df, ["date"])
        capped = cap_rows(df, ["date"], max_rows)
        used = split_by_time(capped.filter("split = 'used'").drop("split"), ["date"])
        return used.unionByName(capped.filter("split = 'unused'"))
    key = SPLIT_KEYS[name]
    halves = split_by_hash(df, key)
    return halves if max_rows is None else cap_rows(halves, [key], max_rows)
