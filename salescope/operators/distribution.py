"""Shares, ranks, concentration, relationships and chart data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.columns import percent, ratio
from salescope.operators.aggregates import grouped
from salescope.operators.ordered import average_ranks, exact_quantiles, ordered_scan
from salescope.session import durable

TOP_PERCENTS = (1, 5, 10)


def ranked(df: DataFrame, value: str, key: str, name: str = "rank", ascending: bool = False, **scan):
    """``df`` with the gapless rank of ``value``; rows without a value get NULL.

    ``key`` breaks ties in the row order; further arguments go to the scan.
    Rows without a value come last in the scan, so ``df`` is evaluated once.
    """
    direction = F.asc_nulls_last(value) if ascending else F.desc_nulls_last(value)
    scanned = ordered_scan(df, [direction, F.asc(key)], dense_rank=(value, name), **scan)
    return scanned.withColumn(name, F.when(F.col(value).isNotNull(), F.col(name)))


rank_values = ranked


def top_n(df: DataFrame, group: str, value: str, n: int = 10) -> DataFrame:
    """Groups whose sum is among the ``n`` highest values; ties may give more rows.

    Only the ``n`` values travel, not the ranking of all groups.  Sums are
    ranked in the type Spark adds up in, so close ones are no false ties.
    """
    sums = exact_sums(df, group, value)
    best = sums.select(value).distinct().orderBy(F.desc(value)).limit(n)
    ranks = best.select(
        F.col(value).alias("__v"), F.row_number().over(Window.orderBy(F.desc(value))).alias("rank")
    )
    # at most n rows
    return sums.join(F.broadcast(ranks), sums[value] == ranks["__v"]).select(
        group, F.col(value).cast("double").alias(value), F.col("rank").cast("long").alias("rank")
    )


def first_n(df: DataFrame, value: str, key: str, n: int = 10) -> DataFrame:
    """Exactly ``n`` rows with the highest values, ties by key."""
    return df.orderBy(F.desc(value), F.asc(key)).limit(n)


def percentage_share(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Each row's part of the total, in percent."""
    whole = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, percent(value, whole))


def cumulative_percentage(
    df: DataFrame, value: str, key: str, name: str = "cumulative_pct"
) -> DataFrame:
    """Running part of the total from the highest value down, in percent."""
    scan = ordered_scan(
        df.filter(F.col(value).isNotNull()),
        [F.desc(value), F.asc(key)],
        running={"__run": F.col(value)},
        totals={"__all": F.col(value)},
    )
    return scan.select(*df.columns, percent("__run", "__all").alias(name))


def pareto_table(df: DataFrame, group: str, value: str) -> DataFrame:
    """Group sums with their cumulative share."""
    sums = exact_sums(df, group, value)
    out = cumulative_percentage(sums, value, group)
    return out.withColumn(value, F.col(value).cast("double"))


def exact_sums(df: DataFrame, group: str, value: str) -> DataFrame:
    """Group sums in the type Spark adds up in, for further exact sums."""
    known = df.filter(F.col(group).isNotNull())
    return known.groupBy(group).agg(F.coalesce(F.sum(value), F.lit(0)).alias(value))


def concentration_analysis(df: DataFrame, value: str, key: str) -> DataFrame:
    """How much the top entities hold, one row.

    ``top_1_pct_share`` and so on give the share of the top 1 %, 5 % and 10 %
    of the entities (at least one); ``entities_for_80pct_of_value`` the part of
    the entities, from the top, that reaches 80 % of the total.  All NULL when
    the total is not positive.
    """
    return concentration_figures(concentration_scan(df, value, key), value)


def concentration_scan(df: DataFrame, value: str, key: str, **scan) -> DataFrame:
    """Entities from the highest value down: position, running sum ``run``, ``whole`` and ``n``."""
    return ordered_scan(
        df.filter(F.col(value).isNotNull()),
        [F.desc(value), F.asc(key)],
        running={"run": F.col(value)},
        totals={"whole": F.col(value), "n": F.lit(1).cast("long")},
        row_number="position",
        **scan,
    )


def concentration_figures(scan: DataFrame, value: str) -> DataFrame:
    """The one-row result of ``concentration_analysis`` from its scan."""
    whole = F.max("whole").cast("double")
    n = F.max("n")
    columns: list[Column] = []
    for pct in TOP_PERCENTS:
        # ceil(n * pct / 100), at least 1, in whole numbers
        inside = F.col("position") <= F.greatest(F.lit(1), F.expr(f"(n * {pct} + 99) div 100"))
        held = F.sum(F.when(inside, F.col(value))).cast("double")
        columns.append(_positive(whole, held / whole * 100).alias(f"top_{pct}_pct_share"))
    reached = F.col("run") * 10 >= F.col("whole") * 8
    needed = F.min(F.when(reached, F.col("position")))
    columns.append(_positive(whole, needed / n * 100).alias("entities_for_80pct_of_value"))
    return scan.agg(*columns)


def _positive(whole: Column, result: Column) -> Column:
    return F.when(whole > 0, F.round(result, 2))


def correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson and Spearman correlation of two columns, one row.

    Rows are first counted per distinct pair, once.  The ranks are then joined
    to pairs, so a value shared by very many rows stays cheap.
    """
    pairs = durable(
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        .agg(F.count(F.lit(1)).alias("w"))
    )
    ranked_pairs = pairs
    for value, rank in (("x", "rx"), ("y", "ry")):
        ranks = average_ranks(pairs, value, "w", rank)
        ranked_pairs = ranked_pairs.join(ranks, value)
    means = pairs.agg(
        F.struct(
            F.sum("w").alias("n"),
            (F.sum(F.col("x") * F.col("w")) / F.sum("w")).alias("x"),
            (F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("y"),
        )
    ).scalar()
    middle = (means.getField("n") + 1) / 2  # the mean of ranks 1..n
    centred = ranked_pairs.select(
        "w",
        (F.col("x") - means.getField("x")).alias("x"),
        (F.col("y") - means.getField("y")).alias("y"),
        (F.col("rx") - middle).alias("rx"),
        (F.col("ry") - middle).alias("ry"),
    )

    def pearson(a: str, b: str) -> Column:
        def moment(p: str, q: str) -> Column:
            return F.sum(F.col(p) * F.col(q) * F.col("w"))

        return ratio(moment(a, b), F.sqrt(moment(a, a)) * F.sqrt(moment(b, b)))

    return centred.agg(pearson("x", "y").alias("pearson"), pearson("rx", "ry").alias("spearman"))


def detect_outliers(df: DataFrame, value: str, name: str = "is_outlier") -> DataFrame:
    """Flag values outside 1.5 interquartile ranges; NULL is no outlier."""
    quartiles = exact_quantiles(df, [value], {"q1": 0.25, "q3": 0.75})
    low, high = F.col(f"{value}_q1"), F.col(f"{value}_q3")
    fences = quartiles.select(
        F.struct(
            (low - 1.5 * (high - low)).alias("low"), (high + 1.5 * (high - low)).alias("high")
        )
    ).scalar()
    col = F.col(value).cast("double")
    outside = (col < fences.getField("low")) | (col > fences.getField("high"))
    return df.withColumn(name, F.coalesce(outside, F.lit(False)))


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """``(bin, low, high, n)`` over equal-width bins; the maximum is in the last one.

    Bins without values are there with 0.
    """
    col = F.col(value).cast("double")
    span = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    low = span.getField("lo")
    width = (span.getField("hi") - low) / bins
    slot = F.coalesce(F.floor(F.try_divide(col - low, width)), F.lit(0))
    counts = (
        df.filter(col.isNotNull())
        .groupBy(F.least(slot, F.lit(bins - 1)).cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # No values, no bins; one value, one bin.
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    every = every.filter(low.isNotNull() & ((width > 0) | (F.col("bin") == 0)))
    return every.join(counts, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def box_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Five-number summary, in all or per group."""
    points = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    out = exact_quantiles(df, [value], points, by=by)
    return out.select(*by, *[F.col(f"{value}_{p}").alias(p) for p in points])


def mean_matrix(df: DataFrame, rows: str, columns: str, value: str) -> DataFrame:
    """``(rows, columns, mean)``: the mean of ``value`` per pair of labels that occurs.

    One line per cell, so neither side has a limit and no label is lost.
    """
    mean = F.try_divide(F.sum(value).cast("double"), F.count(value))
    known = df.filter(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return known.groupBy(rows, columns).agg(mean.alias("mean"))


def pivot_mean(df: DataFrame, rows: str, columns: str, value: str) -> DataFrame:
    """The same as one column per label; the labels are found in one aggregate pass.

    Spark refuses more labels than ``spark.sql.pivotMaxValues``.
    """
    mean = F.try_divide(F.sum(value).cast("double"), F.count(value))
    return df.filter(F.col(rows).isNotNull()).groupBy(rows).pivot(columns).agg(mean)


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
