"""The ordered scan against plain windows, with groups cut by partitions."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salescope.operators import timeseries as ts
from salescope.operators.ordered import average_ranks, exact_quantiles, ordered_scan, over_previous


@pytest.fixture
def skewed(spark):
    """Half of the rows in one group, many equal values."""
    rows = [(i, "hot" if i % 2 else f"g{i % 7}", (i * 37) % 11) for i in range(400)]
    return spark.createDataFrame(rows, "id long, g string, v long")


def same(got, want):
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_whole_frame_equals_window(skewed):
    order = [F.desc("v"), F.col("id")]
    got = ordered_scan(
        skewed, order, running={"run": F.col("v")}, totals={"all": F.col("v")},
        row_number="row", dense_rank=("v", "rank"), partitions=7,
    )
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select(
        "*",
        F.row_number().over(Window.orderBy(*order)).alias("row"),
        F.sum("v").over(upto).alias("run"),
        F.sum("v").over(Window.partitionBy()).alias("all"),
        F.dense_rank().over(Window.orderBy(F.desc("v"))).alias("rank"),
    )
    same(got.select(want.columns), want)


def test_groups_equal_window(skewed):
    got = ordered_scan(
        skewed, [F.col("v"), F.col("id")], by=["g"], running={"run": F.col("v")},
        totals={"all": F.lit(1)}, row_number="row", dense_rank=("v", "rank"), partitions=9,
    )
    group = Window.partitionBy("g")
    order = group.orderBy("v", "id")
    want = skewed.select(
        "*",
        F.sum("v").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
        F.row_number().over(order).alias("row"),
        F.count("*").over(group).alias("all"),
        F.dense_rank().over(group.orderBy("v")).alias("rank"),
    )
    same(got.select(want.columns), want)


@pytest.mark.parametrize("partitions", [None, 6])
def test_quantiles_equal_builtin(skewed, partitions):
    points = {"lo": 0.01, "q1": 0.25, "mid": 0.5, "hi": 0.99}
    got = exact_quantiles(skewed, ["v", "id"], points, by=["g"], partitions=partitions)
    want = skewed.groupBy("g").agg(
        *[F.percentile(c, F.lit(q)).alias(f"{c}_{n}") for c in ("v", "id") for n, q in points.items()]
    )
    rows = {r.g: r for r in want.collect()}
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        for c in got.columns[1:]:
            assert r[c] == pytest.approx(rows[r.g][c])


def test_quantiles_of_many_rows_are_exact(spark):
    """Enough rows for the sketch to merge far values, with heavy ties."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.rand(5) * 1000).alias("x")
    ).persist()
    points = {"a": 0.01, "b": 0.25, "c": 0.3334, "d": 0.5, "e": 0.9999}
    got = exact_quantiles(df, ["x"], points, partitions=5).first()
    want = df.agg(*[F.percentile("x", F.lit(q)).alias(n) for n, q in points.items()]).first()
    for n in points:
        assert got[f"x_{n}"] == pytest.approx(want[n])


def test_quantiles_of_large_groups_move_few_values(spark, monkeypatch):
    """Exact for large, small and null groups with ties, and most distinct values stay where they are."""
    from salescope.operators import ordered

    group = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 4 == 1, "warm").when(F.col("id") % 100 == 3, None)
    df = spark.range(80_000).select(
        group.otherwise(F.concat(F.lit("g"), F.col("id") % 60)).alias("g"),
        F.when(F.col("id") % 5 == 0, F.lit(7.0)).otherwise(F.rand(5) * 1000).alias("x"),
        F.when(F.col("id") % 3 > 0, F.randn(8)).alias("y"),
    )
    df = ordered.durable(df)
    moved, counts = [], ordered.value_counts
    monkeypatch.setattr(ordered, "value_counts", lambda *a, **k: moved.append(counts(*a, **k)) or moved[-1])
    points = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.999, "f": 1.0}
    got = {r.g: r for r in exact_quantiles(df, ["x", "y"], points, by=["g"], partitions=5).collect()}
    want = df.filter("g IS NOT NULL").groupBy("g").agg(
        *[F.percentile(c, F.lit(q)).alias(f"{c}_{n}") for c in ("x", "y") for n, q in points.items()]
    ).collect()
    assert len(got) == len(want)
    for r in want:
        assert all(got[r.g][c] == pytest.approx(r[c]) for c in r.asDict() if c != "g")
    large = df.filter("g IN ('hot', 'warm')")
    distinct = large.groupBy("g").agg(F.count_distinct("x") + F.count_distinct("y")).collect()
    sent = moved[0].filter("g IN ('hot', 'warm')").count()
    assert sent < 0.05 * sum(r[1] for r in distinct)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(empty, ["v"], {"m": 0.5}).first()["v_m"] is None
    assert exact_quantiles(empty, ["v"], {"m": 0.5}, by=["g"]).count() == 0
    assert ordered_scan(empty, [F.col("v")], row_number="n").count() == 0


def test_average_ranks_share_ties(frame):
    df = frame("x double, w long", (1.0, 1), (2.0, 2), (3.0, 1))
    assert {r.x: r.r for r in average_ranks(df, "x", "w", "r").collect()} == {1: 1, 2: 2.5, 3: 4}


@pytest.mark.parametrize(("reach", "size"), [(1, 7), (6, 10), (9, 4), (0, 5), (500, 20)])
def test_rows_before_come_from_the_bucket_before(skewed, reach, size):
    order = [F.col("v"), F.col("id")]

    def columns(window):
        frame = window.rowsBetween(-reach, 0)
        return {"n": F.count("*").over(frame), "s": F.sum("id").over(frame), "last": F.lag("id", min(reach, 1)).over(window)}

    got = over_previous(skewed, order, reach, columns, bucket_rows=size)
    same(got, skewed.withColumns(columns(Window.orderBy(*order))))


def test_any_frame_gives_what_a_series_gives(skewed):
    order = ["v", "id"]
    for f in (ts.growth_rate, ts.rolling_average):
        got, want = f(skewed, order, "id", "x"), f(skewed, order, "id", "x", series=True)
        same(got.select("id", "x"), want.select("id", "x"))
        # What meets in one task is one row per partition; the rows meet by bucket.
        plan = got._jdf.queryExecution().executedPlan().toString()
        for window in plan.split("Window ")[1:]:
            assert "__bucket" in window or "__part" in window
    slope = ts.trend_slope(skewed, order, "id")
    assert slope.first()[0] == pytest.approx(ts.trend_slope(skewed, order, "id", series=True).first()[0])
    assert ts.growth_rate(skewed.limit(0), order, "id", "x").count() == 0
