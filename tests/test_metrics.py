"""Figures, ranks, shares and scores on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from salescope.functions.columns import ratio
from salescope.operators import delivery, distribution, metrics
from salescope.operators import timeseries as ts
from salescope.operators.aggregates import with_distinct_counts
from salescope.operators.evaluation import classification_metrics, regression_metrics
from salescope.operators.scoring import weighted_score

SIX = [1, 2, 2, 5, 9, 40]
approx = pytest.approx


@pytest.fixture
def six(frame):
    return frame("id long, x double", *[(i, float(v)) for i, v in enumerate(SIX)])


def test_summary(six):
    row = metrics.summary_statistics(six, "x").first()
    assert (row["count"], row["p25"], row["median"], row["p75"]) == (6, 2.0, 3.5, 8.0)
    assert row["std"] == approx(15.0654129)
    assert metrics.median(six, "x").first()[0] == 3.5


def test_figures_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, x double")
    assert metrics.total(empty, "x").first()[0] == 0
    assert metrics.count(empty, "x").first()[0] == 0
    assert metrics.unique_count(empty, "x").first()[0] == 0
    for f in (metrics.average, metrics.median, metrics.standard_deviation):
        assert f(empty, "x").first()[0] is None
    assert metrics.aggregate_metric(empty, "g", "x").count() == 0


def test_null_group_is_dropped_and_null_values_skipped(frame):
    df = frame("g string, x double", ("a", 1.0), ("a", None), (None, 9.0), ("b", None))
    got = {r.g: r for r in metrics.aggregate_multiple_metrics(
        df, "g", {"x": ["sum", "count", "mean", "median", "nunique"]}).collect()}
    assert set(got) == {"a", "b"}
    assert tuple(got["a"])[1:] == (1.0, 1, 1.0, 1.0, 1)
    assert tuple(got["b"])[1:] == (0.0, 0, None, None, 0)


def test_unknown_aggregate(six):
    with pytest.raises(ValueError, match="mode"):
        metrics.aggregate_metric(six, "id", "x", "mode")


def test_rank_leaves_null_unranked(frame):
    df = frame("id long, x double", *enumerate([1.0, 2.0, 2.0, 5.0, 9.0, 40.0, None]))
    got = [(r.x, r["rank"]) for r in distribution.rank_values(df, "x", "id").orderBy("id").collect()]
    assert got == [(1, 5), (2, 4), (2, 4), (5, 3), (9, 2), (40, 1), (None, None)]


def test_outliers(six):
    flagged = distribution.detect_outliers(six, "x").filter("is_outlier").collect()
    assert [r.x for r in flagged] == [40]


def test_concentration(six, frame):
    row = distribution.concentration_analysis(six, "x", "id").first()
    assert tuple(row) == (67.8, 67.8, 67.8, 33.33)
    negative = frame("id long, x double", (1, -1.0))
    assert tuple(distribution.concentration_analysis(negative, "x", "id").first()) == (None,) * 4


def test_cumulative(six):
    got = distribution.cumulative_percentage(six, "x", "id").orderBy(F.desc("x"), "id").collect()
    want = [67.7966, 83.0508, 91.5254, 94.9153, 98.3051, 100]
    assert [r.cumulative_pct for r in got] == approx(want, abs=1e-4)


def test_shares_sum_to_100(six):
    got = distribution.percentage_share(six, "x").collect()
    assert sum(r.share_pct for r in got) == approx(100)


def test_top_n_keeps_ties(frame):
    df = frame("g string, x double", ("a", 5.0), ("b", 5.0), ("c", 3.0), ("d", 1.0))
    assert sorted(r.g for r in distribution.top_n(df, "g", "x", 1).collect()) == ["a", "b"]


def test_spearman_shares_ties(frame):
    df = frame("x double, y double", (1.0, 1.0), (2.0, 3.0), (2.0, 2.0), (3.0, 4.0), (None, 1.0))
    assert distribution.correlation(df, "x", "y").first()["spearman"] == approx(0.9486833)


def test_weighted_score(frame):
    df = frame("id long, a double, b double", (1, 0.0, 7.0), (2, 5.0, 7.0), (3, 10.0, 7.0))
    got = weighted_score(df, ["a", "b"]).orderBy("id").collect()
    assert [r.score for r in got] == [0, 0.25, 0.5]
    with pytest.raises(ValueError):
        weighted_score(df, ["a", "b"], [1.0])


def test_ratio(frame):
    df = frame("n double, d double", (4.0, 2.0), (1.0, 0.0), (None, 3.0))
    assert [r[0] for r in df.select(ratio("n", "d")).collect()] == [2, None, None]


def test_class_weight(frame):
    assert metrics.class_weight(frame("y int", 1, 0, 0, 0), "y").first()[0] == 3.0
    assert metrics.class_weight(frame("y int", 0, 0), "y").first()[0] == 1.0


def test_lookup_join_keeps_unmatched_and_drops_right_key(frame):
    left, right = frame("a long", 1, 2), frame("b long, name string, other string", (1, "x", "y"))
    out = metrics.lookup_join(left, right, "a", "b", ["name"])
    assert out.columns == ["a", "name"]
    assert sorted(map(tuple, out.collect())) == [(1, "x"), (2, None)]


def test_histogram_puts_maximum_in_last_bin(six, frame):
    got = {r.bin: r.n for r in distribution.histogram(six, "x", 4).collect()}
    assert got == {0: 5, 1: 0, 2: 0, 3: 1}
    same = frame("x double", 3.0, 3.0)
    assert [tuple(r)[0::3] for r in distribution.histogram(same, "x", 4).collect()] == [(0, 2)]


def days(*values):
    return [dt.date(2024, m, d) for m, d in values]


def test_empty_month_appears(frame):
    df = frame("d date, x double", (dt.date(2024, 1, 1), 1.0), (dt.date(2024, 3, 5), 2.0))
    ends = days((1, 31), (2, 29), (3, 31))
    total = ts.aggregate_time_period(df, "d", "x").orderBy("period").collect()
    assert [tuple(r) for r in total] == list(zip(ends, [1, 0, 2]))
    mean = ts.aggregate_time_period(df, "d", "x", agg="mean").orderBy("period").collect()
    assert [tuple(r) for r in mean] == list(zip(ends, [1, None, 2]))


@pytest.mark.parametrize(
    ("freq", "last"),
    [("D", dt.date(2024, 5, 15)), ("W", dt.date(2024, 5, 19)), ("ME", dt.date(2024, 5, 31)),
     ("QE", dt.date(2024, 6, 30)), ("YE", dt.date(2024, 12, 31))],
)
def test_period_ends(frame, freq, last):
    df = frame("d date, x double", (dt.date(2024, 5, 15), 1.0))
    assert ts.aggregate_time_period(df, "d", "x", freq).first()["period"] == last


def test_growth_after_zero_is_null(frame):
    df = frame("p long, x double", (1, 100.0), (2, 150.0), (3, 0.0), (4, 50.0))
    got = ts.growth_rate(df, ["p"], "x", "g").orderBy("p").collect()
    assert [r.g for r in got] == [None, 50, -100, None]


def test_rolling_needs_full_window(frame):
    df = frame("p long, x double", *enumerate([1.0, 2.0, None, 4.0, 5.0, 6.0]))
    got = ts.rolling_average(df, ["p"], "x", "r").orderBy("p").collect()
    assert [r.r for r in got] == [None] * 5 + [5]


def test_slope(frame):
    df = frame("p long, x double", (1, 10.0), (2, None), (3, 20.0), (4, 30.0))
    assert ts.trend_slope(df, ["p"], "x").first()[0] == 10
    assert ts.trend_slope(df.filter("p = 1"), ["p"], "x").first()[0] is None


def test_duration_floors(frame):
    df = frame(
        "purchase_date timestamp_ntz, delivered_date timestamp_ntz",
        (dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2, 6)),
        (dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 1, 6)),
        (dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 3, 12)),
    )
    assert [r.delivery_days for r in delivery.delivery_duration(df).collect()] == [0, -1, 2]


def test_status_rates(frame):
    row = delivery.delivery_status_rates(frame("delay_days long", -1, 0, 3, None)).first()
    assert tuple(row) == (33.33, 33.33, 33.33, 0.67)


def test_store_sales_range_is_inclusive(frame):
    df = frame("sales_sk string, store_sk long, sales_date timestamp_ntz",
               ("a", 1, dt.datetime(2024, 1, 1)), ("b", 1, dt.datetime(2024, 1, 2)),
               ("c", 2, dt.datetime(2024, 1, 1)), ("d", 1, dt.datetime(2024, 1, 3)))
    got = metrics.store_sales(df, store_sk=1, date_min="2024-01-01", date_max="2024-01-02")
    assert [r.sales_sk for r in got.collect()] == ["a", "b"]
    with pytest.raises(ValueError):
        metrics.store_sales(df, colour="red")


def test_prediction_quality(frame):
    df = frame("y double, p double", (1.0, 1.5), (2.0, 2.0), (3.0, 2.0))
    row = regression_metrics(df, "y", "p").first()
    assert (row.rmse, row.mae, row.r2) == approx(((1.25 / 3) ** 0.5, 0.5, 1 - 1.25 / 2))
    df = frame("y int, s double", (1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1))
    row = classification_metrics(df, "y", "s").first()
    assert (row.accuracy, row.roc_auc) == approx((0.75, 0.875))


@pytest.mark.parametrize("values", [[0, 1, 2, 32767], [0, 1, 32767, 32768], [-1, 0, 1], [2**40, 5, 0]])
def test_distinct_counts_of_any_keys(spark, values):
    rng = random.Random(1)
    rows = [(n % 5 if n % 7 else None, rng.choice(values + [None]), rng.choice([3, 4, None]), rng.choice("abc")) for n in range(300)]
    df = spark.createDataFrame(rows, "g long, a long, b int, c string").repartition(3)
    found = with_distinct_counts(df, ["g"], {"na": "a", "nb": "b", "nc": "c"}, [F.count(F.lit(1)).alias("n")])
    for r in found.collect():
        own = [x for x in rows if x[0] == r.g]
        assert (r.n, r.na, r.nb, r.nc) == (len(own), *[len({x[k] for x in own} - {None}) for k in (1, 2, 3)])
    assert found.count() == 6
    assert with_distinct_counts(df.limit(0), ["g"], {"na": "a"}, []).count() == 0


def test_customer_features_expand_no_rows(spark, small, monkeypatch):
    from salescope.operators import aggregates
    from salescope.plans import features
    from salescope.sources import adapter

    plans = []
    monkeypatch.setattr(aggregates, "durable", lambda df: plans.append(df._jdf.queryExecution().toString()) or df)
    features.customer_features(adapter.fact_sales(spark, small), adapter.customers(spark, small))
    features.product_features(adapter.fact_sales(spark, small), adapter.products(spark, small))
    assert len(plans) == 2 and not any("Expand" in plan for plan in plans)


def test_distinct_counts_of_wide_keys_take_one_pass_and_no_bitmaps(spark, monkeypatch):
    from salescope.operators import aggregates

    plans = []
    keep = aggregates.durable
    monkeypatch.setattr(aggregates, "durable", lambda df: plans.append(df._jdf.queryExecution().toString()) or keep(df))
    rows = [(n % 40, 1_000_000 + n % 900, n % 5) for n in range(4_000)]
    df = spark.createDataFrame(rows, "g long, a long, b long")
    found = with_distinct_counts(df, ["g"], {"na": "a", "nb": "b"}, [F.count(F.lit(1)).alias("n")]).collect()
    for r in found:
        own = [x for x in rows if x[0] == r.g]
        assert (r.n, r.na, r.nb) == (len(own), len({x[1] for x in own}), len({x[2] for x in own}))
    assert len(found) == 40 and len(plans) == 1 and "bitmap" not in plans[0]


def test_distinct_counts_build_their_pairs_without_lambdas(spark, monkeypatch):
    from salescope.operators import aggregates

    plans = []
    keep = aggregates.durable
    monkeypatch.setattr(aggregates, "durable", lambda df: plans.append(df._jdf.queryExecution().toString()) or keep(df))
    rows = [(1, 100, None), (1, None, None), (2, None, "x"), (2, 100, "x"), (None, 7, "y"), (3, None, None)]
    df = spark.createDataFrame(rows, "g long, a long, b string")
    found = with_distinct_counts(df, ["g"], {"na": "a", "nb": "b"}, [F.count(F.lit(1)).alias("n")])
    assert {tuple(r) for r in found.collect()} == {(1, 2, 1, 0), (2, 2, 1, 1), (None, 1, 1, 1), (3, 1, 0, 0)}
    # A lambda is interpreted row by row; it took nearly half of the time of its stage.
    assert len(plans) == 1 and "lambda" not in plans[0]
