"""Features, data sets, manifest, models, retraining and task words."""

import datetime as dt
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from salescope.operators.neighbors import kneighbors
from salescope.plans import ask, datasets, features, ingest, manifest, models, pipeline
from salescope.session import durable
from salescope.sources import adapter

TINY = {"n_estimators": [2], "max_depth": [2], "learning_rate": [0.1]}


def sales_rows(frame, *rows):
    return frame(
        "sales_sk string, sales_id long, customer_sk long, product_sk long, store_sk long, "
        "salesperson_sk long, campaign_sk long, sales_date timestamp_ntz, total_amount decimal(18,4)",
        *rows,
    )


def sale(i, customer, day, amount=1, product=1):
    from decimal import Decimal

    return (f"s{i:03d}", i, customer, product, 1, 1, None, day, Decimal(amount))


def test_customer_features(frame):
    day = dt.datetime(2024, 1, 1, 12)
    sales = sales_rows(
        frame,
        sale(1, 1, day, 10), sale(2, 1, day + dt.timedelta(hours=30), 20, product=2),
        sale(3, 2, day + dt.timedelta(days=91)), sale(4, None, day),
    )
    people = frame("customer_sk long, customer_segment string, first_name string, last_name string",
                   (1, "A", "x", "y"))
    got = {r.customer_sk: r for r in features.customer_features(sales, people).collect()}
    assert set(got) == {1, 2}
    one = got[1]
    assert (one.total_orders, one.total_spent, one.average_order_value) == (2, 30.0, 15.0)
    assert (one.products_purchased, one.campaigns_used) == (2, 0)
    # floored: 30 h is one day, 91 days less 30 h are 89
    assert (one.customer_lifetime_days, one.days_since_last_purchase) == (1, 89)
    assert (one.customer_segment, got[2].customer_segment) == ("A", None)


def test_churn_begins_after_90_days(frame):
    people = frame("customer_sk long, first_name string, last_name string", (1, "x", "y"))
    df = frame("customer_sk long, days_since_last_purchase long", (1, 90), (2, 91))
    got = datasets.churn_dataset(df, people).orderBy("customer_sk").collect()
    assert [r.churn_label for r in got] == [0, 1]


def test_forecast_keeps_complete_rows_only(frame, spark):
    start = dt.datetime(2024, 1, 1)
    sales = sales_rows(frame, *[sale(i, 1, start + dt.timedelta(days=i), i) for i in range(31)])
    dates = spark.range(40).select(
        F.expr("date_add(date'2024-01-01', cast(id as int))").alias("full_date"),
        F.lit(2024).alias("year"), F.lit(1).alias("weekday"),
    )
    got = datasets.forecast_dataset(features.daily_features(sales), dates).collect()
    assert len(got) == 1
    assert (got[0].date, got[0].future_revenue) == (dt.date(2024, 1, 30), 30.0)
    assert got[0].rolling_7_day_average == 26.0


def test_usage_adds_up(frame, spark, small):
    star = adapter.star(spark, small)
    n = 2
    usage = manifest.row_usage(star, n).persist()
    summary = {r.table_name: (r.used_count, r.unused_count)
               for r in manifest.row_usage_summary(usage).collect()}
    assert summary["fact_sales"] == (n, star.fact_sales.count() - n)
    for name, df in star.tables().items():
        assert sum(summary[name]) == df.count()
    assert summary["products"][0] <= n


def test_write_row_usage(frame, spark, tmp_path):
    usage = frame("table_name string, pk_column string, pk string, used boolean",
                  ("t", "k", "1", True), ("t", "k", "2", False))
    manifest.write_row_usage(usage, str(tmp_path))
    assert spark.read.option("header", "true").csv(f"{tmp_path}/rows").count() == 2
    row = spark.read.json(f"{tmp_path}/summary").first()
    assert (row.used_count, row.unused_count) == (1, 1)


def test_neighbors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(300, 4)).round(2)
    points[::3] = points[0]  # a third of the rows are copies of one
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "k long, v array<double>")
    queries = df.filter("k in (0, 1, 2)").withColumnRenamed("k", "q").repartition(2)
    for metric in ("cosine", "euclidean"):
        got = kneighbors(df.repartition(5), "k", "v", queries, "q", 7, metric).collect()
        for q in (0, 1, 2):
            if metric == "cosine":
                norm = np.linalg.norm(points, axis=1)
                far = 1 - points @ points[q] / (norm * norm[q])
            else:
                far = np.linalg.norm(points - points[q], axis=1)
            want = sorted(zip(far.round(9) + 0.0, range(300)))[:7]
            mine = sorted((r.rank, r.k) for r in got if r.q == q)
            assert [k for _, k in mine] == [k for _, k in want]


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("options", [{}, {"pivots": 40, "part": 16}, {"pivots": 1, "part": 50}])
def test_neighbors_of_every_row(spark, metric, options):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(size=(6, 3))[rng.integers(0, 6, 260)] + rng.normal(size=(260, 3)) * 0.05, rng.normal(size=(40, 3)) * 9])
    points = points.round(2)
    points[::4] = points[0]
    points[5] = points[6] = 0
    rows = [(f"k{i:03d}", p.tolist()) for i, p in enumerate(points)]
    odd = [("x1", None), ("x2", [None, 1.0, 2.0]), ("x3", [float("nan")] * 3), ("x4", [float("inf"), 0.0, 0.0]), ("x5", [])]
    df = spark.createDataFrame(rows + odd, "k string, v array<double>").repartition(5)
    queries = df.select(F.concat(F.lit("q"), "k").alias("q"), "v", F.lit(1).alias("distance"))
    found = {}
    for r in kneighbors(df, "k", "v", queries.unionByName(queries.limit(1)), "q", 6, metric, **options).collect():
        found.setdefault(r.q, set()).add((r["rank"], r.k, r.distance))
    assert set(found) == {f"q{k}" for k, _ in rows}
    for name, p in rows:
        p = np.array(p)
        if metric == "cosine":
            norms = np.linalg.norm(points, axis=1) * np.linalg.norm(p)
            far = 1 - np.divide(points @ p, norms, out=np.zeros(len(points)), where=norms > 0)
        else:
            far = np.linalg.norm(points - p, axis=1)
        want = sorted(zip(far.round(9) + 0.0, (k for k, _ in rows)))[:6]
        mine = sorted(found[f"q{name}"])
        assert [k for _, k, _ in mine] == [k for _, k in want]
        assert [d for _, _, d in mine] == pytest.approx([d for d, _ in want], abs=2e-9)


def test_neighbors_of_nothing(frame):
    some, none = frame("k long, v array<double>", (1, [1.0, 2.0])), frame("q long, v array<double>")
    assert kneighbors(some, "k", "v", none, "q").count() == 0
    assert kneighbors(none.withColumnRenamed("q", "k"), "k", "v", some.withColumnRenamed("k", "q"), "q").count() == 0
    with pytest.raises(ValueError, match="lengths"):
        kneighbors(some, "k", "v", frame("q long, v array<double>", (1, [1.0])), "q", metric="euclidean")


def test_registry(spark):
    registry = models.build_model_registry()
    assert registry is not models.build_model_registry()
    status = models.validate_model_registry(spark, registry).collect()
    assert {r.status for r in status} == {"READY"} and len(status) == 5
    broken = {"x": models.ModelSpec("regression", {})}
    assert models.validate_model_registry(spark, broken).first()["status"] == "missing grid"


def test_draws_are_distinct_and_repeatable():
    drawn = models.draw_parameters(models.TREE_GRID)
    assert drawn == models.draw_parameters(models.TREE_GRID)
    assert len({tuple(d.items()) for d in drawn}) == 10
    assert len(models.draw_parameters({"a": [1, 2], "b": [3]}, None)) == 2


def test_tree_settings():
    got = models.tree_settings({"num_leaves": 31, "max_depth": -1, "colsample_bytree": 0.7, "min_child_samples": 20})
    assert (got.leaves, got.depth, got.column_share, got.row_share, got.least_rows) == (31, models.DEEPEST, 0.7, 1.0, 20)


@pytest.fixture(scope="module")
def ltv(spark):
    from salescope.catalog.datasets import ltv as build

    return pipeline.prepare_dataset("ltv", build(spark, "/root/testdata/sf0.001"))


def test_folds(spark, ltv):
    data, _ = ltv
    registry = models.build_model_registry()
    folded = models.with_folds(data, registry["ltv"], "customer_ltv", ["customer_sk"])
    sizes = [r["count"] for r in folded.groupBy("fold").count().collect()]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1
    days = spark.range(40).withColumnRenamed("id", "date")
    blocks = models.with_folds(days, registry["forecast"], "y", ["date"])
    edges = blocks.groupBy("fold").agg(F.min("date"), F.max("date")).orderBy("fold").collect()
    assert [tuple(e) for e in edges] == [(0, 0, 9), (1, 10, 19), (2, 20, 29), (3, 30, 39)]
    labels = spark.range(90).select("id", (F.col("id") < 9).cast("int").alias("y"))
    strata = models.with_folds(labels, registry["churn"], "y", ["id"]).groupBy("fold").agg(F.sum("y"))
    assert [r[1] for r in strata.collect()] == [3, 3, 3]


def test_search_picks_a_candidate(ltv):
    data, inputs = ltv
    spec = models.build_model_registry()["ltv"]
    grid = {"n_estimators": [1, 3], "max_depth": [2]}
    train = data.filter("split = 'train'")
    best = models.search(spec, train, inputs, "customer_ltv", ["customer_sk"], None, 2, grid)
    assert best in models.draw_parameters(grid, None)
    with pytest.raises(ValueError):
        models.search(models.build_model_registry()["recommendation"], train, inputs, "", [])


def test_queries_search_the_registry(spark, small, monkeypatch):
    from salescope.catalog import models as queries
    from salescope.catalog.registry import REGISTRY

    assert "search_results" in REGISTRY
    asked = {}
    monkeypatch.setattr(queries, "DATASETS", {"ltv": lambda *_: None})
    monkeypatch.setattr(pipeline, "prepare_dataset", lambda *_: (None, None))
    monkeypatch.setattr(pipeline, "train_one", lambda *_, **options: asked.update(options))
    queries.trained(spark, small, "ltv")
    assert "grid" not in asked and "draws" not in asked


def test_search_results_has_every_fold(spark, small):
    from salescope.catalog import models as queries

    grid = {"n_estimators": [1, 2], "max_depth": [2]}
    rows = queries.search_results(spark, small, grid=grid, names=("ltv", "forecast")).collect()
    found = {(r.model, r.candidate, r.fold) for r in rows}
    assert found == {(m, c, k) for m in ("ltv", "forecast") for c in (0, 1) for k in (0, 1, 2)}
    assert all(r.score > 0 for r in rows)


def test_packages_and_challenge(spark, ltv, tmp_path):
    data, inputs = ltv
    package = pipeline.train_one("ltv", data, inputs, models.build_model_registry(), grid=TINY)
    models.save_package(spark, package, str(tmp_path))
    loaded = models.load_package(spark, "ltv", str(tmp_path))
    test = data.filter("split = 'test'")
    assert loaded.evaluate(test)["r2"] == pytest.approx(package.score["r2"])
    # equal scores replace, a demanded gain does not
    assert models.challenge(loaded, package, test)[1] is True
    assert models.challenge(loaded, package, test, threshold=0.1)[1] is False
    top = models.feature_importance(spark, package, 3).collect()
    assert len(top) == 3 and top[0].importance >= top[1].importance
    with pytest.raises(Exception):
        models.load_package(spark, "absent", str(tmp_path))


def test_pipeline_and_ingest(spark, small, tmp_path):
    star = adapter.star(spark, small)
    cut = F.col("sales_date") < F.expr("timestamp_ntz'1998-01-01'")
    old = replace(star, fact_sales=star.fact_sales.filter(cut))
    context = pipeline.run_initial_pipeline(old, str(tmp_path), grid=TINY)
    assert set(context.packages) == {"churn", "ltv", "demand", "forecast", "recommendation"}
    assert {p.name for p in tmp_path.iterdir()} == set(context.packages)
    known = context.star.fact_sales.count()

    again, board = pipeline.ingest_and_retrain(context, old.fact_sales)
    figures = {(r.section, r.name, r.metric): r for r in board.collect()}
    assert again.star.fact_sales.count() == known
    assert figures["ingestion", "sales", "net_new_rows"].value == 0
    assert figures["ingestion", "sales", "total_rows"].value == known
    assert figures["models", "ltv", "status"].detail in ("updated", "kept")
    assert figures["models", "recommendation", "status"].detail == "refreshed"
    usage = [figures["row_usage", "fact_sales", m].value for m in ("used_count", "unused_count")]
    assert sum(usage) == known


def test_loads_equal_a_rebuild(spark, small, tmp_path):
    star = adapter.star(spark, small)
    sales = star.fact_sales
    nulls = [F.lit(None).cast(t).alias(c) if c in ("customer_sk", "sales_date", "total_amount") else F.col(c) for c, t in sales.dtypes]
    sales = durable(sales.unionByName(sales.limit(5).select(*nulls)))
    store = ingest.SalesStore(spark, str(tmp_path))
    cuts = ["1992-01-01", "1995-06-01", "1997-02-01", "2100-01-01"]
    loads = [sales.filter(F.col("sales_date").between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz")))
             for a, b in ((cuts[0], cuts[2]), (cuts[1], cuts[3]))] + [sales.filter("sales_date IS NULL OR sales_date > '1998-01-01'"), sales]
    for n, rows in enumerate(loads):
        store.ingest(rows, n)
    assert store.ingest(loads[-1], len(loads) - 1).isEmpty()  # again, and nothing in it is new

    def rows_of(df):
        return sorted(map(str, df.select(sorted(df.columns)).collect()))

    assert rows_of(store.fact()) == rows_of(sales.distinct())
    once = durable(sales.distinct())
    for got, want in (
        (store.customer_features(star.customers), features.customer_features(once, star.customers)),
        (store.product_features(star.products), features.product_features(once, star.products)),
        (store.daily_features(), features.daily_features(once)),
        (store.interactions(), features.interactions(once)),
    ):
        assert rows_of(got) == rows_of(want) and set(got.columns) == set(want.columns)
    # A load of one month reads the buckets of that month only.
    month = sales.filter("date_format(sales_date, 'yyyy-MM') = '1996-03'")
    keys = [r[0] for r in month.select(ingest.bucket_of(sales.columns).alias("b")).distinct().collect()]
    read = store.rows(store.loads()).filter(F.col("bucket").isin(keys)).select(F.input_file_name().alias("f")).distinct().collect()
    assert 0 < len(keys) <= ingest.PARTS and all("bucket=1996-03-" in r.f for r in read)


@pytest.mark.parametrize(
    ("task", "intent"),
    [("Total revenue", "total"), ("discount by store", "aggregate"), ("delivery time trend", "delivery_duration"),
     ("top 10 customers by revenue", "top"), ("give a summary of the mean", "average"),
     ("price vs rating", "correlation"), ("monthly change", "growth"), ("revenue over time", "time_series")],
)
def test_task_words(task, intent):
    assert ask.resolve(task) == intent


def test_ask(frame):
    df = frame("g string, x double, d date", ("a", 1.0, dt.date(2024, 1, 1)), ("b", 3.0, dt.date(2024, 2, 1)))
    assert ask.kpi(df, "x").first()[0] == 4
    assert ask.kpi(df, "x", "median").first()[0] == 2
    assert ask.compare(df, "x", "g", "mean").count() == 2
    assert ask.trend(df, "x", "d").count() == 2
    assert ask.top_n(df, "x", "g", 1).first()["g"] == "b"
    assert ask.ask("concentration", df, "x").first()["top_1_pct_share"] == 75
    assert ask.ask("histogram", df, "x").filter("n > 0").count() == 2
    with pytest.raises(ValueError, match="group"):
        ask.ask("correlation", df, "x")
    with pytest.raises(ValueError, match="no known metric"):
        ask.ask("hello", df, "x")


def test_task_functions_travel_without_the_package():
    import subprocess
    import sys

    from pyspark import cloudpickle

    from salescope.operators import neighbors

    code = "import pickle, sys, numpy as np; f = pickle.load(sys.stdin.buffer); "
    code += "print(f(np.array([2.0, 1.0]), [[7], [8]], 1)[0][1])"
    out = subprocess.run(
        [sys.executable, "-I", "-c", code], input=cloudpickle.dumps(neighbors._nearest),
        capture_output=True, check=True, cwd="/",
    )
    assert out.stdout.strip() == b"8"


def test_manifest_without_a_sample_marks_everything(spark, small):
    star = adapter.star(spark, small)
    summary = {r.table_name: r for r in manifest.row_usage_summary(manifest.row_usage(star, None)).collect()}
    assert summary["fact_sales"].unused_count == 0
    assert summary["fact_sales"].used_count == star.fact_sales.count()
    sample = manifest.earliest_sales(star.fact_sales, 50)
    found = {r.table_name: r for r in manifest.row_usage_summary(manifest.row_usage(star, 50, sample)).collect()}
    assert found["fact_sales"].used_count == 50
    assert found["products"].used_count == sample.select("product_sk").distinct().count()


def test_a_star_is_picked_by_long_or_short_names(spark, small):
    from salescope.sources.schema import SHORT_NAMES, StarSchema

    tables = adapter.star(spark, small).tables()
    mixed = {(n if n in ("stores", "dates") else SHORT_NAMES[n]): df for n, df in tables.items()}
    assert StarSchema.from_tables(mixed).tables().keys() == tables.keys()
    del mixed["stores"]
    with pytest.raises(ValueError, match="dim_stores"):
        StarSchema.from_tables(mixed)


def test_a_new_row_adds_one_row_of_sums(spark, small, tmp_path):
    sales = durable(adapter.fact_sales(spark, small))
    store = ingest.SalesStore(spark, str(tmp_path))
    store.ingest(sales.filter("sales_date < '1998-01-01'"), 0)
    new = store.ingest(sales.unionByName(sales), 1)  # copies within a load come once
    assert new.count() == sales.filter("sales_date >= '1998-01-01' OR sales_date IS NULL").distinct().count()
    sums = spark.read.parquet(f"{tmp_path}/sums/batch-1")
    met = new.select(*ingest.KEYS).distinct().count()
    days = new.select(F.to_date("sales_date")).distinct().count()
    assert sums.count() == met + days and sums.agg(F.sum("n")).first()[0] == 2 * new.count()
    # A bucket's rows meet in one task, which writes them as one file.
    files = new.select(F.input_file_name().alias("f"))
    assert files.distinct().count() == new.select(ingest.bucket_of(sales.columns)).distinct().count()


def test_new_rows_are_made_distinct_once(spark):
    schema = "k long, name string, v double"
    old = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (2, None, 2.0)], schema)
    new = spark.createDataFrame([(2, None, 2.0), (3, " b", 1.0), (3, "b ", 1.0), (4, "c", float("inf")), (4, "c", None)], schema)
    found = pipeline.ingest_union(old, new)
    assert sorted(map(str, found.collect())) == sorted(map(str, [
        Row(k=1, name="a", v=1.0), Row(k=2, name=None, v=2.0), Row(k=3, name="b", v=1.0), Row(k=4, name="c", v=None)]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1
