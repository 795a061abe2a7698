"""Models, neighbours, ingest and the word-driven metrics."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from salescope.catalog.datasets import DATASETS, customer_frame, forecast
from salescope.catalog.events import fresh
from salescope.catalog.registry import as_days, query, rounded, star_sql
from salescope.catalog.series import period_sql
from salescope.operators.evaluation import classification_metrics, regression_metrics
from salescope.operators.neighbors import kneighbors
from salescope.plans import ask as asking
from salescope.plans import datasets, features, ingest, models, pipeline
from salescope.plans.preprocess import preprocess
from salescope.session import written
from salescope.sources import adapter


def trained(spark, folder, name):
    data, inputs = pipeline.prepare_dataset(name, DATASETS[name](spark, folder))
    registry = models.build_model_registry()
    return data, pipeline.train_one(name, data, inputs, registry)


def _scores(name):
    key, label = pipeline.ROW_KEYS[name], datasets.PRIMARY_TARGET[name]

    def run(spark, folder):
        data, package = trained(spark, folder, name)
        scored = package.predict(data.filter("split = 'test'"))
        score = ["score"] if package.task == "classification" else []
        return scored.select(*key, label, "prediction", *score)

    query(f"{name}_scores")(run)


for _name in ("churn", "ltv", "demand", "forecast"):
    _scores(_name)


@query("search_results")
def search_results(spark, folder, draws=models.SEARCH_DRAWS, grid=None, names=("churn", "ltv", "demand", "forecast")):
    """``(model, candidate, fold, parameters, score)`` of the search of every model."""
    tasks = {}
    for name in names:
        data, inputs = pipeline.prepare_dataset(name, DATASETS[name](spark, folder))
        spec, label = models.build_model_registry()[name], datasets.PRIMARY_TARGET[name]
        train = data.filter("split = 'train'")
        if spec.task == "classification":
            train = models.with_weight(train, label)
        tasks[name] = models.make_task(spec, train, inputs, label, pipeline.ROW_KEYS[name], draws, grid=grid)
    rows = []
    for name, found in models.search_all(tasks).items():
        for n, (candidate, scores) in enumerate(zip(tasks[name].candidates, found.scores)):
            rows += [(name, n, k, json.dumps(candidate), x) for k, x in enumerate(scores)]
    return spark.createDataFrame(rows, "model string, candidate int, fold int, parameters string, score double")


@query("feature_importance")
def feature_importance(spark, folder):
    _, package = trained(spark, folder, "ltv")
    return models.feature_importance(spark, package)


@query("champion_challenger")
def champion_challenger(spark, folder):
    """The best of ten draws defends against that of ten others on the same test rows, over a saved package."""
    data, inputs = pipeline.prepare_dataset("ltv", DATASETS["ltv"](spark, folder))
    spec = models.build_model_registry()["ltv"]
    plan = models.Plan(spec, data, tuple(inputs), datasets.PRIMARY_TARGET["ltv"], tuple(pipeline.ROW_KEYS["ltv"]))
    # Both searches in one batch; only the draws differ.
    both = models.train_models({"champion": plan, "challenger": plan}, seeds={"challenger": models.SEED + 1})
    store = fresh(spark, "models")
    models.save_package(spark, both["champion"], store)
    champion, challenger = models.load_package(spark, "champion", store), both["challenger"]
    winner, won = models.challenge(champion, challenger, data.filter("split = 'test'"))
    rows = [
        ("champion", champion.headline(champion.score), not won),
        ("challenger", challenger.headline(challenger.score), won),
    ]
    assert winner in (champion, challenger)
    return spark.createDataFrame(rows, "role string, r2 double, deployed boolean")


@query(
    "regression_metrics",
    star_sql(
        """SELECT round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
        round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 6) AS r2
        FROM (SELECT future_revenue AS y, rolling_7_day_average AS p FROM forecast)"""
    ),
)
def regression_quality(spark, folder):
    """The weekly mean as a forecast of the next day."""
    found = regression_metrics(forecast(spark, folder), "future_revenue", "rolling_7_day_average")
    return rounded(rounded(found, "rmse", "mae", digits=4), "r2")


@query(
    "classification_metrics",
    star_sql(
        """SELECT round(count_if((s > 0.5) = (churn_label = 1)) / count(*), 6) AS accuracy,
        round((sum(CASE WHEN churn_label = 1 THEN r END) - pos * (pos + 1) / 2.0)
          / (pos * (count(*) - pos)), 6) AS roc_auc
        FROM (SELECT *, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r,
            sum(churn_label) OVER () AS pos
          FROM (SELECT churn_label, 1.0 / total_orders AS s FROM churn)) GROUP BY pos"""
    ),
)
def classification_quality(spark, folder):
    """Few orders as a sign of churn."""
    churn = datasets.churn_dataset(
        customer_frame(spark, folder), adapter.customers(spark, folder)
    ).withColumn("s", 1 / F.col("total_orders"))
    return rounded(classification_metrics(churn, "churn_label", "s"), "accuracy", "roc_auc")


POINT_LIMITS_SQL = """limits AS (SELECT quantile_cont(CAST(purchase_count AS DOUBLE), 0.01) AS lo,
          quantile_cont(CAST(purchase_count AS DOUBLE), 0.99) AS hi FROM interactions)"""
POINTS_SQL = """points AS (SELECT customer_sk, customer_sk || '-' || product_sk AS pair,
          coalesce((least(greatest(CAST(purchase_count AS DOUBLE), lo), hi) - lo)
            / nullif(hi - lo, 0), 0) AS x,
          total_spent / 1000000 AS y, average_spend / 1000000 AS z FROM interactions, limits)"""


def interaction_points(spark, folder):
    """The preprocessed interactions as points, money in millions."""
    pairs = features.interactions(adapter.fact_sales(spark, folder))
    ready, _ = preprocess("recommendation", pairs, fit_on="all")
    million = F.lit(1_000_000.0)
    return ready.select(
        "customer_sk",
        F.concat_ws("-", "customer_sk", "product_sk").alias("pair"),
        (F.col("purchase_count") if "purchase_count" in ready.columns else F.lit(0.0)).alias("x"),
        (F.col("total_spent") / million).alias("y"),
        (F.col("average_spend") / million).alias("z"),
    ).withColumn("vector", F.array("x", "y", "z"))


@query(
    "similar_interactions",
    star_sql(
        """SELECT segment, pair, round(distance, 6) AS distance,
          row_number() OVER (PARTITION BY segment ORDER BY distance, pair) AS rank
        FROM (SELECT segment, pair, round(1 - (a * x + b * y + c * z)
            / (sqrt(a * a + b * b + c * c) * sqrt(x * x + y * y + z * z)), 9) + 0.0 AS distance
          FROM points, profiles)
        QUALIFY rank <= 5""",
        POINT_LIMITS_SQL,
        POINTS_SQL,
        """profiles AS (SELECT customer_segment AS segment, round(avg(x), 9) AS a,
          round(avg(y), 9) AS b, round(avg(z), 9) AS c
          FROM points JOIN customers USING (customer_sk) GROUP BY customer_segment)""",
    ),
)
def similar_interactions(spark, folder):
    """The five interactions nearest to the mean one of each customer segment."""
    points = interaction_points(spark, folder)
    segments = adapter.customers(spark, folder).select("customer_sk", "customer_segment")
    profiles = (
        points.join(segments, "customer_sk")
        .groupBy(F.col("customer_segment").alias("segment"))
        .agg(F.array(*[F.round(F.avg(c), 9) for c in "xyz"]).alias("vector"))
    )
    return rounded(kneighbors(points, "pair", "vector", profiles, "segment"), "distance")


@query(
    "customer_recommendations",
    star_sql(
        """SELECT customer_sk, pair, round(distance, 6) AS distance,
          row_number() OVER (PARTITION BY customer_sk ORDER BY distance, pair) AS rank
        FROM (SELECT profiles.customer_sk, pair, round(1 - (a * x + b * y + c * z)
            / (sqrt(a * a + b * b + c * c) * sqrt(x * x + y * y + z * z)), 9) + 0.0 AS distance
          FROM points, profiles)
        QUALIFY rank <= 5""",
        POINT_LIMITS_SQL,
        POINTS_SQL,
        """profiles AS (SELECT customer_sk, round(avg(x), 9) AS a, round(avg(y), 9) AS b,
          round(avg(z), 9) AS c FROM points GROUP BY customer_sk)""",
    ),
)
def customer_recommendations(spark, folder):
    """The five interactions nearest to the mean one of every customer."""
    points = interaction_points(spark, folder)
    profiles = points.groupBy("customer_sk").agg(F.array(*[F.round(F.avg(c), 9) for c in "xyz"]).alias("vector"))
    return rounded(kneighbors(points, "pair", "vector", profiles, "customer_sk"), "distance")


@query(
    "embedding_knn",
    """WITH cells AS (SELECT label, i, round(avg(CAST(embedding[i] AS DOUBLE)), 9) AS m
        FROM embeddings, (SELECT unnest(generate_series(1, 64)) AS i) GROUP BY label, i),
      profiles AS (SELECT label, list(m ORDER BY i) AS v FROM cells GROUP BY label)
    SELECT p.label, vec_id, round(distance, 6) AS distance, rank FROM (
      SELECT p.label, vec_id,
        round(1 - list_cosine_similarity(p.v, CAST(embedding AS DOUBLE[])), 9) AS distance,
        row_number() OVER (PARTITION BY p.label
          ORDER BY round(1 - list_cosine_similarity(p.v, CAST(embedding AS DOUBLE[])), 9), vec_id)
          AS rank
      FROM embeddings, profiles p) p WHERE rank <= 5""",
)
def embedding_knn(spark, folder):
    """The five vectors nearest to the mean vector of each label."""
    vectors = adapter.table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    cells = vectors.select("label", F.posexplode("embedding").alias("i", "e"))
    means = cells.groupBy("label", "i").agg(F.round(F.avg(F.col("e").cast("double")), 9).alias("m"))
    profiles = means.groupBy("label").agg(
        F.array_sort(F.collect_list(F.struct("i", "m"))).getField("m").alias("embedding")
    )
    near = kneighbors(vectors.drop("label"), "vec_id", "embedding", profiles, "label")
    return rounded(near, "distance")


@query(
    "ingest_union",
    star_sql(
        """SELECT CAST(year(sales_date) AS INTEGER) AS year, count(*) AS n,
        CAST(sum(total_amount) AS DOUBLE) AS revenue
        FROM (SELECT DISTINCT * FROM fact_sales) GROUP BY 1"""
    ),
)
def ingest_union(spark, folder):
    """Old and new sales that overlap by a year come out once."""
    sales = adapter.fact_sales(spark, folder)
    merged = pipeline.ingest_union(
        sales.filter("sales_date < timestamp_ntz'1998-01-01'"),
        sales.filter("sales_date >= timestamp_ntz'1997-01-01'"),
    )
    return merged.groupBy(F.year("sales_date").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast("double").alias("revenue")
    )


def _loaded(spark, folder):
    """Three loads that overlap by a year each, out of files that arrived before."""
    sales = written(adapter.fact_sales(spark, folder), "arrived")
    store = ingest.SalesStore(spark, fresh(spark, "sales"))
    spans = (("1992-01-01", "1995-01-01"), ("1994-01-01", "1997-01-01"), ("1996-01-01", "2100-01-01"))
    for load, (first, last) in enumerate(spans):
        old = F.col("sales_date") < F.expr(f"timestamp_ntz'{last}'")
        store.ingest(sales.filter(old & (F.col("sales_date") >= F.expr(f"timestamp_ntz'{first}'"))), load)
    return store


@query(
    "ingested_customers",
    star_sql(
        """SELECT * REPLACE (round(average_order_value, 6) AS average_order_value) FROM customer_features"""
    ),
)
def ingested_customers(spark, folder):
    """Customer features kept up to date by three loads, from sums alone."""
    found = _loaded(spark, folder).customer_features(adapter.customers(spark, folder))
    return rounded(as_days(found, "first_purchase_date", "last_purchase_date"), "average_order_value")


@query("dashboard")
def dashboard(spark, folder):
    """A first run on the older sales, then an ingest of the rest."""
    from dataclasses import replace

    star = adapter.star(spark, folder)
    cut = "timestamp_ntz'1998-01-01'"
    first = pipeline.run_initial_pipeline(
        replace(star, fact_sales=star.fact_sales.filter(f"sales_date < {cut}"))
    )
    _, board = pipeline.ingest_and_retrain(first, star.fact_sales.filter(f"sales_date >= {cut}"))
    return board


@query(
    "ask_top_customers",
    star_sql(
        """SELECT * FROM (SELECT customer_sk, CAST(sum(total_amount) AS DOUBLE) AS total_amount,
        dense_rank() OVER (ORDER BY sum(total_amount) DESC) AS rank
        FROM fact_sales GROUP BY customer_sk) WHERE rank <= 5"""
    ),
)
def ask_top_customers(spark, folder):
    sales = adapter.fact_sales(spark, folder)
    return asking.ask("Top customers by revenue", sales, "total_amount", "customer_sk", top_n=5)


@query(
    "ask_trend",
    star_sql("SELECT period, revenue AS total_amount FROM periods", period_sql("month")),
)
def ask_trend(spark, folder):
    sales = adapter.fact_sales(spark, folder)
    return asking.ask("Revenue trend", sales, "total_amount", date="sales_date")


@query(
    "ask_growth",
    star_sql(
        """SELECT period, revenue AS total_amount, round((revenue - lag(revenue) OVER w)
        / nullif(lag(revenue) OVER w, 0) * 100, 6) AS growth_pct
        FROM periods WINDOW w AS (ORDER BY period)""",
        period_sql("quarter"),
    ),
)
def ask_growth(spark, folder):
    sales = adapter.fact_sales(spark, folder)
    grown = asking.ask("quarterly growth", sales, "total_amount", date="sales_date", freq="QE")
    return rounded(grown, "growth_pct")


@query("ask_total", star_sql("SELECT CAST(sum(total_amount) AS DOUBLE) AS total FROM fact_sales"))
def ask_total(spark, folder):
    return asking.ask("What is the total revenue?", adapter.fact_sales(spark, folder), "total_amount")


@query(
    "ask_average_per_store",
    star_sql(
        """SELECT store_sk, round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 6)
        AS total_amount FROM fact_sales GROUP BY store_sk"""
    ),
)
def ask_average_per_store(spark, folder):
    sales = adapter.fact_sales(spark, folder)
    return rounded(asking.ask("average sale per store", sales, "total_amount", "store_sk"), "total_amount")
