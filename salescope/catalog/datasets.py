"""Feature tables, model data sets, preprocessing, splits and the manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from salescope.catalog.registry import as_days, query, rounded, star_sql
from salescope.functions.columns import money
from salescope.operators.cleaning import clean_ml_dataframe
from salescope.plans import datasets, features, manifest, preprocess, splits
from salescope.session import fresh, written
from salescope.sources import adapter


def customer_frame(spark, folder):
    return features.customer_features(
        adapter.fact_sales(spark, folder), adapter.customers(spark, folder)
    )


def product_frame(spark, folder):
    return features.product_features(
        adapter.fact_sales(spark, folder), adapter.products(spark, folder)
    )


def churn(spark, folder):
    return datasets.churn_dataset(customer_frame(spark, folder), adapter.customers(spark, folder))


def ltv(spark, folder):
    return datasets.ltv_dataset(customer_frame(spark, folder))


def demand(spark, folder):
    return datasets.demand_dataset(product_frame(spark, folder), adapter.products(spark, folder))


def forecast(spark, folder):
    daily = features.daily_features(adapter.fact_sales(spark, folder))
    return datasets.forecast_dataset(daily, adapter.dates(spark, folder))


def recommendation(spark, folder):
    return datasets.recommendation_dataset(features.interactions(adapter.fact_sales(spark, folder)))


DATASETS = {
    "churn": churn,
    "ltv": ltv,
    "demand": demand,
    "forecast": forecast,
    "recommendation": recommendation,
}


def sales_of_features(spark, folder):
    """The sales with what the feature tables need, joined and written once for all of them."""
    return written(adapter.fact_sales(spark, folder).drop("sales_sk"), "sales")


def feature_frames(spark, folder):
    """All four feature tables."""
    customers, products = adapter.customers(spark, folder), adapter.products(spark, folder)
    return features.feature_tables(sales_of_features(spark, folder), customers, products)


def all_datasets(spark, folder):
    """Every model data set; those that start from the same feature table share it."""
    return datasets.model_datasets(feature_frames(spark, folder), adapter.star(spark, folder))


def _customer_days(df):
    return as_days(df, "first_purchase_date", "last_purchase_date")


@query(
    "customer_features",
    star_sql(
        """SELECT * REPLACE (round(average_order_value, 6) AS average_order_value)
        FROM customer_features"""
    ),
)
def customer_features(spark, folder):
    return rounded(_customer_days(customer_frame(spark, folder)), "average_order_value")


@query(
    "product_features",
    star_sql(
        """SELECT * REPLACE (round(average_sales_value, 6) AS average_sales_value)
        FROM product_features"""
    ),
)
def product_features(spark, folder):
    return rounded(product_frame(spark, folder), "average_sales_value")


ROLLING = ("rolling_7_day_average", "rolling_30_day_average")
ROLLING_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in ROLLING)


@query("daily_features", star_sql(f"SELECT * REPLACE ({ROLLING_SQL}) FROM daily_features"))
def daily_features(spark, folder):
    return rounded(features.daily_features(adapter.fact_sales(spark, folder)), *ROLLING)


INTERACTIONS_SQL = star_sql(
    "SELECT * REPLACE (round(average_spend, 6) AS average_spend) FROM interactions"
)


@query("interactions", INTERACTIONS_SQL)
def interactions(spark, folder):
    return rounded(features.interactions(adapter.fact_sales(spark, folder)), "average_spend")


@query("recommendation_dataset", INTERACTIONS_SQL)
def recommendation_dataset(spark, folder):
    return rounded(recommendation(spark, folder), "average_spend")


@query(
    "churn_dataset",
    star_sql(
        "SELECT * REPLACE (round(average_order_value, 6) AS average_order_value) FROM churn"
    ),
)
def churn_dataset(spark, folder):
    return rounded(_customer_days(churn(spark, folder)), "average_order_value")


@query(
    "ltv_dataset",
    star_sql(
        """SELECT * REPLACE (round(average_order_value, 6) AS average_order_value),
        total_spent AS customer_ltv FROM customer_features"""
    ),
)
def ltv_dataset(spark, folder):
    return rounded(_customer_days(ltv(spark, folder)), "average_order_value")


@query(
    "demand_dataset",
    star_sql(
        """SELECT pf.* REPLACE (round(average_sales_value, 6) AS average_sales_value),
        product_name, origin_location
        FROM product_features pf LEFT JOIN products p ON pf.product_sk = p.product_sk"""
    ),
)
def demand_dataset(spark, folder):
    return rounded(demand(spark, folder), "average_sales_value")


@query("forecast_dataset", star_sql(f"SELECT * REPLACE ({ROLLING_SQL}) FROM forecast"))
def forecast_dataset(spark, folder):
    return rounded(forecast(spark, folder), *ROLLING)


# ---- preprocessing ----


def _fitted(spark, folder, name):
    """The whole chain fitted on all rows, so that a single SQL query can check it."""
    clean = clean_ml_dataframe(DATASETS[name](spark, folder), datasets.TARGETS[name])
    out, _ = preprocess.preprocess(name, clean, fit_on="all")
    doubles = [c for c, t in out.dtypes if t == "double"]
    return rounded(out, *doubles)


def _scaled_sql(column, source, extra=""):
    """Clip to the 1st and 99th percentile, then 0..1; constant columns become 0."""
    x = f"CAST({column} AS DOUBLE)"
    lo, hi = (f"(SELECT quantile_cont({x}, {q}) FROM {source})" for q in (0.01, 0.99))
    return (
        f"round(coalesce((least(greatest({x}, {lo}), {hi}) - {lo}) / nullif({hi} - {lo}, 0), 0), 6)"
        f" AS {column}"
    )


def _one_hot_sql(column, values):
    return ", ".join(f"CAST({column} = '{v}' AS DOUBLE) AS \"{column}_{v}\"" for v in values)


# ---- fixed values: categories of the test tables ----
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
# ---- end of fixed values ----


@query(
    "preprocess_recommendation",
    star_sql(
        f"""SELECT customer_sk, product_sk, {_scaled_sql('purchase_count', 'interactions')},
        round(total_spent, 6) AS total_spent, round(average_spend, 6) AS average_spend
        FROM interactions"""
    ),
)
def preprocess_recommendation(spark, folder):
    return _fitted(spark, folder, "recommendation")


def _scaled(columns, source):
    return ", ".join(_scaled_sql(c, source) for c in columns)


CUSTOMER_SCALED = ("total_orders", "products_purchased", "stores_used", "customer_lifetime_days")
MONEY_SQL = "round(average_order_value, 6) AS average_order_value"


# ``campaigns_used`` is not constant at sf0.01 and ``first_name`` is; ``last_name`` has as many
# values as rows.  Dates go, and so do the columns that give the target away.
@query(
    "preprocess_churn",
    star_sql(
        f"""SELECT customer_sk, {_scaled(CUSTOMER_SCALED, 'churn')},
        {_scaled_sql('campaigns_used', 'churn')}, total_spent, {MONEY_SQL}, churn_label,
        {_one_hot_sql('customer_segment', SEGMENTS)} FROM churn"""
    ),
)
def preprocess_churn(spark, folder):
    return _fitted(spark, folder, "churn")


@query(
    "preprocess_ltv",
    star_sql(
        f"""SELECT customer_sk, {_scaled(CUSTOMER_SCALED, 'customer_features')},
        {_scaled_sql('campaigns_used', 'customer_features')},
        {_scaled_sql('days_since_last_purchase', 'customer_features')},
        {MONEY_SQL}, total_spent AS customer_ltv,
        {_one_hot_sql('customer_segment', SEGMENTS)} FROM customer_features"""
    ),
)
def preprocess_ltv(spark, folder):
    return _fitted(spark, folder, "ltv")


CODED = ("brand", "product_name", "origin_location")


@query(
    "preprocess_demand",
    star_sql(
        f"""SELECT product_sk, total_units_sold, round(average_sales_value, 6)
          AS average_sales_value, {_scaled(('customers_purchased', 'stores_sold_in', *CODED), 'coded')},
        {_one_hot_sql('category', CATEGORIES)} FROM coded""",
        "coded AS (SELECT pf.* REPLACE (dense_rank() OVER (ORDER BY pf.brand) - 1 AS brand), "
        "dense_rank() OVER (ORDER BY product_name) - 1 AS product_name, "
        "dense_rank() OVER (ORDER BY origin_location) - 1 AS origin_location "
        "FROM product_features pf LEFT JOIN products p ON pf.product_sk = p.product_sk)",
    ),
)
def preprocess_demand(spark, folder):
    return _fitted(spark, folder, "demand")


@query(
    "preprocess_forecast",
    star_sql(
        f"""SELECT date, daily_revenue, round(future_revenue, 6) AS future_revenue, {ROLLING_SQL},
        {_scaled(('transaction_count', 'day_of_week', 'month', 'quarter', 'year', 'weekday'),
                 'forecast')} FROM forecast"""
    ),
)
def preprocess_forecast(spark, folder):
    return _fitted(spark, folder, "forecast")


CLIPPED = ("total_orders", "products_purchased", "customer_lifetime_days")


@query(
    "clip_numeric",
    star_sql(
        "SELECT customer_sk, "
        + ", ".join(
            f"""round(least(greatest(CAST({c} AS DOUBLE),
            (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.01) FROM customer_features)),
            (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.99) FROM customer_features)), 6) AS {c}"""
            for c in CLIPPED
        )
        + " FROM customer_features"
    ),
)
def clip_numeric(spark, folder):
    frame = customer_frame(spark, folder).select("customer_sk", *CLIPPED)
    return rounded(preprocess.clip_numeric(frame, CLIPPED), *CLIPPED)


@query(
    "minmax_scale",
    star_sql(
        "SELECT customer_sk, "
        + ", ".join(
            f"""round(coalesce((CAST({c} AS DOUBLE) - min({c}) OVER ())
            / nullif(max({c}) OVER () - min({c}) OVER (), 0), 0), 6) AS {c}"""
            for c in CLIPPED
        )
        + " FROM customer_features"
    ),
)
def minmax_scale(spark, folder):
    frame = customer_frame(spark, folder).select("customer_sk", *CLIPPED)
    return rounded(preprocess.minmax_scale(frame, CLIPPED), *CLIPPED)


@query(
    "standard_scale",
    star_sql(
        "SELECT customer_sk, "
        + ", ".join(
            f"""round(coalesce((CAST({c} AS DOUBLE) - avg({c}) OVER ())
            / nullif(stddev_pop(CAST({c} AS DOUBLE)) OVER (), 0), 0), 6) AS {c}"""
            for c in CLIPPED
        )
        + " FROM customer_features"
    ),
)
def standard_scale(spark, folder):
    frame = customer_frame(spark, folder).select("customer_sk", *CLIPPED)
    return rounded(preprocess.standard_scale(frame, CLIPPED), *CLIPPED)


@query(
    "encode_categories",
    star_sql(
        f"""SELECT product_sk, {_one_hot_sql('category', CATEGORIES)},
        CAST(dense_rank() OVER (ORDER BY brand) - 1 AS DOUBLE) AS brand FROM products"""
    ),
)
def encode_categories(spark, folder):
    frame = adapter.products(spark, folder).select("product_sk", "category", "brand")
    return preprocess.encode_categories(frame)


@query(
    "sparse_customers",
    star_sql(
        """SELECT f.sales_sk, dense_rank() OVER (ORDER BY lpad(CAST(c AS VARCHAR), 12, '0')) - 1 AS customer,
          (SELECT count(DISTINCT customer_sk) FROM fact_sales) + dense_rank() OVER (ORDER BY p) - 1 AS product
        FROM (SELECT sales_sk, customer_sk AS c, 'p' || lpad(CAST(product_sk AS VARCHAR), 12, '0') AS p FROM fact_sales) f"""
    ),
)
def sparse_customers(spark, folder):
    """Every line with the positions of its customer and product among all customers and products."""
    sales = adapter.fact_sales(spark, folder).select(
        "sales_sk",
        F.lpad(F.col("customer_sk").cast("string"), 12, "0").alias("c"),
        F.lpad(F.col("product_sk").cast("string"), 12, "0").alias("p"),
    )
    found, _ = preprocess.sparse_indicators(sales, ["c", "p"])
    return found.select("sales_sk", F.col("indicators")[0].alias("customer"), F.col("indicators")[1].alias("product"))


@query(
    "prepare_sales",
    star_sql(
        f"""SELECT sales_sk, store_sk, {_one_hot_sql('segment', SEGMENTS)},
        round((CAST(total_amount AS DOUBLE) - avg(CAST(total_amount AS DOUBLE)) OVER ())
          / stddev_pop(CAST(total_amount AS DOUBLE)) OVER (), 6) AS total_amount,
        CAST(year(sales_date) AS INTEGER) AS sales_date_year,
        CAST(month(sales_date) AS INTEGER) AS sales_date_month,
        CAST(day(sales_date) AS INTEGER) AS sales_date_day,
        CAST(isodow(sales_date) - 1 AS INTEGER) AS sales_date_weekday
        FROM (SELECT f.*, customer_segment AS segment FROM fact_sales f
              LEFT JOIN customers c ON f.customer_sk = c.customer_sk)"""
    ),
)
def prepare_sales(spark, folder):
    from salescope.operators.metrics import lookup_join

    sales = adapter.fact_sales(spark, folder).select(
        "sales_sk", "store_sk", "customer_sk", "sales_date", "total_amount"
    )
    sales = lookup_join(
        sales, adapter.customers(spark, folder), "customer_sk", "customer_sk", ["customer_segment"]
    ).drop("customer_sk")
    ready = preprocess.prepare(
        sales.withColumnRenamed("customer_segment", "segment"),
        dates=["sales_date"],
        categories=["segment"],
        numbers=["total_amount"],
    )
    return rounded(ready, "total_amount")


# ---- splits ----


def _hash_sql(key):
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 80"


@query(
    "split_random",
    star_sql(
        f"""SELECT customer_sk, CASE WHEN {_hash_sql('customer_sk')} THEN 'train' ELSE 'test' END
        AS split FROM customer_features"""
    ),
)
def split_random(spark, folder):
    return splits.split_dataset("ltv", ltv(spark, folder)).select("customer_sk", "split")


@query(
    "split_group",
    star_sql(
        f"""SELECT customer_sk, product_sk, CASE WHEN {_hash_sql('customer_sk')}
        THEN 'train' ELSE 'test' END AS split FROM interactions"""
    ),
)
def split_group(spark, folder):
    pairs = recommendation(spark, folder).select("customer_sk", "product_sk")
    return splits.split_by_hash(pairs, "customer_sk")


@query(
    "split_time",
    star_sql(
        """SELECT date, CASE WHEN row_number() OVER (ORDER BY date)
        <= (count(*) OVER () * 80) // 100 THEN 'train' ELSE 'test' END AS split FROM forecast"""
    ),
)
def split_time(spark, folder):
    return splits.split_dataset("forecast", forecast(spark, folder)).select("date", "split")


@query(
    "split_unused",
    star_sql(
        f"""SELECT customer_sk, CASE WHEN row_number() OVER (ORDER BY customer_sk) > 1000
        THEN 'unused' WHEN {_hash_sql('customer_sk')} THEN 'train' ELSE 'test' END AS split
        FROM customer_features"""
    ),
)
def split_unused(spark, folder):
    capped = splits.split_dataset("churn", churn(spark, folder), max_rows=1000)
    return capped.select("customer_sk", "split")


# ---- learning sample and manifest ----

LEARNING_SQL = """learning AS (
  SELECT *, row_number() OVER (ORDER BY sales_date, sales_sk) <= 5000 AS used FROM fact_sales)"""


@query(
    "learning_sales",
    star_sql("SELECT sales_sk, used FROM learning", LEARNING_SQL),
)
def learning_sales(spark, folder):
    return manifest.learning_sales(adapter.fact_sales(spark, folder)).select("sales_sk", "used")


def _dimension_sql(table, key, child, parent=None):
    parent = parent or key
    return f"""SELECT '{table}' AS table_name, '{key}' AS pk_column, CAST(k AS VARCHAR) AS pk,
      true AS used FROM (SELECT DISTINCT {child} AS k FROM learning WHERE used)
      UNION ALL
      SELECT '{table}', '{key}', CAST({parent} AS VARCHAR), false FROM {table}
      WHERE {parent} NOT IN (SELECT {child} FROM learning WHERE used)"""


USAGE_SQL = "usage AS (" + " UNION ALL ".join(
    [
        """SELECT 'fact_sales' AS table_name, 'sales_sk' AS pk_column, sales_sk AS pk, used
        FROM learning""",
        *[
            _dimension_sql(t, k, k)
            for t, k in (
                ("customers", "customer_sk"),
                ("products", "product_sk"),
                ("stores", "store_sk"),
                ("salespersons", "salesperson_sk"),
                ("campaigns", "campaign_sk"),
            )
        ],
        _dimension_sql("dates", "full_date", "CAST(sales_date AS DATE)"),
    ]
) + ")"


MANIFEST_SQL = """SELECT table_name, pk_column, CAST(count_if(used) AS BIGINT) AS used_count,
        CAST(count_if(NOT used) AS BIGINT) AS unused_count FROM usage GROUP BY ALL"""


@query("manifest_export", star_sql(MANIFEST_SQL, LEARNING_SQL, USAGE_SQL))
def manifest_export(spark, folder):
    """Write the manifest as CSV per table and counts as JSON; count the rows read back."""
    target = fresh(spark, "manifest")
    manifest.write_row_usage(manifest.row_usage(adapter.star(spark, folder)), target)
    schema = "pk_column string, pk string, used boolean, table_name string"
    rows = spark.read.schema(schema).option("header", "true").csv(f"{target}/rows")
    return manifest.row_usage_summary(rows)


@query(
    "feature_tables",
    star_sql(
        """SELECT 'customer_features' AS name, count(DISTINCT customer_sk) AS n,
          CAST(sum(total_amount) AS DOUBLE) AS revenue FROM fact_sales
        UNION ALL SELECT 'product_features', count(DISTINCT product_sk),
          CAST(sum(total_amount) AS DOUBLE) FROM fact_sales
        UNION ALL SELECT 'daily_features', count(DISTINCT CAST(sales_date AS DATE)),
          CAST(sum(total_amount) AS DOUBLE) FROM fact_sales
        UNION ALL SELECT 'interactions', count(DISTINCT (customer_sk, product_sk)),
          CAST(sum(total_amount) AS DOUBLE) FROM fact_sales"""
    ),
)
def feature_tables(spark, folder):
    """All four feature tables, each with its rows and the revenue it holds."""
    built = feature_frames(spark, folder)
    revenue = {
        "customer_features": "total_spent",
        "product_features": "total_revenue",
        "daily_features": "daily_revenue",
        "interactions": "total_spent",
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum(money(revenue[name])).cast("double").alias("revenue")).select(
            F.lit(name).alias("name"), "n", "revenue"
        )
        for name, df in built.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("row_usage", star_sql("SELECT * FROM usage", LEARNING_SQL, USAGE_SQL))
def row_usage(spark, folder):
    return manifest.row_usage(adapter.star(spark, folder))


@query("row_usage_summary", star_sql(MANIFEST_SQL, LEARNING_SQL, USAGE_SQL))
def row_usage_summary(spark, folder):
    return manifest.row_usage_summary(manifest.row_usage(adapter.star(spark, folder)))
