"""Scans, filters, joins, single figures and grouped figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.catalog.registry import query, rounded, star_sql
from salescope.functions.columns import calendar_parts, ratio
from salescope.operators import delivery, metrics
from salescope.session import fresh
from salescope.sources import adapter, tables

TEST_TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders "
    "pages part region supplier"
).split()


def _counts_sql(names, extra=""):
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count{extra} FROM {n}" for n in names
    )


@query("scan_tables", _counts_sql(TEST_TABLES))
def scan_tables(spark, folder):
    return tables.row_counts(tables.scan_tables(spark, folder, "parquet"))


@query("load_report", _counts_sql(TEST_TABLES, ", true AS loaded"))
def load_report(spark, folder):
    """Load the tables in replace mode and count what arrived."""
    target = fresh(spark, "loaded")
    readers = {n: (lambda n=n: adapter.table(spark, folder, n)) for n in TEST_TABLES}
    report = tables.load_tables(spark, readers, tables.parquet_writer(target))
    good = [r.table_name for r in report.filter("loaded").collect()]
    counts = tables.row_counts({n: spark.read.parquet(f"{target}/{n}") for n in good})
    return report.drop("detail").join(counts, "table_name", "left")


@query(
    "preview_customers",
    star_sql("SELECT * FROM customers ORDER BY customer_sk LIMIT 100"),
)
def preview_customers(spark, folder):
    return tables.preview(adapter.customers(spark, folder), "customer_sk")


@query(
    "store_sales",
    star_sql(
        """SELECT sales_sk, customer_sk, product_sk, CAST(sales_date AS DATE) AS sales_date,
        CAST(total_amount AS DOUBLE) AS total_amount FROM fact_sales
        WHERE store_sk = 7 AND sales_date >= DATE '1996-01-01' AND sales_date <= DATE '1997-12-31'"""
    ),
)
def store_sales(spark, folder):
    found = metrics.store_sales(
        adapter.fact_sales(spark, folder), store_sk=7, date_min="1996-01-01", date_max="1997-12-31"
    )
    return found.select(
        "sales_sk",
        "customer_sk",
        "product_sk",
        F.to_date("sales_date").alias("sales_date"),
        F.col("total_amount").cast("double").alias("total_amount"),
    )


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year,
    CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month,
    CAST(day(o_orderdate) AS INTEGER) AS o_orderdate_day,
    CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate_weekday FROM orders""",
)
def date_parts(spark, folder):
    orders = adapter.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return calendar_parts(orders, "o_orderdate")


@query(
    "lookup_join",
    star_sql(
        """SELECT sales_sk, f.product_sk, CAST(total_amount AS DOUBLE) AS total_amount,
        product_name, category FROM fact_sales f LEFT JOIN products p
        ON f.product_sk = p.product_sk"""
    ),
)
def lookup_join(spark, folder):
    sales = adapter.fact_sales(spark, folder).select(
        "sales_sk", "product_sk", F.col("total_amount").cast("double").alias("total_amount")
    )
    products = adapter.products(spark, folder)
    return metrics.lookup_join(
        sales, products, "product_sk", "product_sk", ["product_name", "category"]
    )


@query(
    "total_revenue",
    star_sql("SELECT CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM fact_sales"),
)
def total_revenue(spark, folder):
    return metrics.total(adapter.fact_sales(spark, folder), "total_amount", "total_revenue")


@query("line_count", star_sql("SELECT count(total_amount) AS line_count FROM fact_sales"))
def line_count(spark, folder):
    return metrics.count(adapter.fact_sales(spark, folder), "total_amount", "line_count")


@query(
    "unique_customers",
    star_sql("SELECT count(DISTINCT customer_sk) AS unique_customers FROM fact_sales"),
)
def unique_customers(spark, folder):
    return metrics.unique_count(
        adapter.fact_sales(spark, folder), "customer_sk", "unique_customers"
    )


@query(
    "average_sale",
    star_sql(
        """SELECT round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 6)
        AS average_sale FROM fact_sales"""
    ),
)
def average_sale(spark, folder):
    sales = adapter.fact_sales(spark, folder)
    return rounded(metrics.average(sales, "total_amount", "average_sale"), "average_sale")


@query(
    "median_sale",
    star_sql(
        """SELECT round(quantile_cont(CAST(total_amount AS DOUBLE), 0.5), 6) AS median_sale
        FROM fact_sales"""
    ),
)
def median_sale(spark, folder):
    sales = adapter.fact_sales(spark, folder)
    return rounded(metrics.median(sales, "total_amount", "median_sale"), "median_sale")


@query(
    "stddev_sale",
    star_sql(
        """SELECT round(stddev_samp(CAST(total_amount AS DOUBLE)), 4) AS stddev_sale
        FROM fact_sales"""
    ),
)
def stddev_sale(spark, folder):
    sales = adapter.fact_sales(spark, folder)
    found = metrics.standard_deviation(sales, "total_amount", "stddev_sale")
    return rounded(found, "stddev_sale", digits=4)


def summary_sql(value: str, source: str, by: str = "") -> str:
    x = f"CAST({value} AS DOUBLE)"
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return f"""SELECT {head}count({value}) AS count,
      round(CAST(sum({value}) AS DOUBLE) / count({value}), 4) AS mean,
      round(quantile_cont({x}, 0.5), 4) AS median, round(stddev_samp({x}), 4) AS std,
      CAST(min({value}) AS DOUBLE) AS min, CAST(max({value}) AS DOUBLE) AS max,
      round(quantile_cont({x}, 0.25), 4) AS p25, round(quantile_cont({x}, 0.75), 4) AS p75
      FROM {source}{tail}"""


def rounded_summary(df):
    return rounded(df, "mean", "median", "std", "p25", "p75", digits=4)


@query("summary_stats", star_sql(summary_sql("total_amount", "fact_sales")))
def summary_stats(spark, folder):
    sales = adapter.fact_sales(spark, folder)
    return rounded_summary(metrics.summary_statistics(sales, "total_amount"))


@query(
    "revenue_by_store",
    star_sql(
        """SELECT store_sk, CAST(sum(total_amount) AS DOUBLE) AS total_amount
        FROM fact_sales GROUP BY store_sk"""
    ),
)
def revenue_by_store(spark, folder):
    return metrics.aggregate_metric(adapter.fact_sales(spark, folder), "store_sk", "total_amount")


@query(
    "store_scorecard",
    star_sql(
        """SELECT store_sk, CAST(sum(total_amount) AS DOUBLE) AS total_amount_sum,
        round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 6) AS total_amount_mean,
        round(quantile_cont(CAST(total_amount AS DOUBLE), 0.5), 6) AS total_amount_median,
        round(stddev_samp(CAST(total_amount AS DOUBLE)), 4) AS total_amount_std,
        CAST(min(total_amount) AS DOUBLE) AS total_amount_min,
        CAST(max(total_amount) AS DOUBLE) AS total_amount_max,
        count(sales_id) AS sales_id_count, count(DISTINCT customer_sk) AS customer_sk_nunique
        FROM fact_sales GROUP BY store_sk"""
    ),
)
def store_scorecard(spark, folder):
    card = metrics.aggregate_multiple_metrics(
        adapter.fact_sales(spark, folder),
        "store_sk",
        {
            "total_amount": ["sum", "mean", "median", "std", "min", "max"],
            "sales_id": "count",
            "customer_sk": "nunique",
        },
    )
    card = rounded(card, "total_amount_mean", "total_amount_median", "total_amount_min", "total_amount_max")
    return rounded(card, "total_amount_std", digits=4)


@query(
    "basket_size",
    star_sql("SELECT sales_id, count(*) AS basket_size FROM fact_sales GROUP BY sales_id"),
)
def basket_size(spark, folder):
    lines = adapter.fact_sales(spark, folder)
    return metrics.basket_size(lines, "sales_id")


@query(
    "class_weight",
    star_sql(
        """SELECT round(coalesce(count_if(churn_label = 0) / nullif(count_if(churn_label = 1), 0),
        1.0), 6) AS class_weight FROM churn"""
    ),
)
def class_weight(spark, folder):
    from salescope.catalog.datasets import churn

    return rounded(metrics.class_weight(churn(spark, folder), "churn_label"), "class_weight")


@query(
    "revenue_per_customer",
    star_sql(
        """SELECT store_sk, round(CAST(sum(total_amount) AS DOUBLE)
        / nullif(count(DISTINCT customer_sk), 0), 6) AS revenue_per_customer
        FROM fact_sales GROUP BY store_sk"""
    ),
)
def revenue_per_customer(spark, folder):
    figures = metrics.aggregate_multiple_metrics(
        adapter.fact_sales(spark, folder),
        "store_sk",
        {"total_amount": "sum", "customer_sk": "nunique"},
    )
    figures = figures.select(
        "store_sk", ratio("total_amount_sum", "customer_sk_nunique").alias("revenue_per_customer")
    )
    return rounded(figures, "revenue_per_customer")


LINE_KEY = "sales_id, line_number, product_sk, store_sk"


@query("delivery_duration", star_sql(f"SELECT {LINE_KEY}, delivery_days FROM sales_lines"))
def delivery_duration(spark, folder):
    lines = delivery.delivery_duration(adapter.sales_lines(spark, folder))
    return lines.select(*LINE_KEY.split(", "), "delivery_days")


@query("delivery_delay", star_sql(f"SELECT {LINE_KEY}, delay_days FROM sales_lines"))
def delivery_delay(spark, folder):
    lines = delivery.delivery_delay(
        adapter.sales_lines(spark, folder), "delivered_date", "estimated_date"
    )
    return lines.select(*LINE_KEY.split(", "), "delay_days")


STATUS_SQL = """SELECT round(100.0 * count_if(delay_days > 0) / count(delay_days), 2) AS late_pct,
  round(100.0 * count_if(delay_days = 0) / count(delay_days), 2) AS on_time_pct,
  round(100.0 * count_if(delay_days < 0) / count(delay_days), 2) AS early_pct,
  round(sum(delay_days) / count(delay_days), 2) AS average_delay FROM sales_lines"""


@query("delivery_status", star_sql(STATUS_SQL))
def delivery_status(spark, folder):
    lines = delivery.delivery_delay(
        adapter.sales_lines(spark, folder), "delivered_date", "estimated_date"
    )
    return delivery.delivery_status_rates(lines)
