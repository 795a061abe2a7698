"""Feature tables over all sales lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.columns import floor_days
from salescope.operators.aggregates import builtin, with_distinct_counts
from salescope.operators.metrics import lookup_join
from salescope.operators.timeseries import rolling_average


def customer_features(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per customer with sales; recency counts from the latest sale of all.

    The sales are read once: the aggregate, one row per customer, is written
    out, and the latest date comes from it.
    """
    per_customer = with_distinct_counts(
        sales,
        ["customer_sk"],
        {"products_purchased": "product_sk", "stores_used": "store_sk", "campaigns_used": "campaign_sk"},
        [
            F.count("sales_id").alias("total_orders"),
            builtin("sum", "total_amount").alias("total_spent"),
            builtin("mean", "total_amount").alias("average_order_value"),
            F.min("sales_date").alias("first_purchase_date"),
            F.max("sales_date").alias("last_purchase_date"),
        ],
    )
    return finished_customers(per_customer, customers)


def finished_customers(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """The feature table out of the sums per customer, a written table."""
    latest = per_customer.agg(F.max("last_purchase_date")).scalar()
    known = per_customer.filter(F.col("customer_sk").isNotNull()).withColumns(
        {
            "customer_lifetime_days": floor_days("first_purchase_date", "last_purchase_date"),
            "days_since_last_purchase": floor_days(F.col("last_purchase_date"), latest),
        }
    )
    return lookup_join(known, customers, "customer_sk", "customer_sk", ["customer_segment"])


def product_features(sales: DataFrame, products: DataFrame) -> DataFrame:
    """One row per product with sales."""
    per_product = with_distinct_counts(
        sales.filter(F.col("product_sk").isNotNull()),
        ["product_sk"],
        {"customers_purchased": "customer_sk", "stores_sold_in": "store_sk"},
        [
            F.count(F.lit(1)).alias("total_units_sold"),
            builtin("sum", "total_amount").alias("total_revenue"),
            builtin("mean", "total_amount").alias("average_sales_value"),
        ],
    )
    return lookup_join(per_product, products, "product_sk", "product_sk", ["category", "brand"])


def daily_features(sales: DataFrame) -> DataFrame:
    """One row per day with sales; the rolling means run over rows, not days."""
    daily = (
        sales.filter(F.col("sales_date").isNotNull())
        .groupBy(F.to_date("sales_date").alias("date"))
        .agg(
            F.coalesce(F.sum("total_amount"), F.lit(0)).alias("__exact"),
            F.count("sales_id").alias("transaction_count"),
        )
    )
    return finished_days(daily)


def finished_days(daily: DataFrame) -> DataFrame:
    """The feature table out of ``(date, __exact, transaction_count)``."""
    for days in (7, 30):
        daily = rolling_average(daily, ["date"], "__exact", f"rolling_{days}_day_average", days, series=True)
    return daily.select(
        "date",
        F.col("__exact").cast("double").alias("daily_revenue"),
        "transaction_count",
        F.weekday("date").alias("day_of_week"),
        F.month("date").alias("month"),
        F.quarter("date").alias("quarter"),
        "rolling_7_day_average",
        "rolling_30_day_average",
    )


def interactions(sales: DataFrame) -> DataFrame:
    """One row per customer and product that met."""
    known = sales.filter(F.col("customer_sk").isNotNull() & F.col("product_sk").isNotNull())
    return known.groupBy("customer_sk", "product_sk").agg(
        F.count("sales_id").alias("purchase_count"),
        builtin("sum", "total_amount").alias("total_spent"),
        builtin("mean", "total_amount").alias("average_spend"),
    )


def feature_tables(
    sales: DataFrame, customers: DataFrame, products: DataFrame
) -> dict[str, DataFrame]:
    return {
        "customer_features": customer_features(sales, customers),
        "product_features": product_features(sales, products),
        "daily_features": daily_features(sales),
        "interactions": interactions(sales),
    }


def with_next_value(daily: DataFrame, value: str, name: str) -> DataFrame:
    """The value of the following row of a day series."""
    return daily.withColumn(name, F.lead(value).over(Window.orderBy("date")))
