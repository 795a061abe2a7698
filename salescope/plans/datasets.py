"""Model-ready data sets and what is known about their columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.operators.cleaning import clean_ml_dataframe
from salescope.operators.metrics import lookup_join
from salescope.plans.features import with_next_value
from salescope.sources.schema import StarSchema

# ---- fixed values: the roles columns play in the five data sets ----
CHURN_AFTER_DAYS = 90
MONEY_COLUMNS = {
    "total_amount",
    "total_spent",
    "average_order_value",
    "total_revenue",
    "average_sales_value",
    "daily_revenue",
    "rolling_7_day_average",
    "rolling_30_day_average",
    "customer_ltv",
    "future_revenue",
    "average_spend",
}
TARGETS = {
    "churn": ["churn_label"],
    "ltv": ["customer_ltv"],
    "demand": ["total_units_sold", "total_revenue"],
    "forecast": ["future_revenue"],
    "recommendation": [],
}
PRIMARY_TARGET = {
    "churn": "churn_label",
    "ltv": "customer_ltv",
    "demand": "total_units_sold",
    "forecast": "future_revenue",
}
LEAKAGE_COLUMNS = {
    "churn": ["days_since_last_purchase"],
    "ltv": ["total_spent"],
    "demand": ["total_revenue"],
    "forecast": [],
}
TIME_COLUMNS = {"forecast": "date"}
# ---- end of fixed values ----


def churn_dataset(customer_features: DataFrame, customers: DataFrame) -> DataFrame:
    """A customer has churned after more than 90 days without a sale."""
    named = lookup_join(
        customer_features, customers, "customer_sk", "customer_sk", ["first_name", "last_name"]
    )
    label = (F.col("days_since_last_purchase") > CHURN_AFTER_DAYS).cast("int")
    return named.withColumn("churn_label", label)


def ltv_dataset(customer_features: DataFrame) -> DataFrame:
    return customer_features.withColumn("customer_ltv", F.col("total_spent"))


def demand_dataset(product_features: DataFrame, products: DataFrame) -> DataFrame:
    """Product features plus the product attributes they do not carry yet."""
    return lookup_join(
        product_features, products, "product_sk", "product_sk", ["product_name", "origin_location"]
    )


def forecast_dataset(daily_features: DataFrame, dates: DataFrame) -> DataFrame:
    """Day features with calendar columns and the next day's revenue, complete rows only."""
    calendar = dates.select(F.to_date("full_date").alias("full_date"), "year", "weekday")
    joined = daily_features.join(calendar, F.col("date") == F.col("full_date"), "left")
    return with_next_value(joined, "daily_revenue", "future_revenue").dropna()


def recommendation_dataset(interactions: DataFrame) -> DataFrame:
    return interactions


def model_datasets(features: Mapping[str, DataFrame], star: StarSchema) -> dict[str, DataFrame]:
    return {
        "churn": churn_dataset(features["customer_features"], star.customers),
        "ltv": ltv_dataset(features["customer_features"]),
        "demand": demand_dataset(features["product_features"], star.products),
        "forecast": forecast_dataset(features["daily_features"], star.dates),
        "recommendation": recommendation_dataset(features["interactions"]),
    }


def clean_model_datasets(datasets: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: clean_ml_dataframe(df, TARGETS[name]) for name, df in datasets.items()}


def protected_columns(name: str) -> set[str]:
    """Money, targets and the time column: never dropped, clipped or scaled."""
    time = {TIME_COLUMNS[name]} if name in TIME_COLUMNS else set()
    return MONEY_COLUMNS | set(TARGETS.get(name, [])) | time
