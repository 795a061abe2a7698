"""The 36 business questions over sales lines.

Seller is the store, geography the store's or customer's state, freight and
rating are columns of the sales lines.  Attributes are joined after the lines
have been summed per key wherever the figures allow it, so that the large side
of a join has one row per entity.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.columns import percent, ratio
from salescope.operators import delivery
from salescope.operators import distribution as dist
from salescope.operators import timeseries as ts
from salescope.operators.aggregates import grouped
from salescope.operators.metrics import lookup_join, summary_statistics
from salescope.operators.scoring import weighted_score


@dataclass(frozen=True)
class SalesData:
    """Lines with customer, product and store keys; the attribute tables."""

    lines: DataFrame
    customers: DataFrame  # customer_sk, customer_segment, state, region
    products: DataFrame  # product_sk, category

    def with_customer(self, *columns: str) -> DataFrame:
        return lookup_join(self.lines, self.customers, "customer_sk", "customer_sk", columns)

    def with_product(self, *columns: str) -> DataFrame:
        return lookup_join(self.lines, self.products, "product_sk", "product_sk", columns)

    def delivered(self, lines: DataFrame | None = None) -> DataFrame:
        lines = self.lines if lines is None else lines
        timed = delivery.delivery_duration(lines)
        return delivery.delivery_delay(timed, "delivered_date", "estimated_date")


REVENUE = {
    "revenue": ("total_amount", "sum"),
    "lines": ("total_amount", "count"),
    "average_sale": ("total_amount", "mean"),
}


def share_and_rank(df: DataFrame, key: str, value: str) -> DataFrame:
    """Share of the total and rank by ``value``, from one scan."""
    scan = dist.ranked(df, value, key, totals={"__all": F.col(value)})
    return scan.withColumn("share_pct", percent(value, "__all")).drop("__all")


def sums_by_attribute(
    lines: DataFrame, key: str, lookup: DataFrame, attribute: str, columns: Sequence[str]
) -> DataFrame:
    """Exact sums (``sum_<column>``) and counts (``n_<column>``) per attribute of an entity.

    Lines are summed per entity before the attribute is joined, so neither a
    hot entity nor the number of lines reaches the join.  ``entities`` counts
    the entities with lines.
    """
    per_entity = (
        lines.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            *[F.sum(c).alias(f"sum_{c}") for c in columns],
            *[F.count(c).alias(f"n_{c}") for c in columns],
        )
    )
    named = lookup_join(per_entity, lookup, key, key, [attribute])
    return (
        named.filter(F.col(attribute).isNotNull())
        .groupBy(attribute)
        .agg(
            *[F.coalesce(F.sum(f"sum_{c}"), F.lit(0)).cast("double").alias(f"sum_{c}") for c in columns],
            *[F.sum(f"n_{c}").alias(f"n_{c}") for c in columns],
            F.count(key).alias("entities"),
        )
    )


def mean_of(column: str):
    return ratio(f"sum_{column}", f"n_{column}")


def kpis(d: SalesData) -> DataFrame:
    """Q1."""
    figures = grouped(
        d.lines,
        [],
        {
            "revenue": ("total_amount", "sum"),
            "lines": ("total_amount", "count"),
            "orders": ("sales_id", "nunique"),
            "customers": ("customer_sk", "nunique"),
            "average_sale": ("total_amount", "mean"),
        },
    )
    return figures.withColumn("revenue_per_order", ratio("revenue", "orders")).withColumn(
        "revenue_per_customer", ratio("revenue", "customers")
    )


def monthly(d: SalesData, **specs) -> DataFrame:
    return ts.aggregate_periods(d.lines, "purchase_date", specs)


def with_slope(series: DataFrame, value: str, name: str) -> DataFrame:
    return ts.with_trend_slope(series, ["period"], value, name)


def revenue_trend(d: SalesData) -> DataFrame:
    """Q2."""
    series = monthly(d, revenue=("total_amount", "sum"))
    series = ts.growth_rate(series, ["period"], "revenue", "growth_pct", series=True)
    series = ts.rolling_average(series, ["period"], "revenue", "rolling", series=True)
    return with_slope(series, "revenue", "slope")


def period_share(d: SalesData) -> DataFrame:
    """Q3."""
    return share_and_rank(monthly(d, revenue=("total_amount", "sum")), "period", "revenue")


def concentration(d: SalesData, key: str, with_rank: bool = False) -> DataFrame:
    """Q4 to Q6: Pareto rows of every entity beside the concentration figures."""
    sums = dist.exact_sums(d.lines, key, "total_amount")
    rank = {"dense_rank": ("total_amount", "rank")} if with_rank else {}
    scan = dist.concentration_scan(sums, "total_amount", key, **rank)
    figures = dist.concentration_figures(scan, "total_amount")
    row = figures.select(F.struct(*figures.columns).alias("c")).scalar()
    return scan.select(
        key,
        F.col("total_amount").cast("double").alias("total_amount"),
        percent("run", "whole").alias("cumulative_pct"),
        *(["rank"] if with_rank else []),
        *[row.getField(c).alias(c) for c in figures.columns],
    )


def customer_value(d: SalesData) -> DataFrame:
    """Q7: value per order, mean and median sale and rank of every customer."""
    figures = grouped(
        d.lines,
        ["customer_sk"],
        {
            "revenue": ("total_amount", "sum"),
            "orders": ("sales_id", "nunique"),
            "average_sale": ("total_amount", "mean"),
            "median_sale": ("total_amount", "median"),
        },
    ).withColumn("revenue_per_order", ratio("revenue", "orders"))
    return dist.ranked(figures, "revenue", "customer_sk")


def order_value_stats(d: SalesData) -> DataFrame:
    """Q8."""
    orders = dist.exact_sums(d.lines, "sales_id", "total_amount")
    return summary_statistics(orders, "total_amount")


def customer_states(d: SalesData) -> DataFrame:
    """Q9."""
    figures = orders_by_state(d).withColumn("average_sale", ratio("revenue", "lines"))
    return figures.select("state", *REVENUE, "customers", "orders")


def orders_by_state(d: SalesData) -> DataFrame:
    """Revenue, customers and orders per customer state.

    An order has one customer, so orders are counted per customer before the
    state is joined; no line reaches the join.
    """
    known = d.lines.filter(F.col("customer_sk").isNotNull())
    per_customer = known.groupBy("customer_sk").agg(
        F.sum("total_amount").alias("amount"),
        F.count("total_amount").alias("lines"),
        F.count_distinct("sales_id").alias("orders"),
    )
    named = lookup_join(per_customer, d.customers, "customer_sk", "customer_sk", ["state"])
    return (
        named.filter(F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("revenue"),
            F.sum("lines").alias("lines"),
            F.count("customer_sk").alias("customers"),
            F.sum("orders").alias("orders"),
        )
    )


def category_rank(d: SalesData) -> DataFrame:
    """Q10."""
    per_product = dist.exact_sums(d.lines, "product_sk", "total_amount")
    named = lookup_join(per_product, d.products, "product_sk", "product_sk", ["category"])
    sums = grouped(named, ["category"], {"revenue": ("total_amount", "sum")})
    return share_and_rank(sums, "category", "revenue")


def entity_share_rank(d: SalesData, key: str) -> DataFrame:
    """Q11 and Q14."""
    specs = REVENUE | {"customers": ("customer_sk", "nunique")}
    return share_and_rank(grouped(d.lines, [key], specs), key, "revenue")


def entity_ratios(d: SalesData, key: str) -> DataFrame:
    """Q12 and Q15: revenue per order and customer, freight per revenue."""
    figures = grouped(
        d.lines,
        [key],
        {
            "revenue": ("total_amount", "sum"),
            "freight": ("freight", "sum"),
            "orders": ("sales_id", "nunique"),
            "customers": ("customer_sk", "nunique"),
        },
    )
    return figures.select(
        key,
        ratio("revenue", "orders").alias("revenue_per_order"),
        ratio("revenue", "customers").alias("revenue_per_customer"),
        ratio("freight", "revenue").alias("freight_ratio"),
    )


def seller_rank(d: SalesData) -> DataFrame:
    """Q13: rank by revenue, by orders and by rating."""
    figures = grouped(
        d.lines,
        ["store_sk"],
        {
            "revenue": ("total_amount", "sum"),
            "orders": ("sales_id", "nunique"),
            "rating": ("rating", "mean"),
        },
    )
    for value in ("revenue", "orders", "rating"):
        figures = dist.ranked(figures, value, "store_sk", f"{value}_rank")
    return figures


def revenue_figures() -> list:
    return [
        F.col("sum_total_amount").alias("revenue"),
        F.col("n_total_amount").alias("lines"),
        mean_of("total_amount").alias("average_sale"),
    ]


def state_rank(d: SalesData) -> DataFrame:
    """Q16."""
    sums = sums_by_attribute(d.lines, "customer_sk", d.customers, "state", ["total_amount"])
    return dist.ranked(sums.select("state", *revenue_figures()), "revenue", "state")


def by_attribute(d: SalesData, column: str) -> DataFrame:
    """Q17, Q18 and Q30: several figures per state, region or segment."""
    sums = sums_by_attribute(
        d.lines, "customer_sk", d.customers, column, ["total_amount", "freight", "rating"]
    )
    return sums.select(
        column,
        *revenue_figures(),
        F.col("entities").alias("customers"),
        F.col("sum_freight").alias("freight"),
        mean_of("rating").alias("rating"),
    )


def state_ratio(d: SalesData) -> DataFrame:
    """Q19: orders per customer and state."""
    counts = orders_by_state(d).select("state", "orders", "customers")
    return counts.withColumn("orders_per_customer", ratio("orders", "customers"))


def delivery_trend(d: SalesData) -> DataFrame:
    """Q20: monthly mean and median delivery time, with the slope of the mean."""
    series = ts.aggregate_periods(
        d.delivered(),
        "purchase_date",
        {"mean_days": ("delivery_days", "mean"), "median_days": ("delivery_days", "median")},
    )
    return with_slope(series, "mean_days", "slope")


def delivery_by(d: SalesData, key: str) -> DataFrame:
    """Q21 and Q22: delivery figures and rank per seller or customer state."""
    if key == "store_sk":
        figures = grouped(
            d.delivered(),
            [key],
            {
                "mean_days": ("delivery_days", "mean"),
                "mean_delay": ("delay_days", "mean"),
                "lines": ("delay_days", "count"),
            },
        )
    else:
        sums = sums_by_attribute(
            d.delivered(), "customer_sk", d.customers, key, ["delivery_days", "delay_days"]
        )
        figures = sums.select(
            key,
            mean_of("delivery_days").alias("mean_days"),
            mean_of("delay_days").alias("mean_delay"),
            F.col("n_delay_days").alias("lines"),
        )
    return dist.ranked(figures, "mean_delay", key, ascending=True)


def service_level(d: SalesData) -> DataFrame:
    """Q23."""
    return delivery.delivery_status_rates(d.delivered())


def delay_rating(d: SalesData) -> DataFrame:
    """Q24."""
    return dist.correlation(d.delivered(), "delay_days", "rating")


def rating_by(d: SalesData, key: str) -> DataFrame:
    """Q25 and Q26: rating rank per category or seller."""
    if key == "store_sk":
        figures = grouped(d.lines, [key], {"rating": ("rating", "mean"), "lines": ("rating", "count")})
    else:
        sums = sums_by_attribute(d.lines, "product_sk", d.products, key, ["rating"])
        figures = sums.select(key, mean_of("rating").alias("rating"), F.col("n_rating").alias("lines"))
    return dist.ranked(figures, "rating", key)


def rating_trend(d: SalesData) -> DataFrame:
    """Q27."""
    series = monthly(d, rating=("rating", "mean"), lines=("rating", "count"))
    series = ts.rolling_average(series, ["period"], "rating", "rolling", series=True)
    return with_slope(series, "rating", "slope")


def priority_share(d: SalesData) -> DataFrame:
    """Q28."""
    return dist.percentage_share(grouped(d.lines, ["order_priority"], REVENUE), "revenue")


def status_stats(d: SalesData) -> DataFrame:
    """Q29."""
    return summary_statistics(d.lines, "total_amount", by=["order_status"])


def basket_correlation(d: SalesData) -> DataFrame:
    """Q31."""
    known = d.lines.filter(F.col("sales_id").isNotNull())
    orders = known.groupBy("sales_id").agg(
        F.coalesce(F.sum("total_amount"), F.lit(0)).cast("double").alias("revenue"),
        F.count(F.lit(1)).alias("basket_size"),
    )
    return dist.correlation(orders, "basket_size", "revenue")


def freight_outliers(d: SalesData) -> DataFrame:
    """Q32: lines whose freight is out of line with their price."""
    lines = d.lines.select(
        "sales_id", "line_number", "product_sk", "store_sk",
        ratio("freight", "total_amount").alias("freight_ratio"),
    )
    return dist.detect_outliers(lines, "freight_ratio")


def freight_share(d: SalesData) -> DataFrame:
    """Q33: freight, its ratio to revenue and its share per category."""
    sums = sums_by_attribute(
        d.lines, "product_sk", d.products, "category", ["freight", "total_amount"]
    )
    figures = sums.select(
        "category",
        F.col("sum_freight").alias("freight"),
        F.col("sum_total_amount").alias("revenue"),
        ratio("sum_freight", "sum_total_amount").alias("freight_ratio"),
    )
    return dist.percentage_share(figures, "freight")


def category_score(d: SalesData) -> DataFrame:
    """Q34."""
    figures = grouped(
        d.with_product("category"),
        ["category"],
        {
            "revenue": ("total_amount", "sum"),
            "customers": ("customer_sk", "nunique"),
            "rating": ("rating", "mean"),
        },
    )
    return weighted_score(figures, ["revenue", "customers", "rating"], [0.5, 0.3, 0.2])


def seller_score(d: SalesData) -> DataFrame:
    """Q35."""
    figures = grouped(
        d.lines,
        ["store_sk"],
        {
            "revenue": ("total_amount", "sum"),
            "orders": ("sales_id", "nunique"),
            "rating": ("rating", "mean"),
        },
    )
    return weighted_score(figures, ["revenue", "orders", "rating"])


def state_score(d: SalesData) -> DataFrame:
    """Q36."""
    sums = sums_by_attribute(d.lines, "customer_sk", d.customers, "state", ["total_amount"])
    figures = sums.select(
        "state",
        F.col("sum_total_amount").alias("revenue"),
        F.col("entities").alias("customers"),
        ratio("sum_total_amount", "entities").alias("revenue_per_customer"),
    )
    return weighted_score(figures, ["revenue", "customers", "revenue_per_customer"])
