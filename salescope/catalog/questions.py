"""The 36 business questions."""

from __future__ import annotations

from salescope.catalog.basics import STATUS_SQL, rounded_summary, summary_sql
from salescope.catalog.registry import query, rounded, star_sql
from salescope.catalog.series import (
    OUTLIER_SQL,
    SLOPE_SQL,
    correlation_sql,
    period_sql,
    score_sql,
)
from salescope.plans import questions as qs
from salescope.sources import adapter


def data(spark, folder) -> qs.SalesData:
    nations = adapter.nations(spark, folder)
    return qs.SalesData(
        lines=adapter.sales_lines(spark, folder),
        customers=adapter.customers(spark, folder).join(nations, "nation_key"),
        products=adapter.products(spark, folder),
    )


LINES = """lines AS (
  SELECT l.*, customer_segment, n.state, n.region, category
  FROM sales_lines l JOIN customers c ON l.customer_sk = c.customer_sk
  JOIN nations n ON c.nation_key = n.nation_key
  JOIN products p ON l.product_sk = p.product_sk)"""

REV = "CAST(sum(total_amount) AS DOUBLE)"
MEAN = f"round({REV} / count(total_amount), 6)"
FREIGHT = "CAST(sum(freight) AS DOUBLE)"
RATING = "round(sum(rating) / count(rating), 6)"
FIGURES = f"{REV} AS revenue, count(total_amount) AS lines, {MEAN} AS average_sale"
CUSTOMERS = "count(DISTINCT customer_sk)"
ORDERS = "count(DISTINCT sales_id)"


def lines_sql(body, *ctes):
    return star_sql(body, LINES, *ctes)


def question(name, sql, *columns, digits=6):
    """Register a question; ``columns`` are rounded on the Spark side."""

    def register(build):
        def run(spark, folder):
            out = build(data(spark, folder))
            return rounded(out, *columns, digits=digits) if columns else out

        query(name, sql)(run)
        return build

    return register


question(
    "q01_kpis",
    lines_sql(
        f"""SELECT {REV} AS revenue, count(total_amount) AS lines, {ORDERS} AS orders,
        {CUSTOMERS} AS customers, {MEAN} AS average_sale,
        round({REV} / {ORDERS}, 6) AS revenue_per_order,
        round({REV} / {CUSTOMERS}, 6) AS revenue_per_customer FROM lines"""
    ),
    "average_sale", "revenue_per_order", "revenue_per_customer",
)(qs.kpis)

MONTHS = period_sql("month", source="sales_lines", date="purchase_date")


def slope_cte(value):
    return "trend AS (" + SLOPE_SQL.format(v=value) + ")"


question(
    "q02_revenue_trend",
    star_sql(
        """SELECT period, revenue,
        round((revenue - lag(revenue) OVER o) / nullif(lag(revenue) OVER o, 0) * 100, 4)
          AS growth_pct,
        CASE WHEN count(revenue) OVER r = 3 THEN round(sum(revenue) OVER r / 3, 4) END AS rolling,
        (SELECT slope FROM trend) AS slope FROM periods
        WINDOW o AS (ORDER BY period),
               r AS (ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        MONTHS,
        slope_cte("revenue"),
    ),
    "growth_pct", "rolling", "slope", digits=4,
)(qs.revenue_trend)

question(
    "q03_period_share",
    star_sql(
        """SELECT period, revenue, dense_rank() OVER (ORDER BY revenue DESC) AS rank,
        round(revenue / sum(revenue) OVER () * 100, 6) AS share_pct FROM periods""",
        MONTHS,
    ),
    "share_pct",
)(qs.period_share)


def concentration_sql(key, with_rank):
    rank = "dense_rank() OVER (ORDER BY s DESC) AS rank, " if with_rank else ""
    tops = ", ".join(
        f"""round(CAST(sum(CASE WHEN pos <= greatest(1, (n * {p} + 99) // 100) THEN s END) OVER ()
        AS DOUBLE) / CAST(whole AS DOUBLE) * 100, 2) AS top_{p}_pct_share"""
        for p in (1, 5, 10)
    )
    return star_sql(
        f"""SELECT {key}, CAST(s AS DOUBLE) AS total_amount, {rank}
          round(CAST(run AS DOUBLE) / CAST(whole AS DOUBLE) * 100, 6) AS cumulative_pct, {tops},
          round(CAST(min(CASE WHEN run * 10 >= whole * 8 THEN pos END) OVER () AS DOUBLE)
            / n * 100, 2) AS entities_for_80pct_of_value
        FROM (SELECT {key}, s, row_number() OVER w AS pos, sum(s) OVER w AS run,
            sum(s) OVER () AS whole, count(*) OVER () AS n
          FROM (SELECT {key}, sum(total_amount) AS s FROM sales_lines GROUP BY {key})
          WINDOW w AS (ORDER BY s DESC, {key} ROWS UNBOUNDED PRECEDING))"""
    )


for _name, _key, _rank in (
    ("q04_customer_concentration", "customer_sk", False),
    ("q05_seller_concentration", "store_sk", True),
    ("q06_product_concentration", "product_sk", True),
):
    question(_name, concentration_sql(_key, _rank), "cumulative_pct")(
        lambda d, key=_key, rank=_rank: qs.concentration(d, key, rank)
    )

question(
    "q07_customer_value",
    lines_sql(
        f"""SELECT customer_sk, {REV} AS revenue, {ORDERS} AS orders, {MEAN} AS average_sale,
        round(quantile_cont(CAST(total_amount AS DOUBLE), 0.5), 6) AS median_sale,
        round({REV} / {ORDERS}, 6) AS revenue_per_order,
        dense_rank() OVER (ORDER BY sum(total_amount) DESC) AS rank
        FROM lines GROUP BY customer_sk"""
    ),
    "average_sale", "median_sale", "revenue_per_order",
)(qs.customer_value)

query(
    "q08_order_value_stats",
    star_sql(
        summary_sql("total_amount", "orders_"),
        "orders_ AS (SELECT sales_id, sum(total_amount) AS total_amount FROM sales_lines GROUP BY 1)",
    ),
)(lambda spark, folder: rounded_summary(qs.order_value_stats(data(spark, folder))))

question(
    "q09_state_customers",
    lines_sql(
        f"""SELECT state, {FIGURES}, {CUSTOMERS} AS customers, {ORDERS} AS orders
        FROM lines GROUP BY state"""
    ),
    "average_sale",
)(qs.customer_states)


def share_rank_sql(key, extra=""):
    return lines_sql(
        f"""SELECT {key}, {extra} {REV} AS revenue,
        dense_rank() OVER (ORDER BY sum(total_amount) DESC) AS rank,
        round({REV} / CAST(sum(sum(total_amount)) OVER () AS DOUBLE) * 100, 6) AS share_pct
        FROM lines GROUP BY {key}"""
    )


question("q10_category_rank", share_rank_sql("category"), "share_pct")(qs.category_rank)
for _name, _key in (("q11_product_share_rank", "product_sk"), ("q14_seller_share_rank", "store_sk")):
    question(
        _name,
        share_rank_sql(
            _key,
            f"count(total_amount) AS lines, {MEAN} AS average_sale, {CUSTOMERS} AS customers,",
        ),
        "share_pct", "average_sale",
    )(lambda d, key=_key: qs.entity_share_rank(d, key))

for _name, _key in (("q12_product_ratios", "product_sk"), ("q15_seller_ratios", "store_sk")):
    question(
        _name,
        lines_sql(
            f"""SELECT {_key}, round({REV} / {ORDERS}, 6) AS revenue_per_order,
            round({REV} / {CUSTOMERS}, 6) AS revenue_per_customer,
            round({FREIGHT} / nullif({REV}, 0), 6) AS freight_ratio FROM lines GROUP BY {_key}"""
        ),
        "revenue_per_order", "revenue_per_customer", "freight_ratio",
    )(lambda d, key=_key: qs.entity_ratios(d, key))

question(
    "q13_seller_rank",
    lines_sql(
        f"""SELECT store_sk, {REV} AS revenue, {ORDERS} AS orders, {RATING} AS rating,
        dense_rank() OVER (ORDER BY sum(total_amount) DESC) AS revenue_rank,
        dense_rank() OVER (ORDER BY {ORDERS} DESC) AS orders_rank,
        dense_rank() OVER (ORDER BY sum(rating) / count(rating) DESC) AS rating_rank
        FROM lines GROUP BY store_sk"""
    ),
    "rating",
)(qs.seller_rank)

question(
    "q16_state_rank",
    lines_sql(
        f"""SELECT state, {FIGURES}, dense_rank() OVER (ORDER BY sum(total_amount) DESC) AS rank
        FROM lines GROUP BY state"""
    ),
    "average_sale",
)(qs.state_rank)

for _name, _key in (("q17_state", "state"), ("q18_region", "region"), ("q30_segment", "customer_segment")):
    question(
        _name,
        lines_sql(
            f"""SELECT {_key}, {FIGURES}, {CUSTOMERS} AS customers, {FREIGHT} AS freight,
            {RATING} AS rating FROM lines GROUP BY {_key}"""
        ),
        "average_sale", "rating",
    )(lambda d, key=_key: qs.by_attribute(d, key))

question(
    "q19_state_ratio",
    lines_sql(
        f"""SELECT state, {ORDERS} AS orders, {CUSTOMERS} AS customers,
        round({ORDERS} / {CUSTOMERS}, 6) AS orders_per_customer FROM lines GROUP BY state"""
    ),
    "orders_per_customer",
)(qs.state_ratio)

question(
    "q20_delivery_trend",
    star_sql(
        """SELECT period, round(mean_days, 6) AS mean_days, round(median_days, 6) AS median_days,
        (SELECT round(regr_slope(mean_days, x), 6) FROM (SELECT mean_days,
          CAST(row_number() OVER (ORDER BY period) - 1 AS DOUBLE) AS x FROM per_month
          WHERE mean_days IS NOT NULL)) AS slope FROM per_month""",
        """per_month AS (
          SELECT CAST(s + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS period, mean_days, median_days
          FROM (SELECT CAST(unnest(generate_series(min(date_trunc('month', purchase_date)),
                max(date_trunc('month', purchase_date)), INTERVAL 1 MONTH)) AS DATE) AS s
                FROM sales_lines)
          LEFT JOIN (SELECT CAST(date_trunc('month', purchase_date) AS DATE) AS m,
            CAST(sum(delivery_days) AS DOUBLE) / count(delivery_days) AS mean_days,
            quantile_cont(CAST(delivery_days AS DOUBLE), 0.5) AS median_days
            FROM sales_lines GROUP BY 1) ON s = m)""",
    ),
    "mean_days", "median_days", "slope",
)(qs.delivery_trend)

for _name, _key in (("q21_seller_delivery", "store_sk"), ("q22_state_delivery", "state")):
    question(
        _name,
        lines_sql(
            f"""SELECT {_key}, round(CAST(sum(delivery_days) AS DOUBLE) / count(delivery_days), 6)
              AS mean_days,
            round(CAST(sum(delay_days) AS DOUBLE) / count(delay_days), 6) AS mean_delay,
            count(delay_days) AS lines, dense_rank() OVER
              (ORDER BY CAST(sum(delay_days) AS DOUBLE) / count(delay_days)) AS rank
            FROM lines GROUP BY {_key}"""
        ),
        "mean_days", "mean_delay",
    )(lambda d, key=_key: qs.delivery_by(d, key))

question("q23_service_level", star_sql(STATUS_SQL))(qs.service_level)
question(
    "q24_delay_rating_corr",
    star_sql(correlation_sql("delay_days", "rating", "sales_lines")),
    "pearson", "spearman",
)(qs.delay_rating)

for _name, _key in (("q25_category_rating", "category"), ("q26_seller_rating", "store_sk")):
    question(
        _name,
        lines_sql(
            f"""SELECT {_key}, {RATING} AS rating, count(rating) AS lines,
            dense_rank() OVER (ORDER BY sum(rating) / count(rating) DESC) AS rank
            FROM lines GROUP BY {_key}"""
        ),
        "rating",
    )(lambda d, key=_key: qs.rating_by(d, key))

question(
    "q27_rating_trend",
    star_sql(
        """SELECT p.period, round(rating, 6) AS rating, lines,
        CASE WHEN count(rating) OVER r = 3 THEN round(sum(rating) OVER r / 3, 6) END AS rolling,
        (SELECT round(regr_slope(rating, x), 6) FROM (SELECT rating,
          CAST(row_number() OVER (ORDER BY period) - 1 AS DOUBLE) AS x FROM periods
          WHERE rating IS NOT NULL)) AS slope
        FROM periods p JOIN volumes v ON p.period = v.period
        WINDOW r AS (ORDER BY p.period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        period_sql("month", "sum(rating) / count(rating)", "NULL", "sales_lines", "purchase_date", "rating"),
        """volumes AS (SELECT CAST(date_trunc('month', purchase_date) + INTERVAL 1 MONTH
           - INTERVAL 1 DAY AS DATE) AS period, count(rating) AS lines FROM sales_lines GROUP BY 1)""",
    ),
    "rating", "rolling", "slope",
)(qs.rating_trend)

question(
    "q28_priority_share",
    lines_sql(
        f"""SELECT order_priority, {FIGURES},
        round({REV} / CAST(sum(sum(total_amount)) OVER () AS DOUBLE) * 100, 6) AS share_pct
        FROM lines GROUP BY order_priority"""
    ),
    "average_sale", "share_pct",
)(qs.priority_share)

query("q29_status_stats", star_sql(summary_sql("total_amount", "sales_lines", "order_status")))(
    lambda spark, folder: rounded_summary(qs.status_stats(data(spark, folder)))
)

question(
    "q31_basket_corr",
    star_sql(
        correlation_sql("n", "s", "baskets"),
        """baskets AS (SELECT sales_id, count(*) AS n, sum(total_amount) AS s
        FROM sales_lines GROUP BY sales_id)""",
    ),
    "pearson", "spearman",
)(qs.basket_correlation)

question(
    "q32_freight_outliers",
    star_sql(
        "SELECT sales_id, line_number, product_sk, store_sk, "
        "round(freight_ratio, 6) AS freight_ratio, is_outlier FROM ("
        + OUTLIER_SQL.format(
            key="sales_id, line_number, product_sk, store_sk", v="freight_ratio", source="ratios"
        )
        + ")",
        """ratios AS (SELECT *, CAST(freight AS DOUBLE) / nullif(CAST(total_amount AS DOUBLE), 0)
        AS freight_ratio FROM sales_lines)""",
    ),
    "freight_ratio",
)(qs.freight_outliers)

question(
    "q33_freight_share",
    lines_sql(
        f"""SELECT category, {FREIGHT} AS freight, {REV} AS revenue,
        round({FREIGHT} / nullif({REV}, 0), 6) AS freight_ratio,
        round({FREIGHT} / CAST(sum(sum(freight)) OVER () AS DOUBLE) * 100, 6) AS share_pct
        FROM lines GROUP BY category"""
    ),
    "freight_ratio", "share_pct",
)(qs.freight_share)


def scored(name, key, figures, weights, build):
    aliases = [alias for alias, _ in figures]
    computed = ", ".join(f"{sql} AS {alias}" for alias, sql in figures)
    sql = lines_sql(
        score_sql(key, aliases, "card", weights),
        f"card AS (SELECT {key}, {computed} FROM lines GROUP BY {key})",
    )
    question(name, sql, "score")(lambda d: build(d).select(key, "score"))


RAW_RATING = "sum(rating) / count(rating)"
scored(
    "q34_category_score", "category",
    [("revenue", REV), ("customers", CUSTOMERS), ("rating", RAW_RATING)], [0.5, 0.3, 0.2],
    qs.category_score,
)
scored(
    "q35_seller_score", "store_sk",
    [("revenue", REV), ("orders", ORDERS), ("rating", RAW_RATING)], None,
    qs.seller_score,
)
scored(
    "q36_state_score", "state",
    [("revenue", REV), ("customers", CUSTOMERS), ("revenue_per_customer", f"{REV} / {CUSTOMERS}")],
    None,
    qs.state_score,
)
