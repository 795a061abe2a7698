"""Period series, ranks, shares, concentration and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.catalog.registry import query, rounded, star_sql
from salescope.operators import distribution as dist
from salescope.operators import timeseries as ts
from salescope.operators.aggregates import grouped
from salescope.operators.metrics import aggregate_multiple_metrics, lookup_join
from salescope.operators.scoring import weighted_score
from salescope.sources import adapter


def sales(spark, folder):
    return adapter.fact_sales(spark, folder)


STEPS = {"month": "1 MONTH", "quarter": "3 MONTH", "year": "1 YEAR", "week": "7 DAY"}


def period_sql(unit, value="CAST(sum(total_amount) AS DOUBLE)", empty="0.0", source="fact_sales",
               date="sales_date", name="revenue"):
    """CTE ``periods``: one row per calendar period, empty ones included."""
    step = f"INTERVAL {STEPS[unit]}"
    return f"""raw AS (
      SELECT CAST(date_trunc('{unit}', {date}) AS DATE) AS start, {value} AS v
      FROM {source} GROUP BY 1),
    periods AS (
      SELECT CAST(s + {step} - INTERVAL 1 DAY AS DATE) AS period, coalesce(v, {empty}) AS {name}
      FROM (SELECT CAST(unnest(generate_series(min(start), max(start), {step})) AS DATE) AS s
            FROM raw) LEFT JOIN raw ON s = start)"""


def monthly(spark, folder, freq="ME"):
    return ts.aggregate_time_period(
        sales(spark, folder), "sales_date", "total_amount", freq, name="revenue"
    )


for _unit, _freq, _name in (
    ("week", "W", "weekly_revenue"),
    ("month", "ME", "monthly_revenue"),
    ("quarter", "QE", "quarterly_revenue"),
    ("year", "YE", "yearly_revenue"),
):
    query(_name, star_sql("SELECT * FROM periods", period_sql(_unit)))(
        lambda spark, folder, freq=_freq: monthly(spark, folder, freq)
    )


@query(
    "monthly_growth",
    star_sql(
        """SELECT period, revenue, round((revenue - lag(revenue) OVER w)
        / nullif(lag(revenue) OVER w, 0) * 100, 6) AS growth_pct
        FROM periods WINDOW w AS (ORDER BY period)""",
        period_sql("month"),
    ),
)
def monthly_growth(spark, folder):
    grown = ts.growth_rate(monthly(spark, folder), ["period"], "revenue", "growth_pct", series=True)
    return rounded(grown, "growth_pct")


@query(
    "rolling_revenue",
    star_sql(
        """SELECT period, revenue, CASE WHEN count(revenue) OVER w = 3
        THEN round(sum(revenue) OVER w / 3, 4) END AS rolling
        FROM periods WINDOW w AS (ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        period_sql("month"),
    ),
)
def rolling_revenue(spark, folder):
    rolled = ts.rolling_average(monthly(spark, folder), ["period"], "revenue", "rolling", series=True)
    return rounded(rolled, "rolling", digits=4)


SLOPE_SQL = """SELECT round(regr_slope({v}, x), 4) AS slope FROM (
  SELECT {v}, CAST(row_number() OVER (ORDER BY period) - 1 AS DOUBLE) AS x
  FROM periods WHERE {v} IS NOT NULL)"""


@query("trend_slope", star_sql(SLOPE_SQL.format(v="revenue"), period_sql("month")))
def trend_slope(spark, folder):
    return rounded(ts.trend_slope(monthly(spark, folder), ["period"], "revenue", series=True), "slope", digits=4)


LINES_SQL = """lines AS (
  SELECT sales_sk, sales_date, CAST(total_amount AS DOUBLE) AS amount, total_amount,
         row_number() OVER (ORDER BY sales_date, sales_sk) - 1 AS x FROM fact_sales)"""


@query(
    "line_rolling",
    star_sql(
        """SELECT sales_sk, CASE WHEN count(total_amount) OVER w = 30
        THEN round(CAST(sum(total_amount) OVER w AS DOUBLE) / 30, 6) END AS rolling,
        round((amount - lag(amount) OVER o) / nullif(lag(amount) OVER o, 0) * 100, 6) AS growth_pct
        FROM lines WINDOW o AS (ORDER BY x), w AS (ORDER BY x ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""",
        LINES_SQL,
    ),
)
def line_rolling(spark, folder):
    """Rolling mean and growth over all sales lines in the order of their dates."""
    lines = sales(spark, folder).select("sales_sk", "sales_date", "total_amount")
    order = ["sales_date", "sales_sk"]
    rolled = ts.rolling_average(lines, order, "total_amount", "rolling", 30)
    grown = ts.growth_rate(rolled, order, "total_amount", "growth_pct")
    return rounded(grown.select("sales_sk", "rolling", "growth_pct"), "rolling", "growth_pct")


@query("line_slope", star_sql("SELECT round(regr_slope(amount, CAST(x AS DOUBLE)), 6) AS slope FROM lines", LINES_SQL))
def line_slope(spark, folder):
    """The slope over all sales lines in the order of their dates."""
    lines = sales(spark, folder).select("sales_sk", "sales_date", "total_amount")
    return rounded(ts.trend_slope(lines, ["sales_date", "sales_sk"], "total_amount"), "slope")


STORE_SUMS = """sums AS (
  SELECT store_sk, sum(total_amount) AS exact, CAST(sum(total_amount) AS DOUBLE) AS revenue
  FROM fact_sales GROUP BY store_sk)"""


@query(
    "store_rank",
    star_sql(
        "SELECT store_sk, revenue, dense_rank() OVER (ORDER BY exact DESC) AS rank FROM sums",
        STORE_SUMS,
    ),
)
def store_rank(spark, folder):
    sums = grouped(sales(spark, folder), ["store_sk"], {"revenue": ("total_amount", "sum")})
    return dist.rank_values(sums, "revenue", "store_sk")


@query(
    "category_share",
    star_sql(
        """SELECT category, CAST(sum(total_amount) AS DOUBLE) AS revenue,
        round(CAST(sum(total_amount) AS DOUBLE)
          / (SELECT CAST(sum(total_amount) AS DOUBLE) FROM fact_sales) * 100, 6) AS share_pct
        FROM fact_sales f JOIN products p ON f.product_sk = p.product_sk GROUP BY category"""
    ),
)
def category_share(spark, folder):
    sums = grouped(_by_category(spark, folder), ["category"], {"revenue": ("total_amount", "sum")})
    return rounded(dist.percentage_share(sums, "revenue"), "share_pct")


def _by_category(spark, folder):
    """Sales per product, with the category; summed per product before the join."""
    lines = sales(spark, folder)
    per_product = dist.exact_sums(lines, "product_sk", "total_amount")
    products = adapter.products(spark, folder)
    return lookup_join(per_product, products, "product_sk", "product_sk", ["category"])


@query(
    "top_n_customers",
    star_sql(
        """SELECT * FROM (SELECT customer_sk, CAST(sum(total_amount) AS DOUBLE) AS total_amount,
        dense_rank() OVER (ORDER BY sum(total_amount) DESC) AS rank
        FROM fact_sales GROUP BY customer_sk) WHERE rank <= 10"""
    ),
)
def top_n_customers(spark, folder):
    return dist.top_n(sales(spark, folder), "customer_sk", "total_amount", 10)


def pareto_sql(key):
    return star_sql(
        f"""SELECT {key}, CAST(s AS DOUBLE) AS total_amount, round(
        CAST(sum(s) OVER (ORDER BY s DESC, {key} ROWS UNBOUNDED PRECEDING) AS DOUBLE)
        / CAST(sum(s) OVER () AS DOUBLE) * 100, 6) AS cumulative_pct
        FROM (SELECT {key}, sum(total_amount) AS s FROM fact_sales GROUP BY {key})"""
    )


for _name, _key in (
    ("pareto_products", "product_sk"),
    ("pareto_customers", "customer_sk"),
    ("pareto_stores", "store_sk"),
):
    query(_name, pareto_sql(_key))(
        lambda spark, folder, key=_key: rounded(
            dist.pareto_table(sales(spark, folder), key, "total_amount"), "cumulative_pct"
        )
    )


def concentration_sql(key):
    """Top shares and the part of the entities that make 80 % of the total."""
    tops = ", ".join(
        f"""round(CAST(sum(CASE WHEN pos <= greatest(1, (n * {p} + 99) // 100) THEN s END)
        AS DOUBLE) / max(CAST(whole AS DOUBLE)) * 100, 2) AS top_{p}_pct_share"""
        for p in (1, 5, 10)
    )
    return star_sql(
        f"""SELECT {tops}, round(CAST(min(CASE WHEN run * 10 >= whole * 8 THEN pos END) AS DOUBLE)
          / max(n) * 100, 2) AS entities_for_80pct_of_value
        FROM (SELECT s, row_number() OVER w AS pos, sum(s) OVER w AS run, sum(s) OVER () AS whole,
          count(*) OVER () AS n
          FROM (SELECT {key}, sum(total_amount) AS s FROM fact_sales GROUP BY {key})
          WINDOW w AS (ORDER BY s DESC, {key} ROWS UNBOUNDED PRECEDING))"""
    )


def concentration(spark, folder, key):
    sums = dist.exact_sums(sales(spark, folder), key, "total_amount")
    return dist.concentration_analysis(sums, "total_amount", key)


@query("customer_concentration", concentration_sql("customer_sk"))
def customer_concentration(spark, folder):
    return concentration(spark, folder, "customer_sk")


def correlation_sql(x, y, source):
    def ranks(c):
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"

    return f"""SELECT round(corr(x, y), 6) AS pearson, round(corr(rx, ry), 6) AS spearman FROM (
      SELECT x, y, {ranks('x')} AS rx, {ranks('y')} AS ry FROM (
        SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y FROM {source}
        WHERE {x} IS NOT NULL AND {y} IS NOT NULL))"""


@query("correlation", correlation_sql("l_quantity", "l_extendedprice", "lineitem"))
def correlation(spark, folder):
    lines = adapter.table(spark, folder, "lineitem")
    return rounded(dist.correlation(lines, "l_quantity", "l_extendedprice"), "pearson", "spearman")


OUTLIER_SQL = """SELECT {key}, {v}, v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1) AS is_outlier
  FROM (SELECT *, CAST({v} AS DOUBLE) AS v FROM {source}),
  (SELECT quantile_cont(CAST({v} AS DOUBLE), 0.25) AS q1,
          quantile_cont(CAST({v} AS DOUBLE), 0.75) AS q3 FROM {source})"""


@query(
    "outliers",
    "SELECT * FROM ("
    + OUTLIER_SQL.format(key="o_orderkey", v="o_totalprice", source="orders")
    + ")",
)
def outliers(spark, folder):
    orders = adapter.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return dist.detect_outliers(orders, "o_totalprice")


def score_sql(key, metrics, source, weights=None):
    weights = weights or [1 / len(metrics)] * len(metrics)
    parts = " + ".join(
        f"""coalesce((CAST({m} AS DOUBLE) - min(CAST({m} AS DOUBLE)) OVER ())
        / nullif(max(CAST({m} AS DOUBLE)) OVER () - min(CAST({m} AS DOUBLE)) OVER (), 0)
        * CAST({w!r} AS DOUBLE), 0)"""
        for m, w in zip(metrics, weights)
    )
    return f"SELECT {key}, round({parts}, 6) AS score FROM {source}"


@query(
    "store_score",
    star_sql(
        score_sql("store_sk", ["total_amount_sum", "customer_sk_nunique"], "card", [0.7, 0.3]),
        """card AS (SELECT store_sk, CAST(sum(total_amount) AS DOUBLE) AS total_amount_sum,
        count(DISTINCT customer_sk) AS customer_sk_nunique FROM fact_sales GROUP BY store_sk)""",
    ),
)
def store_score(spark, folder):
    card = aggregate_multiple_metrics(
        sales(spark, folder), "store_sk", {"total_amount": "sum", "customer_sk": "nunique"}
    )
    scored = weighted_score(card, ["total_amount_sum", "customer_sk_nunique"], [0.7, 0.3])
    return rounded(scored.select("store_sk", "score"), "score")


@query(
    "histogram",
    """WITH span AS (SELECT min(o_totalprice) AS lo,
      (max(o_totalprice) - min(o_totalprice)) / 20 AS w FROM orders),
    counts AS (SELECT CAST(least(floor((o_totalprice - lo) / w), 19) AS BIGINT) AS bin, count(*) AS n
      FROM orders, span GROUP BY 1)
    SELECT b AS bin, round(lo + b * w, 6) AS low, round(lo + (b + 1) * w, 6) AS high,
      coalesce(n, 0) AS n
    FROM (SELECT unnest(generate_series(0, 19)) AS b) CROSS JOIN span LEFT JOIN counts ON b = counts.bin""",
)
def histogram(spark, folder):
    orders = adapter.table(spark, folder, "orders")
    return rounded(dist.histogram(orders, "o_totalprice", 20), "low", "high")


@query(
    "box_stats",
    "SELECT l_returnflag, "
    + ", ".join(
        f"round(quantile_cont(l_extendedprice, {q}), 4) AS {n}"
        for n, q in (("min", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1.0))
    )
    + " FROM lineitem GROUP BY l_returnflag",
)
def box_stats(spark, folder):
    lines = adapter.table(spark, folder, "lineitem")
    box = dist.box_stats(lines, "l_extendedprice", by=["l_returnflag"])
    return rounded(box, "min", "q1", "median", "q3", "max", digits=4)


@query(
    "segment_category_pivot",
    star_sql(
        """SELECT customer_segment, category,
        round(CAST(sum(total_amount) AS DOUBLE) / count(total_amount), 6) AS mean
        FROM fact_sales f JOIN customers c ON f.customer_sk = c.customer_sk
        JOIN products p ON f.product_sk = p.product_sk GROUP BY customer_segment, category"""
    ),
)
def segment_category_pivot(spark, folder):
    lines = sales(spark, folder).select("customer_sk", "product_sk", "total_amount")
    lines = lookup_join(
        lines, adapter.customers(spark, folder), "customer_sk", "customer_sk", ["customer_segment"]
    )
    lines = lookup_join(
        lines, adapter.products(spark, folder), "product_sk", "product_sk", ["category"]
    )
    return rounded(dist.mean_matrix(lines, "customer_segment", "category", "total_amount"), "mean")


@query(
    "event_top_products",
    star_sql(
        """SELECT product_sk, count(*) AS n FROM sales_events WHERE product_sk IS NOT NULL
        GROUP BY product_sk ORDER BY n DESC, product_sk LIMIT 10"""
    ),
)
def event_top_products(spark, folder):
    events = adapter.sales_events(spark, folder).filter(F.col("product_sk").isNotNull())
    counts = events.groupBy("product_sk").agg(F.count(F.lit(1)).alias("n"))
    return dist.first_n(counts, "n", "product_sk")
