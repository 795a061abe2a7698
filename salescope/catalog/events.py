"""Event banks, row events and streaming metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.catalog.registry import query, star_sql
from salescope.functions.columns import money
from salescope.session import fresh
from salescope.sources import adapter
from salescope.streaming import metrics, transport


def event_stream(spark, folder):
    """The ``events`` table as a file stream."""
    schema = adapter.table(spark, folder, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return adapter.as_sales_events(files.parquet(folder))


def fact_events(spark, folder):
    sales = adapter.fact_sales(spark, folder)
    return sales.select(
        F.col("sales_id").cast("string").alias("sales_id"),
        "customer_sk",
        "product_sk",
        F.col("total_amount").cast("double").alias("total_amount"),
        "sales_date",
    )


@query(
    "event_bank_roundtrip",
    star_sql(
        """SELECT customer_sk, count(*) AS n, CAST(sum(total_amount) AS DOUBLE) AS revenue,
        CAST(min(sales_date) AS DATE) AS first_day, CAST(max(sales_date) AS DATE) AS last_day,
        count(DISTINCT sales_sk) AS sales, CAST(sum(product_sk) AS BIGINT) AS product_sum,
        CAST(sum(store_sk) AS BIGINT) AS store_sum, CAST(sum(campaign_sk) AS BIGINT) AS campaign_sum
        FROM fact_sales GROUP BY customer_sk"""
    ),
)
def event_bank_roundtrip(spark, folder):
    """Write the whole fact as JSON batches and read all of its columns back."""
    bank = fresh(spark, "bank")
    sales = adapter.fact_sales(spark, folder)
    transport.write_event_bank(sales, bank, compression="gzip")
    return (
        transport.read_event_bank(spark, bank, sales.schema)
        .groupBy("customer_sk")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(money("total_amount")).cast("double").alias("revenue"),
            F.to_date(F.min("sales_date")).alias("first_day"),
            F.to_date(F.max("sales_date")).alias("last_day"),
            F.count_distinct("sales_sk").alias("sales"),
            F.sum("product_sk").alias("product_sum"),
            F.sum("store_sk").alias("store_sum"),
            F.sum("campaign_sk").alias("campaign_sum"),
        )
    )


#: The tables of the star, with a whole number each that is summed up as a check.
ROW_TABLES = {
    "customer": "c_custkey",
    "lineitem": "l_orderkey",
    "nation": "n_nationkey",
    "orders": "o_orderkey",
    "part": "p_partkey",
    "region": "r_regionkey",
    "supplier": "s_suppkey",
}


def _envelopes(spark, folder, name):
    return transport.row_events(adapter.table(spark, folder, name), name)


@query(
    "row_events",
    """SELECT 'row_loaded' AS event_type, 'customer' AS "table",
    CAST(to_json(customer) AS VARCHAR) AS payload FROM customer""",
)
def row_events(spark, folder):
    return _envelopes(spark, folder, "customer")


@query(
    "stream_row_events",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", count(*) AS n, CAST(sum({c}) AS BIGINT) AS key_sum FROM {t}"""
        for t, c in ROW_TABLES.items()
    ),
)
def stream_row_events(spark, folder):
    """Produce row events of all star tables, consume them as one stream, route by table."""
    topic = fresh(spark, "topic")
    envelopes = reduce(DataFrame.unionByName, [_envelopes(spark, folder, t) for t in ROW_TABLES])
    transport.send_to_files(envelopes, topic, compression="gzip")
    # Each payload is searched for the key of its own table only.
    key = F.coalesce(*[F.when(F.col("table") == t, F.get_json_object("payload", f"$.{c}")) for t, c in ROW_TABLES.items()])
    return metrics.running_aggregate(
        transport.stream_from_files(spark, topic).filter(F.col("event_type") == "row_loaded"),
        ["table"],
        {"n": F.count(F.lit(1)), "key_sum": F.sum(key.cast("long"))},
        fresh(spark, "routed"),
    )


@query(
    "event_validity",
    star_sql(
        """SELECT amount IS NOT NULL AND product_sk IS NOT NULL AND customer_sk IS NOT NULL AS valid,
        count(*) AS n, CAST(coalesce(sum(CAST(amount AS DECIMAL(18,4))), 0) AS DOUBLE) AS revenue
        FROM (SELECT CASE WHEN event_type <> 'error' THEN value END AS amount, user_id AS customer_sk,
          json_extract_string(props, '$.k') AS product_sk FROM events) GROUP BY 1"""
    ),
)
def event_validity(spark, folder):
    """Events of type ``error`` lose their amount here, so they are dead letters."""
    events = adapter.table(spark, folder, "events").withColumn(
        "value", F.when(F.col("event_type") != "error", F.col("value"))
    )
    valid, dead = metrics.split_events(adapter.as_sales_events(events))
    counted = [
        part.agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(money("total_amount")), F.lit(0)).cast("double").alias("revenue"),
        ).withColumn("valid", F.lit(flag))
        for part, flag in ((valid, True), (dead, False))
    ]
    return counted[0].unionByName(counted[1])


EVENT_SUM = "CAST(sum(CAST(total_amount AS DECIMAL(18,4))) AS DOUBLE) AS revenue"


@query(
    "stream_totals",
    star_sql(f"SELECT {EVENT_SUM}, count(*) AS transactions FROM sales_events"),
)
def stream_totals(spark, folder):
    return metrics.stream_totals(event_stream(spark, folder), fresh(spark, "totals"))


@query(
    "stream_products",
    star_sql(
        """SELECT product_sk, count(*) AS n FROM sales_events
        WHERE product_sk <> 0 GROUP BY product_sk"""
    ),
)
def stream_products(spark, folder):
    stream = event_stream(spark, folder)
    return metrics.stream_products(stream, fresh(spark, "products"), skip_zero_keys=True)


@query(
    "stream_customers",
    star_sql(
        f"""SELECT customer_sk, {EVENT_SUM} FROM sales_events
        WHERE customer_sk <> 0 GROUP BY customer_sk"""
    ),
)
def stream_customers(spark, folder):
    stream = event_stream(spark, folder)
    return metrics.stream_customers(stream, fresh(spark, "customers"), skip_zero_keys=True)


@query(
    "stream_daily",
    star_sql(
        f"SELECT strftime(sales_date, '%Y-%m-%d') AS day, {EVENT_SUM} FROM sales_events GROUP BY 1"
    ),
)
def stream_daily(spark, folder):
    return metrics.stream_daily(event_stream(spark, folder), fresh(spark, "daily"))


@query(
    "stream_monthly",
    star_sql(
        f"SELECT strftime(sales_date, '%Y-%m') AS month, {EVENT_SUM} FROM sales_events GROUP BY 1"
    ),
)
def stream_monthly(spark, folder):
    return metrics.stream_monthly(event_stream(spark, folder), fresh(spark, "monthly"))


@query(
    "stream_event_time",
    star_sql(
        f"""SELECT strftime(sales_date, '%Y-%m-%d') AS day, {EVENT_SUM}, count(*) AS transactions FROM sales_events
        GROUP BY 1 HAVING any_value(date_trunc('day', sales_date)) + INTERVAL 1 DAY
          <= (SELECT max(sales_date) FROM sales_events) - INTERVAL 2 DAY"""
    ),
)
def stream_event_time(spark, folder):
    """The days that are over, two days after their end in event time; every event comes twice."""
    stream = event_stream(spark, folder)
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return metrics.daily_by_event_time(twice, fresh(spark, "event-time"))[0]


MONTHLY = """SELECT strftime(sales_date, '%Y-%m') AS key, CAST(sum(total_amount) AS DOUBLE) AS value
  FROM fact_sales GROUP BY 1"""
DAILY = """SELECT strftime(sales_date, '%Y-%m-%d') AS key, CAST(sum(total_amount) AS DOUBLE) AS value
  FROM fact_sales GROUP BY 1"""
HEAD = """SELECT 'total_revenue' AS section, '' AS key,
    round(CAST(sum(total_amount) AS DOUBLE), 2) AS value FROM fact_sales
  UNION ALL SELECT 'transactions', '', CAST(count(*) AS DOUBLE) FROM fact_sales
  UNION ALL SELECT * FROM (SELECT 'top_products', CAST(product_sk AS VARCHAR),
    CAST(count(*) AS DOUBLE) AS v FROM fact_sales WHERE product_sk <> 0
    GROUP BY product_sk ORDER BY v DESC, product_sk LIMIT 10)
  UNION ALL SELECT * FROM (SELECT 'top_customers', CAST(customer_sk AS VARCHAR),
    CAST(sum(total_amount) AS DOUBLE) AS v FROM fact_sales WHERE customer_sk <> 0
    GROUP BY customer_sk ORDER BY v DESC, customer_sk LIMIT 10)"""


def summary(spark, folder):
    """Replay the fact as an event bank and fold it."""
    bank = fresh(spark, "bank")
    transport.write_event_bank(fact_events(spark, folder), bank)
    state = metrics.process_events(
        transport.stream_event_bank(spark, bank), fresh(spark, "fold"), skip_zero_keys=True
    )
    return metrics.event_summary(state)


@query(
    "event_summary",
    star_sql(
        f"""{HEAD} UNION ALL SELECT 'daily_sales', * FROM ({DAILY})
        UNION ALL SELECT 'monthly_sales', * FROM ({MONTHLY})"""
    ),
)
def event_summary(spark, folder):
    return summary(spark, folder)


@query(
    "event_report",
    star_sql(
        f"""{HEAD}
        UNION ALL SELECT 'monthly_sales', * FROM (SELECT * FROM ({MONTHLY}) ORDER BY key LIMIT 12)
        UNION ALL SELECT 'months_tracked', '', CAST(count(*) AS DOUBLE) FROM ({MONTHLY})
        UNION ALL SELECT 'days_tracked', min(key) || ' to ' || max(key), CAST(count(*) AS DOUBLE)
        FROM ({DAILY})"""
    ),
)
def event_report(spark, folder):
    return metrics.event_report(summary(spark, folder))
