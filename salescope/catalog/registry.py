"""Registration of queries and the common parts of their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Entry:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Entry(run, sql)
        return run

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round computed figures, which may differ in the last bits between engines."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def as_days(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.to_date(c) for c in columns})


STAR_SQL = """
fact_sales AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS sales_sk,
         l_orderkey AS sales_id, o_custkey AS customer_sk, l_partkey AS product_sk,
         l_suppkey AS store_sk, CAST(c_nationkey AS BIGINT) AS salesperson_sk,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS campaign_sk,
         o_orderdate AS sales_date,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) AS total_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey),
sales_lines AS (
  SELECT l_orderkey AS sales_id, o_custkey AS customer_sk, l_partkey AS product_sk,
         l_suppkey AS store_sk, l_linenumber AS line_number,
         o_orderstatus AS order_status, o_orderpriority AS order_priority,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) AS total_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))
              AS DECIMAL(18,4)) AS freight,
         l_quantity AS rating, o_orderdate AS purchase_date, l_shipdate AS delivered_date,
         o_orderdate + INTERVAL 30 DAY AS estimated_date,
         CAST(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0) AS BIGINT)
           AS delivery_days,
         CAST(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate + INTERVAL 30 DAY))
              / 86400000000.0) AS BIGINT) AS delay_days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
customers AS (
  SELECT c_custkey AS customer_sk, c_name AS customer_id,
         split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         c_mktsegment AS customer_segment, c_nationkey AS nation_key
  FROM customer),
products AS (
  SELECT p_partkey AS product_sk, 'P' || CAST(p_partkey AS VARCHAR) AS product_id,
         p_name AS product_name, p_type AS category, p_brand AS brand,
         CAST(p_size AS VARCHAR) AS origin_location
  FROM part),
nations AS (
  SELECT n_nationkey AS nation_key, n_name AS state, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
stores AS (
  SELECT s_suppkey AS store_sk, s_name AS store_id, state, region
  FROM supplier JOIN nations ON s_nationkey = nation_key),
salespersons AS (
  SELECT CAST(n_nationkey AS BIGINT) AS salesperson_sk, n_name AS salesperson_id FROM nation),
campaigns AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS campaign_sk,
         o_orderpriority AS campaign_id,
         CAST(strftime(min(o_orderdate), '%Y%m%d') AS BIGINT) AS start_date_sk,
         CAST(strftime(max(o_orderdate), '%Y%m%d') AS BIGINT) AS end_date_sk
  FROM orders GROUP BY o_orderpriority),
dates AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_sk, CAST(d AS DATE) AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(isodow(d) - 1 AS INTEGER) AS weekday
  FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)),
               max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)),
customer_features AS (
  SELECT f.customer_sk, count(sales_id) AS total_orders,
         CAST(sum(total_amount) AS DOUBLE) AS total_spent,
         CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS average_order_value,
         CAST(min(sales_date) AS DATE) AS first_purchase_date,
         CAST(max(sales_date) AS DATE) AS last_purchase_date,
         count(DISTINCT product_sk) AS products_purchased,
         count(DISTINCT store_sk) AS stores_used,
         count(DISTINCT campaign_sk) AS campaigns_used,
         CAST(floor((epoch_us(max(sales_date)) - epoch_us(min(sales_date))) / 86400000000.0)
              AS BIGINT) AS customer_lifetime_days,
         CAST(floor((epoch_us((SELECT max(sales_date) FROM fact_sales))
              - epoch_us(max(sales_date))) / 86400000000.0) AS BIGINT) AS days_since_last_purchase,
         any_value(c.customer_segment) AS customer_segment
  FROM fact_sales f LEFT JOIN customers c ON f.customer_sk = c.customer_sk
  GROUP BY f.customer_sk),
product_features AS (
  SELECT f.product_sk, count(*) AS total_units_sold,
         CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
         CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS average_sales_value,
         count(DISTINCT customer_sk) AS customers_purchased,
         count(DISTINCT store_sk) AS stores_sold_in,
         any_value(category) AS category, any_value(brand) AS brand
  FROM fact_sales f LEFT JOIN products p ON f.product_sk = p.product_sk
  GROUP BY f.product_sk),
daily AS (
  SELECT CAST(sales_date AS DATE) AS date, sum(total_amount) AS exact,
         count(sales_id) AS transaction_count
  FROM fact_sales GROUP BY ALL),
daily_features AS (
  SELECT date, CAST(exact AS DOUBLE) AS daily_revenue, transaction_count,
         CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
         CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
         CASE WHEN count(exact) OVER w7 = 7
              THEN CAST(sum(exact) OVER w7 AS DOUBLE) / 7 END AS rolling_7_day_average,
         CASE WHEN count(exact) OVER w30 = 30
              THEN CAST(sum(exact) OVER w30 AS DOUBLE) / 30 END AS rolling_30_day_average
  FROM daily
  WINDOW w7 AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w30 AS (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
interactions AS (
  SELECT customer_sk, product_sk, count(sales_id) AS purchase_count,
         CAST(sum(total_amount) AS DOUBLE) AS total_spent,
         CAST(sum(total_amount) AS DOUBLE) / count(total_amount) AS average_spend
  FROM fact_sales GROUP BY customer_sk, product_sk),
churn AS (
  SELECT cf.*, first_name, last_name,
         CAST(days_since_last_purchase > 90 AS INTEGER) AS churn_label
  FROM customer_features cf LEFT JOIN customers USING (customer_sk)),
forecast AS (
  SELECT * FROM (
    SELECT df.*, full_date, year, weekday,
           lead(daily_revenue) OVER (ORDER BY date) AS future_revenue
    FROM daily_features df LEFT JOIN dates ON date = full_date)
  WHERE rolling_7_day_average IS NOT NULL AND rolling_30_day_average IS NOT NULL
    AND full_date IS NOT NULL AND future_revenue IS NOT NULL),
sales_events AS (
  SELECT CAST(event_id AS VARCHAR) AS sales_id, user_id AS customer_sk,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_sk,
         value AS total_amount, ts AS sales_date
  FROM events)
"""


def star_sql(body: str, *ctes: str) -> str:
    """Check SQL over the star-schema views; ``ctes`` are further named queries."""
    return "WITH " + ",\n".join([STAR_SQL.strip(), *ctes]) + "\n" + body
