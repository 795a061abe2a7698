"""The sales star schema over the order-processing tables of a test folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions.columns import money
from salescope.sources.schema import StarSchema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def net_amount(price: str = "l_extendedprice", discount: str = "l_discount"):
    """Price less discount.  12 and 4 digits give a product of 18, the widest
    decimal Spark keeps in a single long."""
    return money(F.col(price).cast("decimal(12,2)") * (1 - F.col(discount).cast("decimal(4,2)")))


def fact_sales(spark: SparkSession, folder: str, territory: bool = False) -> DataFrame:
    """One row per order line.

    ``territory`` adds the salesperson, who comes with the customer.  No join
    here carries a broadcast hint: Spark broadcasts a side while its size
    allows and shuffles beyond that.
    """
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    if territory:
        people = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
        joined = joined.join(people, orders.o_custkey == people.c_custkey, "left")
    seller = [F.col("c_nationkey").cast("long").alias("salesperson_sk")] if territory else []
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("sales_sk"),
        F.col("l_orderkey").alias("sales_id"),
        F.col("o_custkey").alias("customer_sk"),
        F.col("l_partkey").alias("product_sk"),
        F.col("l_suppkey").alias("store_sk"),
        *seller,
        F.substring("o_orderpriority", 1, 1).cast("long").alias("campaign_sk"),
        F.col("o_orderdate").alias("sales_date"),
        net_amount().alias("total_amount"),
    )


def sales_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``fact_sales`` plus what the delivery and service questions need.

    Freight stands for extended price x tax, rating for quantity; delivery is
    promised 30 days after the order.
    """
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    freight = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("sales_id"),
        F.col("o_custkey").alias("customer_sk"),
        F.col("l_partkey").alias("product_sk"),
        F.col("l_suppkey").alias("store_sk"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"),
        net_amount().alias("total_amount"),
        money(freight).alias("freight"),
        F.col("l_quantity").alias("rating"),
        F.col("o_orderdate").alias("purchase_date"),
        F.col("l_shipdate").alias("delivered_date"),
        F.timestamp_add("DAY", F.lit(30), F.col("o_orderdate")).alias("estimated_date"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    name = F.split("c_name", "#")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_sk"),
        F.col("c_name").alias("customer_id"),
        name[0].alias("first_name"),
        name[1].alias("last_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("c_nationkey").alias("nation_key"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_sk"),
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").cast("string").alias("origin_location"),
    )


def nations(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("nation_key"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "supplier")
        .select(
            F.col("s_suppkey").alias("store_sk"),
            F.col("s_name").alias("store_id"),
            F.col("s_nationkey").alias("nation_key"),
        )
        .join(nations(spark, folder), "nation_key")
        .select("store_sk", "store_id", "state", "region")
    )


def salespersons(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("salesperson_sk"),
        F.col("n_name").alias("salesperson_id"),
    )


def campaigns(spark: SparkSession, folder: str) -> DataFrame:
    """Campaigns are order priorities; each runs while its orders come in."""
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("campaign_id"))
        .agg(F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"))
        .select(
            F.substring("campaign_id", 1, 1).cast("long").alias("campaign_sk"),
            "campaign_id",
            F.date_format("first_day", "yyyyMMdd").cast("long").alias("start_date_sk"),
            F.date_format("last_day", "yyyyMMdd").cast("long").alias("end_date_sk"),
        )
    )


def dates(spark: SparkSession, folder: str) -> DataFrame:
    """A calendar without gaps over the order dates."""
    span = table(spark, folder, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi")
    )
    day = F.col("full_date")
    return span.select(F.explode(F.sequence("lo", "hi")).alias("full_date")).select(
        F.date_format(day, "yyyyMMdd").cast("long").alias("date_sk"),
        "full_date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.weekday(day).alias("weekday"),
    )


def star(spark: SparkSession, folder: str) -> StarSchema:
    return StarSchema(
        fact_sales=fact_sales(spark, folder, territory=True),
        customers=customers(spark, folder),
        products=products(spark, folder),
        stores=stores(spark, folder),
        salespersons=salespersons(spark, folder),
        campaigns=campaigns(spark, folder),
        dates=dates(spark, folder),
    )


def sales_events(spark: SparkSession, folder: str) -> DataFrame:
    """The ``events`` table as sales events."""
    return as_sales_events(table(spark, folder, "events"))


def as_sales_events(events: DataFrame) -> DataFrame:
    """Works on a static or a streaming ``events`` table."""
    return events.select(
        F.col("event_id").cast("string").alias("sales_id"),
        F.col("user_id").alias("customer_sk"),
        F.get_json_object("props", "$.k").try_cast("long").alias("product_sk"),
        F.col("value").alias("total_amount"),
        F.col("ts").alias("sales_date"),
    )
