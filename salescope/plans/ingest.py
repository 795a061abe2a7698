"""Sales that arrive load by load: equal rows once, features kept up to date.

The store has the fact as one folder per load, partitioned by bucket: the month of
the sale and a part of the row's hash.  Equal rows share a bucket, so a load is
compared with the buckets that it touches and with nothing else, and only its new
rows are written.  One exchange, by bucket, does for the comparison and the write.
Loading a load again replaces it.

Beside the fact are sums that add up: per customer, product, store and campaign that
met, and per day.  A load adds those of its new rows, which are merged like a
stream's state.  The feature tables are read off the sums; the fact is not scanned
for them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.operators.aggregates import with_distinct_counts
from salescope.operators.cleaning import clean_columns
from salescope.operators.metrics import lookup_join
from salescope.plans import features
from salescope.session import durable
from salescope.streaming import state

PARTS = 4  # of a month
KEYS = ("customer_sk", "product_sk", "store_sk", "campaign_sk")
MET, DAY = "met", "day"


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row that see its nulls."""
    marked = [*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]
    return [F.xxhash64(*marked).alias("__a"), F.xxhash64(F.lit("second"), *marked).alias("__b")]


def bucket_of(columns: Sequence[str], parts: int = PARTS) -> Column:
    month = F.coalesce(F.date_format("sales_date", "yyyy-MM"), F.lit("none"))
    part = F.pmod(row_digest(columns)[0], F.lit(parts))
    return F.concat_ws("-", month, part.cast("string"))


def sums_of(sales: DataFrame) -> DataFrame:
    """``(kind, *KEYS, day, orders, n, counted, amount, first, last)`` in one pass and one shuffle."""
    none = [F.lit(None).cast("long").alias(c) for c in KEYS]
    day = F.to_date("sales_date")
    entries = [
        F.struct(F.lit(MET).alias("kind"), *[F.col(c).cast("long").alias(c) for c in KEYS], F.lit(None).cast("date").alias("day")),
        F.struct(F.lit(DAY).alias("kind"), *none, day.alias("day")),
    ]
    rows = sales.select(F.explode(F.array(*entries)).alias("e"), "sales_id", "total_amount", "sales_date")
    return rows.groupBy("e.kind", *[f"e.{c}" for c in KEYS], "e.day").agg(
        F.count("sales_id").alias("orders"),
        F.count(F.lit(1)).alias("n"),
        F.count("total_amount").alias("counted"),
        F.sum("total_amount").alias("amount"),
        F.min("sales_date").alias("first"),
        F.max("sales_date").alias("last"),
    )


def added_up(sums: DataFrame) -> DataFrame:
    kept = [F.max(state.BATCH).alias(state.BATCH)] if state.BATCH in sums.columns else []
    amount = F.sum("amount").cast(sums.schema["amount"].dataType).alias("amount")
    counts = [F.sum(c).alias(c) for c in ("orders", "n", "counted")]
    dates = [F.min("first").alias("first"), F.max("last").alias("last")]
    return sums.groupBy("kind", *KEYS, "day").agg(*counts, amount, *dates, *kept)


def apart(sums: DataFrame) -> DataFrame:
    return sums


class SalesStore:
    """The store below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def loads(self) -> list[int]:
        return state.folders(self.spark, f"{self.folder}/rows", "load")

    def rows(self, loads: Sequence[int]) -> DataFrame | None:
        if not loads:
            return None
        # A load without new rows has no files to tell the columns by.
        schema = self.spark.read.parquet(f"{self.folder}/columns").schema
        parts = [self.spark.read.schema(schema).parquet(f"{self.folder}/rows/load-{n}") for n in loads]
        return reduce(lambda a, b: a.unionByName(b), parts)

    def fact(self) -> DataFrame:
        """All sales, equal rows once."""
        return self.rows(self.loads()).drop("bucket")

    def ingest(self, incoming: DataFrame, load: int) -> DataFrame:
        """Add the new rows of load number ``load``; loads come in ascending order.

        Returns the rows that were new.
        """
        rows = clean_columns(incoming)
        columns = rows.columns
        rows = durable(rows.withColumn("bucket", bucket_of(columns)))
        digest = row_digest(columns)
        known = self.rows([n for n in self.loads() if n < load])
        keyed = rows.withColumn("__old", F.lit(None).cast(T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b")])))
        if known is not None:
            # Bounded by the months and their parts.
            touched = [r[0] for r in rows.select("bucket").distinct().collect()]
            old = known.filter(F.col("bucket").isin(touched))
            old = old.select("bucket", F.struct(digest[0].alias("a"), digest[1].alias("b")).alias("__old"))
            keyed = keyed.unionByName(old, allowMissingColumns=True)
        # Equal rows share a bucket, so they meet where the bucket is written.
        hashes = [F.coalesce(F.col(f"__old.{n}"), h).alias(f"__{n}") for n, h in zip("ab", digest)]
        dealt = keyed.repartition("bucket").select("*", *hashes)
        equal = Window.partitionBy("bucket", "__a", "__b").orderBy(F.col("__old").isNull())
        first = dealt.withColumn("__row", F.row_number().over(equal)).filter("__row = 1 AND __old IS NULL")
        new = first.select(*columns, "bucket")
        if not self.loads():
            new.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/columns")
        packed = new.write.mode("overwrite").option("compression", "zstd")
        packed.partitionBy("bucket").parquet(f"{self.folder}/rows/load-{load}")
        written = self.rows([load]).drop("bucket")
        state.write_batch(sums_of(written), f"{self.folder}/sums", load, added_up)
        return written

    def sums(self, kind: str, merge=added_up) -> DataFrame:
        """The sums of a kind; a ``merge`` that leaves the batches apart does for what adds up itself."""
        found = state.read_state(self.spark, f"{self.folder}/sums", lambda df: merge(df.filter(F.col("kind") == kind)))
        return found.drop(state.BATCH, "kind")

    def customer_features(self, customers: DataFrame) -> DataFrame:
        counted = {"products_purchased": "product_sk", "stores_used": "store_sk", "campaigns_used": "campaign_sk"}
        amount = F.sum("amount").cast("double")
        figures = [
            F.sum("orders").alias("total_orders"),
            F.coalesce(amount, F.lit(0.0)).alias("total_spent"),
            F.try_divide(amount, F.sum("counted")).alias("average_order_value"),
            F.min("first").alias("first_purchase_date"),
            F.max("last").alias("last_purchase_date"),
        ]
        per_customer = with_distinct_counts(self.sums(MET, apart), ["customer_sk"], counted, figures)
        return features.finished_customers(per_customer, customers)

    def product_features(self, products: DataFrame) -> DataFrame:
        counted = {"customers_purchased": "customer_sk", "stores_sold_in": "store_sk"}
        amount = F.sum("amount").cast("double")
        figures = [
            F.sum("n").alias("total_units_sold"),
            F.coalesce(amount, F.lit(0.0)).alias("total_revenue"),
            F.try_divide(amount, F.sum("counted")).alias("average_sales_value"),
        ]
        sold = self.sums(MET, apart).filter("product_sk IS NOT NULL")
        per_product = with_distinct_counts(sold, ["product_sk"], counted, figures)
        return lookup_join(per_product, products, "product_sk", "product_sk", ["category", "brand"])

    def daily_features(self) -> DataFrame:
        days = self.sums(DAY).filter("day IS NOT NULL").select(
            F.col("day").alias("date"),
            F.coalesce("amount", F.lit(0)).alias("__exact"),
            F.col("orders").alias("transaction_count"),
        )
        return features.finished_days(days)

    def interactions(self) -> DataFrame:
        met = self.sums(MET, apart).filter("customer_sk IS NOT NULL AND product_sk IS NOT NULL")
        amount = F.sum("amount").cast("double")
        return met.groupBy("customer_sk", "product_sk").agg(
            F.sum("orders").alias("purchase_count"),
            F.coalesce(amount, F.lit(0.0)).alias("total_spent"),
            F.try_divide(amount, F.sum("counted")).alias("average_spend"),
        )
