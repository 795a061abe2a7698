"""Which source rows a learning sample used."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.session import durable
from salescope.sources.schema import FOREIGN_KEYS, PRIMARY_KEYS, StarSchema

LEARNING_SAMPLE_SIZE = 5000


def earliest_sales(sales: DataFrame, n: int = LEARNING_SAMPLE_SIZE) -> DataFrame:
    """The ``n`` earliest sales: a top-k, no full sort."""
    return sales.orderBy("sales_date", "sales_sk").limit(n)


def learning_sales(
    sales: DataFrame, n: int = LEARNING_SAMPLE_SIZE, sample: DataFrame | None = None
) -> DataFrame:
    """Flag the ``n`` earliest sales as ``used``.

    Every row is compared with the last one of the sample, so there is no join.
    """
    position = F.struct("sales_date", "sales_sk")
    if sample is None:
        sample = earliest_sales(sales.select("sales_date", "sales_sk"), n)
    last = sample.agg(F.max(position)).scalar()
    return sales.withColumn("used", F.coalesce(position <= last, F.lit(False)))


def row_usage(
    star: StarSchema, n: int | None = LEARNING_SAMPLE_SIZE, sample: DataFrame | None = None
) -> DataFrame:
    """``(table_name, pk_column, pk, used)`` for the fact and its dimensions.

    The sample is the ``n`` earliest sales, written out once for the fact and
    every dimension, or the given one, which must be such a sample.  Without a
    size all sales count as used.
    """
    links = FOREIGN_KEYS["fact_sales"]
    needed = sorted({"sales_sk", "sales_date", *links})
    narrow = star.fact_sales.select("sales_sk", "sales_date")
    if n is None:
        sample = star.fact_sales.select(*needed)
        flagged = narrow.withColumn("used", F.lit(True))
    else:
        if sample is None:
            sample = durable(earliest_sales(star.fact_sales.select(*needed), n))
        flagged = learning_sales(narrow, n, sample)
    tables = star.tables()
    parts = [_usage("fact_sales", PRIMARY_KEYS["fact_sales"][0], flagged, F.col("used"))]
    for column, (table, key) in links.items():
        child = F.to_date(column) if table == "dates" else F.col(column)
        parent = F.to_date(key) if table == "dates" else F.col(key)
        seen = sample.select(child.alias(key)).filter(F.col(key).isNotNull()).distinct()
        unseen = tables[table].select(parent.alias(key)).join(seen, key, "left_anti")
        parts += [
            _usage(table, key, seen, F.lit(True)),
            _usage(table, key, unseen, F.lit(False)),
        ]
    return reduce(DataFrame.unionByName, parts)


def _usage(table, key, rows, used):
    return rows.select(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("pk_column"),
        F.col(key).cast("string").alias("pk"),
        used.alias("used"),
    )


def row_usage_summary(usage: DataFrame) -> DataFrame:
    return usage.groupBy("table_name", "pk_column").agg(
        F.count_if("used").alias("used_count"), F.count_if(~F.col("used")).alias("unused_count")
    )


def write_row_usage(usage: DataFrame, folder: str) -> None:
    """One CSV folder per table, and the counts as JSON."""
    usage.write.mode("overwrite").partitionBy("table_name").option("header", "true").csv(
        f"{folder}/rows"
    )
    row_usage_summary(usage).write.mode("overwrite").json(f"{folder}/summary")
