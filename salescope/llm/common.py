"""Parts that several operators share: stored tables, row keys, components."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.session import durable, fresh

# The functions below travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- fixed values ----
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
# ---- end of fixed values ----

BUCKETS = 1 << 20
MAX_ROUNDS = 60  # of the component search; a round at least halves every chain


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Spark then knows its true size, so a join broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold`` and sorts or splits it above.
    """
    spark = df.sparkSession
    path = fresh(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def row_key(*columns: Column) -> Column:
    """A text that tells rows with different columns apart (two 64-bit hashes)."""
    marked = with_nulls(*columns)
    return F.concat_ws("-", F.hex(F.xxhash64(*marked)), F.hex(F.xxhash64(F.lit("second"), *marked)))


def with_nulls(*columns: Column) -> list[Column]:
    """The columns and whether each is null, since a hash passes over nulls."""
    return [*columns, *[c.isNull() for c in columns]]


def parted(rows: DataFrame, keys: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have one of ``keys``, and those that surely have none.

    Only the first part needs a join, so wide rows without a partner are not
    shuffled.  What is broadcast are the numbers of the buckets that the keys
    fall in, ``BUCKETS`` at most; with very many keys all rows are in the first part.
    """
    bucket = F.pmod(F.xxhash64(*columns), F.lit(BUCKETS))
    used = F.broadcast(stored(keys.select(bucket.alias("__bucket")).distinct(), "buckets"))
    tagged = rows.withColumn("__bucket", bucket)
    some = tagged.join(used, "__bucket", "left_semi").drop("__bucket")
    return some, tagged.join(used, "__bucket", "left_anti").drop("__bucket")


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of the undirected ``edges(a, b)`` over long ids.

    ``component`` is the smallest node reachable.  Alternating large and small
    stars: every round links each node to the smallest one it sees, so a chain
    shrinks by half or more.  Minima are aggregated before the shuffle, and a
    node with very many edges is a skewed join that Spark can split: the minima
    are keyed by the negated node, which keeps their exchange next to the join.
    """
    now = durable(_directed(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    seen = None
    for _ in range(MAX_ROUNDS):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _linked(both, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = large.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = durable(_directed(large))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _linked(large, lowest).filter("v <> m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = durable(_directed(small.union(lowest.select("u", F.col("m").alias("v")))))
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _directed(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with the larger node first, without loops."""
    return (
        pairs.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _linked(pairs: DataFrame, minima: DataFrame) -> DataFrame:
    keyed = minima.select(F.negative("u").alias("k"), "m")
    return pairs.withColumn("k", F.negative("u")).join(keyed, "k").select("u", "v", "m")


def forest(links: np.ndarray) -> Sequence[int]:
    """For every row of a symmetric boolean matrix, the smallest row reachable."""
    label = np.arange(len(links))
    if not len(links):
        return label
    while True:
        near = np.where(links, label[None, :], len(links)).min(axis=1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new
