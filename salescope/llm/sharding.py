"""Sharding: a uniform shuffle of the rows into shards of exact sizes.

Of all ways to put the rows into ``shards`` shards whose counts differ by at most
one, each is equally likely, and so is each order within a shard.

Communication matrix: how many rows each input partition sends to each shard.  For
a uniform shuffle its law is hypergeometric.  It is drawn without touching the
rows again: every row's number draws a shard freely; of the shards drawn too often
a uniform choice of the surplus draws is taken back, and these, in random order,
fill the shards drawn too seldom.  No step tells draws apart by anything but
chance, so all assignments with the exact sizes stay equally likely, which is
what makes the counts hypergeometric.  The surplus is of the order of the square
root of the number of rows.

Local permutation: every partition puts its rows in random order, and the matrix
says where to cut that order into pieces for the shards.  Exchange: rows are
range-partitioned by shard and a second random key.  Second permutation: the rank
by that key is the slot.  A shard spreads over as many partitions as Spark makes,
so its size is no task's limit.

Random numbers are hashes of ``seed`` and the row's number, so a repeated task
repeats itself, and the same files in the same splits give the same shards.

Defined results: shard ``s`` has one row more than others if ``s`` is below the
remainder; with fewer rows than shards the last ones are empty; repeated rows are
rows of their own; nulls don't matter; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import stored
from salescope.operators.ordered import ordered_scan
from salescope.session import durable

SHARDS = 16
SEED = 42
PART_BITS = 33  # of the place within its partition in a row's number
RETRIES = 8


def chance(seed: int, step: str, *values: Column | str) -> Column:
    """64 random bits per value and step."""
    return F.xxhash64(F.lit(seed).cast("long"), F.lit(step), *values)


def drawn(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(part, shard, n)``: free draws of the rows ``(part, uid)``, every pair of both listed."""
    draw = F.pmod(chance(seed, "draw", "uid"), F.lit(shards)).cast("int")
    counts = rows.groupBy("part", draw.alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    every = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    return every.join(counts, ["part", "shard"], "left").select("part", "shard", F.coalesce("n", F.lit(0)).alias("n"))


def _balance(counts: DataFrame, shards: int) -> DataFrame:
    """``(shard, total, surplus, fill_from, fill_upto)``, one row per shard."""
    sums = counts.groupBy("shard").agg(F.sum("n").alias("total"))
    whole = Window.partitionBy(F.lit(0))  # one row per shard
    rows = F.sum("total").over(whole)
    want = F.floor(rows / shards) + (F.col("shard") < rows % shards).cast("long")
    sums = sums.withColumn("surplus", F.col("total") - want)
    lack = F.greatest(-F.col("surplus"), F.lit(0))
    upto = F.sum(lack).over(whole.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    return sums.select(
        "shard",
        "total",
        F.greatest("surplus", F.lit(0)).alias("surplus"),
        (upto - lack).alias("fill_from"),
        upto.alias("fill_upto"),
    )


def _taken_back(balance: DataFrame, seed: int) -> DataFrame:
    """``(shard, at)``: per shard as many different draws as it has too many, each choice equally likely.

    These are the first ``surplus`` different numbers of a random sequence; it is
    lengthened until it holds as many.
    """
    over = balance.filter("surplus > 0")
    for attempt in range(RETRIES):
        length = (F.col("surplus") * 4 + 64) * (1 << attempt)
        tries = over.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), length)))
        bits = F.shiftrightunsigned(chance(seed, "back", "shard", "i"), 1)
        found = tries.groupBy("shard", "surplus", (bits % F.col("total")).alias("at")).agg(F.min("i").alias("i"))
        rank = F.row_number().over(Window.partitionBy("shard").orderBy("i"))
        found = durable(found.withColumn("rank", rank).filter("rank <= surplus").select("shard", "surplus", "at"))
        short = over.join(found.groupBy("shard").agg(F.count(F.lit(1)).alias("n")), "shard", "left")
        if short.filter("n IS NULL OR n < surplus").isEmpty():
            return found.select("shard", "at")
    raise RuntimeError("the random sequence is too short")


def communication_matrix(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``(part, cuts)`` of the rows ``(part, uid)``: where a partition's order is cut.

    ``cuts`` has the number of rows sent to shard 0, to shards 0 and 1, and so on;
    the last entry is the partition's number of rows.
    """
    counts = durable(drawn(rows, shards, seed))
    balance = durable(_balance(counts, shards))
    back = _taken_back(balance, seed)
    # Draw number `at` of a shard belongs to the partition whose stretch holds it.
    by_part = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    starts = counts.withColumn("at", F.sum("n").over(by_part) - F.col("n")).filter("n > 0")
    marks = starts.select("shard", "at", F.col("part").alias("owner"), F.lit(0).alias("drawn")).union(
        back.select("shard", "at", F.lit(None).cast("int").alias("owner"), F.lit(1).alias("drawn"))
    )
    upto = Window.partitionBy("shard").orderBy("at", "drawn").rowsBetween(Window.unboundedPreceding, 0)
    owned = marks.withColumn("part", F.last("owner", ignorenulls=True).over(upto)).filter("drawn = 1")
    owned = durable(owned.select("part", "shard", "at"))
    # In random order they fill the other shards.
    mixed = ordered_scan(owned, [chance(seed, "fill", "shard", "at"), F.col("shard"), F.col("at")], row_number="rank")
    gaps = balance.filter("fill_from < fill_upto").select(F.col("shard").alias("to"), "fill_from", "fill_upto")
    # One row per shard.
    into = (F.col("fill_from") < F.col("rank")) & (F.col("rank") <= F.col("fill_upto"))
    filled = mixed.join(F.broadcast(gaps), into)
    changes = owned.select("part", "shard", F.lit(-1).alias("n")).union(filled.select("part", "to", F.lit(1)))
    exact = counts.union(changes).groupBy("part", "shard").agg(F.sum("n").alias("n"))
    lists = exact.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("sent"))
    sums = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda k: F.aggregate(F.slice("sent", 1, k), F.lit(0).cast("long"), lambda total, one: total + one["n"]),
    )
    return lists.select("part", sums.alias("cuts"))


def shard(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """All ``rows`` with ``shard`` and ``slot``, the place within the shard from 0.

    Columns of these names are replaced.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    base = rows.select(F.struct(*[rows[c] for c in names]).alias("row"))
    # The rows stay in the partitions they were read in; their numbers say which.
    base = durable(base.withColumn("uid", F.monotonically_increasing_id()))
    numbered = base.select(F.shiftright("uid", PART_BITS).cast("int").alias("part"), "uid")
    cuts = stored(communication_matrix(numbered, shards, seed), "matrix")

    local = base.sortWithinPartitions(chance(seed, "local", "uid"), F.col("uid"))
    place = F.monotonically_increasing_id().bitwiseAND((1 << PART_BITS) - 1)
    local = local.select("row", "uid", F.shiftright("uid", PART_BITS).cast("int").alias("part"), place.alias("place"))
    sent = local.join(cuts, "part")
    to = F.size(F.filter("cuts", lambda cut: cut <= F.col("place")))
    dealt = sent.select("row", "uid", to.alias("shard"))
    mixed = ordered_scan(dealt, [chance(seed, "shard", "uid"), F.col("uid")], by=["shard"], row_number="slot")
    return mixed.select("row.*", "shard", (F.col("slot") - 1).alias("slot"))


def write(rows: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write the shards as folders ``shard=0``, ``shard=1``, ... of Parquet files in the order of the slots."""
    shard(rows, shards, seed).write.partitionBy("shard").parquet(path)
