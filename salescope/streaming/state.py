"""Versioned state of a stream as Parquet folders, compacted as it grows.

A micro-batch writes ``batch-<id>`` in overwrite mode, so a batch that runs again
replaces itself.  Every ``COMPACT_AFTER`` batches, the newest base and the batches
behind it are merged into ``base-<id>``, which covers the batches up to ``id``; only
batches before the running one are merged, so they are committed and will not run
again.  A base counts once Spark has put its ``_SUCCESS`` beside it, which switches
all readers at once.  What a base replaces is deleted when the next one is there, so
a reader that has just listed the folders still finds them.  A reader opens one base
and at most about ``2 * COMPACT_AFTER`` batches, however long the stream has run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.session import remove

COMPACT_AFTER = 16
BATCH = "__batch"

Merge = Callable[[DataFrame], DataFrame]


def folders(spark: SparkSession, folder: str, kind: str) -> list[int]:
    """The numbers of the complete ``<kind>-<number>`` folders, ascending."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(folder)
    store = root.getFileSystem(context._jsc.hadoopConfiguration())
    if not store.exists(root):
        return []
    found = []
    for status in store.listStatus(root):
        name, _, number = status.getPath().getName().partition("-")
        done = context._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name == kind and number.isdigit() and store.exists(done):
            found.append(int(number))
    return sorted(found)


def _numbers(spark: SparkSession, folder: str) -> tuple[list[int], list[int]]:
    return folders(spark, folder, "base"), folders(spark, folder, "batch")


def read_state(spark: SparkSession, folder: str, merge: Merge, before: int | None = None) -> DataFrame | None:
    """The merged state, of the batches below ``before`` if given; None where there is none.

    ``merge`` turns rows of any number of batches, with their ``BATCH`` column,
    into one row per key, and must allow for its own results among them.
    """
    bases, batches = _numbers(spark, folder)
    bases = [n for n in bases if before is None or n < before]
    newest = bases[-1] if bases else -1
    paths = [f"{folder}/base-{newest}"] if bases else []
    paths += [f"{folder}/batch-{n}" for n in batches if n > newest and (before is None or n < before)]
    return merge(spark.read.parquet(*paths)) if paths else None


def write_batch(rows: DataFrame, folder: str, batch_id: int, merge: Merge, compact_after: int = COMPACT_AFTER) -> None:
    """Write what a micro-batch found, and compact what was there before it if it is time."""
    spark = rows.sparkSession
    bases, batches = _numbers(spark, folder)
    newest = bases[-1] if bases else -1
    behind = [n for n in batches if newest < n < batch_id]
    if len(behind) >= compact_after:
        merged = read_state(spark, folder, merge, behind[-1] + 1)
        merged.write.mode("overwrite").parquet(f"{folder}/base-{behind[-1]}")
        for n in bases:
            if n < newest:
                remove(spark, f"{folder}/base-{n}")
        for n in batches:
            if n <= newest:
                remove(spark, f"{folder}/batch-{n}")
    rows.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{folder}/batch-{batch_id}")
