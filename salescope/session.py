"""Session construction and durable materialisation."""

from __future__ import annotations

import atexit
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A sales fact is often joined and then aggregated on the joined key; let
    # AQE split a hot partition even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A checkpoint goes when nothing refers to it any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app: str = "salescope", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and stream state, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without one gets a temporary folder; elsewhere that would lose data with
    the machine, so it is an error.
    """
    context = spark.sparkContext
    known = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if known is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        known = tempfile.mkdtemp(prefix="salescope-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(known)
    return known


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back from there.

    The partitions of the result are fixed, so they survive lost executors and
    are the same for every consumer.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(spark: SparkSession, name: str) -> str:
    """A new folder for one run in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in a folder of this run, for several readers that each need some of its columns."""
    path = fresh(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; after the end of the session there is nothing to delete with."""
    context = spark.sparkContext
    if context._jsc is None:
        return
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
