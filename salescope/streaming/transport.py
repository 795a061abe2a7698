"""Writing and reading events: JSON batches, and envelopes over files or Kafka."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.sources.schema import ENVELOPE_SCHEMA, EVENT_SCHEMA

# ---- fixed values ----
BATCH_SIZE = 5000
ROW_LOADED = "row_loaded"
# ---- end of fixed values ----
FILE_EVENTS = 1_000_000  # some 30 MB of compressed envelopes
# Spark's own JSON form would cut times to milliseconds.
ISO_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_event_bank(
    events: DataFrame, folder: str, batch_size: int = BATCH_SIZE, compression: str = "none"
) -> None:
    """JSON files of at most ``batch_size`` events each, all columns, dates in ISO form."""
    writer = events.write.mode("overwrite").option("maxRecordsPerFile", batch_size)
    writer.options(**ISO_TIMES, compression=compression).json(folder)


def read_event_bank(
    spark: SparkSession, folder: str, schema: T.StructType = EVENT_SCHEMA
) -> DataFrame:
    """The events with the columns of ``schema``; others in the files are left."""
    return spark.read.schema(schema).options(**ISO_TIMES).json(folder)


def stream_event_bank(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )


def row_events(df: DataFrame, table_name: str) -> DataFrame:
    """Every row as ``(event_type, table, payload)`` with the row as JSON."""
    return df.select(
        F.lit(ROW_LOADED).alias("event_type"),
        F.lit(table_name).alias("table"),
        F.to_json(F.struct(*df.columns), ISO_TIMES).alias("payload"),
    )


def _as_messages(envelopes: DataFrame) -> DataFrame:
    return envelopes.select(F.to_json(F.struct("event_type", "table", "payload")).alias("value"))


def send_to_files(envelopes: DataFrame, folder: str, compression: str = "none") -> None:
    """Append the envelopes as JSON lines; the stand-in for a topic.

    A compressed file is read by one task, so it has at most ``FILE_EVENTS`` of them.
    """
    writer = _as_messages(envelopes).write.mode("append").option("compression", compression)
    if compression != "none":
        writer = writer.option("maxRecordsPerFile", FILE_EVENTS)
    writer.text(folder)


def send_to_kafka(envelopes: DataFrame, servers: str, topic: str) -> None:
    """Publish the envelopes; needs Spark's Kafka connector on the class path."""
    (
        _as_messages(envelopes)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def stream_from_files(spark: SparkSession, folder: str) -> DataFrame:
    return decode(spark.readStream.text(folder))


def stream_from_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The topic from its first message on."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return decode(messages.select(F.col("value").cast("string").alias("value")))


def decode(messages: DataFrame) -> DataFrame:
    """``(event_type, table, payload, raw)``; what is no envelope keeps only ``raw``, its text."""
    return messages.select(
        F.from_json("value", ENVELOPE_SCHEMA).alias("e"), F.col("value").alias("raw")
    ).select("e.*", "raw")


def dead_letters(envelopes: DataFrame, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """``(raw, reason)`` of the messages that no table of ``schemas`` gets a row from.

    With ``rows_of`` for every table, each message is counted once.
    """
    known = F.coalesce(F.col("event_type") == ROW_LOADED, F.lit(False))
    row = F.lit(False)
    for table, schema in schemas.items():
        row = row | ((F.col("table") == table) & _readable(schema))
    reason = (
        F.when(F.col("event_type").isNull() | F.col("table").isNull(), "not an envelope")
        .when(~known, "other event")
        .when(~F.coalesce(F.col("table").isin(*schemas), F.lit(False)), "other table")
        .when(~F.coalesce(row, F.lit(False)), "payload does not read")
    )
    return envelopes.select("raw", reason.alias("reason")).filter(F.col("reason").isNotNull())


def _readable(schema: T.StructType) -> Column:
    """Whether the payload is an object whose fields all read as ``schema`` has them."""
    corrupt = "__corrupt"
    marked = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    row = F.from_json("payload", marked, {"columnNameOfCorruptRecord": corrupt, **ISO_TIMES})
    return F.col("payload").isNotNull() & row.isNotNull() & row[corrupt].isNull()


def rows_of(envelopes: DataFrame, table_name: str, schema: T.StructType) -> DataFrame:
    """The rows of one table out of a mixed stream of envelopes; see ``dead_letters`` for the rest."""
    mine = envelopes.filter(
        (F.col("event_type") == ROW_LOADED) & (F.col("table") == table_name) & _readable(schema)
    )
    return mine.select(F.from_json("payload", schema, ISO_TIMES).alias("row")).select("row.*")
