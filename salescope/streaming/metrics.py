"""Running sales metrics over an event stream.

Two forms.  ``running_aggregate`` keeps one aggregate in Spark's state store
and writes the keys that changed.  ``process_events`` keeps no state: each
micro-batch writes its own sums, which add up on reading.  Both write a folder
per ``batch_id`` in overwrite mode, so a batch that runs again after a failure
replaces its own output, and both are compacted (see ``salescope.streaming.state``).
``daily_by_event_time`` follows event time and closes a day when it is over.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.columns import money
from salescope.sources.schema import REQUIRED_EVENT_COLUMNS
from salescope.streaming import state

# ---- fixed values ----
TOP_ENTITIES = 10
REPORT_MONTHS = 12
# ---- end of fixed values ----


def is_valid(required: Sequence[str] = REQUIRED_EVENT_COLUMNS) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])


def split_events(
    events: DataFrame, required: Sequence[str] = REQUIRED_EVENT_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """Valid events, and the dead letters that lack a required value."""
    valid = is_valid(required)
    return events.filter(valid), events.filter(~valid)


def counted_key(column: str, skip_zero_keys: bool) -> Column:
    known = F.col(column).isNotNull()
    return known & (F.col(column) != 0) if skip_zero_keys else known


def _latest(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Per key the values of the last batch that changed it."""

    def merge(versions: DataFrame) -> DataFrame:
        values = [c for c in versions.columns if c not in keys]
        newest = F.max_by(F.struct(*values), state.BATCH).alias("__v")
        return versions.groupBy(*keys).agg(newest).select(*keys, "__v.*")

    return merge


def running_aggregate(
    stream: DataFrame, keys: Sequence[str | Column], sums: Mapping[str, Column], folder: str
) -> DataFrame:
    """Aggregate all that is in the stream now; a later call goes on from there.

    ``folder`` holds the stream's progress and its output.  Returns the current
    value of every key.
    """

    totals = stream.groupBy(*keys).agg(*[c.alias(n) for n, c in sums.items()])
    merge = _latest([c for c in totals.columns if c not in sums])

    def write(batch: DataFrame, batch_id: int) -> None:
        state.write_batch(batch, f"{folder}/values", batch_id, merge)

    run = (
        totals.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return state.read_state(stream.sparkSession, f"{folder}/values", merge).drop(state.BATCH)


def amount() -> Column:
    return F.sum(money("total_amount"))


def stream_totals(events: DataFrame, folder: str) -> DataFrame:
    """``(revenue, transactions)``."""
    sums = {"revenue": amount(), "transactions": F.count(F.lit(1))}
    return _as_double(running_aggregate(events.filter(is_valid()), [], sums, folder))


def stream_products(events: DataFrame, folder: str, skip_zero_keys: bool = False) -> DataFrame:
    counted = events.filter(is_valid() & counted_key("product_sk", skip_zero_keys))
    return running_aggregate(counted, ["product_sk"], {"n": F.count(F.lit(1))}, folder)


def stream_customers(events: DataFrame, folder: str, skip_zero_keys: bool = False) -> DataFrame:
    counted = events.filter(is_valid() & counted_key("customer_sk", skip_zero_keys))
    return _as_double(
        running_aggregate(counted, ["customer_sk"], {"revenue": amount()}, folder)
    )


def day_key() -> Column:
    return F.date_format("sales_date", "yyyy-MM-dd")


def month_key() -> Column:
    return F.date_format("sales_date", "yyyy-MM")


def stream_daily(events: DataFrame, folder: str) -> DataFrame:
    dated = events.filter(is_valid() & F.col("sales_date").isNotNull())
    keys = [day_key().alias("day")]
    return _as_double(running_aggregate(dated, keys, {"revenue": amount()}, folder))


def stream_monthly(events: DataFrame, folder: str) -> DataFrame:
    dated = events.filter(is_valid() & F.col("sales_date").isNotNull())
    keys = [month_key().alias("month")]
    return _as_double(running_aggregate(dated, keys, {"revenue": amount()}, folder))


def _as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", F.col("revenue").cast("double"))


def batch_increments(events: DataFrame, skip_zero_keys: bool = False) -> DataFrame:
    """``(metric, key, amount, n)`` of a set of events, in one pass and one shuffle."""
    valid = is_valid()

    def entry(metric: str, key: Column, when: Column) -> Column:
        row = F.struct(F.lit(metric).alias("metric"), key.cast("string").alias("key"))
        return F.when(when, row)

    dated = valid & F.col("sales_date").isNotNull()
    entries = F.array(
        entry("total", F.lit(""), valid),
        entry("failed", F.lit(""), ~valid),
        entry("product", F.col("product_sk"), valid & counted_key("product_sk", skip_zero_keys)),
        entry("customer", F.col("customer_sk"), valid & counted_key("customer_sk", skip_zero_keys)),
        entry("day", day_key(), dated),
        entry("month", month_key(), dated),
    )
    exploded = events.select(
        money("total_amount").alias("a"), F.explode(F.array_compact(entries)).alias("e")
    )
    return exploded.groupBy("e.metric", "e.key").agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("amount"), F.count(F.lit(1)).alias("n")
    )


def process_events(stream: DataFrame, folder: str, skip_zero_keys: bool = False) -> DataFrame:
    """Fold all events that are in the stream now; returns the sums of all batches so far.

    Dead letters go to ``<folder>/dead``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read twice below
        sums = batch_increments(batch, skip_zero_keys)
        state.write_batch(sums, f"{folder}/increments", batch_id, metric_state)
        _, dead = split_events(batch)
        dead.write.mode("overwrite").json(f"{folder}/dead/batch={batch_id}")
        batch.unpersist()

    run = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return state.read_state(stream.sparkSession, f"{folder}/increments", metric_state).drop(state.BATCH)


def metric_state(increments: DataFrame) -> DataFrame:
    """Increments, or states, of any number of batches added up."""
    kept = [F.max(state.BATCH).alias(state.BATCH)] if state.BATCH in increments.columns else []
    amount = F.sum("amount").cast(increments.schema["amount"].dataType)
    return increments.groupBy("metric", "key").agg(amount.alias("amount"), F.sum("n").alias("n"), *kept)


def daily_by_event_time(stream: DataFrame, folder: str, delay: str = "2 days") -> tuple[DataFrame, DataFrame]:
    """Revenue of the days that are over in event time, and the events that came too late.

    An event is late if it is older than the newest one of the batches before it
    less ``delay``; late events go to the dead letters ``<folder>/late`` and count
    nowhere.  Of events with one ``sales_id`` within the delay, one counts.  A day
    is returned once the watermark has passed its end; its sum changes no more, so
    state is kept for the days within the delay only.

    Returns ``(day, revenue, transactions)`` and the late events.
    """
    spark = stream.sparkSession
    columns = ["sales_id", "sales_date", "total_amount"]
    valid = stream.filter(is_valid() & F.col("sales_date").isNotNull()).select(*columns)
    schema = valid.schema

    def newest(marks: DataFrame) -> DataFrame:
        return marks.agg(F.max("newest").alias("newest"), F.max(state.BATCH).alias(state.BATCH))

    def route(batch: DataFrame, batch_id: int) -> None:
        seen = state.read_state(spark, f"{folder}/marks", newest, batch_id)
        mark = seen.select("newest").first()[0] if seen is not None else None
        late = F.lit(False)
        if mark is not None:
            late = F.col("sales_date") < F.lit(mark) - F.expr(f"interval {delay}")
        batch.persist()  # read three times below
        state.write_batch(batch.agg(F.max("sales_date").alias("newest")), f"{folder}/marks", batch_id, newest)
        batch.filter(late).write.mode("overwrite").parquet(f"{folder}/late/{batch_id:09d}")
        batch.filter(~late).write.mode("overwrite").parquet(f"{folder}/on-time/{batch_id:09d}")
        batch.unpersist()

    def run(frame: DataFrame, name: str, write) -> None:
        writer = frame.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/progress-{name}")
        writer.trigger(availableNow=True).start().awaitTermination()

    run(valid, "route", route)
    # This watermark is never ahead of the one above, so it drops nothing more.
    on_time = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/on-time")
    on_time = on_time.withColumn("at", F.col("sales_date").cast("timestamp")).withWatermark("at", delay)
    once = on_time.dropDuplicatesWithinWatermark(["sales_id"])
    days = once.groupBy(F.window("at", "1 day")).agg(amount().alias("revenue"), F.count(F.lit(1)).alias("transactions"))
    days = days.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "revenue", "transactions")

    def closed(batch: DataFrame, batch_id: int) -> None:
        state.write_batch(batch, f"{folder}/days", batch_id, lambda df: df)

    run(days, "days", closed)
    found = state.read_state(spark, f"{folder}/days", lambda df: df).drop(state.BATCH)
    late = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/late")
    return _as_double(found), late


def _top(sums: DataFrame, metric: str, value: str) -> DataFrame:
    found = sums.filter(F.col("metric") == metric)
    ordered = found.orderBy(F.desc(value), F.col("key").cast("long")).limit(TOP_ENTITIES)
    return ordered.select(
        F.lit(f"top_{metric}s").alias("section"), "key", F.col(value).cast("double").alias("value")
    )


def _section(sums: DataFrame, metric: str, name: str, value: str = "amount") -> DataFrame:
    return sums.filter(F.col("metric") == metric).select(
        F.lit(name).alias("section"), "key", F.col(value).cast("double").alias("value")
    )


def event_summary(sums: DataFrame) -> DataFrame:
    """``(section, key, value)``: totals, the top ten, daily and monthly revenue."""
    total = _section(sums, "total", "total_revenue").withColumn("value", F.round("value", 2))
    return reduce(
        DataFrame.unionByName,
        [
            total,
            _section(sums, "total", "transactions", "n"),
            _top(sums, "product", "n"),
            _top(sums, "customer", "amount"),
            _section(sums, "day", "daily_sales"),
            _section(sums, "month", "monthly_sales"),
        ],
    )


def event_report(summary: DataFrame) -> DataFrame:
    """The printable part of a summary: the first twelve months, and the days as a range."""
    months = summary.filter("section = 'monthly_sales'")
    days = summary.filter("section = 'daily_sales'")
    return reduce(
        DataFrame.unionByName,
        [
            summary.filter(~F.col("section").isin("monthly_sales", "daily_sales")),
            months.orderBy("key").limit(REPORT_MONTHS),
            months.agg(F.count("key").cast("double").alias("value")).select(
                F.lit("months_tracked").alias("section"), F.lit("").alias("key"), "value"
            ),
            days.agg(
                F.concat_ws(" to ", F.min("key"), F.max("key")).alias("key"),
                F.count("key").cast("double").alias("value"),
            ).select(F.lit("days_tracked").alias("section"), "key", "value"),
        ],
    )
