"""No caps, no size switches, and bad data that neither stops a run nor vanishes."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.operators import distribution, ordered, validation
from salescope.plans import preprocess
from salescope.session import durable, fresh, remove
from salescope.sources import adapter, tables
from salescope.streaming import transport


def test_indicators_have_no_limit(spark):
    df = spark.range(1500).select(F.format_string("c%04d", "id").alias("c"), F.lit(1.0).alias("x"))
    out = preprocess.prepare(df, categories=["c"], numbers=["x"])
    assert len(out.columns) == 1501
    codes = preprocess.prepare(df, codes=["c"])
    assert codes.agg(F.count_distinct("c")).first()[0] == 1500


def test_sparse_indicators_equal_wide_ones(spark):
    rows = [(n, f"c{n * 7 % 50:02d}" if n % 9 else None, n % 4 if n % 5 else None) for n in range(300)]
    df = spark.createDataFrame(rows, "id long, c string, d int").repartition(4)
    out, dictionary = preprocess.sparse_indicators(df, ["c", "d"])
    names = [(r.position, r.column_name, r.value) for r in dictionary.orderBy("position").collect()]
    values = [("c", v) for v in sorted({r[1] for r in rows} - {None})] + [("d", str(v)) for v in range(4)]
    assert names == [(k, *v) for k, v in enumerate(values)]
    for r in out.collect():
        own = [(c, str(v)) for c, v in zip(("c", "d"), rows[r.id][1:]) if v is not None]
        assert [values[k] for k in r.indicators] == own
    assert out.columns == ["id", "indicators"]
    many = spark.range(60_000).select(F.format_string("c%06d", F.col("id") % 20_000).alias("c"))
    out, dictionary = preprocess.sparse_indicators(many, ["c"])
    assert dictionary.count() == 20_000
    assert out.agg(F.sum(F.col("indicators")[0])).first()[0] == 3 * sum(range(20_000))
    none, dictionary = preprocess.sparse_indicators(df.limit(0), ["c", "d"])
    assert none.count() == dictionary.count() == 0


def test_matrix_keeps_labels_nobody_listed(frame):
    df = frame("r string, c string, v double", ("a", "x", 1.0), ("a", "NEW", 3.0), ("a", "x", 2.0), ("b", "NEW", None))
    got = {(r.r, r.c): r["mean"] for r in distribution.mean_matrix(df, "r", "c", "v").collect()}
    assert got == {("a", "x"): 1.5, ("a", "NEW"): 3.0, ("b", "NEW"): None}
    wide = {r.r: r.asDict() for r in distribution.pivot_mean(df, "r", "c", "v").collect()}
    assert wide["a"] == {"r": "a", "x": 1.5, "NEW": 3.0}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 37, 500, 4_001, 100_000])
def test_quantiles_are_exact_for_any_number_of_rows(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.lognormal(size=n), 3 if n % 2 else 9)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    points = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.99, "f": 1.0}
    got = ordered.exact_quantiles(df, ["v"], points).first()
    for name, q in points.items():
        assert got[f"v_{name}"] == pytest.approx(np.quantile(values, q), abs=1e-12)


def test_rank_reads_its_input_once(frame):
    df = frame("k string, v double", ("a", 5.0), ("b", None), ("c", 9.0), ("d", 5.0), ("e", None))
    calls = df.sparkSession.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(v):
        calls.add(1)
        return v

    out = distribution.ranked(df.withColumn("v", counted("v")), "v", "k")
    assert {r.k: r["rank"] for r in out.collect()} == {"c": 1, "a": 2, "d": 2, "b": None, "e": None}
    # Once for the bounds of the range partitions and once for the rows.
    assert calls.value <= 2 * 5


def test_foreign_keys_of_another_type_are_missing(frame):
    child = frame("k string", "1", "n/a", "7", None)
    parent = frame("p long", 1, 2)
    read = F.col("k").try_cast("bigint").cast("string")
    key = F.coalesce(read, F.concat(F.lit("not read: "), F.col("k")))
    got = validation.missing_keys(child, {"k": (key, parent, F.col("p").try_cast("bigint"))}).first()
    assert got.missing == 3


def test_events_with_a_product_that_is_no_number(frame):
    rows = frame(
        "event_id long, user_id long, props string, value double, ts timestamp",
        (1, 2, '{"k": 3}', 1.0, None),
        (2, 2, '{"k": "abc"}', 1.0, None),
        (3, 2, "no json", 1.0, None),
    )
    got = {r.sales_id: r.product_sk for r in adapter.as_sales_events(rows).collect()}
    assert got == {"1": 3, "2": None, "3": None}


def test_every_message_is_a_row_or_a_dead_letter(spark, frame):
    good = transport._as_messages(transport.row_events(frame("a long, b string", (1, "x"), (2, None)), "t"))
    bad = frame(
        "value string",
        "",
        "{broken",
        "[1]",
        '{"event_type": "other", "table": "t", "payload": "{}"}',
        '{"event_type": "row_loaded", "table": "u", "payload": "{}"}',
        '{"event_type": "row_loaded", "table": "t", "payload": "{\\"a\\": \\"x\\"}"}',
        '{"event_type": "row_loaded", "table": "t", "payload": "nothing"}',
        '{"event_type": "row_loaded", "table": "t"}',
    )
    envelopes = transport.decode(good.union(bad))
    schema = frame("a long, b string", (1, "x")).schema
    rows = transport.rows_of(envelopes, "t", schema)
    dead = transport.dead_letters(envelopes, {"t": schema})
    assert sorted(r.a for r in rows.collect()) == [1, 2]
    assert dead.count() == 8
    assert {r.reason for r in dead.collect()} == {"not an envelope", "other event", "other table", "payload does not read"}


def test_event_bank_keeps_all_columns(spark, frame):
    df = frame("sales_id string, extra long, total_amount double", ("a", 7, 1.5))
    folder = fresh(spark, "bank")
    transport.write_event_bank(df, folder)
    assert transport.read_event_bank(spark, folder, df.schema).first() == df.first()


def test_a_folder_of_parts_is_one_table(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(4).write.parquet(str(tmp_path / "deeper dir" / "events.parquet"))
    spark.range(2).toPandas().to_parquet(tmp_path / "region.parquet")
    found = tables.scan_tables(spark, str(tmp_path), "parquet")
    assert {n: df.count() for n, df in found.items()} == {"orders": 10, "events": 4, "region": 2}


def test_fresh_folders_can_be_removed(spark):
    folder = fresh(spark, "x")
    spark.range(1).write.parquet(folder)
    path = folder.removeprefix("file:")
    assert os.path.isdir(path)
    remove(spark, folder)
    assert not os.path.exists(path)
    assert durable(spark.range(3)).count() == 3
    assert spark.conf.get("spark.cleaner.referenceTracking.cleanCheckpoints") == "true"


def test_close_sums_are_no_ties(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES ('a', 9007199254740993.0001BD), ('b', 9007199254740993.0002BD), ('c', 1BD) AS t(g, v)"
    )
    got = {r.g: r["rank"] for r in distribution.top_n(rows, "g", "v", 2).collect()}
    assert got == {"b": 1, "a": 2}
