"""Files in and out, event banks, row events and streams."""

import datetime as dt
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salescope import catalog
from salescope.catalog import events as catalog_events
from salescope.sources import adapter, tables
from salescope.streaming import metrics, state, transport

EVENTS = "sales_id string, customer_sk long, product_sk long, total_amount double, sales_date timestamp_ntz"


def test_scan_csv_tree(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "dim_stores.csv").write_text("store_sk,store_id\n1,a b\n")
    (tmp_path / "deep" / "dim_fact_sales_denormalized.csv").write_text("sales_sk,total_amount\n1,NaN\n2,2.5\n")
    found = tables.scan_tables(spark, str(tmp_path))
    assert set(found) == {"dim_stores", "fact_sales_denormalized"}
    assert [r.total_amount for r in found["fact_sales_denormalized"].orderBy("sales_sk").collect()] == [None, 2.5]
    given = tables.scan_tables(spark, str(tmp_path), schemas={"dim_stores": _schema("store_sk string, store_id string")})
    assert given["dim_stores"].dtypes[0] == ("store_sk", "string")


def _schema(text):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(text)


def test_bad_table_does_not_stop_the_load(spark, frame, tmp_path):
    def broken():
        raise OSError("unreadable")

    readers = {"My Table-1": lambda: frame("a long", 1, 2), "bad": broken, "good": lambda: frame("b long", 1)}
    report = tables.load_tables(spark, readers, tables.parquet_writer(str(tmp_path)))
    got = {r.table_name: (r.loaded, r.detail) for r in report.collect()}
    assert got == {"my_table_1": (True, ""), "bad": (False, "unreadable"), "good": (True, "")}
    assert spark.read.parquet(f"{tmp_path}/my_table_1").count() == 2


def test_event_bank_batches(spark, small, tmp_path):
    events = adapter.sales_events(spark, small)
    transport.write_event_bank(events, str(tmp_path / "bank"), batch_size=300)
    back = transport.read_event_bank(spark, str(tmp_path / "bank"))
    assert sorted(back.collect()) == sorted(events.collect())
    files = [p.read_text().count("\n") for p in (tmp_path / "bank").glob("*.json")]
    assert max(files) <= 300 and sum(files) == 1000


def test_rows_come_back_from_envelopes(spark, frame, tmp_path):
    df = frame("a long, b string", (1, "x"), (2, None))
    other = frame("c long", 5)
    mixed = transport.row_events(df, "t").unionByName(transport.row_events(other, "u"))
    transport.send_to_files(mixed, str(tmp_path / "topic"))
    stream = transport.stream_from_files(spark, str(tmp_path / "topic"))
    rows = transport.rows_of(stream, "t", df.schema)
    query = (rows.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [(1, "x"), (2, None)]


@pytest.fixture
def odd_events(frame):
    return frame(EVENTS, ("1", 1, 7, 2.5, None), (None, 1, 7, 1.0, None), ("3", 1, 7, None, None),
                 ("4", 0, 0, 1.0, None), ("5", 1, None, 1.0, None))


def test_bucketed_tables_join_without_a_shuffle(spark, small, tmp_path):
    star = adapter.star(spark, small)
    write = tables.bucketed_writer("customer_sk", 6, str(tmp_path))
    readers = {"bucketed sales": lambda: star.fact_sales, "bucketed customers": lambda: star.customers, "gone": lambda: 1 / 0}
    report = {r.table_name: r.loaded for r in tables.load_tables(spark, readers, write).collect()}
    assert report == {"bucketed_sales": True, "bucketed_customers": True, "gone": False}
    sales, people = spark.table("bucketed_sales"), spark.table("bucketed_customers")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = sales.join(people, "customer_sk", "left")
        summed = joined.groupBy("customer_sk", "customer_segment").agg(F.sum("total_amount").alias("x"))
        plan = summed._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = star.fact_sales.join(star.customers, "customer_sk", "left").groupBy("customer_sk", "customer_segment")
        want = want.agg(F.sum("total_amount").alias("x"))
        assert sorted(map(str, summed.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE bucketed_sales")
        spark.sql("DROP TABLE bucketed_customers")


def test_dead_letters(odd_events):
    valid, dead = metrics.split_events(odd_events)
    assert sorted(r.sales_id for r in valid.collect()) == ["1", "4"]
    assert dead.count() == 3


def test_zero_keys(odd_events):
    def keys(skip):
        rows = metrics.batch_increments(odd_events, skip).filter("metric = 'product'").collect()
        return sorted(r.key for r in rows)

    assert keys(False) == ["0", "7"]
    assert keys(True) == ["7"]
    failed = metrics.batch_increments(odd_events).filter("metric = 'failed'").first()
    assert failed.n == 3


def files_of(frame, folder, *values):
    """One JSON file per value, as a producer would drop them."""
    for i, v in enumerate(values):
        transport.write_event_bank(frame(EVENTS, (str(v), v, v, float(v), None)), f"{folder}/part{i}")


def test_running_aggregate_goes_on_and_equals_batch(spark, frame, tmp_path):
    bank, state = str(tmp_path / "bank"), str(tmp_path / "state")

    def stream():
        return spark.readStream.schema(EVENTS).option("recursiveFileLookup", "true").option(
            "maxFilesPerTrigger", 1).json(bank)

    files_of(frame, bank, 1, 2)
    first = metrics.stream_totals(stream(), state).first()
    assert (first.revenue, first.transactions) == (3.0, 2)
    transport.write_event_bank(frame(EVENTS, ("9", 2, 2, 4.0, None)), f"{bank}/later")
    again = metrics.stream_totals(stream(), state).first()
    assert (again.revenue, again.transactions) == (7.0, 3)


def test_replayed_batch_changes_nothing(spark, frame, tmp_path):
    """A batch that runs again writes the same folder."""
    bank, out = str(tmp_path / "bank"), str(tmp_path / "out")
    files_of(frame, bank, 1, 2)

    def stream():
        return spark.readStream.schema(EVENTS).option("recursiveFileLookup", "true").json(bank)

    def total(state):
        return [(r.amount, r.n) for r in state.filter("metric = 'total'").collect()]

    once = total(metrics.process_events(stream(), out))
    # forget that the batch was committed, as after a crash between write and commit
    for commit in (tmp_path / "out" / "progress" / "commits").iterdir():
        commit.unlink()
    assert total(metrics.process_events(stream(), out)) == once


def test_state_is_compacted_and_replays_change_nothing(spark, frame, tmp_path):
    folder = str(tmp_path / "s")

    def rows(n):
        return frame("metric string, key string, amount decimal(18,4), n long", ("m", str(n % 3), Decimal(n), 1))

    def now():
        found = state.read_state(spark, folder, metrics.metric_state)
        return {r.key: (r.amount, r.n) for r in found.collect()}

    assert state.read_state(spark, folder, metrics.metric_state) is None
    most = 0
    for n in range(23):
        for _ in range(2):  # every batch runs twice
            state.write_batch(rows(n), folder, n, metrics.metric_state, compact_after=4)
        done = range(n + 1)
        assert now() == {str(k): (sum(x for x in done if x % 3 == k), len([x for x in done if x % 3 == k])) for k in range(min(3, n + 1))}
        most = max(most, len(list((tmp_path / "s").iterdir())))
    assert most <= 2 * 4 + 4
    before = state.read_state(spark, folder, metrics.metric_state, before=22)
    assert before.agg({"n": "sum"}).first()[0] == 22
    # A base that was not finished does not count.
    (tmp_path / "s" / "base-21").mkdir()
    assert sum(n for _, n in now().values()) == 23


def test_late_and_repeated_events(spark, frame, tmp_path):
    bank, out = str(tmp_path / "bank"), str(tmp_path / "out")
    def day(d, h=12):
        return dt.datetime(2024, 1, d, h)

    files = [
        [("a", day(1)), ("b", day(2)), ("b", day(2))],
        [("c", day(1)), ("d", day(9)), ("a", day(1))],  # within two days of the newest so far
        [("e", day(3)), ("f", day(7, 13)), ("d", day(9)), ("g", day(12))],  # e is late, f is not
        [("h", day(9)), ("i", day(11)), ("j", day(20))],  # h is late
    ]
    schema = "sales_id string, customer_sk long, product_sk long, total_amount double, sales_date timestamp_ntz"
    for i, rows in enumerate(files):
        frame(schema, *[(n, 1, 1, 1.0, at) for n, at in rows]).coalesce(1).write.json(f"{bank}/{i}")
        time.sleep(0.05)

    def stream():
        return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).json(bank)

    found, late = metrics.daily_by_event_time(stream(), out)
    assert sorted(r.sales_id for r in late.collect()) == ["e", "h"]
    days = {r.day: (r.revenue, r.transactions) for r in found.collect()}
    assert days == {f"2024-01-{d:02d}": (n, n) for d, n in ((1, 2), (2, 1), (7, 1), (9, 1), (11, 1), (12, 1))}
    # Going on with nothing new changes nothing; the last day closes with a later event.
    frame(schema, ("k", 1, 1, 1.0, day(28))).coalesce(1).write.json(f"{bank}/9")
    again, late = metrics.daily_by_event_time(stream(), out)
    assert {r.day for r in again.collect()} == {*days, "2024-01-20"}
    assert late.count() == 2


def test_summary_equals_batch(spark, small, tmp_path):
    events = adapter.sales_events(spark, small)
    transport.write_event_bank(events, str(tmp_path / "bank"), batch_size=100)
    stream = transport.stream_event_bank(spark, str(tmp_path / "bank"), files_per_batch=3)
    state = metrics.process_events(stream, str(tmp_path / "fold"))
    want = metrics.metric_state(metrics.batch_increments(events))
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, want.collect()))
    report = metrics.event_report(metrics.event_summary(state))
    days = report.filter("section = 'days_tracked'").first()
    assert days.value == events.select(F.to_date("sales_date")).distinct().count()


def test_preview(frame):
    assert [r.a for r in tables.preview(frame("a long", 3, 1, 2), "a", 2).collect()] == [1, 2]


def _packed(folder) -> int:
    """The bytes of a folder's data files, all of which are compressed."""
    files = [p for p in folder.rglob("part-*")]
    assert files and all(p.name.endswith(".gz") for p in files)
    return sum(p.stat().st_size for p in files)


def test_a_topic_in_compressed_files(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(transport, "FILE_EVENTS", 500)
    events = transport.row_events(adapter.table(spark, small, "orders"), "orders")
    transport.send_to_files(events, str(tmp_path / "plain"))
    transport.send_to_files(events, str(tmp_path / "packed"), compression="gzip")
    plain = sum(p.stat().st_size for p in (tmp_path / "plain").glob("part-*"))
    assert _packed(tmp_path / "packed") < plain / 4
    # A file is read by one task, so none has very many events.
    counts = spark.read.text(str(tmp_path / "packed")).groupBy(F.input_file_name()).count().collect()
    assert len(counts) > 1 and max(r["count"] for r in counts) <= 500
    back = transport.decode(spark.read.text(str(tmp_path / "packed"))).drop("raw")
    assert sorted(back.collect()) == sorted(events.collect())


def test_a_bank_in_compressed_files(spark, small, tmp_path):
    events = adapter.sales_events(spark, small)
    transport.write_event_bank(events, str(tmp_path / "plain"), batch_size=300)
    transport.write_event_bank(events, str(tmp_path / "packed"), batch_size=300, compression="gzip")
    plain = sum(p.stat().st_size for p in (tmp_path / "plain").glob("part-*"))
    assert _packed(tmp_path / "packed") < plain / 2
    counts = spark.read.text(str(tmp_path / "packed")).groupBy(F.input_file_name()).count().collect()
    assert len(counts) == 4 and max(r["count"] for r in counts) <= 300
    assert sorted(transport.read_event_bank(spark, str(tmp_path / "packed")).collect()) == sorted(events.collect())


@pytest.mark.parametrize("name, folder", [("event_bank_roundtrip", "bank"), ("stream_row_events", "topic")])
def test_queries_keep_what_they_write_compressed(spark, small, tmp_path, monkeypatch, name, folder):
    monkeypatch.setattr(catalog_events, "fresh", lambda spark, kind: str(tmp_path / kind))
    assert catalog.load()[name].run(spark, small).count() > 0
    assert _packed(tmp_path / folder) > 0
