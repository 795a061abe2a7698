"""Cleaning, validation, profiling and preprocessing on hand-made rows."""

import datetime as dt
import io
import math
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from salescope.operators import cleaning, profiling, validation
from salescope.plans import preprocess, splits
from salescope.sources.schema import StarSchema


def test_clean_dataframe(frame):
    df = frame("s string, sale_date string, x double", (" b ", "garbage", math.inf),
               (" b ", "garbage", math.inf), (None, "2024-01-02", math.nan))
    got = sorted(map(tuple, cleaning.clean_dataframe(df).collect()), key=str)
    assert ("b", None, None) in got and len(got) == 2
    assert [r for r in got if r[0] is None][0][1] == dt.datetime(2024, 1, 2)


def test_clean_ml(frame):
    df = frame("id long, n long, s string, y double", (1, 1, "a", 1.0), (2, None, None, None),
               (3, 3, "a", 1.0))
    got = cleaning.clean_ml_dataframe(df, ["y"]).orderBy("id").collect()
    assert tuple(got[1]) == (2, 2, "Unknown", None)
    assert cleaning.clean_feature_dataset_raw(df).filter("id = 2").first()["y"] == 1.0


def test_median_that_is_not_whole_widens_the_column(frame):
    df = frame("id long, n long", (1, 1), (2, None), (3, 2))
    assert cleaning.clean_ml_dataframe(df).filter("id = 2").first()["n"] == 1.5


def test_primary_key_counts_nulls_as_a_value(frame):
    got = validation.validate_primary_keys(frame("date_sk long", 1, 1, None, None), "dates").first()
    assert (got.nulls, got.duplicates, got.passed) == (2, 2, False)


def test_primary_key_missing_column_and_unknown_table(frame):
    df = frame("x long", 1)
    assert [r.passed for r in validation.validate_primary_keys(df, "dates").collect()] == [False]
    empty = frame("date_sk long", 1).filter("date_sk > 1")
    assert [r.passed for r in validation.validate_primary_keys(empty, "dates").collect()] == [True]
    assert validation.validate_primary_keys(df, "weather").count() == 0


@pytest.mark.parametrize(("parents", "missing"), [((1, 2), 2), ((1, None), 1)])
def test_orphans_and_null_keys(frame, parents, missing):
    child, parent = frame("k long", 1, None, 5), frame("p long", *parents)
    links = {"k": (F.col("k"), parent, F.col("p"))}
    assert validation.missing_keys(child, links).first()["missing"] == missing


def star_of(frame):
    day = dt.datetime(2024, 1, 1, 15)
    return StarSchema(
        fact_sales=frame(
            "sales_sk string, sales_id long, customer_sk long, product_sk long, store_sk long, "
            "salesperson_sk long, campaign_sk long, sales_date timestamp_ntz, total_amount double",
            ("a", 1, 1, 1, 1, 1, 1, day, 5.0), ("b", 2, 9, 1, 1, 1, 1, day, -1.0),
        ),
        customers=frame("customer_sk long, customer_id string", (1, "c")),
        products=frame("product_sk long, product_id string", (1, "p")),
        stores=frame("store_sk long, store_id string", (1, "s")),
        salespersons=frame("salesperson_sk long, salesperson_id string", (1, "e")),
        campaigns=frame("campaign_sk long, campaign_id string, start_date_sk long, end_date_sk long",
                        (1, "x", 20240102, 20240101)),
        dates=frame("date_sk long, full_date date", (20240101, dt.date(2024, 1, 1))),
    )


def test_star_validation(frame):
    star = star_of(frame)
    failed = {(r.check, r.subject, r.bad_rows)
              for r in validation.validate_star_schema(star).filter("not passed").collect()}
    assert failed == {
        ("foreign_key", "customer_sk", 1),
        ("business_rule", "campaign_ends_after_start", 1),
        ("business_rule", "amount_not_negative", 1),
    }
    with pytest.raises(ValueError, match="customer_sk"):
        validation.validate_star_schema(star, strict=True)


def test_required_tables():
    with pytest.raises(ValueError, match="dim_stores"):
        StarSchema.from_tables({"dim_customers": None})


def test_skew_is_adjusted(frame):
    df = frame("x double", *[float(v) for v in (1, 2, 2, 5, 9, 40)])
    row = profiling.inspect_dataset(df).first()
    assert row.skew == pytest.approx(2.2538029)
    assert (row["count"], row.p25, row.p50, row.p75, row.nulls) == (6, 2, 3.5, 8, 0)


def test_duplicates_and_constants(frame):
    df = frame("a long, b string", (1, None), (1, None), (2, None))
    got = {(r.check, r.subject): r.value for r in profiling.validate_ml_dataframe(df, ["a"]).collect()}
    assert got == {("rows", ""): 3, ("columns", ""): 2, ("null_cells", ""): 3,
                   ("duplicate_rows", ""): 1, ("constant", "b"): 0, ("target_values", "a"): 2}


def test_profile_counts_values_of_all_types(frame):
    df = frame(
        "x double, n int, s string, b boolean, d date, f float",
        (0.0, 1, "1", True, dt.date(2024, 1, 1), 0.5), (-0.0, 1, "1.0", False, None, 0.5),
        (float("nan"), None, None, None, None, 0.25), (None, None, "1", True, None, None),
    )
    got = {r.column_name: tuple(r)[1:] for r in profiling.column_profile(df).collect()}
    # rows, nulls, distinct values, rows of the most frequent value; -0.0 equals 0.0
    assert got == {"x": (4, 1, 2, 2), "n": (4, 2, 1, 2), "s": (4, 1, 2, 2), "b": (4, 1, 2, 2),
                   "d": (4, 3, 1, 3), "f": (4, 1, 2, 2)}


def test_a_data_set_is_profiled_once(spark):
    df = spark.range(5).withColumn("y", F.col("id") % 2)
    out = io.StringIO()
    with redirect_stdout(out):
        profiling.validate_ml_dataframe(df, ["y"]).explain()
    assert out.getvalue().count("Generate explode") == 1


def test_constant_and_high_cardinality_limits(spark):
    df = spark.range(100).select(
        F.when(F.col("id") < 99, 1).otherwise(2).alias("c99"),
        F.when(F.col("id") < 98, 1).otherwise(2).alias("c98"),
        F.least("id", F.lit(94)).cast("string").alias("s95"),
        F.least("id", F.lit(93)).cast("string").alias("s94"),
    )
    profile = profiling.column_profile(df).persist()
    constant = profiling.constant_columns(profile)
    assert {r.column_name for r in constant.collect()} == {"c99"}
    assert profiling.constant_columns(profile, ["c99"]).count() == 0
    many = profiling.high_cardinality_columns(profile, ["s95", "s94"])
    assert {r.column_name for r in many.collect()} == {"s95"}


def test_encoding_limits(spark):
    df = spark.range(11).select(
        "id", (F.col("id") % 10).cast("string").alias("few"), F.lpad("id", 2, "0").alias("many")
    )
    out = preprocess.encode_categories(df).orderBy("id")
    assert [c for c in out.columns if c.startswith("few_")] == [f"few_{i}" for i in range(10)]
    assert [r.many for r in out.collect()] == [float(i) for i in range(11)]


def test_unknown_category_is_zero_and_unknown_code_is_minus_one(frame):
    train = frame("k long, s string, t string", *[(i, "ab"[i % 2], f"t{i // 2 % 11:02d}") for i in range(60)])
    fitted = preprocess.fit_preprocessor("recommendation", train.withColumnRenamed("k", "k_id"))
    new = frame("k_id long, s string, t string", (1, "z", "zz"))
    row = fitted.transform(new).first()
    assert (row.k_id, row.s_a, row.s_b, row.t) == (1, 0.0, 0.0, 0.0)
    assert fitted.encode(new).first()["t"] == -1.0


def test_scaling(frame):
    same = frame("x double", 3.0, 3.0, 3.0)
    assert [r.x for r in preprocess.minmax_scale(same, ["x"]).collect()] == [0, 0, 0]
    assert [r.x for r in preprocess.standard_scale(same, ["x"]).collect()] == [0, 0, 0]
    got = preprocess.standard_scale(frame("x double", 1.0, 3.0), ["x"]).collect()
    assert sorted(r.x for r in got) == [-1, 1]


def test_prepare(frame):
    df = frame("d date, s string, x double", (dt.date(2024, 1, 1), "a", 1.0),
               (dt.date(2024, 1, 7), None, 3.0))
    out = preprocess.prepare(df, ["d"], ["s"], ["x"], "minmax").orderBy("x").collect()
    assert out[0].asDict() == {"x": 0.0, "d_year": 2024, "d_month": 1, "d_day": 1, "d_weekday": 0, "s_a": 1.0}
    assert (out[1].d_weekday, out[1].s_a) == (6, 0.0)


def test_time_split(spark):
    df = spark.range(10).withColumnRenamed("id", "day")
    got = {r.day: r.split for r in splits.split_by_time(df, ["day"]).collect()}
    assert got == {i: "train" if i < 8 else "test" for i in range(10)}


def test_group_split_keeps_groups_whole(spark):
    df = spark.range(2000).withColumn("g", F.col("id") % 100)
    out = splits.split_by_hash(df, "g")
    assert out.groupBy("g").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    assert 60 <= out.filter("split = 'train'").select("g").distinct().count() <= 95


def test_cap_marks_the_rest_unused(spark):
    df = spark.range(100).withColumnRenamed("id", "date")
    out = splits.split_dataset("forecast", df, max_rows=10).collect()
    assert len(out) == 100
    assert sorted(r.date for r in out if r.split == "train") == list(range(8))
    assert sorted(r.date for r in out if r.split == "test") == [8, 9]
