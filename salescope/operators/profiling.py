"""Column profiles and data set checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.columns import numeric_columns
from salescope.operators.ordered import exact_quantiles


VALUE_TYPES = ("bigint", "double", "string")


def column_profile(df: DataFrame) -> DataFrame:
    """``(column_name, row_count, nulls, distinct_values, top_count)`` per column.

    One shuffle for all columns: values are counted per column first, whole numbers
    and floats as they are (-0.0 is 0.0), any other value as text.
    ``top_count`` is the frequency of the most frequent value, NULL included.
    """
    kinds = {t: "bigint" for t in ("tinyint", "smallint", "int", "bigint")} | {"float": "double", "double": "double"}
    cells = []
    for k, (c, kind) in enumerate(df.dtypes):
        own = kinds.get(kind, "string")
        parts = [(F.col(c) if t == own else F.lit(None)).cast(t).alias(t) for t in VALUE_TYPES]
        cells.append(F.struct(F.lit(k).alias("column"), *parts))
    counts = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .groupBy("cell.column", *[f"cell.{t}" for t in VALUE_TYPES])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = reduce(lambda a, b: a | b, [F.col(t).isNotNull() for t in VALUE_TYPES])
    found = counts.groupBy("column").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("nulls"),
        F.count_if(known).alias("distinct_values"),
        F.max("n").alias("top_count"),
    )
    names = F.array(*[F.lit(c) for c in df.columns])
    return found.select(F.get(names, "column").alias("column_name"), *found.columns[1:])


def constant_columns(profile: DataFrame, protected: Sequence[str] = (), share: float = 0.99):
    """Columns with one value, or one value in at least ``share`` of the rows."""
    one = F.col("distinct_values") + (F.col("nulls") > 0).cast("int") <= 1
    same = F.col("top_count") >= F.col("row_count") * share
    return profile.filter(~F.col("column_name").isin(list(protected)) & (one | same))


def high_cardinality_columns(
    profile: DataFrame, columns: Sequence[str], share: float = 0.95
) -> DataFrame:
    """Of the given (text) columns, those with nearly as many values as rows."""
    spread = F.col("distinct_values") >= F.col("row_count") * share
    return profile.filter(F.col("column_name").isin(list(columns)) & spread)


def duplicate_rows(df: DataFrame, name: str = "duplicate_rows") -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    sets = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return sets.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias(name))


def validate_ml_dataframe(df: DataFrame, targets: Sequence[str] = ()) -> DataFrame:
    """``(check, subject, value)``: size, gaps, duplicates, constants, target counts."""
    cells = F.collect_list(F.struct("column_name", "distinct_values"))  # one per column
    size = column_profile(df).agg(
        F.max("row_count").alias("rows"),
        F.count(F.lit(1)).alias("columns"),
        F.sum("nulls").alias("null_cells"),
        cells.alias("cells"),
    )

    def row(check: str, subject: Column, value: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), subject.alias("subject"), value.alias("value"))

    def rows(check: str, wanted: Callable[[Column], Column]) -> Column:
        return F.transform(F.filter("cells", wanted), lambda c: row(check, c["column_name"], c["distinct_values"]))

    # The profile is read once, whatever the number of checks on it.
    found = F.concat(
        F.array(*[row(c, F.lit(""), F.col(c)) for c in ("rows", "columns", "null_cells")]),
        rows("constant", lambda c: c["distinct_values"] <= 1),
        rows("target_values", lambda c: c["column_name"].isin(list(targets))),
    )
    again = duplicate_rows(df, "value").select(F.lit("duplicate_rows").alias("check"), F.lit("").alias("subject"), "value")
    return size.select(F.inline(found)).unionByName(again)


def numeric_summary(df: DataFrame) -> DataFrame:
    """Per numeric column: count, mean, std, min, quartiles, max and adjusted skew."""
    columns = numeric_columns(df)
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
        for c in columns
    ]
    long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    n = F.count("value")
    # Spark's skewness is the population one; this is the sample correction.
    correction = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    moments = long.groupBy("column_name").agg(
        n.alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.when(n > 2, F.skewness("value") * correction).alias("skew"),
    )
    points = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    wide = exact_quantiles(df, columns, points)
    quartiles = wide.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        *[F.col(f"{c}_{p}").alias(p) for p in points],
                    )
                    for c in columns
                ]
            )
        ).alias("q")
    ).select("q.*")
    return moments.join(quartiles, "column_name", "left")


def inspect_dataset(df: DataFrame) -> DataFrame:
    """Type, gaps and distinct values of every column, with its numeric summary."""
    names = F.create_map(*[F.lit(part) for pair in df.dtypes for part in pair])
    profile = column_profile(df).drop("top_count")
    typed = profile.withColumn("type", F.element_at(names, F.col("column_name")))
    return typed.join(numeric_summary(df), "column_name", "left")
