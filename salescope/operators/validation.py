"""Key and business-rule checks of a star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.sources.schema import FOREIGN_KEYS, PRIMARY_KEYS, StarSchema


def validate_primary_keys(df: DataFrame, table_name: str) -> DataFrame:
    """``(table_name, column_name, nulls, duplicates, passed)`` per key column.

    Duplicates are the rows beyond the first of each value, NULL counted as a
    value.  A table without known keys yields no rows; a missing key column fails.
    All key columns are checked in one pass.
    """
    wanted = PRIMARY_KEYS.get(table_name, ())
    present = [c for c in wanted if c in df.columns]
    keys = _key_counts(df, {c: F.col(c) for c in present})
    sums = keys.groupBy("column_name").agg(
        F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.sum(F.col("n") - 1).alias("duplicates"),
    )
    rows = _names(df, wanted).join(sums, "column_name", "left")
    known = F.col("column_name").isin(present)
    counted = {c: F.when(known, F.coalesce(c, F.lit(0))) for c in ("nulls", "duplicates")}
    return rows.withColumns(counted).select(
        F.lit(table_name).alias("table_name"),
        "column_name",
        "nulls",
        "duplicates",
        F.coalesce((F.col("nulls") == 0) & (F.col("duplicates") == 0), F.lit(False)).alias("passed"),
    )


def _names(df: DataFrame, names) -> DataFrame:
    return df.sparkSession.createDataFrame([(n,) for n in names], "column_name string")


def _key_counts(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``(column_name, key, n)`` of several key columns, as text, in one pass.

    Rows are counted per key before the shuffle, so a hot key costs one row per task.
    """
    if not keys:
        return df.sparkSession.createDataFrame([], "column_name string, key string, n long")
    cells = [
        F.struct(F.lit(name).alias("column_name"), key.cast("string").alias("key"))
        for name, key in keys.items()
    ]
    long = df.select(F.explode(F.array(*cells)).alias("cell"))
    return long.groupBy("cell.column_name", "cell.key").agg(F.count(F.lit(1)).alias("n"))


def missing_keys(child: DataFrame, links: dict[str, tuple[Column, DataFrame, Column]]) -> DataFrame:
    """``(column_name, missing)``: child rows per link whose key no parent row has.

    ``links`` maps a name to the child's key, the parent and its key.  A NULL
    key is missing unless the parent has a NULL key too.  The child is read
    once and joined once, whatever the number of links.
    """
    counts = _key_counts(child, {name: key for name, (key, _, _) in links.items()})
    parents = reduce(
        DataFrame.unionByName,
        [
            parent.select(F.lit(name).alias("p_name"), key.cast("string").alias("p_key"))
            for name, (_, parent, key) in links.items()
        ],
    )
    same = (F.col("column_name") == F.col("p_name")) & F.col("key").eqNullSafe(F.col("p_key"))
    lost = counts.join(parents, same, "left_anti")
    sums = lost.groupBy("column_name").agg(F.sum("n").alias("missing"))
    rows = _names(child, links).join(sums, "column_name", "left")
    return rows.withColumn("missing", F.coalesce("missing", F.lit(0)))


def validate_foreign_keys(star: StarSchema) -> DataFrame:
    """``(column_name, parent_table, missing, passed)``; dates match by day."""
    tables = star.tables()
    parts = []
    for child_name, columns in FOREIGN_KEYS.items():
        child = tables[child_name]
        links = {}
        for column, (parent_name, parent_key) in columns.items():
            parent = tables[parent_name]
            day = parent_name == "dates"
            # as text, keys only match when both sides have the same type
            dtype = "date" if day else parent.schema[parent_key].dataType.simpleString()
            # A key that is not of the type is no parent's key: it stays as text and misses.
            read = F.col(column).try_cast(dtype).cast("string")
            child_key = F.coalesce(read, F.concat(F.lit("not read: "), F.col(column).cast("string")))
            links[column] = (child_key, parent, F.col(parent_key).try_cast(dtype))
        names = F.create_map(*[F.lit(x) for c, (p, _) in columns.items() for x in (c, p)])
        parts.append(
            missing_keys(child, links).select(
                "column_name",
                F.element_at(names, F.col("column_name")).alias("parent_table"),
                "missing",
                (F.col("missing") == 0).alias("passed"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def validate_business_rules(star: StarSchema) -> DataFrame:
    """``(rule, bad_rows, passed)``."""
    campaigns = star.campaigns.agg(
        F.count_if(F.col("end_date_sk") < F.col("start_date_sk")).alias("bad_rows")
    ).select(F.lit("campaign_ends_after_start").alias("rule"), "bad_rows")
    amounts = star.fact_sales.agg(
        F.count_if(F.col("total_amount") < 0).alias("bad_rows")
    ).select(F.lit("amount_not_negative").alias("rule"), "bad_rows")
    both = campaigns.unionByName(amounts)
    return both.withColumn("passed", F.col("bad_rows") == 0)


def validate_star_schema(star: StarSchema, strict: bool = False) -> DataFrame:
    """``(check, subject, bad_rows, passed)`` of all checks; ``strict`` raises on a failure."""
    keys = reduce(
        DataFrame.unionByName,
        [validate_primary_keys(df, name) for name, df in star.tables().items()],
    )
    parts = [
        keys.select(
            F.lit("primary_key").alias("check"),
            F.concat_ws(".", "table_name", "column_name").alias("subject"),
            (F.col("nulls") + F.col("duplicates")).alias("bad_rows"),
            "passed",
        ),
        validate_foreign_keys(star).select(
            F.lit("foreign_key").alias("check"),
            F.col("column_name").alias("subject"),
            F.col("missing").alias("bad_rows"),
            "passed",
        ),
        validate_business_rules(star).select(
            F.lit("business_rule").alias("check"), F.col("rule").alias("subject"), "bad_rows", "passed"
        ),
    ]
    report = reduce(DataFrame.unionByName, parts)
    if strict:
        failed = [f"{r.check} {r.subject}" for r in report.filter(~F.col("passed")).collect()]
        if failed:
            raise ValueError(f"star schema checks failed: {', '.join(failed)}")
    return report
