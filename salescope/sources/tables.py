"""Directory scans, table loads, previews."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.functions.columns import finite, is_float
from salescope.sources.schema import TABLE_ALIASES


def safe_table_name(stem: str) -> str:
    return stem.lower().translate(str.maketrans("- ", "__"))


def list_tables(spark: SparkSession, root: str, suffix: str) -> dict[str, str]:
    """``{stem: path}`` of all tables below ``root`` with the suffix.

    A table is a file, or the first folder below ``root`` that carries the suffix,
    with all part files in it.  Spark lists the files, so any file system it
    knows will do; only one path per table comes to the driver.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{suffix}")
        .load(root)
    )
    top = re.sub(r"^[a-z0-9]+:/+", "/", root.rstrip("/"))
    # The shortest start of the path, below the root, that ends in the suffix.
    table = F.regexp_extract("path", rf"^(.*?{re.escape(quote(top))}/(?:[^/]+/)*?[^/]+\.{suffix})(?:/.*)?$", 1)
    found = {}
    for (path,) in sorted(files.select(table).distinct().collect()):
        stem = unquote(path.rsplit("/", 1)[-1])[: -len(suffix) - 1]
        found[TABLE_ALIASES.get(stem, stem)] = unquote(re.sub(r"^file:/+", "/", path))
    return found


def scan_tables(
    spark: SparkSession,
    root: str,
    suffix: str = "csv",
    schemas: Mapping[str, T.StructType] | None = None,
) -> dict[str, DataFrame]:
    """Every file below ``root`` as a named DataFrame.

    CSV columns are inferred only for tables without an entry in ``schemas``.
    """
    schemas = schemas or {}
    tables = {}
    for name, path in list_tables(spark, root, suffix).items():
        reader = spark.read
        if name in schemas:
            reader = reader.schema(schemas[name])
        if suffix == "csv":
            reader = reader.option("header", "true")
            if name not in schemas:
                reader = reader.option("inferSchema", "true")
        tables[name] = fold_non_finite(reader.format(suffix).load(path))
    return tables


def fold_non_finite(df: DataFrame) -> DataFrame:
    """NaN and infinities of every floating column become NULL."""
    names = [f.name for f in df.schema.fields if is_float(f.dataType)]
    return df.withColumns({c: finite(c) for c in names}) if names else df


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


def load_tables(
    spark: SparkSession,
    readers: Mapping[str, Callable[[], DataFrame]],
    write: Callable[[str, DataFrame], None],
) -> DataFrame:
    """Write every table and report on each; a bad one does not stop the rest.

    ``readers`` is called per table so that an unreadable file fails on its own.
    The report has one row per table: ``(table_name, loaded, detail)``.
    """
    report = []
    for stem, read in readers.items():
        name = safe_table_name(stem)
        try:
            write(name, read())
            report.append((name, True, ""))
        except Exception as error:  # the report is the error handling
            report.append((name, False, str(error).splitlines()[0]))
    return spark.createDataFrame(report, "table_name string, loaded boolean, detail string")


def parquet_writer(folder: str) -> Callable[[str, DataFrame], None]:
    return lambda name, df: df.write.mode("overwrite").parquet(f"{folder}/{name}")


def catalog_writer() -> Callable[[str, DataFrame], None]:
    return lambda name, df: df.write.mode("overwrite").saveAsTable(name)


def jdbc_writer(url: str, **options: str) -> Callable[[str, DataFrame], None]:
    """The same load into a database; the driver jar is the user's."""

    def write(name: str, df: DataFrame) -> None:
        df.write.format("jdbc").mode("overwrite").options(url=url, dbtable=name, **options).save()

    return write


def bucketed_writer(key: str, buckets: int, folder: str | None = None) -> Callable[[str, DataFrame], None]:
    """Bucket a table by a join key, so later joins and groups on it need no shuffle.

    Tables that are joined want the same key type and number of buckets.  With
    ``folder`` the files go there and not to the warehouse.
    """

    def write(name: str, df: DataFrame) -> None:
        # One task per bucket, so a bucket is one file and comes sorted.
        dealt = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
        if folder:
            dealt = dealt.option("path", f"{folder}/{name}")
        dealt.saveAsTable(name)

    return write


def preview(df: DataFrame, key: str, rows: int = 100) -> DataFrame:
    """The first rows of a table in key order."""
    return df.orderBy(key).limit(rows)
