"""Documents to a training mix: judged, without repeats and test passages, in proportion.

Every stage takes ``(spark, docs, sf_dir)`` and works on what the one before
kept; ``run`` writes each result as Parquet to the shared folder and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import decontamination, line_dedup, mixing, quality, simhash
from salescope.llm.common import row_key, stored
from salescope.operators.ordered import ordered_scan
from salescope.session import durable


def _with(docs: DataFrame, judged: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` out of ``judged.row``, some of them changed."""
    return judged.select(*[(changed[c] if c in changed else F.col("row")[c]).alias(c) for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _with(docs, quality.classify(docs, labels).filter("predicted = 1"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later copies of repeated line runs; ``n_chars`` follows."""
    found = line_dedup.dedup_lines(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars"))
    return _with(docs, found, text=F.col("text"), n_chars=n_chars.cast(docs.schema["n_chars"].dataType))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with(docs, decontamination.decontaminate(docs, benchmark).filter("NOT contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the words it takes of each, repeats counted.

    Documents of which the mix takes nothing are not in it.  Columns of the names
    that it adds (``size``, ``source_size``, ``target``, ``taken``) are replaced.
    """
    mixed = durable(mixing.mixture(docs).drop("doc_id"))
    added = [c for c in mixed.columns if c != "key"]
    key = row_key(*[docs[c].cast("string") for c in ("doc_id", "source", "text")]).alias("mix_key")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), key)
    times = mixed.groupBy("key").agg(F.count(F.lit(1)).alias("times"))
    again = stored(times.filter("times > 1").select("key"), "repeated")
    alone = stored(mixed.filter("taken > 0").join(again, "key", "left_anti"), "mix")
    found = rows.join(alone, rows["mix_key"] == alone["key"])
    if not again.isEmpty():
        # Of rows that repeat each other, each takes one share; which one makes no difference.
        shares = mixed.join(again, "key")
        shares = ordered_scan(shares, [F.desc("taken")], by=["key"], row_number="place").filter("taken > 0")
        copies = rows.join(again, rows["mix_key"] == again["key"], "left_semi").withColumn("uid", F.monotonically_increasing_id())
        copies = ordered_scan(copies, [F.col("uid")], by=["mix_key"], row_number="at")
        same = (copies["mix_key"] == shares["key"]) & (copies["at"] == shares["place"])
        repeats = copies.join(shares, same)
        found = found.select("row", *added).unionByName(repeats.select("row", *added))
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
]

#: SQL can't express the fitted classifier; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return docs
