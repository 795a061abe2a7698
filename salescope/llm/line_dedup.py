"""Line dedup by a suffix array over line ids.

Every text is a sequence of line ids (two 64-bit hashes of a line; blank lines
are left out).  Lines that occur once can't be part of a repeated run, so only
stretches of lines that occur again, with at least ``min_words`` words, go on.

Prefix doubling gives every position the rank of its next ``2^k`` lines among all
positions, from the ranks of the two halves: round ``k`` sorts the pairs
``(rank_k(i), rank_k(i + 2^k))``.  The sort is ``ordered_scan``, which
range-partitions by pair and position, so a line in a third of all documents is
cut into pieces.  The rounds stop when ``2^k`` exceeds the longest window: a run
is known by its shortest windows of ``min_words`` words, at most that many lines.

Positions whose next ``m`` lines are equal are an interval of the suffix array
with a longest common prefix of at least ``m``; its key is the pair of ranks of
the first and last ``2^k`` of those lines.  Of every interval at the depth of its
window, the first position stays and the others are later copies.  A maximal
repeated run of ``min_words`` or more words is the union of the windows that
begin in it and those that end in it, so deleting the later copies of both kinds
of windows deletes exactly the later copies of all maximal runs.

The first copy is the one with the smallest ``doc_id`` (none last), then by a hash
of the document, then by line.

Defined results: null texts stay null and empty texts empty; runs may repeat
inside one document, where all but their first lines go; rows that repeat both
``doc_id`` and text count as one document; blank lines between two deleted lines
go with them; a text all of whose lines go becomes empty; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import WORD, parted, stored, with_nulls
from salescope.operators.ordered import ordered_scan
from salescope.session import durable

MIN_WORDS = 50
DOC = ["u1", "u2"]
PLACE = [*DOC, "stretch"]


def _keyed(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, text, u1, u2)``; the hashes name a document by id and text."""
    doc, text = docs["doc_id"].cast("string"), docs["text"].cast("string")
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].alias("doc_id"),
        text.alias("text"),
        F.xxhash64(*with_nulls(doc, text)).alias("u1"),
        F.xxhash64(F.lit("second"), *with_nulls(doc, text)).alias("u2"),
    )


def repeated_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """``(doc_id, u1, u2, stretch, i, line, w, h1, h2)``: the stretches that may hold repeated runs.

    ``i`` counts the lines of a stretch from 0, ``line`` those of the text.
    """
    parts = F.transform(F.split("text", "\n", -1), lambda line, n: F.struct(n.alias("line"), line.alias("content")))
    full = F.filter(parts, lambda part: F.regexp_like(part["content"], F.lit(WORD)))
    keyed = _keyed(docs).withColumn("uid", F.monotonically_increasing_id())
    split = keyed.select("doc_id", *DOC, "uid", F.posexplode(full).alias("n", "part"))
    lines = split.select(
        "doc_id",
        *DOC,
        "uid",
        "n",
        "part.line",
        F.regexp_count("part.content", F.lit(WORD)).cast("long").alias("w"),
        F.xxhash64("part.content").alias("h1"),
        F.xxhash64(F.lit("second"), "part.content").alias("h2"),
    )
    lines = stored(lines, "lines")
    counts = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("times"))
    again = stored(counts.filter("times > 1").select("h1", "h2"), "repeated")
    # Most lines occur once, and most of those need no shuffle to know it.
    some, _ = parted(lines, again, "h1", "h2")
    by_doc = Window.partitionBy(*DOC).orderBy("n")
    # Of rows that repeat a document one goes on, so a window sees a document once.
    rows = lines.filter("n = 0").groupBy(*DOC).agg(F.min("uid").alias("kept"), F.count(F.lit(1)).alias("times"))
    twice = stored(rows.filter("times > 1").drop("times"), "repeated-rows")
    once = some.join(twice, DOC, "left").filter("kept IS NULL OR uid = kept").drop("uid", "kept")
    numbered = once.join(again, ["h1", "h2"]).withColumn("stretch", F.col("n") - F.row_number().over(by_doc))
    own = Window.partitionBy(*PLACE)
    long_enough = numbered.withColumn("words", F.sum("w").over(own)).filter(F.col("words") >= min_words)
    at = F.row_number().over(own.orderBy("n")) - 1
    return long_enough.select("doc_id", *PLACE, at.alias("i"), "line", "w", "h1", "h2")


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """Add the window that begins at a line (``m`` lines) and the one that ends there (``b`` lines)."""
    own = Window.partitionBy(*PLACE)
    upto = F.sum("w").over(own.orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    summed = lines.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("w"))
    summed = summed.withColumn("last", F.max("i").over(own)).withColumn("all", F.max("upto").over(own))
    ahead = own.orderBy("before").rangeBetween(min_words, Window.unboundedFollowing)
    behind = own.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words)
    end = F.coalesce(
        F.min("i").over(ahead) - 1, F.when(F.col("all") >= F.col("before") + min_words, F.col("last"))
    )
    start = F.coalesce(F.max("i").over(behind) + 1, F.when(F.col("upto") >= min_words, F.lit(0)))
    return summed.withColumn("m", end - F.col("i") + 1).withColumn("b", F.col("i") - start + 1).drop(
        "upto", "before", "last", "all"
    )


def suffix_ranks(lines: DataFrame, depth: int) -> DataFrame:
    """``(u1, u2, stretch, i, line, ranks)``: for every ``2^k <= depth``, the rank of a position's next ``2^k`` lines.

    Equal lines have equal ranks, and ranks sort positions as the sequences of
    their lines sort; sorted by the last rank, the rows are the suffix array to
    that depth.  A sequence cut off by the end of its stretch sorts first.
    """
    order = [F.col(c) for c in (*PLACE, "i")]
    rows = lines.select(*PLACE, "i", "line", F.struct("h1", "h2").alias("pair"))
    rows = rows.withColumn("ranks", F.array().cast("array<bigint>"))
    own = Window.partitionBy(*PLACE).orderBy("i")
    step = 1
    while True:
        ranked = ordered_scan(rows, [F.col("pair"), *order], dense_rank=("pair", "rank"))
        rows = ranked.withColumn("ranks", F.array_append("ranks", F.col("rank"))).drop("pair", "rank")
        if step * 2 > depth:
            return durable(rows)
        newest = F.element_at("ranks", -1)
        second = F.coalesce(F.lead(newest, step).over(own), F.lit(0).cast("long"))
        rows = rows.withColumn("pair", F.struct(newest.alias("a"), second.alias("b")))
        step *= 2


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(u1, u2, low, high)``: the lines of later copies, as ranges of the text's lines."""
    lines = durable(windows(repeated_lines(docs, min_words), min_words))
    depth = lines.agg(F.max(F.greatest("m", "b"))).first()[0] or 1
    ranked = suffix_ranks(lines, depth)
    begin = lines.filter("m IS NOT NULL").select("doc_id", *PLACE, "i", F.col("m").alias("n"))
    close = lines.filter("b IS NOT NULL").select(
        "doc_id", *PLACE, (F.col("i") - F.col("b") + 1).alias("i"), F.col("b").alias("n")
    )
    runs = begin.union(close).distinct()
    # Twice the ranks of a place: where the window begins and where its last 2^k lines do.
    runs = runs.withColumn("k", F.floor(F.log2(F.col("n") + F.lit(0.5))).cast("int"))
    runs = runs.withColumn("tail", (F.col("i") + F.col("n") - F.expr("shiftleft(1, k)")).cast("int"))
    runs = runs.withColumn("last", F.col("i") + F.col("n") - 1)

    def at(place: str, *extra):
        return ranked.select(*PLACE, F.col("i").alias(place), *extra)

    runs = runs.join(at("i", F.col("ranks").alias("ranks_a"), F.col("line").alias("low")), [*PLACE, "i"])
    runs = runs.join(at("tail", F.col("ranks").alias("ranks_b")), [*PLACE, "tail"])
    runs = runs.join(at("last", F.col("line").alias("high")), [*PLACE, "last"])
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *DOC, "low")
    runs = runs.select(
        *PLACE,
        "i",
        "last",
        "low",
        "high",
        "n",
        F.element_at("ranks_a", F.col("k") + 1).alias("head_rank"),
        F.element_at("ranks_b", F.col("k") + 1).alias("tail_rank"),
        place.alias("place"),
    )
    runs = durable(runs)
    interval = ["n", "head_rank", "tail_rank"]
    firsts = runs.groupBy(*interval).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    firsts = stored(firsts.filter("size > 1").select(*interval, "first"), "intervals")
    copies = runs.join(firsts, interval).filter("place > first")
    # Windows that touch or overlap become one range, with the blank lines between.
    own = Window.partitionBy(*PLACE).orderBy("i", "last")
    reach = F.max("last").over(own.rowsBetween(Window.unboundedPreceding, -1))
    islands = copies.withColumn("new", F.coalesce((F.col("i") > reach + 1).cast("int"), F.lit(1)))
    islands = islands.withColumn("island", F.sum("new").over(own))
    ranges = islands.groupBy(*PLACE, "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return ranges.select(*DOC, "low", "high")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(row, text, n_lines, n_removed)`` of every document; ``text`` lacks the later copies."""
    cuts = later_copies(docs, min_words).groupBy(*DOC)
    cuts = stored(cuts.agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("cuts")), "cuts")
    some, rest = parted(_keyed(docs), cuts, *DOC)
    none = F.lit(None).cast(cuts.schema["cuts"].dataType)
    rows = some.join(cuts, DOC, "left").unionByName(rest.withColumn("cuts", none))
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda _, n: ~F.exists("cuts", lambda c: n.between(c["low"], c["high"])))
    removed = F.aggregate("cuts", F.lit(0).cast("long"), lambda n, c: n + c["high"] - c["low"] + 1)
    cut = F.col("cuts").isNotNull()
    return rows.select(
        "row",
        F.when(cut, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size(F.when(F.col("text").isNotNull(), lines)), F.lit(0)).cast("long").alias("n_lines"),
        F.when(cut, removed).otherwise(F.lit(0).cast("long")).alias("n_removed"),
    )
