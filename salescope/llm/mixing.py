"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: the sources in code-point order (no source last) weigh 1, 2, 3, 1, ...
and share all words by weight; no target exceeds ``REPEATS`` times its source's
words, and the excess is shared by the others, by weight.  That is the level
``l`` at which ``sum(min(REPEATS * size, l * weight))`` is the number of words,
found in one pass over the sources in order of ``size / weight``.

Schedule: slot ``i`` takes the van der Corput point of ``i`` (its bits mirrored
behind the point), and the cumulative targets say whose slot it is; so every
stretch of the mix has each source near its share.  Slots are ranked per source.

Blocks: the documents of a source, in hash order, are one stream of words, which
repeats when the target asks for more.  Its target is cut into as many equal
blocks as the source has slots, and the block of rank ``r`` fills its slot of
rank ``r``.  A source too small for a slot gets one at the end.

Ranks and offsets come from ``ordered_scan``, which range-partitions and so cuts
a source with a third of all rows into pieces.  The text is read once, for its
number of words; everything after that moves numbers.

Defined results: null and empty texts have size 0 and are never taken; a null
source is a source; repeated rows are documents of their own; no words give
targets of 0; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import WORD, row_key, stored
from salescope.operators.ordered import ordered_scan
from salescope.session import durable

# ---- fixed values ----
WEIGHTS = (1, 2, 3)
REPEATS = 3
# ---- end of fixed values ----
BLOCK_WORDS = 512
POINT_BITS = 53  # of a van der Corput point; a double holds them all
CELLS = 1024  # of the unit interval, at least, to find the source of a point


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """Add ``ix``, ``weight``, ``target`` and ``words`` (rounded) to ``(skey, source, source_size)``."""
    ranked = ordered_scan(sources, [F.col("source").asc_nulls_last()], row_number="ix")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("ix") - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("long")).withColumn(
        "ratio", F.col("source_size") / F.col("weight")
    )
    summed = ordered_scan(
        ranked,
        [F.col("ratio"), F.col("ix")],
        running={"size_upto": F.col("source_size"), "weight_upto": F.col("weight")},
        totals={"all_size": F.col("source_size"), "all_weight": F.col("weight")},
    )
    # If this source is the first that is not stopped, the level is ``level``.
    stopped = REPEATS * (F.col("size_upto") - F.col("source_size"))
    left = F.col("all_weight") - (F.col("weight_upto") - F.col("weight"))
    summed = durable(summed.withColumn("level", (F.col("all_size") - stopped) / left))
    fits = F.col("level") <= REPEATS * F.col("ratio")
    level = summed.filter(fits).agg(F.min_by("level", F.struct("ratio", "ix"))).first()[0] or 0.0
    target = F.least(REPEATS * F.col("source_size").cast("double"), F.lit(level) * F.col("weight"))
    out = summed.withColumn("target", target).withColumn("words", F.round("target").cast("long"))
    return out.select("skey", "source", "source_size", "ix", "weight", "target", "words")


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(ix, slot, rank, slots)``: whose each slot is, its rank and the source's number of slots."""
    spark = sources.sparkSession
    laid = durable(ordered_scan(sources.filter("words > 0"), [F.col("ix")], running={"upto": F.col("words")}))
    total, count = laid.agg(F.max("upto"), F.count(F.lit(1))).first()
    total = total or 0
    scale = max(CELLS, 4 * count) / max(total, 1)

    def cell(position: Column) -> Column:
        return F.floor(position * F.lit(scale))

    spans = laid.withColumn("low", F.col("upto") - F.col("words"))
    spans = spans.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("upto") - 1))))
    mirrored = F.conv(F.reverse(F.lpad(F.bin("slot"), POINT_BITS, "0")), 2, 10).cast("double")
    position = F.floor(mirrored / F.lit(2.0**POINT_BITS) * F.lit(float(total)))
    points = spark.range(-(-total // block_words)).withColumnRenamed("id", "slot")
    points = points.withColumn("position", position).withColumn("cell", cell(F.col("position")))
    owned = points.join(spans.select("ix", "low", "upto", "cell"), "cell").filter("low <= position AND position < upto")
    ranked = ordered_scan(
        owned.select("ix", "slot"),
        [F.col("slot")],
        by=["ix"],
        row_number="rank",
        totals={"slots": F.lit(1).cast("long")},
    )
    ranked = durable(ranked.withColumn("rank", F.col("rank") - 1))
    closing = laid.join(ranked.select("ix").distinct(), "ix", "left_anti")
    return ranked.select("ix", "slot", "rank", "slots").union(
        closing.select(
            "ix",
            (F.lit(-(-total // block_words)) + F.col("ix")).alias("slot"),
            F.lit(0).cast("long").alias("rank"),
            F.lit(1).cast("long").alias("slots"),
        )
    )


def _blocks(placed: DataFrame) -> DataFrame:
    """Cut every document's stretches of its source's stream at the block bounds."""
    epochs = F.sequence(F.lit(0).cast("long"), F.expr("(words - 1) div source_size"))
    rows = placed.filter("size > 0 AND words > 0").withColumn("epoch", F.explode(epochs))
    rows = rows.withColumn("x0", F.expr("epoch * source_size + upto - size"))
    rows = rows.withColumn("x1", F.least(F.col("x0") + F.col("size"), F.col("words"))).filter("x0 < x1")
    rows = rows.withColumn("q", F.expr("words div slots")).withColumn("rest", F.expr("words % slots"))

    def block(position: str) -> Column:
        return F.expr(
            f"IF({position} < rest * (q + 1), ({position}) div (q + 1),"
            f" rest + ({position} - rest * (q + 1)) div greatest(q, 1))"
        )

    rows = rows.withColumn("rank", F.explode(F.sequence(block("x0"), block("(x1 - 1)"))))
    low = F.expr("rank * q + least(rank, rest)")
    high = F.expr("(rank + 1) * q + least(rank + 1, rest)")
    rows = rows.withColumn("low", F.greatest("x0", low)).withColumn("high", F.least("x1", high))
    return rows.select(
        "ix",
        "rank",
        "uid",
        "doc_id",
        "epoch",
        F.expr("low - x0").alias("start"),
        F.expr("high - low").alias("words"),
    )


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The rows with their sizes and targets, and the mix.

    rows  ``(uid, doc_id, key, size, source_size, target)``
    mix   ``(slot, ix, rank, uid, doc_id, epoch, start, words)``: a slot takes
          ``words`` words of a document from word ``start``; ``epoch`` counts
          the repeats of the source's stream
    """
    source = docs["source"].cast("string")
    base = durable(
        docs.select(
            docs["doc_id"],
            row_key(docs["doc_id"].cast("string"), source, docs["text"].cast("string")).alias("key"),
            source.alias("source"),
            F.coalesce(F.concat(F.lit("="), source), F.lit("none")).alias("skey"),
            n_words(docs["text"]).alias("size"),
        )
    ).withColumn("uid", F.monotonically_increasing_id())
    sums = base.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    sources = stored(targets(sums), "sources")
    slots = stored(schedule(sources, block_words), "schedule")
    counts = slots.filter("rank = 0").select("ix", "slots")
    known = stored(sources.drop("source").join(counts, "ix", "left"), "known")
    placed = ordered_scan(
        base.select("uid", "doc_id", "skey", "size", F.xxhash64("key").alias("shuffled")),
        [F.col("shuffled"), F.col("uid")],
        by=["skey"],
        running={"upto": F.col("size")},
    ).join(known, "skey")
    taken = _blocks(placed).join(slots.select("ix", "rank", "slot"), ["ix", "rank"])
    rows = base.join(known.select("skey", "source_size", "target"), "skey")
    return rows.select("uid", "doc_id", "key", "size", "source_size", "target"), taken


def mixture(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, key, size, source_size, target, taken)`` of every row of ``docs``."""
    rows, taken = mix(docs, block_words)
    words = taken.groupBy("uid").agg(F.sum("words").alias("taken"))
    return rows.join(words, "uid", "left").select(
        "doc_id", "key", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )
