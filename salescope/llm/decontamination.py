"""Benchmark decontamination by a Wu-Manber search over words.

The patterns are the windows of ``window`` consecutive words of every test item,
and whole items that are shorter.  The search keeps, for every block of
``block`` words that occurs in the first ``m`` words of a pattern (``m``: the
shortest pattern of the search), how far the text may shift before that block
can end a match.  A block that occurs nowhere skips ``m - block + 1`` words at
once.  Where the shift is zero, the patterns whose first ``m`` words end in that
block are candidates, and a direct comparison of all their words decides.

Windows and short items are searched apart, in one search per length, because a
single short item would otherwise make every shift small.

The tables are arrays of word numbers: a pattern is a place in its item's words, a
block two numbers in one, and buckets are stretches of the places sorted by their
last block.  They go to the tasks in shards of at most about ``table_bytes`` (one item is
never cut), counted from the words of the test sets, so a broadcast has a bound
whatever the size of the test sets; each shard is one pass that adds to the hits
of the ones before, and a pass is stored before the next table goes out.

Defined results: a null or empty text has no words and is not contaminated; an
empty test table leaves every document clean; items without an ``item_id`` mark
words but are not counted or listed; items with the same id count once; repeated
documents are judged alike; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import lower_ascii
from salescope.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- fixed values ----
#: Bytes of words: digits, letters and all of UTF-8 beyond ASCII; the rest parts them.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: The same as a pattern.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# ---- end of fixed values ----
WINDOW = 13
BLOCK = 2
SHARE = 20  # a document is contaminated when a word in so many is hit
TABLE_BYTES = 128_000_000
WORD_COST = 48  # bytes of the tables per word of a test text
NAME_COST = 160  # and per different word or item, which are Python strings


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


@dataclass(frozen=True)
class Search:
    """The patterns of one length."""

    m: int
    size: int  # words of a block
    blocks: np.ndarray  # in order
    shifts: np.ndarray  # of the blocks
    tails: np.ndarray  # the last blocks of the patterns, in order, each once
    bounds: np.ndarray  # where each one's patterns begin in ``places``, and their number
    places: np.ndarray  # of the patterns among all words
    owners: np.ndarray  # the patterns' items


@dataclass(frozen=True)
class Tables:
    numbers: dict[bytes, int]  # of the words
    text: np.ndarray  # all items' words
    names: list[str | None]  # of the items
    searches: list[Search]


def _blocks(text: np.ndarray, size: int, words: int) -> np.ndarray:
    """The block that begins at every place; one with an unknown word (-1) is -1."""
    if size == 1:
        return text.astype(np.int64)
    first, second = text[:-1].astype(np.int64), text[1:]
    return np.where((first < 0) | (second < 0), -1, first * words + second)


def build(items: Iterable[tuple[str | None, bytes | None]], window: int = WINDOW, block: int = BLOCK) -> Tables:
    """Shift tables and buckets of the items' windows, one search for each pattern length."""
    numbers: dict[bytes, int] = {}
    names: list[str | None] = []
    parts: list[np.ndarray] = []
    begins: dict[int, list[np.ndarray]] = {}
    owners: dict[int, list[np.ndarray]] = {}
    total = 0
    for name, raw in items:
        tokens = words(raw)
        if not tokens:
            continue
        parts.append(np.array([numbers.setdefault(w, len(numbers)) for w in tokens], dtype=np.int32))
        m = min(window, len(tokens))
        count = len(tokens) - m + 1
        begins.setdefault(m, []).append(np.arange(total, total + count, dtype=np.int64))
        owners.setdefault(m, []).append(np.full(count, len(names), dtype=np.int32))
        names.append(name)
        total += len(tokens)
    text = np.concatenate(parts) if parts else np.empty(0, np.int32)
    searches = []
    for m in sorted(begins):
        places, own = np.concatenate(begins[m]), np.concatenate(owners[m])
        size = min(block, m)
        keys = _blocks(text, size, len(numbers))
        blocks, shifts = np.empty(0, np.int64), np.empty(0, np.int16)
        # Later ends have smaller shifts, so a block's first entry from the end counts.
        for end in range(m, size - 1, -1):
            found = np.setdiff1d(keys[places + end - size], blocks)
            blocks = np.concatenate([blocks, found])
            shifts = np.concatenate([shifts, np.full(len(found), m - end, np.int16)])
        order = np.argsort(blocks)
        tail = keys[places + m - size]
        by_tail = np.argsort(tail, kind="stable")
        tails, first = np.unique(tail[by_tail], return_index=True)
        bounds = np.append(first, len(places))
        searches.append(Search(m, size, blocks[order], shifts[order], tails, bounds, places[by_tail], own[by_tail]))
    return Tables(numbers, text, names, searches)


def search(tokens: Sequence[bytes], tables: Tables) -> tuple[list[tuple[int, int]], set[str]]:
    """The hit ranges of ``tokens``, in order and merged, and the items that occur."""
    ranges: list[tuple[int, int]] = []
    items: set[str] = set()
    get = tables.numbers.get
    text = np.array([get(w, -1) for w in tokens], dtype=np.int32)
    n = len(text)
    if not n or (text < 0).all():
        return ranges, items
    for one in tables.searches:
        if n < one.m:
            continue
        keys = _blocks(text, one.size, len(tables.numbers))
        at = np.minimum(np.searchsorted(one.blocks, keys), len(one.blocks) - 1)
        skip = one.m - one.size + 1
        steps = np.where(one.blocks[at] == keys, one.shifts[at], skip).tolist()
        end = one.m  # the text's words before ``end`` hold the last block
        while end <= n:
            step = steps[end - one.size]
            if step:
                end += step
                continue
            bucket = int(np.searchsorted(one.tails, keys[end - one.size]))
            low, high = one.bounds[bucket], one.bounds[bucket + 1]
            alive = np.arange(low, high)
            for k in range(one.m - 1, -1, -1):
                alive = alive[tables.text[one.places[alive] + k] == text[end - one.m + k]]
                if not len(alive):
                    break
            else:
                ranges.append((end - one.m, end))
                items.update(tables.names[o] for o in one.owners[alive].tolist())
            end += 1
    return merged(ranges), items - {None}


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


FOUND = "n_words long, ranges array<struct<low:long,high:long>>, items array<string>"


def _scan(rows: DataFrame, items: Iterable[tuple[str | None, bytes]], window: int) -> DataFrame:
    """One pass: add what these items hit to ``ranges`` and ``items`` of every row."""
    table = rows.sparkSession.sparkContext.broadcast(build(items, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ranges, names = [], [], []
            before = zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())
            for text, (old, known) in zip(batch.column(1).cast(pa.binary()), before):
                tokens = words(text.as_py())
                more, found = search(tokens, table.value)
                counts.append(len(tokens))
                ranges.append(merged([(r["low"], r["high"]) for r in old] + more))
                names.append(sorted(found.union(known)))
            spans = pa.array(
                [[{"low": low, "high": high} for low, high in r] for r in ranges],
                pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    spans,
                    pa.array(names, pa.list_(pa.string())),
                ],
                ["row", "text", "n_words", "ranges", "items"],
            )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, text string, {FOUND}")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """``(row, n_words, n_hit, n_items, items_sha256, contaminated)`` for every document.

    ``row`` is the document's whole input row, so that a filter keeps all columns.
    """
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")
    ).filter(F.length("text") > 0)
    found = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(WORD), 0)
    tokens = items.select("item", F.explode(found).alias("word"))
    most = tokens.agg(F.count(F.lit(1)), F.approx_count_distinct("word"), F.approx_count_distinct("item")).first()
    passes = max(1, -(-(most[0] * WORD_COST + (most[1] + most[2]) * NAME_COST) // table_bytes))
    if passes > 1:
        passes *= 2  # a hash deals unevenly
    state = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["text"].cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<low:bigint,high:bigint>>").alias("ranges"),
        F.array().cast("array<string>").alias("items"),
    )
    for k in range(passes):
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k)
        state = _scan(state, ((r[0], r[1].encode()) for r in own.toLocalIterator()), window)
        if k + 1 < passes:
            state = durable(state)
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["high"] - r["low"])
    return state.select(
        "row",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.expr(f"n_hit > 0 AND {SHARE} * n_hit >= n_words"))
