"""SimHash near-duplicates: fingerprints, pigeonhole blocks, exact verification.

A fingerprint of 64 bits is cut into ``blocks`` pieces.  Two that differ in at
most ``distance`` bits agree on at least ``blocks - distance`` whole pieces, so
every close pair meets in one of the tables that are keyed by such a choice of
pieces.  Only distinct fingerprints are compared, and every pair that meets is
verified, so the links are exact.

The number of tables is C(blocks, distance) and the key has about
``64 * (blocks - distance) / blocks`` bits: 6 blocks give 15 tables with 21 bits,
which suits some ten million distinct fingerprints; 7 give 35 with 27 bits, 8
give 70 with 32 bits, for larger corpora.  The links are the same for any choice.

A key shared by more than ``part`` fingerprints is cut into parts by hash, and
each pair of parts is compared on its own, so no task holds a whole hot key.
Parts report a spanning forest of their links and not all pairs.

Defined results: null and empty texts have fingerprint 0; a null ``doc_id`` is
never a component's name unless all its documents have none; repeated rows are
kept and share a component; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import components, forest, parted, row_key, stored
from salescope.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- fixed values ----
SEED = 42
BITS = 64
# ---- end of fixed values ----
SHINGLE = 4
DISTANCE = 4
BLOCKS = 6
PART = 1024  # fingerprints of one key that a task compares with as many others
CHUNK = 100_000  # shingles whose bits are unpacked at a time
SHORT = 64  # up to this many rows of a key are compared row by row


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of the word shingles of a UTF-8 text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends.tolist()
    size = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    total = len(words) - size + 1
    for low in range(0, total, CHUNK):
        high = min(total, low + CHUNK)
        spans = zip(starts[low:high], ends[low + size - 1 : high + size - 1])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(2 * counts > total, bitorder="little")
    return int(set_bits.view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        prints = pa.array([fingerprint(t.as_py(), size) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), prints, batch.column(2)], ["doc_id", "fp", "key"])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp, key)``: the fingerprint of every row as a signed long."""
    rows = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"), document_key(docs))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        return _fingerprints(batches, size)

    return rows.mapInArrow(run, f"doc_id {kind}, fp long, key string")


def document_key(docs: DataFrame) -> Column:
    """Tells rows apart that differ in ``doc_id`` or text."""
    return row_key(docs["doc_id"].cast("string"), docs["text"].cast("string")).alias("key")


def block_keys(blocks: int, distance: int):
    """The keys of a fingerprint: one for each choice of blocks that must agree."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    keys = []
    for table, chosen in enumerate(itertools.combinations(masks, blocks - distance)):
        mask = sum(chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        part = F.col("fp").bitwiseAND(F.lit(signed))
        keys.append(F.struct(F.lit(table).alias("table"), part.alias("bits")))
    return F.array(*keys)


def links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, part: int = PART) -> DataFrame:
    """``(a, b)``: pairs of distinct ``fp`` that connect all that differ in at most ``distance`` bits.

    Keys with few fingerprints give every close pair, large ones a spanning
    forest of them, so the components are exact.
    """
    rows = prints.select("fp", F.explode(block_keys(blocks, distance)).alias("key")).select("fp", "key.*")
    hot = stored(rows.groupBy("table", "bits").count().filter(F.col("count") > part), "hot-keys")
    cut = F.ceil(F.coalesce("count", F.lit(1)) / part).cast("int")
    tagged = rows.join(hot, ["table", "bits"], "left").withColumn("parts", cut)
    own = F.pmod(F.xxhash64("fp"), "parts").cast("int")
    pairs = tagged.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    pairs = pairs.select(
        "table", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"
    )
    dealt = pairs.repartition("table", "bits", "i", "j").sortWithinPartitions("table", "bits", "i", "j")

    def run(batches):
        return _close_pairs(batches, distance)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _close_pairs(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Compare the rows of each key; the rows come sorted by key."""
    rest = None
    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        if rest is not None:
            rows = np.concatenate([rest, rows])
        if not len(rows):
            continue
        change = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
        done = change[-1] if len(change) else 0
        rest = rows[done:]
        if done:
            yield _compare(rows[:done, 4], np.concatenate(([0], change)), distance)
    if rest is not None and len(rest):
        yield _compare(rest[:, 4], np.array([0, len(rest)]), distance)


def _compare(prints: np.ndarray, bounds: np.ndarray, distance: int) -> pa.RecordBatch:
    # Unsigned: numpy counts the bits of a signed number's absolute value.
    prints = prints.astype(np.int64).view(np.uint64)
    sizes = np.diff(bounds)
    left, right = [], []
    end = np.repeat(bounds[1:], sizes)
    short = np.repeat(sizes <= SHORT, sizes)
    at = np.flatnonzero(short)
    for step in range(1, SHORT):
        at = at[at + step < end[at]]
        if not len(at):
            break
        a, b = prints[at], prints[at + step]
        near = np.bitwise_count(a ^ b) <= distance
        left.append(a[near])
        right.append(b[near])
    for k in np.flatnonzero(sizes > SHORT):
        own = prints[bounds[k] : bounds[k + 1]]
        close = np.empty((len(own), len(own)), dtype=bool)
        for low in range(0, len(own), 256):
            close[low : low + 256] = np.bitwise_count(own[low : low + 256, None] ^ own[None, :]) <= distance
        root = own[forest(close)]
        left.append(own[root != own])
        right.append(root[root != own])
    a = np.concatenate(left or [prints[:0]]).view(np.int64)
    b = np.concatenate(right or [prints[:0]]).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"]
    )


def near_duplicates(
    docs: DataFrame,
    size: int = SHINGLE,
    distance: int = DISTANCE,
    blocks: int = BLOCKS,
    part: int = PART,
) -> DataFrame:
    """``(doc_id, key, fp, component_id)`` of every row.

    ``component_id`` is the smallest ``doc_id`` reachable over pairs of
    fingerprints that differ in at most ``distance`` bits.
    """
    prints = durable(fingerprints(docs, size))
    unique = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(links(unique.select("fp"), distance, blocks, part))
    named = unique.join(found, unique.fp == found.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    # The parts of the corpus that share a fingerprint meet one row of this table.
    names = stored(named.join(smallest, "component").select("fp", "component_id"), "names")
    return prints.join(names, "fp", "left").select("doc_id", "key", "fp", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without all but one document of every component.

    The smallest ``doc_id`` stays; of documents that share it, the one with the
    smallest key; of rows that repeat both ``doc_id`` and text, any one.
    """
    found = near_duplicates(docs, **options)
    # Not by fp, which would tie the skewed join before it to this exchange.
    by_key = found.groupBy("component_id", "doc_id", "key").agg(F.max("fp").alias("fp"), F.count(F.lit(1)).alias("rows"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    alone = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp").cast("string")))
    by_key = stored(by_key.withColumn("name", alone).withColumn("order", order), "documents")
    chosen = by_key.groupBy("name").agg(F.min("order").alias("order"))
    chosen = chosen.select(F.col("order.key").alias("key")).withColumn("chosen", F.lit(True))
    gone = stored(by_key.select("key").distinct().join(chosen.distinct(), "key", "left_anti"), "gone")
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), document_key(docs))
    some, kept = parted(keyed, gone, "key")
    kept = kept.unionByName(some.join(gone, "key", "left_anti"))
    twice = stored(by_key.filter("rows > 1").select("key").distinct(), "repeated")
    if not twice.isEmpty():
        some, kept = parted(kept, twice, "key")
        once = some.join(twice, "key", "left_semi").dropDuplicates(["key"])
        kept = kept.unionByName(some.join(twice, "key", "left_anti")).unionByName(once)
    return kept.select("row.*")
