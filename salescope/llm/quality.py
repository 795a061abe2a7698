"""Quality classifier: a factorisation machine over words, structure and length.

Features: every distinct word of the text, hashed into ``BUCKETS`` and weighted
by the root of its share of the words; statistics of the text's structure (case,
digits, marks, repeats, word and line length); and the document's ``n_chars``.
``doc_id``, ``lang``, ``source`` and labels are never features.

Training: Spark's ``FMClassifier`` on labelled rows whose crc32(doc_id) mod 5 is
not 0.  When there are more than ``max_rows`` of them, a hash of ``doc_id`` keeps
about that many; this is the only sample, and it bounds the model's input, not
what is scored.

Scoring: ``w0 + sum(w_i x_i) + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``,
so all pairwise interactions cost no more than one pass over the features.
The model has ``(BUCKETS + statistics) * (factors + 1)`` numbers whatever the
corpus, which bounds its broadcast.

Defined results: a null text is an empty one, and empty texts are scored by their
statistics; a null ``doc_id`` counts as the empty text and so as held out; a
missing ``n_chars`` is taken from the text; repeated rows score alike; rows with
contradicting labels are learned as both; without labelled rows of both classes
every score is the share of label 1 with one row of each added; other columns
are ignored.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import FMClassifier
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- fixed values ----
FOLDS = 5
THRESHOLD = 0.3
# ---- end of fixed values ----
BUCKETS = 4096
FACTORS = 4
MAX_ROWS = 20_000
ITERATIONS = 60
STEP = 0.05
PENALTY = 1e-4
STATISTICS = 16
WORD_WEIGHT = 0.5  # of the hashed words beside the statistics


def statistics(text: bytes, words: list[bytes], counts: Counter, n_chars: int | None) -> list[float]:
    """Figures of the text's structure, each of about the size of one."""
    by_byte = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    size = max(len(text), 1)
    n = max(len(words), 1)
    upper = int(by_byte[65:91].sum())
    letters = upper + int(by_byte[97:123].sum() + by_byte[128:].sum())
    digits = int(by_byte[48:58].sum())
    plain = int(by_byte[[33, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum())
    marks = int(by_byte[33:127].sum()) - int(by_byte[97:123].sum()) - upper - digits - plain
    chars = len(text) - int(by_byte[128:192].sum())
    stated = chars if n_chars is None else max(n_chars, 0)
    return [
        upper / max(letters, 1),
        digits / size * 5,
        marks / n,
        plain / n,
        by_byte[33] / n,
        by_byte[124] / n,
        by_byte[10] / n * 5,
        letters / size,
        len(text) / n / 10,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(eq, words, islice(words, 1, None))) / n,
        np.log1p(len(words)) / 8,
        float(not words),
        np.log1p(stated) / 10,
        min(abs(np.log1p(stated) - np.log1p(chars)), 3.0),
    ]


def features(text: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted indices and values of a document's features."""
    text = text or b""
    words = text.lower().split()
    counts = Counter(words)
    weights: dict[int, float] = {}
    for word, count in counts.items():
        key = zlib.crc32(word) % BUCKETS
        weights[key] = weights.get(key, 0.0) + count
    index = np.fromiter(weights, dtype=np.int64, count=len(weights))
    value = WORD_WEIGHT * np.sqrt(np.fromiter(weights.values(), dtype=float, count=len(weights)) / max(len(words), 1))
    order = np.argsort(index)
    stats = np.array(statistics(text, words, counts, n_chars), dtype=float)
    used = np.flatnonzero(stats)
    return np.concatenate([index[order], BUCKETS + used]), np.concatenate([value[order], stats[used]])


@dataclass(frozen=True)
class Machine:
    """A fitted factorisation machine; ``prior`` alone where there was nothing to learn."""

    prior: float
    intercept: float = 0.0
    linear: np.ndarray | None = None
    factors: np.ndarray | None = None

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        if self.linear is None:
            return self.prior
        rows = self.factors[index] * value[:, None]
        pairs = (rows.sum(axis=0) ** 2 - (rows**2).sum(axis=0)).sum() / 2
        raw = self.intercept + float(self.linear[index] @ value) + float(pairs)
        return float(1 / (1 + np.exp(-np.clip(raw, -500, 500))))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; 0 is held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Machine:
    """Fit on the labelled documents that are not held out."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label"))
    known = known.filter("label IN (0, 1) AND doc_id IS NOT NULL").filter(fold(F.col("doc_id")) != 0).distinct()
    total, ones = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    prior = ((ones or 0) + 1) / (total + 2)
    if not total or ones in (0, total):
        return Machine(prior)
    scale = 1 << 30
    share = int(scale * min(1.0, max_rows / total))
    chosen = known.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(scale)) < share)
    # At most about ``max_rows`` narrow rows, whatever the corpus.
    chosen = F.broadcast(stored(chosen, "labels"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("n_chars").cast("long"))
    rows = rows.join(chosen, "doc_id").select("text", "n_chars", F.col("label").cast("double"))

    @F.udf(VectorUDT())
    def vector(text, n_chars):
        index, value = features(text.encode() if text else None, n_chars)
        return SparseVector(BUCKETS + STATISTICS, index, value)

    learned = stored(rows.select(vector("text", "n_chars").alias("features"), "label"), "features")
    both = learned.agg(F.min("label"), F.max("label")).first()
    if tuple(both) != (0.0, 1.0):
        return Machine(prior)
    model = FMClassifier(
        factorSize=FACTORS, maxIter=ITERATIONS, stepSize=STEP, regParam=PENALTY, seed=1, tol=0.0
    ).fit(learned)
    return Machine(prior, float(model.intercept), model.linear.toArray(), model.factors.toArray())


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``(row, score)`` of every document; ``row`` is its whole input row."""
    # A broadcast of plain values; the class itself travels with the task.
    model = docs.sparkSession.sparkContext.broadcast(astuple(machine))
    chars = docs["n_chars"] if "n_chars" in docs.columns else F.lit(None)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["text"].cast("string").alias("text"),
        chars.cast("long").alias("n_chars"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*model.value)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            chars = batch.column(2).to_pylist()
            scores = [machine.score(*features(t.as_py(), n)) for t, n in zip(texts, chars)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["row", "score"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``(row, held_out, score, predicted)`` of every document."""
    scored = score(docs, train(docs, labels, max_rows))
    return scored.select(
        "row",
        (fold(F.col("row.doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
