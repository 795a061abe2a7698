"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Generators with high recall propose overlapping spans of four kinds (email, ip,
card, phone), among them spellings that the base rules below don't know, such as
``name (at) host (dot) org``, addresses of version 6 and numbers without a plus
sign.  Gradient-boosted trees (Spark's ``GBTClassifier``) judge every candidate by
its format and context.  Per kind, the lowest threshold that keeps ``PRECISION``
on held-out documents selects the spans that are added.  A kind's precision counts
``PRIOR`` cases of all kinds together on top of its own, so a kind with few or no
held-out cases has the threshold of all.

There are no labels of personal data, so the trees learn from the base rules:
candidates that are base spans are positive, with copies of them in other
spellings; candidates that touch no base span, and copies with a broken check
digit, part or length, are negative.  A candidate of the text that is written like
one of those other spellings is neither: nobody knows what it is.  They learn from the candidates of two thirds
of about ``SAMPLE`` documents, chosen by hash; of a kind with more than its share of
``MAX_ROWS`` candidates there, from those of some of the documents.  The thresholds
come from a third of all documents, held out by hash, and every whole text is
searched and scored.

Base spans, leftmost and not overlapping within a kind, always stay; an added
span never overlaps one.  All searches take time linear in the text.

Defined results: null texts are empty and have no spans; offsets count code
points; repeated rows are judged alike; without candidates of both classes
nothing is added; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---- fixed values ----
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS = range(14, 20)
PHONE_DIGITS = range(10, 16)
# ---- end of fixed values ----
SAMPLE = 20_000
MAX_ROWS = 100_000  # candidates that the trees learn from, in equal shares of the kinds
HELD = 3  # one of so many documents is held out
TREES = 12
DEPTH = 3
PRECISION = 0.98
PRIOR = 20  # held-out cases of all kinds that count for each kind
STEPS = 50  # of the thresholds
CONTEXT = 40  # characters around a span
CHUNK = 20_000  # candidates that are judged at once

AT = re.compile(r"[\[({<]\x20?(?:at|AT)\x20?[\])}>]")
SPELLED = re.compile(r"\x20?[A-Za-z0-9-]+(?:(?:\x20?[\[({<]\x20?(?:dot|DOT)\x20?[\])}>]\x20?|\.)[A-Za-z0-9-]+)+")
SIX = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![0-9A-Za-z:])")
ANY_CARD = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[\x20.\-]?[0-9]){11,18}(?![0-9A-Za-z])")
ANY_PHONE = re.compile(r"(?<![0-9A-Za-z+])[+(]?[0-9][0-9\x20().\-/]{5,20}[0-9](?![0-9A-Za-z])")
NATIONAL = re.compile(r"(?:\([0-9]{3}\) |[0-9]{3}-)[0-9]{3}-[0-9]{4}")
HINTS = {
    "email": ("mail", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "carte", "karte", "tarjeta"),
    "phone": ("tel", "phone", "call", "fax", "mobile"),
}
AGAINST = ("version", "v", "section", "isbn", "id", "no", "nr", "figure")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _before(text: str, low: int, high: int, chars: str) -> int:
    """Where the run of ``chars`` that ends at ``high`` begins, not before ``low``."""
    width = 64
    while True:
        start = max(low, high - width)
        kept = len(text[start:high].rstrip(chars))
        if kept or start == low:
            return start + kept
        width *= 4


def emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = _before(text, done, at, LOCAL)
            if start < at:
                done = domain.end()
                yield "email", start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The spans of the base rules by start, then kind."""
    found = list(emails(text))
    for match in NUMBERS.finditer(text):
        parts = match.group().split(".")
        at = match.start()
        for n in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[n : n + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts[n : n + 4]):
                found.append(("ip", at, at + size))
            at += size + 1
    for match in CARD.finditer(text):
        digits = digits_of(match.group())
        if len(digits) in CARD_DIGITS and luhn(digits):
            found.append(("card", match.start(), match.end()))
    for match in PHONE.finditer(text):
        if len(digits_of(match.group())) in PHONE_DIGITS:
            found.append(("phone", match.start(), match.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> set[Span]:
    """Spans that might be personal data; they may overlap."""
    found = set(emails(text))
    for match in AT.finditer(text):
        high = match.start() - (text[match.start() - 1 : match.start()] == " ")
        start = _before(text, 0, high, LOCAL)
        host = SPELLED.match(text, match.end())
        if host and start < high:
            found.add(("email", start, host.end()))
    for match in NUMBERS.finditer(text):
        if 2 <= match.group().count(".") <= 7:
            found.add(("ip", match.start(), match.end()))
    if ":" in text:
        found.update(("ip", m.start(), m.end()) for m in SIX.finditer(text))
    found.update(("card", m.start(), m.end()) for m in ANY_CARD.finditer(text))
    found.update(("phone", m.start(), m.end()) for m in ANY_PHONE.finditer(text) if 7 <= len(digits_of(m.group())) <= 15)
    return found


def span_features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    own = text[start:end]
    digits = digits_of(own)
    groups = re.findall(r"[0-9]+", own)
    sizes = [len(g) for g in groups] or [0]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + 2]
    words = re.findall(r"\w+", before.lower())
    last = words[-1] if words else ""
    nearby = words[-4:]
    row = [float(kind == k) for k in KINDS]
    row += [
        len(digits),
        len(own),
        len(groups),
        max(sizes),
        min(sizes),
        own.count("+"),
        own.count("("),
        own.count(" "),
        own.count("-"),
        own.count("."),
        own.count("/"),
        own.count(":"),
        own.count("@"),
        float(bool(AT.search(own))),
        sum(c.isalpha() for c in own),
        len(own.rpartition(".")[2]) if kind == "email" else 0,
        float(bool(digits) and luhn(digits)) if kind == "card" else 0,
        sum(len(g) > 3 or int(g) > 255 for g in groups) if kind == "ip" else 0,
        float(before[-1:].isalnum()),
        float(before[-1:] not in ("", " ", "\n", "\t")),
        float(after[:1].isalnum()),
        float(after[:1] in (".", "-", "/") and after[1:2].isalnum()),
        float(any(w.startswith(h) for w in nearby for h in HINTS[kind])),
        float(last in AGAINST),
        float(before[-1:] == "." or before[-2:] in ("$", "€", "£")),
    ]
    return [float(x) for x in row]


def variants(kind: str, own: str) -> list[tuple[str, int]]:
    """The span in other spellings (1) and broken (0)."""
    digits = digits_of(own)
    if kind == "email":
        name, _, host = own.partition("@")
        return [(f"{name} (at) {host}", 1), (f"{name} [at] {host.replace('.', ' [dot] ')}", 1)]
    if kind == "ip":
        parts = own.split(".")
        groups = [*[f"{int(p):x}" for p in parts], digits[:4], digits[-3:]]
        six = "2001:db8:" + ":".join(groups)
        short = "2001:db8::" + ":".join(groups[:4])
        broken = [parts[0] + "." + parts[1] + "." + parts[2], f"{own}.{digits[:2]}", ".".join([f"9{parts[0]}99", *parts[1:]])]
        return [(six, 1), (short, 1), *[(b, 0) for b in broken]]
    if kind == "card":
        grouped = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        broken = digits[:-1] + str((int(digits[-1]) + 3) % 10)
        return [(" ".join(grouped), 1), ("-".join(grouped), 1), (".".join(grouped), 1), (broken, 0)]
    short = digits[-10:]
    national = f"{short[:3]}-{short[3:6]}-{short[6:]}"
    return [(f"({short[:3]}) {short[3:6]}-{short[6:]}", 1), (national, 1), (digits[:8], 0), (digits, 0)]


def spelled_otherwise(span: Span, text: str) -> bool:
    """Whether a span is written like a positive one of ``variants``."""
    kind, start, end = span
    own = text[start:end]
    if kind == "email":
        return bool(AT.search(own))
    if kind == "ip":
        return ":" in own
    digits = digits_of(own)
    if kind == "card":
        return len(digits) in CARD_DIGITS and luhn(digits)
    return bool(NATIONAL.fullmatch(own))


def examples(text: str) -> Iterator[tuple[list[float], int]]:
    """Labelled candidates of a text; see the module's head."""
    base = base_spans(text)
    known, cover = set(base), Cover(base)
    for span in sorted(candidates(text)):
        if span in known:
            yield span_features(text, span), 1
        elif not cover.touches(span) and not spelled_otherwise(span, text):
            yield span_features(text, span), 0
    for kind, start, end in base:
        left, right = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
        for own, label in variants(kind, text[start:end]):
            snippet = left + own + right
            span = (kind, len(left), len(left) + len(own))
            if span in candidates(snippet):
                yield span_features(snippet, span), label


class Cover:
    """Ranges without overlaps, in order; tells in logarithmic time whether a span touches one."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, start, end in sorted(spans, key=lambda s: s[1:]):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def touches(self, span: Span) -> bool:
        at = bisect_right(self.ends, span[1])
        return at < len(self.starts) and self.starts[at] < span[2]

    def add(self, span: Span) -> None:
        """Add a span that touches none."""
        at = bisect_right(self.ends, span[1])
        self.starts.insert(at, span[1])
        self.ends.insert(at, span[2])


N_FEATURES = len(span_features("", ("email", 0, 0)))

Model = tuple[list[list[tuple]], list[float], dict[str, float]]


SCALE = 1 << 30


def learning_rows(texts: DataFrame) -> DataFrame:
    """``(x, y)`` of the candidates that the trees learn from, chosen per document and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                at = zlib.crc32(text.encode(), HELD)
                rows += [(x, y, x.index(1.0), at) for x, y in examples(text)]
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.list_(pa.float64()), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["x", "y", "kind", "at"])

    found = stored(texts.mapInArrow(run, "x array<double>, y int, kind int, at long"), "candidates")
    kept = F.lit(True)
    for kind, total in found.groupBy("kind").count().collect():
        share = int(min(1.0, MAX_ROWS / len(KINDS) / total) * SCALE)
        kept = kept & ((F.col("kind") != kind) | (F.pmod(F.xxhash64("kind", "at"), F.lit(SCALE)) < share))
    return found.filter(kept).select("x", "y")


def calibrate(held: DataFrame, trees: list[list[tuple]], weights: list[float]) -> dict[str, float]:
    """Kind -> the lowest threshold that keeps ``PRECISION`` on the held-out texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels = [], []
            totals = np.zeros((len(KINDS), STEPS + 1, 2), dtype=np.int64)

            def count() -> None:
                table = np.array(rows)
                steps = (probabilities(table, trees, weights) * STEPS).astype(int)
                kinds = table[:, : len(KINDS)].argmax(axis=1)
                np.add.at(totals, (kinds, steps, 0), labels)
                np.add.at(totals, (kinds, steps, 1), 1)

            for text in batch.column(0).to_pylist():
                for x, y in examples(text):
                    rows.append(x)
                    labels.append(y)
                if len(rows) >= CHUNK:
                    count()
                    rows, labels = [], []
            if rows:
                count()
            kinds, steps = np.nonzero(totals[:, :, 1])
            columns = [kinds, steps, totals[kinds, steps, 0], totals[kinds, steps, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["kind", "step", "ones", "n"])

    judged = held.mapInArrow(run, "kind long, step long, ones long, n long")
    counts = judged.groupBy("kind", "step").agg(F.sum("ones"), F.sum("n")).collect()
    totals = np.zeros((STEPS + 1, len(KINDS), 2))
    for kind, at, ones, size in counts:
        totals[at, kind] = ones, size
    above = totals[::-1].cumsum(axis=0)[::-1]  # what a threshold of a step lets through
    pooled = above.sum(axis=1, keepdims=True)
    share = np.divide(pooled[..., 0], pooled[..., 1], out=np.zeros((STEPS + 1, 1)), where=pooled[..., 1] > 0)
    precise = (above[..., 0] + PRIOR * share) >= PRECISION * (above[..., 1] + PRIOR)
    return {name: int(np.flatnonzero(ok)[0]) / STEPS for name, ok in zip(KINDS, precise.T) if ok.any()}


def fit(docs: DataFrame) -> Model:
    """``(trees, weights, thresholds)``, as plain values."""
    texts = docs.select(docs["text"].cast("string").alias("text")).filter("length(text) > 0")
    share = min(1.0, SAMPLE / max(texts.count(), 1))
    held = F.crc32(F.col("text").cast("binary")) % HELD == 0
    sample = texts.filter(F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(SCALE)) < int(share * SCALE))
    found = learning_rows(sample.filter(~held))
    learn = found.select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"))
    if learn.select("label").distinct().count() < 2:
        return [], [], {}
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1).fit(learn)
    trees, weights = [_flat(t._java_obj.rootNode()) for t in model.trees], list(model.treeWeights)
    return trees, weights, calibrate(texts.filter(held), trees, weights)


def _flat(root) -> list[tuple]:
    """A tree as rows ``(feature, threshold, left, right, value)``; leaves have feature -1."""
    rows: list[tuple] = []

    def visit(node) -> int:
        at = len(rows)
        rows.append(())
        if node.getClass().getSimpleName() == "LeafNode":
            rows[at] = (-1, 0.0, at, at, float(node.prediction()))
        else:
            split = node.split()
            left, right = visit(node.leftChild()), visit(node.rightChild())
            rows[at] = (int(split.featureIndex()), float(split.threshold()), left, right, 0.0)
        return at

    visit(root)
    return rows


def probabilities(rows: np.ndarray, trees: list[list[tuple]], weights: list[float]) -> np.ndarray:
    margin = np.zeros(len(rows))
    line = np.arange(len(rows))
    for tree, weight in zip(trees, weights):
        feature, threshold, left, right, value = (np.array(c) for c in zip(*tree))
        at = np.zeros(len(rows), dtype=int)
        for _ in range(DEPTH):
            low = rows[line, np.maximum(feature[at], 0)] <= threshold[at]
            at = np.where(low, left[at], right[at])
        margin += weight * value[at]
    return 1 / (1 + np.exp(-2 * margin))


def added_spans(text: str, base: list[Span], model: Model) -> list[Span]:
    """The best candidates above their thresholds that overlap no base span and no better one."""
    trees, weights, thresholds = model
    if not thresholds:
        return []
    cover = Cover(base)
    spans = sorted(s for s in candidates(text) if s[0] in thresholds and not cover.touches(s))
    if not spans:
        return []
    scores = probabilities(np.array([span_features(text, s) for s in spans]), trees, weights)
    chosen: list[Span] = []
    for score, span in sorted(zip(scores, spans), key=lambda x: (-x[0], x[1])):
        if score >= thresholds[span[0]] and not cover.touches(span):
            chosen.append(span)
            cover.add(span)
    return chosen


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

COLUMNS = [c.split()[0] for c in FOUND.split(", ")]


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``(row, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` of every document.

    The counts are those of the base spans; ``row`` is the whole input row.
    """
    known = docs.sparkSession.sparkContext.broadcast(fit(docs) if model is None else model)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64()]
        names = ["row", *COLUMNS]
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                more = added_spans(text or "", base, known.value)
                counts = [sum(s[0] == k for s in base) for k in KINDS]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                out.append((*counts, digest, joined(base + more), len(more)))
            columns = list(zip(*out)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, {FOUND}")


def redact(text: str, spans: str) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, done = [], 0
    for span in sorted((s.split(":") for s in spans.split(",") if s), key=lambda s: (int(s[1]), -int(s[2]))):
        kind, start, end = span[0], int(span[1]), int(span[2])
        if start >= done:
            out += [text[done:start], f"[{kind}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])
