"""Embedding near-duplicates: spherical k-means cells, cosine products within cells.

Vectors with the same components are compared once, as one representative with
its number of copies.  A bounded sample fits the centres; every vector then gets
its nearest centre as home and also visits other cells near the border: cell
``c`` is visited by ``x`` with home ``h`` when ``x.h - x.c <= slack * r * |h - c| / 2``
with ``r = sqrt(2 - 2 * threshold)``, the largest distance of a linked pair.

Of a pair with homes ``h`` and ``c``, ``(x.h - x.c) + (y.c - y.h) <= r * |h - c|``,
so one of the two is within half of that: with ``slack = 1`` every link is found,
proved, at the price of more visits.  The default of 0.5 finds what is not built
to hide; the README has the measured recall.  Every pair that meets is computed
in double precision, so no link is below the threshold.

Only vectors of equal length are compared.  Every length has cells of its own: as
many as its vectors need, one for a length with few, ``MAX_CELLS`` in all but for
the last one of each length.  A cell's number is ``length * 2^SHIFT + cell``.

A cell's vectors are dealt into parts of about ``part`` rows by hash and every
pair of parts is one blocked product, so no task holds a whole hot cell.  A part
reports a count per vector and a spanning forest of its links, never all pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, nor do those of different lengths; a null takes part but names no component unless all in it are null; rows that repeat a
vector link with each other; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import components, stored
from salescope.session import durable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.95
SLACK = 0.5
CELL = 1024  # representatives per cell, about
MAX_CELLS = 4096  # centres that every task holds, at most about
SHIFT = 16  # bits of a cell's number within its length
SAMPLE = 32_768  # vectors that fit the centres, at most about
PART = 1024
ROUNDS = 8


def representatives(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with the key of their vector, and the distinct usable vectors.

    rows   ``(vec_id, key)``; the key is null where a vector can't link
    unique ``(key, v, first, copies)``: unit vectors, the smallest ``vec_id``
    """
    v = F.col("embedding").cast("array<double>")
    usable = (F.size(v) > 0) & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    usable = F.coalesce(usable, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id"), F.when(usable, v).alias("v"))
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # no negative zero
    key = F.when(
        F.col("v").isNotNull(),
        F.concat_ws("-", F.hex(F.xxhash64("v")), F.hex(F.xxhash64(F.lit("second"), "v"))),
    )
    rows = rows.withColumn("key", key)
    unique = rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.first("v").alias("v"), F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies")
    )
    unique = durable(unique).withColumn("node", F.monotonically_increasing_id())
    return rows.select("vec_id", "key"), unique


def unit(rows: np.ndarray) -> np.ndarray:
    # Scaled first, so that very large and very small components don't overflow.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit(unique: DataFrame, cell: int) -> dict[int, np.ndarray]:
    """Per vector length, centres by spherical k-means over a sample of about ``SAMPLE`` vectors in all.

    Only lengths with more vectors than a cell holds have centres, at most ``MAX_CELLS`` lengths.
    """
    sizes = durable(unique.groupBy(F.size("v").alias("n")).count())
    total = sizes.agg(F.sum("count")).first()[0] or 0
    cell = max(cell, -(-total // MAX_CELLS))
    large = {r["n"]: r["count"] for r in sizes.filter(F.col("count") > cell).collect()}
    if not large:
        return {}
    share = min(1.0, SAMPLE / sum(large.values()))
    scale = 1 << 30
    chosen = unique.filter(F.size("v").isin(list(large)))
    chosen = chosen.filter(F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(scale)) < int(share * scale))
    sample = chosen.select("key", "v").toArrow().sort_by("key").column("v").combine_chunks()
    lengths = sample.value_lengths().to_numpy(zero_copy_only=False)
    centres = {}
    for n in np.unique(lengths):
        rows = unit(_matrix(sample.take(pa.array(np.flatnonzero(lengths == n)))))
        centres[int(n)] = _centres(rows, -(-large[int(n)] // cell))
    return centres


def _centres(rows: np.ndarray, cells: int) -> np.ndarray:
    pick = np.random.default_rng(1).permutation(len(rows))[:cells]
    centres = rows[pick]
    for _ in range(ROUNDS):
        home = np.concatenate([(rows[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(rows), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, home, rows)
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], centres)
    return centres


def place(unique: DataFrame, centres: dict[int, np.ndarray], threshold: float, slack: float) -> DataFrame:
    """``(node, copies, v, home, cells)``: home cell and all cells that hold the vector."""
    spark = unique.sparkSession
    known = spark.sparkContext.broadcast(centres)
    radius = float(np.sqrt(2 - 2 * threshold))

    def visits(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        near = rows @ centres.T
        home = near.argmax(axis=1)
        best = near[np.arange(len(rows)), home][:, None]
        own = centres[home]
        gaps = np.sqrt(np.maximum((own**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * own @ centres.T, 0))
        inside = best - near <= slack * radius / 2 * gaps
        inside[np.arange(len(rows)), home] = True
        return home, [np.flatnonzero(row) for row in inside]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for n in np.unique(lengths):
                own = batch.take(pa.array(np.flatnonzero(lengths == n)))
                rows = unit(_matrix(own.column(2)))
                home, cells = visits(rows, known.value.get(int(n), rows[:1]))
                first = int(n) << SHIFT
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column(0),
                        own.column(1),
                        pa.array(list(rows), pa.list_(pa.float64())),
                        pa.array(home + first, pa.int64()),
                        pa.array([c + first for c in cells], pa.list_(pa.int64())),
                    ],
                    ["node", "copies", "v", "home", "cells"],
                )

    rows = unique.select("node", "copies", "v")
    return rows.mapInArrow(run, "node long, copies long, v array<double>, home long, cells array<long>")


def compare(placed: DataFrame, threshold: float, part: int) -> DataFrame:
    """``(node, other, links)``: links a vector has in a part, and one node it is connected to."""
    sizes = stored(placed.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts")), "cells")
    visits = placed.select("*", F.explode("cells").alias("cell"))
    visits = visits.join(sizes.withColumnRenamed("home", "cell"), "cell")
    own = F.pmod(F.xxhash64("node"), "parts").cast("int")
    at_home = F.col("cell") == F.col("home")
    # A pair of parts (i, j) of a cell compares visitors and residents of i with residents of j.
    visits = visits.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asks = visits.select("cell", F.col("own").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"), "*")
    answers = visits.filter(at_home & (F.col("own") != F.col("other")))
    answers = answers.select("cell", F.col("other").alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), "*")
    fields = ["cell", "i", "j", "side", "node", "copies", "v", "home", "cells"]
    asks = asks.toDF(*[f"c{n}" for n in range(4)], *visits.columns).select(
        *[F.col(f"c{n}").alias(f) for n, f in enumerate(fields[:4])], *fields[4:]
    )
    answers = answers.toDF(*[f"c{n}" for n in range(4)], *visits.columns).select(
        *[F.col(f"c{n}").alias(f) for n, f in enumerate(fields[:4])], *fields[4:]
    )
    dealt = asks.union(answers).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            bounds = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
            for low, high in zip(bounds[:-1], bounds[1:]):
                key = tuple(keys[low])
                if key != current and rest:
                    yield _links(pa.Table.from_batches(rest), threshold)
                    rest = []
                current = key
                rest.append(batch.slice(low, high - low))
        if rest:
            yield _links(pa.Table.from_batches(rest), threshold)

    return dealt.mapInArrow(run, "node long, other long, links long")


def _links(table: pa.Table, threshold: float) -> pa.RecordBatch:
    """Compare the rows that ask with the residents of the answering part.

    The pair of parts (i, i) holds its residents once, on the asking side.
    """
    cell, i, j = (table.column(c)[0].as_py() for c in range(3))
    side = table.column("side").to_numpy()
    node = table.column("node").to_numpy()
    copies = table.column("copies").to_numpy()
    home = table.column("home").to_numpy()
    rows = _matrix(table.column("v").combine_chunks())
    cells = table.column("cells").to_pylist()
    ask = np.flatnonzero(side == 0)
    answer = np.flatnonzero(home == cell) if i == j else np.flatnonzero(side == 1)
    edges_a, edges_b = [], []
    links = np.zeros(len(node), dtype=np.int64)
    right = rows[answer].T
    for low in range(0, len(ask), 512):
        at = ask[low : low + 512]
        a, b = np.nonzero(rows[at] @ right >= threshold)
        a, b = at[a], answer[b]
        differs = node[a] != node[b]
        a, b = a[differs], b[differs]
        # Residents meet in both orders; a visitor's pair may meet in the other home too.
        away = home[a] != cell
        again = np.array([home[x] < cell and home[x] in cells[y] for x, y in zip(a[away], b[away])], dtype=bool)
        use = np.ones(len(a), dtype=bool)
        use[np.flatnonzero(away)[again]] = False
        a, b, away = a[use], b[use], away[use]
        np.add.at(links, a, copies[b])
        np.add.at(links, b[away], copies[a[away]])
        # One neighbour of every row and, for the visitors' sake, of every resident.
        edges_a.append(a)
        edges_b.append(b)
    a, b = np.concatenate(edges_a), np.concatenate(edges_b)
    a, b = _forest(len(node), a, b)
    counted = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([node[counted], node[a]]), pa.int64()),
            pa.array(np.concatenate([node[counted], node[b]]), pa.int64()),
            pa.array(np.concatenate([links[counted], np.zeros(len(a), np.int64)]), pa.int64()),
        ],
        ["node", "other", "links"],
    )


def _forest(size: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to the smallest row reachable, which connect what the given ones connect."""
    label = np.arange(size)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(size))
    return at, label[at]


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    slack: float = SLACK,
    cell: int = CELL,
    part: int = PART,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    rows, unique = representatives(vectors)
    rows = durable(rows)
    placed = durable(place(unique, fit(unique, cell), threshold, slack))
    parts = durable(compare(placed, threshold, part))
    links = parts.groupBy("node").agg(F.sum("links").alias("links")).filter("links > 0")
    edges = parts.filter("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b"))
    named = components(edges.distinct())
    found = links.join(named, "node", "full").select(
        "node", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component")
    )
    members = unique.select("node", "key", "first", "copies").join(found, "node", "left")
    members = members.withColumn("component", F.coalesce("component", "node"))
    smallest = members.groupBy("component").agg(F.min("first").alias("component_id"))
    names = members.join(smallest, "component").select(
        "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = rows.join(stored(names, "names"), "key", "left")
    alone = F.col("key").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
