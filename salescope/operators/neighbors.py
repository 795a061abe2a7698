"""Exact nearest rows by cosine or Euclidean distance, for any number of queries.

Both sides are partitioned tables; only some pivots and one line of figures per
pivot reach the driver.  Rows belong to the cell of their nearest pivot.  A query
first looks into the nearest cells that hold ``k`` rows; the distance of its k-th
row there bounds how far it must look.  It then visits the cells that may hold a
nearer one: the triangle inequality, with a cell's smallest and largest distance
from its pivot and with the query's own nearest pivot, says which.  The result is
exact whatever the pivots.

Equal vectors are one row with its first ``k`` keys, and one query for all that ask
it, so a vector that a third of all rows share costs no more than others.  Cells
and their visitors are cut into parts of about ``PART``, and a pair of parts is one
task's work; it returns ``k`` rows per query.

Cosine distances are Euclidean ones of unit vectors.  A vector of zeros is at
distance 1 from everything, itself included.  Rows and queries whose vector is
null, empty or holds null or non-finite components have no neighbours; vectors of
different lengths are an error.  Ties in distance are decided by key.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.session import durable

# ---- fixed values ----
NEIGHBORS = 5
METRICS = ("cosine", "euclidean")
# ---- end of fixed values ----
DIGITS = 9  # distances closer than this are ties, decided by key
PIVOTS = 2048  # at most; about the square root of the number of different vectors
PART = 2048
CHUNK = 256  # queries compared at a time
SLACK = 1e-7  # of the largest length, far above the rounding of distances

# The functions below travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def kneighbors(
    df: DataFrame,
    key: str,
    vector: str,
    queries: DataFrame,
    query_key: str,
    k: int = NEIGHBORS,
    metric: str = "cosine",
    pivots: int | None = None,
    part: int = PART,
) -> DataFrame:
    """``(query key, key, distance, rank)``: the ``k`` nearest rows of each query.

    ``vector`` is an array column of both frames, ``key`` a unique text or
    number column.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {', '.join(METRICS)}")
    cosine = metric == "cosine"
    asked = durable(_points(queries, query_key, vector, cosine, 1))
    wanted = durable(asked.select("v").distinct()).withColumn("q", F.monotonically_increasing_id())
    first = F.row_number().over(Window.partitionBy("v").orderBy("name"))
    named = _points(df, key, vector, cosine, 0).withColumn("n", first).filter(F.col("n") <= k)
    rows = named.groupBy("v").agg(F.array_sort(F.collect_list("name")).alias("names"))
    rows = durable(rows).withColumn("id", F.monotonically_increasing_id())
    _one_length(rows, wanted)

    count = rows.count()
    chosen = pivots or min(PIVOTS, max(1, int(count**0.5)))
    centres = np.array([r[0] for r in rows.orderBy(F.xxhash64("v"), "id").limit(chosen).select("v").collect()])
    cells = durable(_placed(rows, centres))
    figures = cells.groupBy("cell").agg(
        F.sum(F.size("names")).alias("names"), F.min("away").alias("low"), F.max("away").alias("high"),
        F.count(F.lit(1)).alias("rows"),
    )
    figures = durable(figures)
    known = {r.cell: (r.names, r.low, r.high) for r in figures.select("cell", "names", "low", "high").collect()}

    def best(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("q").orderBy("distance", "name")).cast("long")
        return found.withColumn("rank", rank).filter(F.col("rank") <= k)

    near = _visits(wanted.withColumn("bound", F.lit(None).cast("double")), centres, known, k, cosine)
    start = durable(best(_compared(cells, figures, near, k, cosine, part)))
    bounds = start.groupBy("q").agg(F.when(F.count(F.lit(1)) == k, F.max("distance")).alias("bound"))
    bounds = wanted.join(bounds, "q", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    rest = _visits(bounds, centres, known, k, cosine)
    more = _compared(cells, figures, rest, k, cosine, part)
    final = best(start.select("q", "name", "distance").union(more))
    named = asked.join(wanted, "v").select("q", F.col("name").alias("asked"))
    return named.join(final, "q").select(
        F.col("asked").alias(query_key), F.col("name").alias(key), "distance", "rank"
    )


def _points(df: DataFrame, key: str, vector: str, cosine: bool, axis: int) -> DataFrame:
    """``(name, v)`` of the usable rows; for cosine, unit vectors.

    A zero vector gets an axis of its own, another one among queries, so it is at
    right angles to everything.
    """
    v = F.col("v")
    rows = df.select(F.col(key).alias("name"), F.col(vector).cast("array<double>").alias("v"))
    usable = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.coalesce(usable, F.lit(False)))
    plain = F.transform(v, lambda x: x + F.lit(0.0))  # no negative zero
    if not cosine:
        return rows.withColumn("v", plain)
    largest = F.array_max(F.transform(v, F.abs))
    rows = rows.withColumn("scaled", F.transform(plain, lambda x: x / F.greatest(largest, F.lit(5e-324))))
    length = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x * x))
    rows = rows.withColumn("length", length)
    unit = F.concat(F.transform("scaled", lambda x: x / F.col("length")), F.array(F.lit(0.0), F.lit(0.0)))
    zero = F.concat(F.transform(v, lambda x: F.lit(0.0)), F.array(F.lit(1.0 - axis), F.lit(float(axis))))
    return rows.select("name", F.when(F.col("length") > 0, unit).otherwise(zero).alias("v"))


def _one_length(*sides: DataFrame) -> None:
    lengths = set()
    for side in sides:
        low, high = side.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
        lengths |= {low, high} - {None}
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {', '.join(map(str, sorted(lengths)))}")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, rows by rows."""
    squares = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def _placed(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """``(id, v, names, cell, away)``: the nearest pivot and the distance from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = _matrix(batch.column(1))
                far = _apart(points, centres)
                cell = far.argmin(axis=1)
                # Not by the products, which lose the digits of short distances.
                away = np.sqrt(((points - centres[cell]) ** 2).sum(axis=1))
                added = [pa.array(cell.astype(np.int32)), pa.array(away)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], ["id", "v", "names", "cell", "away"])

    names = rows.schema["names"].dataType.simpleString()
    return rows.select("id", "v", "names").mapInArrow(
        run, f"id long, v array<double>, names {names}, cell int, away double"
    )


def _visits(wanted: DataFrame, centres: np.ndarray, known: dict, k: int, cosine: bool) -> DataFrame:
    """``(q, v, cell)`` of the queries ``(q, v, bound)``.

    Without a bound, the nearest cells that hold ``k`` rows; with one, the others
    that may hold a row within it.
    """
    used = np.array(sorted(known), dtype=np.int64)
    names, low, high = (np.array([known[c][i] for c in used.tolist()], dtype=float) for i in range(3))
    size = (np.linalg.norm(centres, axis=1).max() if len(centres) else 0.0) + high.max(initial=0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not len(used):
                continue
            points = _matrix(batch.column(1))
            far = np.concatenate(
                [np.sqrt(((points[i : i + 64, None] - centres[None, used]) ** 2).sum(axis=2)) for i in range(0, len(points), 64)]
            )
            order = far.argsort(axis=1, kind="stable")
            held = names[order].cumsum(axis=1)
            early = np.zeros(far.shape, dtype=bool)
            np.put_along_axis(early, order, held - names[order] < k, axis=1)
            bound = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            if np.isnan(bound).all():
                mask = early
            else:
                reach = (np.sqrt(2 * np.maximum(bound, 0)) if cosine else bound)[:, None]
                reach = reach + SLACK * (1 + size + np.linalg.norm(points, axis=1)[:, None])
                least = np.maximum(far - high, low - far)
                least = np.maximum(least, (far - far.min(axis=1, keepdims=True)) / 2)
                mask = ~early & (least <= reach)
            q, cell = np.nonzero(mask)
            taken = batch.take(pa.array(q))
            arrays = [taken.column(0), taken.column(1), pa.array(used[cell].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["q", "v", "cell"])

    return durable(wanted.select("q", "v", "bound").mapInArrow(run, "q long, v array<double>, cell int"))


def _compared(cells: DataFrame, figures: DataFrame, visits: DataFrame, k: int, cosine: bool, part: int) -> DataFrame:
    """``(q, name, distance)``: per pair of parts and query, the ``k`` nearest rows."""

    def cut(column: str) -> Column:
        return F.ceil(F.col(column) / part).cast("int")

    sizes = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("visitors"))
    sizes = durable(sizes.join(figures.select("cell", "rows"), "cell").select("cell", cut("visitors").alias("i"), cut("rows").alias("j")))

    def dealt(side: DataFrame, number: str, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(number), F.col(own)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        kept = [c for c in side.columns if c not in ("cell", "away")]
        return side.join(sizes, "cell").select("cell", mine, every, *kept).groupBy("cell", "i", "j")

    name = cells.schema["names"].dataType.elementType

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q, names, far = [], [], []
        if left.num_rows and right.num_rows:
            points, asked = _matrix(right.column("v")), _matrix(left.column("v"))
            ids, known = left.column("q").to_numpy(), right.column("names").to_pylist()
            for at in range(0, len(asked), CHUNK):
                found = _distances(asked[at : at + CHUNK], points, cosine)
                for query, distances in zip(ids[at : at + CHUNK].tolist(), found):
                    for distance, one in _nearest(distances, known, k):
                        q.append(query)
                        names.append(one)
                        far.append(distance)
        kind = right.schema.field("names").type.value_type
        arrays = [pa.array(q, pa.int64()), pa.array(names, kind), pa.array(far, pa.float64())]
        return pa.Table.from_arrays(arrays, ["q", "name", "distance"])

    asks, answers = dealt(visits, "q", "i", "j"), dealt(cells, "id", "j", "i")
    return asks.cogroup(answers).applyInArrow(run, f"q long, name {name.simpleString()}, distance double")


def _distances(queries: np.ndarray, rows: np.ndarray, cosine: bool) -> np.ndarray:
    if cosine:
        far = 1.0 - queries @ rows.T
    else:
        # One query at a time: the memory needed stays that of the rows.
        far = np.stack([np.sqrt(((rows - query) ** 2).sum(axis=1)) for query in queries])
    return np.round(far, DIGITS) + 0.0


def _nearest(far: np.ndarray, names: list, k: int) -> list[tuple]:
    """The first ``k`` of all names by distance and name; ``names`` has those of each row, sorted."""
    at = np.arange(len(far))
    if len(far) > k:
        at = np.flatnonzero(far <= np.partition(far, k - 1)[k - 1])
    return sorted((far[row].item(), name) for row in at.tolist() for name in names[row][:k])[:k]
