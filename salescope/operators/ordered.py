"""Running totals, ranks and exact quantiles without a single-task window.

A window without a partition key sends every row to one task, and a window
over a hot key sends that key's rows to one task.  ``ordered_scan`` instead
range-partitions the rows on ``(by, order)``, so one group may spread over any
number of partitions.  Each partition is scanned on its own, and the little
that has to be carried from one partition to the next (one row per partition
boundary) is broadcast back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from salescope.session import durable

PART = "__part"


def ordered_scan(
    df: DataFrame,
    order: Sequence[Column],
    *,
    by: Sequence[str] = (),
    running: Mapping[str, Column] | None = None,
    totals: Mapping[str, Column] | None = None,
    row_number: str | None = None,
    dense_rank: tuple[str, str] | None = None,
    unwanted: Column | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add order-dependent columns to ``df``.

    ``order`` must be unique within ``by`` for the result to be deterministic.

    running     name -> column summed over the rows up to and including this one
    totals      name -> column summed over the whole ``by`` group
    row_number  name of a 1-based position column
    dense_rank  (value column, name): rank without gaps of a column that is
                the first entry of ``order``
    unwanted    leave out the pieces of a cut group for which this holds; it may
                use ``<running>_before`` and ``<running>_after`` (the sums up to
                the piece and including it) and the totals
    partitions  number of range partitions; by default Spark decides
    """
    by = list(by)
    keys = [F.col(c) for c in by] + list(order)
    laid = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    tagged = durable(laid).withColumn(PART, F.spark_partition_id())

    sums = {name: col for name, col in (running or {}).items()}
    if row_number:
        sums[row_number] = F.lit(1).cast("long")
    whole = dict(totals or {})
    tagged = tagged.withColumns(
        {f"__run_{n}": c for n, c in sums.items()} | {f"__tot_{n}": c for n, c in whole.items()}
    )

    carried = _carry(tagged, by, list(sums), list(whole), dense_rank, unwanted)

    local = Window.partitionBy(PART, *by)
    upto = local.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = tagged.join(F.broadcast(carried), [PART, *by], "left")
    if unwanted is not None:
        out = out.filter(~F.coalesce(F.col("__unwanted"), F.lit(False)))
    columns: dict[str, Column] = {}
    for name in sums:
        here = F.sum(f"__run_{name}").over(upto)
        columns[name] = here + F.coalesce(F.col(f"__off_{name}"), F.lit(0))
    for name in whole:
        columns[name] = F.coalesce(F.col(f"__all_{name}"), F.sum(f"__tot_{name}").over(local))
    if dense_rank:
        value, name = dense_rank
        here = F.dense_rank().over(local.orderBy(*order[:1]))
        columns[name] = (here + F.coalesce(F.col("__off_dense"), F.lit(0))).cast("long")
    return out.select(*df.columns, *[c.alias(n) for n, c in columns.items()])


def _carry(tagged, by, sums, whole, dense, unwanted):
    """What every partition needs to know about the ones before it.

    Only groups that cross a partition boundary are kept, so there are at most
    two rows per partition whatever the number of groups; that bound is what
    makes the broadcast in ``ordered_scan`` safe.
    """
    parts = [F.sum(f"__run_{n}").alias(f"__run_{n}") for n in sums]
    parts += [F.sum(f"__tot_{n}").alias(f"__tot_{n}") for n in whole]
    if dense:
        value = F.col(dense[0])
        parts += [
            F.count_distinct(value).alias("__distinct"),
            F.min(value).alias("__low"),
            F.max(value).alias("__high"),
        ]
    chunks = tagged.groupBy(PART, *by).agg(F.count(F.lit(1)).alias("__rows"), *parts)

    # One row per (partition, group): a window here is over partitions.
    group = Window.partitionBy(*by)
    before = group.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    columns = {f"__off_{n}": F.sum(f"__run_{n}").over(before) for n in sums}
    columns |= {f"__all_{n}": F.sum(f"__tot_{n}").over(group) for n in whole}
    columns["__pieces"] = F.count(F.lit(1)).over(group)
    if dense:
        # A value cut by the boundary was already counted by the partition before.
        cut = (F.lag("__low").over(group.orderBy(PART)) == F.col("__high")) | (
            F.lag("__high").over(group.orderBy(PART)) == F.col("__low")
        )
        columns["__cut"] = F.coalesce(cut, F.lit(False)).cast("long")
    carried = chunks.withColumns(columns).filter("__pieces > 1")
    if dense:
        upto = group.orderBy(PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        carried = carried.withColumn(
            "__off_dense",
            F.coalesce(F.sum("__distinct").over(before), F.lit(0)) - F.sum("__cut").over(upto),
        )
    if unwanted is not None:
        seen = {f"{n}_before": F.coalesce(F.col(f"__off_{n}"), F.lit(0)) for n in sums}
        carried = carried.withColumns(seen | {n: F.col(f"__all_{n}") for n in whole})
        carried = carried.withColumns(
            {f"{n}_after": F.col(f"{n}_before") + F.col(f"__run_{n}") for n in sums}
        ).withColumn("__unwanted", unwanted)
    keep = ["__unwanted"] if unwanted is not None else []
    keep += [f"__off_{n}" for n in sums] + [f"__all_{n}" for n in whole]
    keep += ["__off_dense"] if dense else []
    return carried.select(PART, *by, *keep)


BUCKET_ROWS = 1 << 16


def over_previous(
    df: DataFrame,
    order: Sequence[Column],
    reach: int,
    columns: Callable[[WindowSpec], Mapping[str, Column]],
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add window columns that look at the row and at most ``reach`` rows before it.

    ``columns`` gets the ordered window to build them on.  The rows are numbered
    by an ordered scan and cut into buckets; each bucket also gets the last
    ``reach`` rows of the one before, so no task holds more than a few buckets,
    whatever the number of rows.
    """
    numbered = ordered_scan(df, order, row_number="__row")
    size = max(bucket_rows, reach, 1)
    place = F.col("__row") - 1
    own = F.floor(place / size)
    late = place % size >= size - reach
    copies = F.when(late, F.array(own, own + 1)).otherwise(F.array(own))
    spread = numbered.select("*", own.alias("__own"), F.explode(copies).alias("__bucket"))
    window = Window.partitionBy("__bucket").orderBy("__row")
    out = spread.withColumns(dict(columns(window)))
    return out.filter(F.col("__own") == F.col("__bucket")).drop("__row", "__own", "__bucket")


def value_counts(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    squash: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``(by, metric, value, n)`` for several numeric columns in one pass.

    Counting happens before the shuffle, so a value shared by a third of the
    rows costs one row per task.  ``squash`` may replace a column's values.
    """
    values = {c: F.col(c).cast("double") for c in columns} | dict(squash or {})
    pairs = [F.struct(F.lit(c).alias("metric"), v.alias("value")) for c, v in values.items()]
    long = df.select(*by, F.explode(F.array(*pairs)).alias("__p")).select(
        *by, F.col("__p.metric").alias("metric"), F.col("__p.value").alias("value")
    )
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by], F.col("value").isNotNull())
    return long.filter(known).groupBy(*by, "metric", "value").agg(F.count(F.lit(1)).alias("n"))


# percentile_approx is off by at most n / SKETCH positions, and interpolation
# needs the position on either side, so a bracket of +-margin around a quantile
# surely holds it when margin >= 1 / SKETCH + 2 / n.  The sketch is asked for all
# margins at once and each column takes the narrowest that is safe for its n; the
# widest spans all values.
SKETCH = 10_000
MARGINS = (5e-4, 5e-3, 5e-2, 1.0)


def _squash_far_values(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, Column]:
    """Per column, an expression that merges values far from every wanted position.

    A sketch brackets each position; values between two brackets become the
    upper edge of the lower one.  Order and counts around the wanted positions
    stay exact, and only about 0.1 % of the distinct values reach the shuffle.
    """
    def clamp(p: float) -> float:
        return min(max(p, 0.0), 1.0)

    edges = sorted({clamp(p + d) for p in probabilities for m in MARGINS for d in (-m, m)})
    asked = []
    for c in columns:
        asked += [
            F.count(c).alias(f"n_{c}"),
            F.percentile_approx(F.col(c).cast("double"), edges, SKETCH).alias(f"e_{c}"),
        ]
    found = df.agg(*asked).first()
    position = {p: i for i, p in enumerate(edges)}
    out = {}
    for c in columns:
        edge, n = found[f"e_{c}"], found[f"n_{c}"]
        if not n:
            continue
        margin = next((m for m in MARGINS if m >= 1 / SKETCH + 2 / n), MARGINS[-1])
        value = F.col(c).cast("double")
        squashed = F.lit(float("-inf"))
        for p in sorted(probabilities):
            low, high = edge[position[clamp(p - margin)]], edge[position[clamp(p + margin)]]
            squashed = F.when(value >= low, F.least(value, F.lit(high))).otherwise(squashed)
        out[c] = F.when(value.isNotNull(), squashed)
    return out


# The same per group, for groups large enough to be worth it; there are at most
# rows / LARGE_GROUP of them.  MARGIN >= 1 / GROUP_SKETCH + 2 / LARGE_GROUP.
GROUP_SKETCH = 1_000
GROUP_MARGIN = 2e-3
LARGE_GROUP = 4_000


def _squash_far_values_by_group(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str]
) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with the brackets of its large groups, and per column the expression that uses them.

    Values of small groups, of which little would be saved, stay as they are.
    """
    wanted = sorted(probabilities)
    edges = [min(max(p + d, 0.0), 1.0) for p in wanted for d in (-GROUP_MARGIN, GROUP_MARGIN)]
    asked = []
    for c in columns:
        asked += [
            F.count(c).alias(f"__n_{c}"),
            F.percentile_approx(F.col(c).cast("double"), edges, GROUP_SKETCH).alias(f"__e_{c}"),
        ]
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])
    sizes = reduce(F.greatest, [F.col(f"__n_{c}") for c in columns]) if len(columns) > 1 else F.col(f"__n_{columns[0]}")
    found = durable(df.filter(known).groupBy(*by).agg(*asked).filter(sizes >= LARGE_GROUP))
    bracketed = df.join(found.withColumnsRenamed({c: f"__by_{c}" for c in by}), [F.col(c) == F.col(f"__by_{c}") for c in by], "left")
    out = {}
    for c in columns:
        value, edge = F.col(c).cast("double"), F.col(f"__e_{c}")
        squashed = F.lit(float("-inf"))
        for k in range(len(wanted)):
            squashed = F.when(value >= edge[2 * k], F.least(value, edge[2 * k + 1])).otherwise(squashed)
        large = F.coalesce(F.col(f"__n_{c}") >= LARGE_GROUP, F.lit(False))
        out[c] = F.when(value.isNotNull(), F.when(large, squashed).otherwise(value))
    return bracketed, out


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Exact, linearly interpolated quantiles of several columns.

    Returns one row per ``by`` group with columns ``<column>_<quantile name>``
    (one row in all when ``by`` is empty).  No task holds a whole group: the
    distinct values are range-partitioned and only the few rows that cover a
    wanted position are kept.
    """
    if by:
        df, squash = _squash_far_values_by_group(df, columns, list(quantiles.values()), by)
    else:
        squash = _squash_far_values(df, columns, list(quantiles.values()))
    counts = value_counts(df, columns, by, squash)
    positions = {n: (F.col("total") - 1) * F.lit(float(q)) for n, q in quantiles.items()}

    def holds(position: Column, first: Column, last: Column) -> Column:
        return (first <= position) & (position <= last)

    def wanted(first: Column, last: Column) -> Column:
        hits = [
            holds(edge(p), first, last) for p in positions.values() for edge in (F.floor, F.ceil)
        ]
        return reduce(lambda a, b: a | b, hits)

    # Of a group cut by partitions, only the pieces with a wanted position are scanned.
    scan = ordered_scan(
        counts,
        [F.col("value")],
        by=[*by, "metric"],
        running={"upto": F.col("n")},
        totals={"total": F.col("n")},
        unwanted=~wanted(F.col("upto_before"), F.col("upto_after") - 1),
        partitions=partitions,
    )
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    picks = []
    for name, position in positions.items():
        low, high = F.floor(position), F.ceil(position)
        for column in columns:
            mine = F.col("metric") == column
            below = mine & holds(low, first, last)
            above = mine & holds(high, first, last)
            picks += [
                F.max(F.when(below, F.col("value"))).alias(f"__lo_{column}_{name}"),
                F.max(F.when(above, F.col("value"))).alias(f"__hi_{column}_{name}"),
                F.max(F.when(mine, position - low)).alias(f"__w_{column}_{name}"),
            ]
    rows = scan.filter(wanted(first, last))
    picked = rows.groupBy(*by).agg(*picks) if by else rows.agg(*picks)
    out = []
    for column in columns:
        for name in quantiles:
            lo, hi = F.col(f"__lo_{column}_{name}"), F.col(f"__hi_{column}_{name}")
            weight = F.col(f"__w_{column}_{name}")
            out.append((lo + (hi - lo) * weight).alias(f"{column}_{name}"))
    return picked.select(*by, *out)


def average_ranks(df: DataFrame, value: str, weight: str, rank: str) -> DataFrame:
    """``(value, rank)``: the mean position of each distinct value, ties shared.

    ``weight`` holds how many rows carry the value.
    """
    sizes = df.groupBy(value).agg(F.sum(weight).alias("__n"))
    scan = ordered_scan(sizes, [F.col(value)], running={"__upto": F.col("__n")})
    return scan.select(value, (F.col("__upto") - (F.col("__n") - 1) / 2).alias(rank))
