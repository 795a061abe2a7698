"""Aggregates chosen by name, safe for hot groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.operators.ordered import exact_quantiles
from salescope.session import durable

AGGREGATES = ("sum", "mean", "median", "min", "max", "count", "std", "nunique")


def builtin(name: str, column: str) -> Column:
    """Every named aggregate but the median; NULLs are skipped, money adds up exactly."""
    if name == "sum":
        return F.coalesce(F.sum(column).cast("double"), F.lit(0.0))
    if name == "mean":
        return F.try_divide(F.sum(column).cast("double"), F.count(column))
    if name == "std":
        return F.stddev_samp(F.col(column).cast("double"))
    if name == "nunique":
        return F.count_distinct(column)
    return {"min": F.min, "max": F.max, "count": F.count}[name](column)


MASK_KEYS = 63  # whole numbers that the bits of a long tell apart
SALTS = 8  # parts of a key's values, so that a hot key has several tasks


def with_distinct_counts(
    df: DataFrame, by: Sequence[str], distinct: Mapping[str, str], aggregates: Sequence[Column]
) -> DataFrame:
    """Aggregates and exact distinct counts per key; ``distinct`` maps a name to a column.

    Whole numbers below ``MASK_KEYS`` are bits of one long per key, merged like a
    sum.  Any other value is a narrow row of its own, dealt by the key and a part
    of the values, so that a key's equal values meet and are counted once after
    one exchange; what follows is at most ``SALTS`` rows per key.
    """
    kinds = {c: t for c, t in df.dtypes}
    whole = {n for n, c in distinct.items() if kinds[c] in ("tinyint", "smallint", "int", "bigint")}
    wide = "bigint" if len(whole) == len(distinct) else "string"
    columns, pairs = [], []
    for k, (n, c) in enumerate(distinct.items()):
        far = F.col(c).isNotNull()
        if n in whole:
            near = F.col(c).between(0, MASK_KEYS - 1)
            bit = F.when(near, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(c).cast("int")))
            columns.append(F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)).alias(f"__near_{n}"))
            far = far & ~near
        pairs.append(F.struct(F.lit(k).alias("kind"), F.when(far, F.col(c).cast(wide)).alias("value")))
    sums = df.groupBy(*by).agg(*aggregates, *columns)
    keys = [F.col(c).alias(f"__by_{c}") for c in by]
    rows = df.select(*keys, F.explode(F.array(*pairs)).alias("__p")).filter("__p.value IS NOT NULL")
    own = [f"__by_{c}" for c in by]
    rows = rows.select(*own, "__p.kind", "__p.value", F.pmod(F.xxhash64("__p.value"), F.lit(SALTS)).alias("__salt"))
    # Equal values are neighbours of a sort, which holds less than a table of all values and can spill.
    dealt = Window.partitionBy(*own, "__salt", "kind").orderBy("value")
    first = rows.repartition(*own, "__salt").withColumn("__first", ~F.col("value").eqNullSafe(F.lag("value").over(dealt)))
    new = [F.count_if(F.col("__first") & (F.col("kind") == k)).alias(n) for k, n in enumerate(distinct)]
    parts = first.groupBy(*own, "__salt").agg(*new)
    counts = parts.groupBy(*own).agg(*[F.sum(n).alias(f"__far_{n}") for n in distinct])
    same = [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by]
    found = {n: F.coalesce(f"__far_{n}", F.lit(0)) for n in distinct}
    found = {n: c + F.col(f"__near_{n}") if n in whole else c for n, c in found.items()}
    plain = [c for c in sums.columns if not c.startswith("__near_")]
    out = sums.join(counts, same, "left").select(*plain, *[c.cast("bigint").alias(n) for n, c in found.items()])
    return durable(out)


def grouped(
    df: DataFrame, keys: Sequence[str], specs: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Aggregate per key; ``specs`` maps an output name to ``(column, aggregate)``.

    Rows with a NULL key are dropped.  Medians take the ordered-scan path and
    are joined on, because the built-in exact percentile holds a whole group
    in one task.
    """
    unknown = {agg for _, agg in specs.values()} - set(AGGREGATES)
    if unknown:
        raise ValueError(f"unknown aggregate: {', '.join(sorted(unknown))}")
    kept = df
    if keys:
        kept = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    plain = {name: spec for name, spec in specs.items() if spec[1] != "median"}
    medians = {name: column for name, (column, agg) in specs.items() if agg == "median"}
    # With medians only, a row count keeps groups whose values are all NULL.
    columns = [builtin(agg, c).alias(name) for name, (c, agg) in plain.items()]
    columns = columns or [F.count(F.lit(1)).alias("__rows")]
    out = kept.groupBy(*keys).agg(*columns)
    if medians:
        wanted = sorted(set(medians.values()))
        middle = exact_quantiles(kept, wanted, {"median": 0.5}, by=keys)
        middle = middle.select(
            *keys, *[F.col(f"{c}_median").alias(name) for name, c in medians.items()]
        )
        if keys:
            out = out.join(middle, list(keys), "left")
        else:
            row = middle.select(F.struct(*middle.columns).alias("m")).scalar()
            out = out.withColumns({n: row.getField(n) for n in medians})
    return out.select(*keys, *specs)
