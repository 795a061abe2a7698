"""Merkle manifest of a data set: digests, proofs and their check.

Leaves are the rows; the leaves of a group, in order, form a tree, and the groups'
subroots, in order, form the tree on top.  A run of ``FANOUT`` consecutive nodes
has a parent, whose digest is that of the run's digests; the last run may be
shorter, even a single node.

Every node is labelled with the interval ``[lo, hi)`` of leaf ranks that it covers,
so intervals of a tree are nested or apart.  ``STRIDE`` levels form a block: a node
and the at most ``FANOUT ** STRIDE`` nodes that many levels below, its members.
Bottom up, members are grouped by ``lo`` cut to the block's width, and the block's
digest is folded from theirs.  Top down, a containment join, bucketed by level and
by the same cut, attaches to every block the member above whose interval holds the
block's, with that one's path, so all ancestors.  Inside a block, what an ancestor's
interval holds to the left and to the right of the member are the siblings on the
way up.  No group or key has more than ``FANOUT ** STRIDE`` rows, and a path is
moved once per block and not once per leaf.

Ranks come from ``ordered_scan``, so a group with a third of all rows is cut into
pieces.  Texts are read once, for their digests; only digests are moved.

Defined results: nulls are encoded as such; leaves ascend by ``doc_id``, nulls
first, ties by digest, so equal rows are neighbours and each has a proof; the group
without a name comes first; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.operators.ordered import ordered_scan
from salescope.session import durable

# ---- fixed values ----
FANOUT = 3
# ---- end of fixed values ----
STRIDE = 4  # levels of a block
LEVELS = 39  # 3 ** 39 still fits a rank
NO_PATH = "CAST(array() AS array<struct<left:string,right:string>>)"


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a row."""
    return F.sha2(F.concat(*map(encoded, (doc_id, source, lang, n_chars, text))), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, digest, lambda own, step: F.sha2(F.concat(step["left"], own, step["right"]), 256))


def height(leaves: Column) -> Column:
    """Levels above the leaves until one node is left."""
    powers = F.array(*[F.lit(FANOUT**k).cast("long") for k in range(LEVELS)])
    return F.size(F.filter(powers, lambda power: power < leaves))


def labelled(leaves: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Leaves ``(tree, digest, carried, ...)`` as nodes ``(tree, leaves, lo, hi, digest, carried)``."""
    ranked = ordered_scan(
        leaves, [*order, F.col("digest")], by=["tree"], row_number="hi", totals={"leaves": F.lit(1).cast("long")}
    )
    return ranked.select("tree", "leaves", (F.col("hi") - 1).alias("lo"), "hi", "digest", "carried")


def _parents(nodes: Column) -> Column:
    runs = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(nodes) / FANOUT).cast("int") - 1),
        lambda i: F.slice(nodes, i * FANOUT + 1, FANOUT),
    )
    return F.transform(
        runs,
        lambda run: F.struct(
            run[0]["lo"].alias("lo"),
            F.element_at(run, -1)["hi"].alias("hi"),
            F.sha2(F.concat_ws("", run["digest"]), 256).alias("digest"),
        ),
    )


def _with_levels(blocks: DataFrame) -> DataFrame:
    """Add the nodes inside the blocks, ``l0`` (the members) to ``l<STRIDE>``, as far as the tree goes."""
    members = F.transform("members", lambda m: F.struct(*[m[c].alias(c) for c in ("lo", "hi", "digest")]))
    out = blocks.withColumn("l0", members)
    for k in range(1, STRIDE + 1):
        out = out.withColumn(f"l{k}", F.when(F.col("levels") >= k, _parents(F.col(f"l{k - 1}"))))
    return out


def _blocks(nodes: DataFrame, level: int) -> DataFrame:
    """``(tree, leaves, levels, lo, hi, digest, members)`` over the nodes of a level."""
    width = FANOUT ** (level + STRIDE)
    start = (F.col("lo") - F.col("lo") % width).alias("start")
    out = nodes.groupBy("tree", "leaves", start).agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi", "digest", "carried"))).alias("members")
    )
    out = out.withColumn("levels", F.least(height(F.col("leaves")) - level, F.lit(STRIDE)))
    top = F.coalesce(*[F.col(f"l{k}") for k in range(STRIDE, -1, -1)])[0]
    out = _with_levels(out).withColumns({c: top[c] for c in ("lo", "hi", "digest")})
    return durable(out.select("tree", "leaves", "levels", "lo", "hi", "digest", "members"))


def grow(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of all trees, bottom up: entry ``k`` has the levels from ``k * STRIDE`` on."""
    out = [_blocks(nodes, 0)]
    most = out[0].agg(F.max("leaves")).first()[0] or 0
    while FANOUT ** (STRIDE * len(out)) < most:
        level = STRIDE * len(out)
        up = out[-1].filter(height(F.col("leaves")) > level)
        out.append(_blocks(up.select("tree", "leaves", "lo", "hi", "digest", F.lit(None).alias("carried")), level))
    return out


def roots(blocks: Sequence[DataFrame]) -> DataFrame:
    """``(tree, leaves, at, digest)``: the root of every tree; ``at`` is its entry of ``blocks``."""
    out = None
    for at, table in enumerate(blocks):
        tops = table.filter(height(F.col("leaves")) <= STRIDE * (at + 1))
        tops = tops.select("tree", "leaves", F.lit(at).alias("at"), "digest")
        out = tops if out is None else out.union(tops)
    return out


def _way_up(level: int) -> Column:
    """The siblings of ``member`` and of its ancestors inside the block, level by level."""
    lo, hi = F.col("member.lo"), F.col("member.hi")
    steps = []
    for k in range(STRIDE):
        width = FANOUT ** (level + k)
        parent = lo - lo % (FANOUT * width)
        first = F.expr(f"CAST(({FANOUT * width} * (member.lo div {FANOUT * width}) - lo) div {width} AS int)")
        run = F.filter(
            F.slice(F.col(f"l{k}"), first + 1, FANOUT),
            lambda node: (node["lo"] >= parent) & (node["hi"] <= parent + FANOUT * width),
        )
        step = F.struct(
            F.concat_ws("", F.filter(run, lambda node: node["hi"] <= lo)["digest"]).alias("left"),
            F.concat_ws("", F.filter(run, lambda node: node["lo"] >= hi)["digest"]).alias("right"),
        )
        steps.append(F.when(F.col("levels") > k, step))
    return F.filter(F.array(*steps), lambda step: step.isNotNull())


def descend(blocks: Sequence[DataFrame], heads: DataFrame) -> DataFrame:
    """``(tree, lo, digest, carried, path, names)`` of every leaf.

    ``heads(tree, leaves, at, path, names)`` says how every tree goes on above its
    root; ``names`` is handed down as it is.
    """
    above = None
    for at in reversed(range(len(blocks))):
        level = at * STRIDE
        width = FANOUT ** (level + STRIDE)
        held = heads.filter(F.col("at") == at).select(
            "tree", F.lit(0).cast("long").alias("lo"), F.col("leaves").alias("hi"), "path", "names"
        )
        held = held if above is None else held.union(above)
        held = held.select(
            F.col("tree").alias("held_tree"),
            (F.col("lo") - F.col("lo") % width).alias("held_bucket"),
            F.col("lo").alias("held_lo"),
            F.col("hi").alias("held_hi"),
            F.col("path").alias("held_path"),
            "names",
        )
        bucket = F.col("lo") - F.col("lo") % width
        contained = (F.col("held_lo") <= F.col("lo")) & (F.col("hi") <= F.col("held_hi"))
        same = (F.col("tree") == F.col("held_tree")) & (bucket == F.col("held_bucket"))
        rows = _with_levels(blocks[at].join(held, same & contained))
        rows = rows.select("*", F.explode("members").alias("member")).withColumn("inner", _way_up(level))
        found = rows.select(
            "tree",
            "member.lo",
            "member.hi",
            "member.digest",
            "member.carried",
            F.concat("inner", "held_path").alias("path"),
            "names",
        )
        if at:
            above = durable(found.select("tree", "lo", "hi", "path", "names"))
    return found.drop("hi")


def manifest(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """``(doc_id, leaf, subroot, root, path, claimed, folded_root, verified)`` of every row.

    ``path`` is the proof: per level the digests to the left and to the right.
    ``claimed`` is the leaf that a holder of the row presents (the true one by
    default); ``folded_root`` is what it and the path lead to.
    """
    source = docs["source"].cast("string")
    true = leaf(*[docs[c] for c in ("doc_id", "source", "lang", "n_chars", "text")])
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"),
        docs["doc_id"].alias("doc_id"),
        true.alias("digest"),
        (true if claimed is None else claimed).alias("claimed"),
    )
    # Most claims are the leaf itself, which need not be carried twice.
    other = F.when(F.col("claimed") != F.col("digest"), F.col("claimed")).alias("claimed")
    leaves = leaves.select("tree", "doc_id", "digest", F.struct("doc_id", other).alias("carried"))
    groups = grow(labelled(leaves, [F.col("doc_id")]))
    subroots = durable(roots(groups))

    tops = subroots.select(
        F.lit("").alias("tree"),
        # No source has an empty name here and others begin with "=", so it is first.
        F.col("tree").alias("name"),
        "digest",
        F.struct("tree", "leaves", "at").alias("carried"),
    )
    above = grow(labelled(tops, [F.col("name")]))
    crown = roots(above).withColumn("path", F.expr(NO_PATH)).withColumn("names", F.struct(F.col("digest").alias("root")))
    heads = descend(above, crown).select(
        "carried.*", "path", F.struct(F.col("digest").alias("subroot"), "names.root").alias("names")
    )
    found = descend(groups, durable(heads))
    presented = F.coalesce("carried.claimed", "digest")
    folded = found.withColumn("claimed", presented).withColumn("folded_root", fold(F.col("claimed"), F.col("path")))
    return folded.select(
        "carried.doc_id",
        F.col("digest").alias("leaf"),
        "names.subroot",
        "names.root",
        "path",
        "claimed",
        "folded_root",
        (F.col("folded_root") == F.col("names.root")).alias("verified"),
    )


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, level by level, left to right."""
    sides = F.transform(path, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(sides, ""), 256)
