"""Boosted trees for many fits at once, by histograms of binned inputs.

A run is one fit: a data set, the fold that it does not learn from, and settings.
All runs of a search, over all data sets, grow side by side, tree by tree.  Rows are
binned once and laid out in blocks of about ``BLOCK_ROWS``; a block carries what
every run predicts for its rows so far.  One Spark job per tree level sums the
gradient histograms of all open nodes of all runs, keyed ``(run, node)`` and
combined before the shuffle; the reducers choose the splits, and only the splits
reach the driver.  So thirty fits take the jobs of one.  A data set of a single
block has nothing to exchange: a task grows all trees of a run by the same
functions, one job does for all runs, and they are the same trees.

A run's first ``k`` trees are the fit with ``k`` trees, so every tree count of a
grid is scored from one run.  Gradients are whole numbers (``GRADIENT_BITS`` of the
largest first one), so sums don't depend on the order or the layout of the rows,
and a repeated task repeats itself.

The blocks of larger data sets are kept in memory and on disk, and written to the
checkpoint folder every ``CHECKPOINT_TREES`` trees, so a lost executor costs no more
than those.

Trees grow level by level, within a depth and a number of leaves; if the leaves
don't suffice, a level's best splits come first.  A missing input is below all
others.  Regression learns squared errors, classification the log-loss.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.session import durable, shared_dir

# The functions below travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
BLOCK_ROWS = 1 << 23  # a task holds some 100 bytes of each; a table of one block needs no job per tree level
PIECE_ROWS = 1 << 18  # of a block as it is stored and sent
CHUNK = 1 << 14  # rows at a time, so that what is made of them stays in the cache
CHECKPOINT_TREES = 25
GRADIENT_BITS = 28  # sums of 2 ** 33 rows fit a long
HESSIAN_BITS = 24
SKETCH = 10_000


@dataclass(frozen=True)
class Settings:
    trees: int
    depth: int
    rate: float
    leaves: int | None = None
    row_share: float = 1.0
    column_share: float = 1.0
    least_rows: int = 1
    least_weight: float = 1.0
    penalty: float = 1.0


@dataclass(frozen=True)
class Run:
    table: str
    settings: Settings
    fold: int | None = None  # the fold that it is judged on; None learns from all
    scored: tuple[int, ...] = ()  # tree counts to be judged


@dataclass(frozen=True)
class Tree:
    """Nodes as columns; a leaf has feature -1.  Rows with a bin up to ``cut`` go left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def columns(self) -> tuple[np.ndarray, ...]:
        return tuple(getattr(self, name) for name in self.__dataclass_fields__)

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The node in which every column of ``bins`` ends."""
        at = np.zeros(bins.shape[1], dtype=np.int32)
        rows = np.arange(bins.shape[1])
        while len(rows):
            rows = rows[self.feature[at[rows]] >= 0]
            node = at[rows]
            low = bins[self.feature[node], rows] <= self.cut[node]
            at[rows] = np.where(low, self.left[node], self.right[node])
        return at


#: Per leaf the rows of a block that a tree learnt from, and its other rows.
Ends = dict[int, tuple[np.ndarray, np.ndarray]]


class Growth:
    """A tree while it grows."""

    def __init__(self, settings: Settings, columns: Sequence[int]):
        self.settings, self.columns = settings, tuple(columns)
        self.rows: list[list] = [[-1, 0, -1, -1, 0.0, 0.0]]  # as the columns of Tree
        self.open = [0]
        self.level = 0

    def tree(self) -> Tree:
        kinds = (np.int32, np.int32, np.int32, np.int32, np.float64, np.float64)
        return Tree(*[np.array(c, dtype=k) for c, k in zip(zip(*self.rows), kinds)])

    def extend(self, splits: Mapping[int, tuple]) -> None:
        """Put in the chosen splits of the open nodes; see ``choose``."""
        for node in self.open:
            if self.level == 0:
                self.rows[node][4] = splits[node][4]
        wanted = [n for n in self.open if splits[n][0] > 0 and self.level < self.settings.depth]
        if self.settings.leaves is not None:
            leaves = sum(row[0] < 0 for row in self.rows)
            wanted = sorted(wanted, key=lambda n: (-splits[n][0], n))[: max(0, self.settings.leaves - leaves)]
        self.open = []
        for node in sorted(wanted):
            gain, feature, cut, (low, high), _ = splits[node]
            first = len(self.rows)
            self.rows[node][:4] = [self.columns[feature], cut, first, first + 1]
            self.rows[node][5] = gain
            self.rows += [[-1, 0, -1, -1, low, 0.0], [-1, 0, -1, -1, high, 0.0]]
            self.open += [first, first + 1]
        self.level += 1
        if self.level >= self.settings.depth:
            self.open = []


def choose(sums: np.ndarray, scale: float, settings: Settings) -> list[tuple]:
    """Per node the best split of ``sums[(gradient, hessian, rows), node, column, bin]``.

    ``(gain, column, cut, (value left, value right), value here)``; a gain of 0 is no split.
    """
    first, second, rows = sums.cumsum(axis=3)
    first, second = first * scale, second * 2.0**-HESSIAN_BITS
    penalty = settings.penalty + 1e-300
    whole = first[:, :1, -1:], second[:, :1, -1:], rows[:, :1, -1:]
    low = first[..., :-1], second[..., :-1], rows[..., :-1]
    high = tuple(w - part for w, part in zip(whole, low))
    least = max(settings.least_rows, 1)
    enough = (low[2] >= least) & (high[2] >= least)
    if settings.least_weight > 0:
        enough &= (low[1] >= settings.least_weight) & (high[1] >= settings.least_weight)
    both = low[0] ** 2 / (low[1] + penalty) + high[0] ** 2 / (high[1] + penalty)
    gain = both - whole[0] ** 2 / (whole[1] + penalty)
    gain[~enough | (gain <= 1e-9 * both)] = 0.0
    nodes = np.arange(sums.shape[1])
    best = gain.reshape(len(nodes), -1).argmax(axis=1)
    column, cut = np.divmod(best, low[0].shape[2])
    values = [-part[0][nodes, column, cut] / (part[1][nodes, column, cut] + penalty) for part in (low, high)]
    here = -whole[0][:, 0, 0] / (whole[1][:, 0, 0] + penalty)
    gains = gain[nodes, column, cut]
    return [
        (g, c, k, (low_value, high_value), v)
        for g, c, k, low_value, high_value, v in zip(*(x.tolist() for x in (gains, column, cut, *values, here)))
    ]


@dataclass(frozen=True)
class Part:
    """A block of a table's rows, and what some of the runs predict for them.

    Between tasks it travels as a plain tuple of its fields.
    """

    table: str
    bins: np.ndarray  # column by row
    y: np.ndarray
    weight: np.ndarray
    fold: np.ndarray
    key: np.ndarray
    margins: dict[int, np.ndarray]
    scored: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]

    def record(self) -> tuple:
        return tuple(getattr(self, name) for name in self.__dataclass_fields__)


@dataclass(frozen=True)
class Job:
    """What the tasks of a job know of a run."""

    run: Run
    classes: bool
    forward: bool  # folds are blocks in time order
    scale: float
    growth: Growth
    number: int  # of the tree
    seed: int

    def learns_from(self, part: Part) -> np.ndarray:
        mask = np.ones(len(part.y), dtype=bool)
        tree = mixed(np.array([self.seed * 1_000_003 + self.number], dtype=np.uint64))
        for some in chunks(len(mask)):
            if self.run.fold is not None:
                fold = part.fold[some]
                mask[some] = fold < self.run.fold if self.forward else fold != self.run.fold
            if self.run.settings.row_share < 1:
                mask[some] &= mixed(part.key[some] ^ tree) < np.uint64(self.run.settings.row_share * 2.0**64)
        return mask

    def gradients(self, part: Part, margin: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y, weight = part.y[rows], part.weight[rows]
        if self.classes:
            chance = 1 / (1 + np.exp(-margin[rows]))
            first, second = (chance - y) * weight, chance * (1 - chance) * weight
        else:
            first, second = (margin[rows] - y) * weight, weight
        return np.rint(first / self.scale), np.rint(second * 2.0**HESSIAN_BITS)

    def sums(self, part: Part, margin: np.ndarray) -> tuple[list[int], np.ndarray]:
        """The open nodes with rows in this block, and their histograms, ``[figure, node, column, bin]``."""
        rows = np.flatnonzero(self.learns_from(part))
        at = self.growth.tree().leaf_of(part.bins[:, rows])
        nodes = np.array(self.growth.open)
        slot = np.full(len(self.growth.rows), -1)
        slot[nodes] = np.arange(len(nodes))
        mine = slot[at]
        rows, mine = rows[mine >= 0], mine[mine >= 0]
        seen, mine = np.unique(mine, return_inverse=True)
        first, second = self.gradients(part, margin, rows)
        return nodes[seen].tolist(), histograms(part.bins, self.growth.columns, rows, mine, len(seen), first, second)

    def split(self, sums: np.ndarray) -> list[tuple]:
        return choose(sums, self.scale, self.run.settings)

    def whole(self, part: Part, margin: np.ndarray, pairs: np.ndarray | None = None) -> tuple[Growth, Ends]:
        """The grown tree of a run whose rows are all in this block, and the rows at its leaves.

        Rows stay with their node from level to level, those that the tree doesn't learn
        from beside the others.  Of two siblings the one with fewer rows is counted; the
        other is what is left of their parent, exactly, for the sums are whole numbers.
        ``pairs`` are those of the block, see ``paired``.
        """
        learned = self.learns_from(part)
        held = {0: tuple(np.flatnonzero(m).astype(np.int32) for m in (learned, ~learned))}
        growth = self.growth
        if not len(held[0][0]):
            return growth, held
        pairs = paired(part.bins) if pairs is None else pairs
        first, second = (np.empty(len(learned), dtype=np.int64) for _ in range(2))
        for some in chunks(len(learned)):
            first[some], second[some] = self.gradients(part, margin, some)
        counter = Counter(part.bins, pairs, growth.columns, first, second)
        known: dict[int, np.ndarray] = {}
        while growth.open:
            siblings = [(n, n + 1) for n in growth.open[::2]] if growth.level else []
            counted = [min(p, key=lambda n: (len(held[n][0]), n)) for p in siblings] if growth.level else [0]
            new = dict(zip(counted, counter.sums([held[n][0] for n in counted])))
            for (a, b), parent in zip(siblings, self.parents() if siblings else []):
                done, other = (a, b) if a in new else (b, a)
                new[other] = known[parent] - new[done]
            known = new
            opened = growth.open
            growth.extend(dict(zip(opened, self.split(np.stack([new[n] for n in opened], axis=1)))))
            # The rows of the nodes that were split go to their children.
            for node in opened:
                feature, cut, left, right = growth.rows[node][:4]
                if feature >= 0:
                    both = [parted(part.bins[feature], cut, rows) for rows in held.pop(node)]
                    held[left], held[right] = zip(*both)
        return growth, held

    def parents(self) -> list[int]:
        """The split node above each pair of open ones."""
        above = {row[2]: n for n, row in enumerate(self.growth.rows) if row[0] >= 0}
        return [above[n] for n in self.growth.open[::2]]


def joined(bins: np.ndarray, columns: Sequence[int]) -> list[np.ndarray]:
    """Every two of the columns as one with ``BINS * BINS`` bins; an odd last one is left out."""
    return [bins[a].astype(np.uint16) * BINS + bins[b] for a, b in zip(columns[::2], columns[1::2])]


def histograms(
    bins: np.ndarray,
    columns: Sequence[int],
    rows: np.ndarray,
    slots: np.ndarray,
    count: int,
    first: np.ndarray,
    second: np.ndarray,
    pairs: Sequence[np.ndarray] | None = None,
) -> np.ndarray:
    """Sums of the gradients and numbers of the rows, ``[figure, slot, column, bin]``; ``rows`` are columns of ``bins``.

    Two columns at a time (``pairs``, see ``joined``) are counted in one pass, from which the sums of either
    follow, where the rows are not fewer than the cells of both.  All sums are whole numbers far below 2 ** 53.
    """
    out = np.empty((3, count, len(columns), BINS), dtype=np.int64)
    same = len(second) > 0 and bool((second == second[0]).all())  # as of squared errors without weights
    if len(rows) < count * BINS * BINS:
        pairs = ()
    elif pairs is None:
        pairs = joined(bins, columns)
    base = slots.astype(np.int64) * BINS

    def summed(place: np.ndarray, cells: int, into: Callable[[int, np.ndarray], None]) -> None:
        into(0, np.bincount(place, first, count * cells))
        into(2, np.bincount(place, minlength=count * cells))
        if not same:
            into(1, np.bincount(place, second, count * cells))

    wide = base * BINS
    for k, pair in enumerate(pairs):

        def both(figure: int, sums: np.ndarray, k: int = 2 * k) -> None:
            sums = sums.reshape(count, BINS, BINS)
            out[figure, :, k], out[figure, :, k + 1] = sums.sum(axis=2), sums.sum(axis=1)

        summed(wide + pair.take(rows), BINS * BINS, both)
    for k in range(2 * len(pairs), len(columns)):

        def one(figure: int, sums: np.ndarray, k: int = k) -> None:
            out[figure, :, k] = sums.reshape(count, BINS)

        summed(base + bins[columns[k]].take(rows), BINS, one)
    if same:
        out[1] = out[2] * np.int64(second[0])
    return out


def chunks(count: int) -> Iterator[slice]:
    return (slice(at, at + CHUNK) for at in range(0, count, CHUNK))


def parted(column: np.ndarray, cut: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows with a bin up to ``cut`` and the others."""
    low, high = [rows[:0]], [rows[:0]]
    for some in chunks(len(rows)):
        at = rows[some]
        here = column.take(at) <= cut
        # Positions, taken in order, are faster than a mask.
        low.append(at.take(np.flatnonzero(here)))
        high.append(at.take(np.flatnonzero(~here)))
    return np.concatenate(low), np.concatenate(high)


def paired(bins: np.ndarray) -> np.ndarray:
    """Row by row every two columns as one with ``BINS * BINS`` bins, so one read brings a whole row."""
    count, width = bins.shape[1], -(-bins.shape[0] // 2)
    # Widths of 8, 16 and 32 bytes are the ones that numpy copies fast.
    out = np.zeros((count, next((w for w in (4, 8, 16) if w >= width), width)), dtype=np.uint16)
    for some in chunks(count):
        for k in range(width):
            cell = bins[2 * k, some].astype(np.uint16) * BINS
            out[some, k] = cell + bins[2 * k + 1, some] if 2 * k + 1 < len(bins) else cell
    return out


class Counter:
    """The histograms of a tree's nodes, over rows of one block."""

    def __init__(self, bins: np.ndarray, pairs: np.ndarray, columns: Sequence[int], first: np.ndarray, second: np.ndarray):
        self.bins, self.pairs, self.columns, self.first, self.second = bins, pairs, columns, first, second
        self.same = bool((second == second[0]).all())  # as of squared errors without weights
        # A long holds the sum of the first gradients above the number of rows, of so many rows.
        bits = int(max(first.max(), -first.min())).bit_length()
        self.span = 1 << (61 - bits) // 2 if bits <= 61 else 0

    def sums(self, nodes: Sequence[np.ndarray]) -> list[np.ndarray]:
        """``[figure, column, bin]`` of every node's rows."""
        wide = min(BINS * BINS, self.span) == BINS * BINS
        alone = [wide and len(rows) >= BINS * BINS for rows in nodes]
        # Nodes with fewer rows than cells are counted together, a column at a time.
        small = [rows for rows, whole in zip(nodes, alone) if not whole]
        together = iter(())
        if small:
            rows, slots = np.concatenate(small), np.repeat(np.arange(len(small)), [len(r) for r in small])
            sums = (x.take(rows).astype(float) for x in (self.first, self.second))
            together = iter(histograms(self.bins, self.columns, rows, slots, len(small), *sums).swapaxes(0, 1))
        return [self._node(rows) if whole else next(together) for rows, whole in zip(nodes, alone)]

    def _node(self, rows: np.ndarray) -> np.ndarray:
        """All columns of the rows, two at a time, both figures in one pass."""
        used = sorted({c // 2 for c in self.columns})
        shift = self.span.bit_length()
        sums = np.zeros((3, len(used), BINS * BINS), dtype=np.int64)
        for start in range(0, len(rows), self.span):
            span = rows[start : start + self.span]
            joint = np.zeros(sums.shape[1:], dtype=np.int64)
            for some in chunks(len(span)):
                at = span[some]
                cells, first = self.pairs.take(at, axis=0), (self.first.take(at) << shift) + 1
                second = None if self.same else self.second.take(at)
                for k, pair in enumerate(used):
                    cell = cells[:, pair].astype(np.intp)
                    np.add.at(joint[k], cell, first)
                    if second is not None:
                        np.add.at(sums[1, k], cell, second)
            sums[0] += joint >> shift
            sums[2] += joint & ((1 << shift) - 1)
        if self.same:
            sums[1] = sums[2] * self.second[0]
        sums = sums.reshape(3, len(used), BINS, BINS)
        place = {pair: k for k, pair in enumerate(used)}
        return np.stack([sums[:, place[c // 2]].sum(axis=1 if c % 2 else 2) for c in self.columns], axis=1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Random bits of whole numbers (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin 0 for missing values, then one per interval ending with an edge."""
    found = np.searchsorted(edges, values, side="left") + 1
    return np.where(np.isnan(values), 0, found).astype(np.uint8)


# ---- tables ----


@dataclass(frozen=True)
class Table:
    """A data set laid out for growing."""

    name: str
    rows: DataFrame  # one row per piece; the pieces of a block share a partition, unless there is only one block
    blocks: int
    features: tuple[str, ...]
    edges: tuple[np.ndarray, ...]
    classes: bool
    forward: bool
    folds: dict[int, tuple[float, float, float, float]]  # weighted label sum, weight, smallest and largest label

    def start(self, run: Run) -> tuple[float, float]:
        """Where a run's predictions begin and its largest first gradient."""
        used = [s for k, s in self.folds.items() if run.fold is None or (k < run.fold if self.forward else k != run.fold)]
        total, weight = sum(s[0] for s in used), sum(s[1] for s in used)
        low, high = min((s[2] for s in used), default=0.0), max((s[3] for s in used), default=0.0)
        mean = total / weight if weight else 0.0
        if not self.classes:
            return mean, max(high - mean, mean - low) or 1.0
        mean = min(max(mean, 1e-6), 1 - 1e-6)
        return float(np.log(mean / (1 - mean))), 1.0


def table(
    name: str,
    df: DataFrame,
    features: Sequence[str],
    label: str,
    keys: Sequence[str],
    classes: bool = False,
    forward: bool = False,
    weight: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> Table:
    """Bin ``df`` (with its ``fold`` column) and cut it into blocks.

    The driver learns ``BINS`` edges per input and four figures per fold.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    inputs = [F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"x{i}") for i, c in enumerate(features)]
    rows = durable(
        df.select(
            F.array(*inputs).alias("x"),
            F.col(label).cast("double").alias("y"),
            w.alias("w"),
            F.col("fold").cast("int").alias("fold"),
            F.xxhash64(*keys).alias("key"),
        )
    )
    shares = [k / (BINS - 1) for k in range(1, BINS - 1)]
    marks = rows.agg(*[F.percentile_approx(F.col("x")[i], shares, SKETCH).alias(f"e{i}") for i in range(len(features))])
    edges = tuple(np.unique(np.array(e if e else [], dtype=float)) for e in marks.first())
    weighted = F.sum(F.col("w") * F.col("y"))
    stats = rows.groupBy("fold").agg(weighted.alias("s"), F.sum("w").alias("t"), F.min("y"), F.max("y"), F.count("*"))
    stats = {r[0]: tuple(r[1:]) for r in stats.collect()}
    count = sum(s[4] for s in stats.values())
    blocks, pieces = (max(1, -(-count // rows)) for rows in (block_rows, PIECE_ROWS))

    def piece(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        held = pa.Table.from_batches(batches)
        x = held.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        x = x.reshape(held.num_rows, len(edges)).T
        bins = np.stack([binned(c, e) for c, e in zip(x, edges)]) if len(edges) else np.empty((0, held.num_rows), np.uint8)
        parts = (bins, *[held.column(c).to_numpy() for c in ("y", "w", "fold")])
        parts += (held.column("key").to_numpy().view(np.uint64),)
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(parts)], pa.binary())], ["piece"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.RecordBatch] = []
        for batch in batches:
            rows.append(batch)
            if sum(b.num_rows for b in rows) >= PIECE_ROWS:
                yield piece(rows)
                rows = []
        if any(b.num_rows for b in rows):
            yield piece(rows)

    dealt = rows.repartition(blocks, "key", "y") if blocks > 1 else rows.coalesce(pieces)
    packed = durable(dealt.mapInArrow(pack, "piece binary"))
    folds = {k: s[:4] for k, s in stats.items()}
    return Table(name, packed, blocks, tuple(features), edges, classes, forward, folds)


# ---- growing ----


@dataclass(frozen=True)
class Grown:
    """The trees of a run and where its predictions begin."""

    run: Run
    start: float
    trees: tuple[Tree, ...]


def _spread(table: Table, groups: Sequence[Sequence[int]]) -> RDD:
    """``(piece, runs)``: a table's blocks, once for each group of runs, each in a partition of its own."""
    packed = table.rows.rdd.map(lambda row: bytes(row.piece))
    if table.blocks == 1:
        packed = packed.coalesce(1)
    # Each task reads its block where it was written; a shuffle would copy it once a group in one task.
    return packed.cartesian(packed.context.parallelize(list(groups), len(groups)))


def _begun(name: str, starts: Mapping[int, float]):
    """A block out of its pieces, with the first predictions of its runs."""

    def begun(pairs: Iterator[tuple]) -> Iterator[tuple]:
        pieces, runs = [], ()
        for piece, runs in pairs:
            pieces.append(pickle.loads(piece))
        if pieces:
            bins = np.concatenate([p[0] for p in pieces], axis=1)
            y, weight, fold, key = (np.concatenate(parts) for parts in list(zip(*pieces))[1:])
            margins = {r: np.full(len(y), starts[r]) for r in runs}
            yield Part(name, bins, y, weight, fold, key, margins, {}).record()

    return begun


def _advanced(
    part: Part, trees: Mapping[int, Tree], runs: Sequence[Run], number: int, ends: Mapping[int, Ends] | None = None
) -> Part:
    """The block after the trees with this number; ``ends`` has the rows at their leaves, if that is known."""
    margins, scored = dict(part.margins), dict(part.scored)
    for r in margins.keys() & trees.keys():
        steps = runs[r].settings.rate * trees[r].value
        if ends is None:
            margins[r] = margins[r] + steps[trees[r].leaf_of(part.bins)]
        else:
            # In place: the task that knows them is the only one that has these predictions.
            for leaf, both in ends[r].items():
                for rows in both:
                    for some in chunks(len(rows)):
                        margins[r][rows[some]] += steps[leaf]
        if number + 1 in runs[r].scored:
            held = part.fold == runs[r].fold
            scored[r, number + 1] = part.y[held], margins[r][held]
    return Part(*part.record()[:-2], margins, scored)


@dataclass(frozen=True)
class Batch:
    """All runs, with what their jobs need of the tables."""

    runs: tuple[Run, ...]
    tables: dict[str, tuple[int, bool, bool]]  # inputs, classes, forward
    begin: tuple[tuple[float, float], ...]
    seed: int

    def job(self, r: int, number: int) -> Job:
        run = self.runs[r]
        inputs, classes, forward = self.tables[run.table]
        growth = Growth(run.settings, _columns(inputs, run.settings.column_share, self.seed, number))
        return Job(run, classes, forward, self.begin[r][1] / 2.0**GRADIENT_BITS, growth, number, self.seed)

    def last(self, names: Sequence[str]) -> int:
        """The most trees of a run of these tables."""
        return max((run.settings.trees for run in self.runs if run.table in names), default=0)


def grow(
    spark: SparkSession, tables: Sequence[Table], runs: Sequence[Run], seed: int = 0
) -> tuple[list[Grown], DataFrame]:
    """All runs, and ``(run, trees, y, score)`` of the rows that each is judged on."""
    shared_dir(spark)
    known = {t.name: t for t in tables}
    batch = Batch(
        tuple(runs),
        {t.name: (len(t.features), t.classes, t.forward) for t in tables},
        tuple(known[run.table].start(run) for run in runs),
        seed,
    )
    trees: list[list[Tree]] = [[] for _ in runs]
    alone = [t for t in tables if t.blocks == 1]
    shared = [t for t in tables if t.blocks > 1]
    judged = [_scores(spark, step(spark, some, batch, trees)) for some, step in ((alone, _alone), (shared, _shared)) if some]
    found = [Grown(run, batch.begin[r][0], tuple(trees[r])) for r, run in enumerate(runs)]
    return found, reduce(DataFrame.union, judged)


def _laid(spark: SparkSession, tables: Sequence[Table], batch: Batch, groups) -> RDD:
    """The blocks of all tables, each once for each of ``groups(table)`` groups of its runs."""
    parts = []
    for t in tables:
        own = [r for r, run in enumerate(batch.runs) if run.table == t.name]
        # The longest runs come first, and each group has its share of them.
        own.sort(key=lambda r: -batch.runs[r].settings.trees * batch.runs[r].settings.depth)
        count = max(1, min(len(own), groups(t)))
        starts = {r: batch.begin[r][0] for r in own}
        parts.append(_spread(t, [own[k::count] for k in range(count)]).mapPartitions(_begun(t.name, starts)))
    return spark.sparkContext.union(parts)


def _alone(spark: SparkSession, tables: Sequence[Table], batch: Batch, trees: list[list[Tree]]) -> RDD:
    """Tables of one block: nothing to exchange, so a task grows a run from its first to its last tree."""
    state = _laid(spark, tables, batch, lambda t: len(batch.runs)).map(_grower(batch))
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    state.checkpoint()
    for r, tree in state.flatMap(lambda pair: pair[1]).collect():
        trees[r].append(Tree(*tree))
    return state.keys()


def _grower(batch: Batch):
    def grown(record: tuple) -> tuple:
        part, found = Part(*record), []
        pairs = paired(part.bins)
        for number in range(max(batch.runs[r].settings.trees for r in part.margins) if part.margins else 0):
            new, ends = {}, {}
            for r, margin in part.margins.items():
                if number < batch.runs[r].settings.trees:
                    growth, ends[r] = batch.job(r, number).whole(part, margin, pairs)
                    new[r] = growth.tree()
                    found.append((r, new[r].columns()))
            part = _advanced(part, new, batch.runs, number, ends)
        none = np.empty(0)  # only the scores are read after this
        return Part(part.table, none, none, none, none, none, {}, part.scored).record(), found

    return grown


def _shared(spark: SparkSession, tables: Sequence[Table], batch: Batch, trees: list[list[Tree]]) -> RDD:
    """Tables of many blocks: the histograms of a tree level meet in one job."""
    # Where the blocks are fewer than the cores, each comes once for several groups of runs.
    cores = spark.sparkContext.defaultParallelism
    blocks = sum(t.blocks for t in tables)
    state = _laid(spark, tables, batch, lambda t: -(-cores // blocks)).persist(StorageLevel.MEMORY_AND_DISK)
    names = [t.name for t in tables]
    old = state
    for number in range(batch.last(names)):
        own = [r for r, run in enumerate(batch.runs) if run.table in names and number < run.settings.trees]
        jobs = {r: batch.job(r, number) for r in own}
        while growing := {r: job for r, job in jobs.items() if job.growth.open}:
            _level(state, growing)
        new = {r: job.growth.tree() for r, job in jobs.items()}
        for r, tree in new.items():
            trees[r].append(tree)
        older, old, state = old, state, state.map(_advancer(new, batch.runs, number)).persist(StorageLevel.MEMORY_AND_DISK)
        if number % CHECKPOINT_TREES == CHECKPOINT_TREES - 1:
            state.checkpoint()
        if older is not old:
            # The blocks before the last ones have been read for those.
            older.unpersist()
    return state


def _advancer(trees: Mapping[int, Tree], runs: Sequence[Run], number: int):
    return lambda record: _advanced(Part(*record), trees, runs, number).record()


def _columns(count: int, share: float, seed: int, number: int) -> list[int]:
    wanted = max(1, round(share * count)) if count else 0
    return sorted(np.random.default_rng([seed, number]).permutation(count)[:wanted].tolist())


def _level(state: RDD, jobs: Mapping[int, Job]) -> None:
    """One level of all runs that still grow."""

    def offered(record: tuple) -> Iterator[tuple]:
        part = Part(*record)
        for r in sorted(part.margins.keys() & jobs.keys()):
            nodes, sums = jobs[r].sums(part, part.margins[r])
            for k, node in enumerate(nodes):
                yield (r, node), sums[:, k]

    def decided(pair: tuple) -> tuple:
        (r, node), sums = pair
        return r, node, jobs[r].split(sums[:, None])[0]

    nodes = sum(len(job.growth.open) for job in jobs.values())
    summed = state.flatMap(offered).reduceByKey(np.add, max(1, min(nodes, state.getNumPartitions())))
    splits: dict[int, dict[int, tuple]] = {r: {} for r in jobs}
    for r, node, split in summed.map(decided).collect():
        splits[r][node] = split
    none = (0.0, 0, 0, (0.0, 0.0), 0.0)  # of a node without rows, which only a root can be
    for r, job in jobs.items():
        job.growth.extend({n: splits[r].get(n, none) for n in job.growth.open})


def _scores(spark: SparkSession, state: RDD) -> DataFrame:
    def packed(record: tuple) -> Iterator[tuple]:
        for (r, count), (y, score) in Part(*record).scored.items():
            yield r, count, bytearray(y.tobytes()), bytearray(score.tobytes())

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, count, y, score in zip(*(c.to_pylist() for c in batch.columns)):
                y, score = np.frombuffer(y), np.frombuffer(score)
                columns = [np.full(len(y), r, np.int32), np.full(len(y), count, np.int32), y, score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["run", "trees", "y", "score"])

    found = spark.createDataFrame(state.flatMap(packed), "run int, trees int, y binary, score binary")
    return durable(found.mapInArrow(unpacked, "run int, trees int, y double, score double"))


# ---- models ----


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model over named inputs."""

    features: tuple[str, ...]
    edges: tuple[np.ndarray, ...]
    classes: bool
    start: float
    rate: float
    trees: tuple[Tree, ...]

    @staticmethod
    def of(table: Table, grown: Grown, count: int) -> BoostedTrees:
        """The model of a run's first ``count`` trees."""
        rate = grown.run.settings.rate
        return BoostedTrees(table.features, table.edges, table.classes, grown.start, rate, grown.trees[:count])

    def margin(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        bins = np.stack([binned(c, e) for c, e in zip(columns, self.edges)])
        out = np.full(bins.shape[1], self.start)
        for tree in self.trees:
            out += self.rate * tree.value[tree.leaf_of(bins)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``, the label or the value, and a classifier's ``score``."""
        model = self

        def score(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for columns in batches:
                margin = model.margin([c.to_numpy(zero_copy_only=False).astype(float) for c in columns])
                yield pa.array(1 / (1 + np.exp(-margin)) if model.classes else margin)

        inputs = [F.col(c).cast("double") for c in self.features]
        found = F.arrow_udf("double")(score)(*inputs) if inputs else F.lit(self.start)
        if not self.classes:
            return df.withColumn("prediction", found)
        return df.withColumn("score", found).withColumn("prediction", (F.col("score") > 0.5).cast("double"))

    def importances(self) -> dict[str, float]:
        """Every input's share of the gain of all splits."""
        gains = np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(gains, tree.feature[inner], tree.gain[inner])
        total = gains.sum() or 1.0
        return dict(zip(self.features, (gains / total).tolist()))

    def save(self, spark: SparkSession, path: str) -> None:
        """One row of plain columns per tree, and one for the rest."""
        names = Tree.__dataclass_fields__
        rows = [(k, *[getattr(tree, n).tolist() for n in names]) for k, tree in enumerate(self.trees)]
        kinds = {"value": "double", "gain": "double"}
        schema = ", ".join(["number int", *[f"`{n}` array<{kinds.get(n, 'int')}>" for n in names]])
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/trees")
        rest = (list(self.features), [e.tolist() for e in self.edges], self.classes, self.start, self.rate)
        schema = "features array<string>, edges array<array<double>>, classes boolean, start double, rate double"
        spark.createDataFrame([rest], schema).write.mode("overwrite").parquet(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        kinds = {"value": float, "gain": float}
        rows = spark.read.parquet(f"{path}/trees").orderBy("number").collect()
        trees = [Tree(*[np.array(r[n], dtype=kinds.get(n, np.int32)) for n in Tree.__dataclass_fields__]) for r in rows]
        rest = spark.read.parquet(f"{path}/model").first()
        edges = tuple(np.array(e, dtype=float) for e in rest.edges)
        return BoostedTrees(tuple(rest.features), edges, rest.classes, rest.start, rest.rate, tuple(trees))
