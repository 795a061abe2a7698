"""Boosted trees against a plain implementation, for any layout of the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.plans import boosting, models
from salescope.plans.boosting import Run, Settings

FEATURES = ["a", "b", "c", "same"]


def rows(n=240, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 9, n) * 1.0, rng.integers(0, 5, n) * 1.0, rng.integers(0, 3, n) * 1.0
    y = np.round(3 * a - b * b + 4 * (a > 4) * c + rng.normal(size=n), 3)
    gaps = rng.random(n) < 0.1
    return [
        (k, None if gap else float(i), float(j), float("nan") if gap and k % 2 else float(l), 7.0, float(t), k % 3)
        for k, (i, j, l, t, gap) in enumerate(zip(a, b, c, y, gaps))
    ]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, a double, b double, c double, same double, y double, fold int").repartition(4)


def slow_boost(data, settings, start, classes=False):
    """Greedy trees over the values themselves, one split at a time, best gains first within a level."""
    x = np.array([[-np.inf if v is None or np.isnan(v) else v for v in r[1:5]] for r in data])
    y = np.array([r[5] for r in data])
    margin = np.full(len(y), start)
    for _ in range(settings.trees):
        chance = 1 / (1 + np.exp(-margin))
        g, h = (chance - y, chance * (1 - chance)) if classes else (margin - y, np.ones(len(y)))
        value = {0: np.arange(len(y))}
        weight = {}

        def leaf(at):
            return -g[at].sum() / (h[at].sum() + settings.penalty)

        def gain(at, low):
            out = 0.0
            for part, sign in ((at[low], 1), (at[~low], 1), (at, -1)):
                out += sign * g[part].sum() ** 2 / (h[part].sum() + settings.penalty)
            return out

        leaves, open_nodes = {0: np.arange(len(y))}, [0]
        for _ in range(settings.depth):
            found = []
            for node in open_nodes:
                at = leaves[node]
                best = (0.0, 0, 0.0)
                for k in range(x.shape[1]):
                    for cut in np.unique(x[at, k])[:-1]:
                        low = x[at, k] <= cut
                        sizes = min(low.sum(), (~low).sum()), min(h[at[low]].sum(), h[at[~low]].sum())
                        if sizes[0] >= settings.least_rows and sizes[1] >= settings.least_weight:
                            new = gain(at, low)
                            if new > best[0] * (1 + 1e-6) + 1e-7:
                                best = (new, k, cut)
                if best[0]:
                    found.append((node, best))
            if settings.leaves is not None:
                found = sorted(found, key=lambda f: -f[1][0])[: max(0, settings.leaves - len(leaves))]
            open_nodes = []
            for node, (_, k, cut) in sorted(found):
                at = leaves.pop(node)
                first = max([*leaves, node, *open_nodes, max(value)]) + 1
                for n, part in ((first, at[x[at, k] <= cut]), (first + 1, at[x[at, k] > cut])):
                    leaves[n], value[n] = part, part
                    open_nodes.append(n)
        for at in leaves.values():
            margin[at] += settings.rate * leaf(at)
    return margin


def scores(spark, data, runs, block_rows, classes=False, **options):
    table = boosting.table("t", frame(spark, data), FEATURES, "y", ["id"], classes, block_rows=block_rows, **options)
    assert (table.blocks == 1) == (block_rows >= len(data))
    grown, judged = boosting.grow(spark, [table], runs)
    return table, grown, judged


@pytest.mark.parametrize(
    "settings",
    [Settings(3, 3, 0.5), Settings(2, 6, 0.3, leaves=7, least_rows=10, least_weight=0.0, penalty=0.0), Settings(1, 0, 1.0)],
)
def test_trees_equal_plain_greedy_ones(spark, settings):
    data = rows()
    table, (grown,), _ = scores(spark, data, [Run("t", settings)], 1000)
    model = boosting.BoostedTrees.of(table, grown, settings.trees)
    got = {r.id: r.prediction for r in model.transform(frame(spark, data)).collect()}
    want = slow_boost(data, settings, grown.start)
    assert np.allclose([got[k] for k in range(len(data))], want, atol=1e-5)


def test_classifier_equals_plain_greedy_one(spark):
    data = [(*r[:5], float(r[5] > 12), r[6]) for r in rows()]
    settings = Settings(3, 3, 0.4)
    table, (grown,), _ = scores(spark, data, [Run("t", settings)], 1000, classes=True)
    got = boosting.BoostedTrees.of(table, grown, 3).transform(frame(spark, data)).collect()
    want = 1 / (1 + np.exp(-slow_boost(data, settings, grown.start, True)))
    assert np.allclose([r.score for r in sorted(got)], want, atol=1e-5)
    assert all(r.prediction == (r.score > 0.5) for r in got)


def test_any_layout_gives_the_same_trees(spark):
    data = rows()
    runs = [
        Run("t", Settings(4, 3, 0.5, row_share=0.7, column_share=0.6), 0, (2, 4)),
        Run("t", Settings(2, 5, 0.3, leaves=6, least_rows=5, penalty=0.0), 2, (2,)),
        Run("t", Settings(4, 3, 0.5), None),
    ]
    _, one, judged = scores(spark, data, runs, 1000)
    _, many, again = scores(spark, data, runs, 40)
    for a, b in zip(one, many):
        for x, y in zip(a.trees, b.trees, strict=True):
            assert all((getattr(x, n) == getattr(y, n)).all() for n in ("feature", "cut", "left", "right"))
            assert np.allclose(x.value, y.value)
    assert np.allclose(sorted(map(tuple, judged.collect())), sorted(map(tuple, again.collect())))
    seen = {(r.run, r.trees): r.n for r in judged.groupBy("run", "trees").agg(F.count("*").alias("n")).collect()}
    assert seen == {(0, 2): 80, (0, 4): 80, (1, 2): 80}
    # Several levels of a table with many blocks and one of a table with one, side by side.
    small = boosting.table("s", frame(spark, data), FEATURES, "y", ["id"])
    large = boosting.table("t", frame(spark, data), FEATURES, "y", ["id"], block_rows=40)
    mixed, _ = boosting.grow(spark, [small, large], [Run("s", runs[2].settings), *runs])
    assert all((x.feature == y.feature).all() for x, y in zip(mixed[0].trees, one[2].trees))
    assert all((x.feature == y.feature).all() for x, y in zip(mixed[1].trees, one[0].trees))


def test_a_run_never_learns_from_its_fold(spark):
    data = rows()
    changed = [(*r[:5], r[5] + (1000.0 if r[6] == 1 else 0.0), r[6]) for r in data]
    for forward, held in ((False, (0, 1)), (True, (0, 1, 2))):
        runs = [Run("t", Settings(2, 3, 0.5), 1, (2,))]
        _, (a,), _ = scores(spark, data, runs, 1000, forward=forward)
        _, (b,), _ = scores(spark, changed, runs, 1000, forward=forward)
        assert a.start == b.start
        assert all((x.value == y.value).mean() > 0.99 or np.allclose(x.value, y.value, atol=1e-4) for x, y in zip(a.trees, b.trees))


def test_tables_without_rows_or_splits(spark):
    runs = [Run("t", Settings(2, 3, 0.5), None)]
    for data in ([], rows(1), [(k, None, None, None, 7.0, 2.0, 0) for k in range(5)]):
        for size in (1000, 2):
            table = boosting.table("t", frame(spark, data), FEATURES, "y", ["id"], block_rows=size)
            (grown,), judged = boosting.grow(spark, [table], runs)
            assert all((tree.feature < 0).all() for tree in grown.trees) and judged.isEmpty()
    out = boosting.BoostedTrees.of(table, grown, 2).transform(frame(spark, rows(3)))
    assert [r.prediction for r in out.collect()] == [2.0] * 3


def test_scores_of_folds(spark):
    """Exact areas with ties, and root mean squared errors, per run and tree count."""
    rng = np.random.default_rng(3)
    data = [(run, trees, float(rng.random() < 0.3), float(rng.integers(0, 6))) for run in (0, 1) for trees in (1, 2) for _ in range(60)]
    found = models._fold_scores(spark.createDataFrame(data, "run int, trees int, y double, score double"), {0})
    for (run, trees), got in found.items():
        own = [(y, s) for r, t, y, s in data if (r, t) == (run, trees)]
        if run:
            want = np.sqrt(np.mean([(y - s) ** 2 for y, s in own]))
        else:
            pairs = [(p, q) for y, p in own for z, q in own if y == 1 and z == 0]
            want = np.mean([(p > q) + 0.5 * (p == q) for p, q in pairs])
        assert got == pytest.approx(want)
    assert len(found) == 4


def test_models_come_back(spark, tmp_path):
    data = rows()
    table, (grown,), _ = scores(spark, data, [Run("t", Settings(3, 3, 0.5))], 1000)
    model = boosting.BoostedTrees.of(table, grown, 3)
    model.save(spark, str(tmp_path))
    again = boosting.BoostedTrees.load(spark, str(tmp_path))
    some = frame(spark, data)
    assert sorted(map(str, model.transform(some).collect())) == sorted(map(str, again.transform(some).collect()))
    shares = model.importances()
    assert shares == again.importances() and sum(shares.values()) == pytest.approx(1)
    assert max(shares, key=shares.get) == "a" and shares["same"] == 0


def test_a_table_of_one_block_takes_as_many_jobs_for_many_trees(spark):
    context, jobs = spark.sparkContext, {}
    table = boosting.table("t", frame(spark, rows()), FEATURES, "y", ["id"])
    for trees in (2, 60):
        context.setJobGroup(f"grow-{trees}", "grow")
        grown, _ = boosting.grow(spark, [table], [Run("t", Settings(trees, 2, 0.3), fold, (trees,) if fold else ()) for fold in (None, 1)])
        context.setJobGroup("other", "other")
        assert [len(g.trees) for g in grown] == [trees, trees]
        jobs[trees] = len(context.statusTracker().getJobIdsForGroup(f"grow-{trees}"))
    assert jobs[2] == jobs[60] > 0


@pytest.mark.parametrize("classes, share", [(False, 1.0), (True, 0.6)])
def test_rows_stay_with_their_node_to_the_leaf(classes, share):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 20, (3, 400)).astype(np.uint8)
    y = ((x[0] > 9).astype(float) + x[1] % 2 + rng.random(400) > 1).astype(float)
    key = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    part = boosting.Part("t", x, y, np.ones(400), np.arange(400) % 3, key, {}, {})
    run = Run("t", Settings(1, 5, 0.1, row_share=share), 2)
    job = boosting.Batch((run,), {"t": (3, classes, False)}, ((0.0, 1.0),), 7).job(0, 0)
    learned = job.learns_from(part)
    growth, ends = job.whole(part, np.zeros(400))
    leaf = growth.tree().leaf_of(x)
    assert len(ends) > 4 and sorted(r for both in ends.values() for rows in both for r in rows) == list(range(400))
    for node, (used, others) in ends.items():
        assert (leaf[used] == node).all() and (leaf[others] == node).all()
        assert learned[used].all() and not learned[others].any()


@pytest.mark.parametrize("columns, calls", [((0, 1, 2, 3), 4), ((3, 0, 2), 4), ((1,), 2)])
def test_two_columns_are_counted_in_one_pass(monkeypatch, columns, calls):
    rng = np.random.default_rng(5)
    bins = rng.integers(0, boosting.BINS, (4, 5_000)).astype(np.uint8)
    rows = np.sort(rng.choice(5_000, 4_000, replace=False))
    slots, first, second = np.sort(rng.integers(0, 3, 4_000)), np.rint(rng.normal(size=4_000) * 2.0**28), np.full(4_000, 2.0**24)
    want = np.zeros((3, 3, len(columns), boosting.BINS), dtype=np.int64)
    for k, c in enumerate(columns):
        for figure, w in enumerate((first, second, np.ones(4_000))):
            np.add.at(want[figure, :, k], (slots, bins[c, rows]), w.astype(np.int64))
    made, real = [], np.bincount
    monkeypatch.setattr(boosting.np, "bincount", lambda *a, **k: made.append(a) or real(*a, **k))
    found = boosting.histograms(bins, columns, rows, slots, 3, first, second)
    assert len(made) == calls
    np.testing.assert_array_equal(found, want)
    # With few rows a slot the cells of two columns would cost more than they save.
    few = boosting.histograms(bins, columns, rows[:50], slots[:50], 3, first[:50], second[:50])
    assert few[2].sum() == 50 * len(columns) and len(made) == calls + 2 * len(columns)


def test_a_block_of_many_pieces_gives_the_same_trees(spark, monkeypatch):
    """Its rows are packed by several tasks and grown by one, however many pieces there are."""
    data = rows()
    runs = [Run("t", Settings(4, 4, 0.5, row_share=0.7, column_share=0.6), 0, (4,)), Run("t", Settings(3, 3, 0.5), None)]
    _, one, judged = scores(spark, data, runs, 1000)
    monkeypatch.setattr(boosting, "PIECE_ROWS", 20)
    table, many, again = scores(spark, data, runs, 1000)
    assert table.rows.count() > 1
    for a, b in zip(one, many):
        assert all((x.feature == y.feature).all() and (x.value == y.value).all() for x, y in zip(a.trees, b.trees, strict=True))
    assert sorted(map(tuple, judged.collect())) == sorted(map(tuple, again.collect()))


@pytest.mark.parametrize("columns", [(0, 1, 2, 3, 4), (4, 1), (3,)])
@pytest.mark.parametrize("largest, even", [(2.0**28, True), (2.0**28, False), (2.0**38, False), (2.0**48, False)])
def test_nodes_are_counted_exactly(columns, largest, even):
    """Gradients and numbers of rows share a long for as many rows as their size allows."""
    rng = np.random.default_rng(5)
    bins = rng.integers(0, boosting.BINS, (5, 40_000)).astype(np.uint8)
    first = rng.choice([-1, 1], 40_000) * (int(largest) - rng.integers(0, 9, 40_000))
    second = np.full(40_000, 1 << 24) if even else rng.integers(0, 1 << 24, 40_000)
    nodes = [np.sort(rng.choice(40_000, n, replace=False)).astype(np.int32) for n in (30_000, 1, 1_024, 900)]
    found = boosting.Counter(bins, boosting.paired(bins), columns, first, second).sums(nodes)
    for at, sums in zip(nodes, found, strict=True):
        want = np.zeros((3, len(columns), boosting.BINS), dtype=np.int64)
        for k, c in enumerate(columns):
            for figure, w in enumerate((first, second, np.ones_like(first))):
                np.add.at(want[figure, k], bins[c, at], w[at])
        # Sums beyond 2 ** 53 are rounded where the gradients are too large to share a long.
        assert (np.abs(sums - want) <= (largest if largest > 2.0**38 else 0)).all()


def test_a_run_over_millions_of_rows_takes_one_task():
    """A table beyond the block of earlier rounds (2 ** 20 rows) needs no job per tree level."""
    assert boosting.BLOCK_ROWS > 5_760_000
    n = 1_200_000
    x = np.random.default_rng(1).integers(0, boosting.BINS, (3, n)).astype(np.uint8)
    part = boosting.Part("t", x, x[0] + 2.0 * (x[1] > 9), np.ones(n), np.zeros(n, np.int32), np.arange(n).astype(np.uint64), {0: np.zeros(n)}, {})
    run = Run("t", Settings(2, 3, 1.0))
    found = boosting._grower(boosting.Batch((run,), {"t": (3, False, False)}, ((0.0, 33.0),), 7))(part.record())[1]
    first = boosting.Tree(*found[0][1])
    leaf = first.leaf_of(x)
    for node in np.unique(leaf):
        assert first.value[node] == pytest.approx(part.y[leaf == node].sum() / ((leaf == node).sum() + 1), rel=1e-6)


def test_only_the_best_is_fitted_over_all_rows(spark, monkeypatch):
    """Tasks over the same rows share their layout and their fits of the folds; the models are those of all rows."""
    data = rows()
    train = frame(spark, data).drop("fold")
    spec = models.build_model_registry()["ltv"]
    grid = {"n_estimators": [2, 4], "max_depth": [1, 3], "min_child_samples": [5]}
    tasks = {
        name: models.make_task(spec, train, FEATURES, "y", ["id"], None, grid=some)
        for name, some in {"all": grid, "deep": grid | {"max_depth": [3, 4]}}.items()
    }
    grown, grow = [], boosting.grow
    monkeypatch.setattr(boosting, "grow", lambda s, tables, runs, seed=0: grown.append((tables, runs)) or grow(s, tables, runs, seed))
    found = models.search_all(tasks)
    (tables, folds), (_, whole) = grown
    assert len(tables) == 1 and len(folds) == 3 * models.FOLDS and all(run.fold is not None for run in folds)
    assert [run.fold for run in whole] == [None, None]
    for name, task in tasks.items():
        alone = models.search_all({name: task})[name]
        assert alone.scores == found[name].scores and alone.best == found[name].best
        assert len(alone.scores) == 4 and all(len(s) == models.FOLDS for s in alone.scores)
        best = models.tree_settings(task.candidates[alone.best], spec.deepest)
        want = grow(spark, tables, [Run("all", best)], models.SEED)[0][0].trees
        assert len(found[name].model.trees) == best.trees
        for a, b in zip(found[name].model.trees, want, strict=True):
            assert all((getattr(a, n) == getattr(b, n)).all() for n in ("feature", "cut", "value"))


def test_a_plan_that_comes_twice_is_laid_out_once(spark, monkeypatch):
    data = frame(spark, rows()).withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    spec = models.build_model_registry()["ltv"]
    plan = models.Plan(spec, data, tuple(FEATURES), "y", ("id",))
    laid, table = [], boosting.table
    monkeypatch.setattr(boosting, "table", lambda *a: laid.append(a[0]) or table(*a))
    both = models.train_models({"a": plan, "b": plan}, seeds={"b": 1}, draws=2, grid=spec.grid | {"n_estimators": [3]})
    assert laid == ["a"] and set(both) == {"a", "b"}
    assert all(len(p.model.trees) == 3 and set(p.score) for p in both.values())
