"""Model registry, search, training, packages and champion / challenger."""

from __future__ import annotations

import json
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from itertools import product
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.operators.evaluation import classification_metrics, regression_metrics
from salescope.operators.metrics import class_weight
from salescope.operators.ordered import ordered_scan
from salescope.plans import boosting
from salescope.session import durable

# ---- fixed values: tasks and search grids of the five models ----
SEED = 42
SEARCH_DRAWS = 10
FOLDS = 3
TREE_GRID = {
    "n_estimators": [100, 200, 300],
    "max_depth": [3, 5, 7],
    "learning_rate": [0.01, 0.05, 0.1],
    "subsample": [0.7, 0.8, 1.0],
    "colsample_bytree": [0.7, 0.8, 1.0],
}
LEAF_GRID = {
    "n_estimators": [100, 200, 300],
    "num_leaves": [15, 31, 63],
    "learning_rate": [0.01, 0.05, 0.1],
    "max_depth": [-1, 5, 10],
    "min_child_samples": [10, 20, 50],
}
NEIGHBOR_GRID = {"n_neighbors": [3, 5, 10, 20], "metric": ["cosine", "euclidean"]}
# ---- end of fixed values ----


DEEPEST = 10


@dataclass(frozen=True)
class ModelSpec:
    task: str  # classification, regression or unsupervised
    grid: Mapping[str, Sequence[Any]]
    time_series: bool = False
    defaults: Mapping[str, Any] = field(default_factory=dict)
    deepest: int = DEEPEST  # depth of trees whose grid sets no limit


def build_model_registry() -> dict[str, ModelSpec]:
    return {
        "forecast": ModelSpec("regression", TREE_GRID, time_series=True),
        "churn": ModelSpec("classification", TREE_GRID),
        "ltv": ModelSpec("regression", LEAF_GRID),
        "demand": ModelSpec("regression", TREE_GRID),
        "recommendation": ModelSpec(
            "unsupervised", NEIGHBOR_GRID, defaults={"n_neighbors": 5, "metric": "cosine"}
        ),
    }


def validate_model_registry(spark: SparkSession, registry: Mapping[str, Any]) -> DataFrame:
    """``(model, status)``: READY, or what an entry lacks."""
    rows = []
    for name, spec in registry.items():
        missing = [part for part in ("task", "grid") if not getattr(spec, part, None)]
        rows.append((name, "missing " + ", ".join(missing) if missing else "READY"))
    return spark.createDataFrame(rows, "model string, status string")


LEAST_WEIGHT = 1.0  # of the second derivatives in a leaf, where a grid counts no rows
PENALTY = 1.0


def tree_settings(parameters: Mapping[str, Any], deepest: int = DEEPEST) -> boosting.Settings:
    """Read a grid's names.  A depth of -1 means no limit of its own, for which ``deepest`` stands."""
    depth = parameters.get("max_depth", -1)
    counted = "min_child_samples" in parameters
    return boosting.Settings(
        trees=parameters.get("n_estimators", 100),
        depth=deepest if depth == -1 else depth,
        rate=parameters.get("learning_rate", 0.1),
        leaves=parameters.get("num_leaves"),
        row_share=parameters.get("subsample", 1.0),
        column_share=parameters.get("colsample_bytree", 1.0),
        least_rows=parameters.get("min_child_samples", 1),
        least_weight=0.0 if counted else LEAST_WEIGHT,
        penalty=0.0 if counted else PENALTY,
    )


def draw_parameters(
    grid: Mapping[str, Sequence[Any]], draws: int | None = SEARCH_DRAWS, seed: int = SEED
) -> list[dict[str, Any]]:
    """``draws`` different combinations of a grid at random, or all of them."""
    names = list(grid)
    combinations = [dict(zip(names, values)) for values in product(*grid.values())]
    if draws is None or draws >= len(combinations):
        return combinations
    return random.Random(seed).sample(combinations, draws)


def with_weight(df: DataFrame, label: str) -> DataFrame:
    """Positives weigh as much in all as negatives do."""
    weight = class_weight(df, label).first()[0]
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(1.0))


def with_folds(
    df: DataFrame, spec: ModelSpec, label: str, keys: Sequence[str], folds: int = FOLDS
) -> DataFrame:
    """A ``fold`` column: blocks in time order, stratified by label, or shuffled.

    The shuffle is by a hash of the row's keys, so it is the same in every run.
    """
    if spec.time_series:
        scan = ordered_scan(
            df,
            [F.col(c) for c in keys],
            row_number="__row",
            totals={"__rows": F.lit(1).cast("long")},
        )
        block = F.expr(f"(__row - 1) * {folds + 1} div __rows")
        return scan.withColumn("fold", block.cast("int")).drop("__row", "__rows")
    shuffle = [F.xxhash64(*keys), *[F.col(c) for c in keys]]
    by = [label] if spec.task == "classification" else []
    scan = ordered_scan(df, shuffle, by=by, row_number="__row")
    return scan.withColumn("fold", (F.col("__row") % folds).cast("int")).drop("__row")


@dataclass(frozen=True)
class Task:
    """A model to be searched and trained: its training rows and the parameters to try."""

    spec: ModelSpec
    train: DataFrame
    features: tuple[str, ...]
    label: str
    keys: tuple[str, ...]
    candidates: tuple[Mapping[str, Any], ...]
    folds: int = FOLDS

    @property
    def blocks(self) -> range:
        return range(1, self.folds + 1) if self.spec.time_series else range(self.folds)


def make_task(
    spec: ModelSpec,
    train: DataFrame,
    features: Sequence[str],
    label: str,
    keys: Sequence[str],
    draws: int | None = SEARCH_DRAWS,
    folds: int = FOLDS,
    grid: Mapping[str, Sequence[Any]] | None = None,
    seed: int = SEED,
) -> Task:
    if spec.task == "unsupervised":
        raise ValueError("there is nothing to tune without a target")
    candidates = draw_parameters(grid or spec.grid, draws, seed)
    return Task(spec, train, tuple(features), label, tuple(keys), tuple(candidates), folds)


@dataclass(frozen=True)
class Searched:
    """Per candidate the score of every fold, and the best one's model over all training rows."""

    scores: list[list[float]]
    model: boosting.BoostedTrees
    best: int


def search_all(tasks: Mapping[str, Task], block_rows: int = boosting.BLOCK_ROWS) -> dict[str, Searched]:
    """Search the parameters of several models in one batch of fits, then fit the best of each in another.

    AUC or RMSE by folds; a time series learns from the blocks before the one it
    is judged on.  Candidates that differ in their number of trees share one fit,
    and tasks over the same training rows share their layout and their fits.
    """
    if not tasks:
        return {}
    spark = next(iter(tasks.values())).train.sparkSession
    tables, laid, own, counts = {}, {}, {}, {}
    for name, task in tasks.items():
        classes, forward = task.spec.task == "classification", task.spec.time_series
        layout = (id(task.train), task.features, task.label, task.keys, task.folds, classes, forward)
        if layout not in laid:
            folded = with_folds(task.train, task.spec, task.label, task.keys, task.folds)
            weight = "weight" if classes else None
            tables[name] = boosting.table(
                name, folded, task.features, task.label, task.keys, classes, forward, weight, block_rows
            )
        own[name] = laid.setdefault(layout, name)
        for candidate in task.candidates:
            settings = tree_settings(candidate, task.spec.deepest)
            for fold in task.blocks:
                counts.setdefault((own[name], replace(settings, trees=0), fold), set()).add(settings.trees)
    runs = [
        boosting.Run(table, replace(shape, trees=max(trees)), fold, tuple(sorted(trees)))
        for (table, shape, fold), trees in counts.items()
    ]
    places = {place: r for r, place in enumerate(counts)}
    _, judged = boosting.grow(spark, list(tables.values()), runs, SEED)
    scores = _fold_scores(judged, {r for r, run in enumerate(runs) if tables[run.table].classes})
    found, best, whole = {}, {}, []
    for name, task in tasks.items():
        tried = [tree_settings(candidate, task.spec.deepest) for candidate in task.candidates]
        found[name] = [
            [scores[places[own[name], replace(s, trees=0), fold], s.trees] for fold in task.blocks] for s in tried
        ]
        pick = max if task.spec.task == "classification" else min
        # A fold without both classes has no AUC.
        means = [sum(known) / len(known) if (known := [x for x in f if x is not None]) else 0.5 for f in found[name]]
        best[name] = pick(range(len(means)), key=means.__getitem__)
        whole.append(boosting.Run(own[name], tried[best[name]]))
    grown, _ = boosting.grow(spark, list(tables.values()), whole, SEED)
    return {
        name: Searched(found[name], boosting.BoostedTrees.of(tables[own[name]], fit, fit.run.settings.trees), best[name])
        for name, fit in zip(tasks, grown)
    }


def _fold_scores(judged: DataFrame, classes: set[int]) -> dict[tuple[int, int], float | None]:
    """AUC of the classifiers' runs and RMSE of the others, per run and number of trees."""
    counts = judged.filter(F.col("run").isin(list(classes))).groupBy("run", "trees", "score").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("pos")
    )
    # The area is the share of pairs in order; an equal pair counts half.
    scan = ordered_scan(counts, [F.col("score")], by=["run", "trees"], running={"upto": F.col("n")})
    rank = F.col("upto") - (F.col("n") - 1) / 2
    positives = F.sum("pos").cast("double")
    above = F.sum(rank * F.col("pos")) - positives * (positives + 1) / 2
    area = F.try_divide(above, positives * (F.sum("n") - positives))
    areas = scan.groupBy("run", "trees").agg(area.alias("found"))
    away = F.col("score") - F.col("y")
    errors = judged.filter(~F.col("run").isin(list(classes))).groupBy("run", "trees")
    errors = errors.agg(F.sqrt(F.avg(away * away)).alias("found"))
    rows = (areas.union(errors) if classes else errors).collect()
    return {(r.run, r.trees): r.found for r in rows}


def search(spec: ModelSpec, train: DataFrame, features, label, keys, draws=SEARCH_DRAWS, folds=FOLDS, grid=None, seed=SEED):
    """The best of the drawn parameters by cross-validated AUC or RMSE."""
    task = make_task(spec, train, features, label, keys, draws, folds, grid, seed)
    return task.candidates[search_all({"model": task})["model"].best]


@dataclass(frozen=True)
class ModelPackage:
    """A trained model with its parameters and test scores."""

    name: str
    task: str
    model: boosting.BoostedTrees | None
    parameters: Mapping[str, Any]
    score: Mapping[str, float] | None
    features: tuple[str, ...] = ()
    label: str = ""

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` and, for a classifier, ``score``."""
        return self.model.transform(df)

    def evaluate(self, test: DataFrame) -> dict[str, float]:
        # Scored once, whatever the number of figures.
        predicted = durable(self.predict(test.select(*self.features, self.label)))
        if self.task == "classification":
            return classification_metrics(predicted, self.label, "score").first().asDict()
        return regression_metrics(predicted, self.label, "prediction").first().asDict()

    def headline(self, score: Mapping[str, float]) -> float:
        return score["roc_auc" if self.task == "classification" else "r2"]


@dataclass(frozen=True)
class Plan:
    """What a model is trained on: ``data`` has a ``split`` column."""

    spec: ModelSpec
    data: DataFrame
    features: tuple[str, ...]
    label: str
    keys: tuple[str, ...]


def train_models(
    plans: Mapping[str, Plan],
    block_rows: int = boosting.BLOCK_ROWS,
    seeds: Mapping[str, int] | None = None,
    **search_options,
) -> dict[str, ModelPackage]:
    """Search on the training rows, fit, score on the test rows, for all models in one batch."""
    tasks, trains = {}, {}
    for name, plan in plans.items():
        if id(plan) not in trains:
            train = plan.data.filter("split = 'train'")
            trains[id(plan)] = with_weight(train, plan.label) if plan.spec.task == "classification" else train
        train = trains[id(plan)]
        options = search_options | ({"seed": seeds[name]} if seeds and name in seeds else {})
        tasks[name] = make_task(plan.spec, train, plan.features, plan.label, plan.keys, **options)
    out = {}
    for name, found in search_all(tasks, block_rows).items():
        plan, parameters = plans[name], tasks[name].candidates[found.best]
        package = ModelPackage(name, plan.spec.task, found.model, parameters, None, plan.features, plan.label)
        out[name] = replace(package, score=package.evaluate(plan.data.filter("split = 'test'")))
    return out


def train_model(
    name: str,
    spec: ModelSpec,
    data: DataFrame,
    features: Sequence[str],
    label: str,
    keys: Sequence[str],
    **options,
) -> ModelPackage:
    return train_models({name: Plan(spec, data, tuple(features), label, tuple(keys))}, **options)[name]


def feature_importance(spark: SparkSession, package: ModelPackage, top: int = 20) -> DataFrame:
    """``(feature, importance)`` of the most important inputs."""
    rows = list(package.model.importances().items())
    frame = spark.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature").limit(top)


def save_package(spark: SparkSession, package: ModelPackage, folder: str) -> None:
    """The model under ``<folder>/<name>/model`` and one registry row beside it."""
    target = f"{folder}/{package.name}"
    if package.model is not None:
        package.model.save(spark, f"{target}/model")
    row = (
        package.name,
        package.task,
        json.dumps(dict(package.parameters)),
        json.dumps(dict(package.score)) if package.score is not None else None,
        list(package.features),
        package.label,
    )
    schema = (
        "name string, task string, parameters string, score string, "
        "features array<string>, label string"
    )
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").json(f"{target}/entry")


def load_package(spark: SparkSession, name: str, folder: str) -> ModelPackage:
    """Raises when there is no such package."""
    schema = (
        "name string, task string, parameters string, score string, "
        "features array<string>, label string"
    )
    target = f"{folder}/{name}"
    entry = spark.read.schema(schema).json(f"{target}/entry").first()
    model = None if entry.task == "unsupervised" else boosting.BoostedTrees.load(spark, f"{target}/model")
    return ModelPackage(
        entry.name,
        entry.task,
        model,
        json.loads(entry.parameters),
        json.loads(entry.score) if entry.score else None,
        tuple(entry.features or ()),
        entry.label or "",
    )


def challenge(
    champion: ModelPackage, challenger: ModelPackage, test: DataFrame, threshold: float = 0.0
) -> tuple[ModelPackage, bool]:
    """The challenger wins if it gains at least ``threshold`` on the same test rows."""
    test = durable(test)
    won = wins(champion, champion.evaluate(test), challenger.evaluate(test), threshold)
    return (challenger if won else champion), won


def wins(
    champion: ModelPackage, before: Mapping[str, float], after: Mapping[str, float], threshold: float = 0.0
) -> bool:
    """Whether the scores ``after`` gain at least ``threshold`` over the champion's."""
    return champion.headline(after) - champion.headline(before) >= threshold
