"""The training run and the ingest-and-retrain run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.operators.cleaning import clean_columns, clean_dataframe, clean_ml_dataframe, clean_star
from salescope.operators.validation import validate_star_schema
from salescope.plans import datasets, features, manifest, models, preprocess, splits
from salescope.session import durable
from salescope.sources.schema import StarSchema

ROW_KEYS = {
    "churn": ["customer_sk"],
    "ltv": ["customer_sk"],
    "demand": ["product_sk"],
    "forecast": ["date"],
}


@dataclass(frozen=True)
class PipelineContext:
    star: StarSchema
    checks: DataFrame
    prepared: Mapping[str, DataFrame]
    packages: Mapping[str, models.ModelPackage]
    usage: DataFrame
    sample_size: int | None
    options: Mapping[str, object] = field(default_factory=dict)


def prepare_dataset(
    name: str, raw: DataFrame, max_rows: int | None = None
) -> tuple[DataFrame, list[str]]:
    """Clean, split and preprocess one data set; returns it with its model inputs."""
    clean = clean_ml_dataframe(raw, datasets.TARGETS[name])
    if name not in datasets.PRIMARY_TARGET:
        out, fitted = preprocess.preprocess(name, clean, fit_on="all")
        return out, fitted.feature_columns(out)
    ready, fitted = preprocess.preprocess(name, splits.split_dataset(name, clean, max_rows))
    return durable(ready), fitted.feature_columns(ready)


def learn_from(star: StarSchema, sample_size: int | None) -> tuple[dict, DataFrame]:
    """Prepared data sets over all sales or the earliest ones, and the usage of just these."""
    sample = None
    learned = star
    if sample_size is not None:
        sample = durable(manifest.earliest_sales(star.fact_sales, sample_size))
        learned = replace(star, fact_sales=sample)
    return prepare_all(learned), manifest.row_usage(star, sample_size, sample)


def prepare_all(star: StarSchema, max_rows: int | None = None):
    tables = features.feature_tables(star.fact_sales, star.customers, star.products)
    raw = datasets.model_datasets(tables, star)
    return {name: prepare_dataset(name, df, max_rows) for name, df in raw.items()}


def train_all(
    prepared: Mapping[str, tuple[DataFrame, list[str]]], registry: Mapping[str, models.ModelSpec], **options
) -> dict[str, models.ModelPackage]:
    """Packages of all prepared data sets; the models with a target are searched and fitted in one batch."""
    plans, packages = {}, {}
    for name, (df, inputs) in prepared.items():
        spec = registry[name]
        if spec.task == "unsupervised":
            packages[name] = models.ModelPackage(name, spec.task, None, spec.defaults, None, tuple(inputs))
        else:
            label = datasets.PRIMARY_TARGET[name]
            plans[name] = models.Plan(spec, df, tuple(inputs), label, tuple(ROW_KEYS[name]))
    packages |= models.train_models(plans, **options)
    return {name: packages[name] for name in prepared}


def train_one(name, prepared, inputs, registry, **options) -> models.ModelPackage:
    return train_all({name: (prepared, inputs)}, registry, **options)[name]


def run_initial_pipeline(
    star: StarSchema,
    model_dir: str | None = None,
    sample_size: int | None = None,
    strict: bool = False,
    **search_options,
) -> PipelineContext:
    """Clean, check, build features and data sets, train every model.

    ``sample_size`` lets the models see only so many of the earliest sales;
    without it they see everything.  The manifest reports what was really used.
    """
    spark = star.fact_sales.sparkSession
    star = clean_star(star)
    # The cleaned fact feeds the checks, all four feature tables and the manifest.
    star = replace(star, fact_sales=durable(star.fact_sales))
    checks = validate_star_schema(star, strict)
    registry = models.build_model_registry()
    prepared, usage = learn_from(star, sample_size)
    packages = train_all(prepared, registry, **search_options)
    if model_dir:
        for package in packages.values():
            models.save_package(spark, package, model_dir)
    frames = {name: df for name, (df, _) in prepared.items()}
    return PipelineContext(star, checks, frames, packages, usage, sample_size, search_options)


def ingest_union(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """History plus cleaned new rows, equal rows once.

    The new rows are not made distinct before: a task would hold them twice.
    """
    return history.unionByName(clean_columns(incoming)).dropDuplicates()


def ingest_and_retrain(
    context: PipelineContext,
    new_sales: DataFrame,
    threshold: float = 0.0,
    model_dir: str | None = None,
) -> tuple[PipelineContext, DataFrame]:
    """Add new sales, rebuild everything, let every model be challenged.

    Returns the new context and the dashboard rows.
    """
    spark = new_sales.sparkSession
    received = durable(clean_dataframe(new_sales))
    fact = durable(context.star.fact_sales.unionByName(received).dropDuplicates())
    star = replace(context.star, fact_sales=fact)
    registry = models.build_model_registry()
    prepared, usage = learn_from(star, context.sample_size)
    packages, status, scores = {}, {}, {}
    trained = train_all(prepared, registry, **context.options)
    for name, (df, _) in prepared.items():
        current, fresh = context.packages.get(name), trained[name]
        if fresh.task == "unsupervised":
            packages[name], status[name] = fresh, "refreshed"
        elif current is None or not set(current.features) <= set(df.columns):
            # no champion, or one that needs inputs the data no longer has
            packages[name], status[name] = fresh, "initial_training"
        else:
            # The new model was scored on these test rows when it was trained.
            before = current.evaluate(df.filter("split = 'test'"))
            won = models.wins(current, before, fresh.score, threshold)
            packages[name], status[name] = (fresh, "updated") if won else (current, "kept")
            scores[name] = fresh.score if won else before
        if model_dir and status[name] != "kept":
            models.save_package(spark, packages[name], model_dir)
    frames = {name: df for name, (df, _) in prepared.items()}
    updated = replace(context, star=star, prepared=frames, packages=packages, usage=usage)
    board = dashboard(context, updated, received, status, scores)
    return updated, board


def dashboard(
    before: PipelineContext,
    after: PipelineContext,
    received: DataFrame,
    status: Mapping[str, str],
    scores: Mapping[str, Mapping[str, float]],
) -> DataFrame:
    """``(section, name, metric, value, detail)`` rows of an ingest run.

    ``scores`` are those of the models, kept or new, on the test rows of this run.
    """
    spark = received.sparkSession

    def counted(df: DataFrame, section: str, name: str, metric: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit(section).alias("section"),
            F.lit(name).alias("name"),
            F.lit(metric).alias("metric"),
            "value",
            F.lit(None).cast("string").alias("detail"),
        )

    # One definition of a new row: what the merged fact has more than the one before.
    previous, total = before.star.fact_sales.count(), after.star.fact_sales.count()
    figures = {"previous_rows": previous, "net_new_rows": total - previous, "total_rows": total}
    parts = [counted(received, "ingestion", "sales", "received_rows")]
    known: list[tuple] = [("ingestion", "sales", k, float(v), None) for k, v in figures.items()]
    for name, df in after.prepared.items():
        parts.append(counted(df, "datasets", name, "rows"))
        known.append(("datasets", name, "columns", float(len(df.columns)), None))
    for name, package in after.packages.items():
        known.append(("models", name, "status", None, status[name]))
        known += [("models", name, f"parameter_{k}", None, str(v)) for k, v in package.parameters.items()]
        if package.model is None:
            continue
        score = scores.get(name, package.score)  # a first model was scored on this run's rows
        known += [("models", name, k, v, None) for k, v in score.items()]
        known += [("importance", name, f, v, None) for f, v in package.model.importances().items()]
    schema = "section string, name string, metric string, value double, detail string"
    parts.append(spark.createDataFrame(known, schema))
    summary = manifest.row_usage_summary(after.usage)
    for metric in ("used_count", "unused_count"):
        parts.append(
            summary.select(
                F.lit("row_usage").alias("section"),
                F.col("table_name").alias("name"),
                F.lit(metric).alias("metric"),
                F.col(metric).cast("double").alias("value"),
                F.col("pk_column").alias("detail"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
