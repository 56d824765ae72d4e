"""From the feature table to an evaluated ensemble."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.operators import clean, enrich, metrics, models, prep
from chronoweave.sources.stages import ModelStore, StageStore, input_version


@dataclass(frozen=True)
class ModelSpec:
    """Column roles of a model table."""

    label: str
    keys: Sequence[str]
    hash_keys: Sequence[str]
    period: str
    month: str
    numeric: Sequence[str]
    extra: Sequence[str] = ()
    categorical: Sequence[str] = ()
    order: Sequence[str] = ()
    cancelled: str | None = None
    blocks: Sequence[int] = field(default_factory=list)
    test_period: int = 0
    features: Sequence[str] = ("scaled_features",)


def model_rows(features: DataFrame, spec: ModelSpec, sparse_share: float = 0.5) -> DataFrame:
    """Complete, unique, not cancelled rows with the columns a model needs."""
    required = list(dict.fromkeys([spec.label, *spec.keys]))
    rows = clean.drop_missing_required(features, required)
    # One row per key even where the label differs, so that predictions can be joined on the key.
    rows = clean.dedup_keys(rows, list(spec.keys), [*spec.order, spec.label])
    if spec.cancelled:
        rows = clean.null_safe_filter(rows, spec.cancelled, 1)
    rows = clean.drop_sparse_columns(rows, sparse_share)
    wanted = [*required, *spec.hash_keys, spec.period, spec.month, *spec.numeric, *spec.extra, *spec.categorical]
    selected, missing = clean.project_available(rows, list(dict.fromkeys(wanted)))
    if missing:
        raise ValueError(f"columns are missing or too sparse: {missing}")
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("UNK")) for c in spec.categorical}
    return selected.withColumns(texts) if texts else selected


def balanced_tables(rows: DataFrame, spec: ModelSpec) -> tuple[DataFrame, DataFrame]:
    """Balanced training rows and the held-out period, scaled by bounds of the unbalanced training rows."""
    train = rows.filter(F.col(spec.period).isin(list(spec.blocks)))
    held_out = rows.filter(F.col(spec.period) == spec.test_period)
    balanced = prep.undersample_majority(train, spec.label, spec.period, spec.hash_keys)
    _, tables = prep.fit_and_apply(prep.prep_pipeline(spec.numeric), train, balanced, held_out)
    return tables[0], tables[1]


def prepare_tables(stages: StageStore, features: DataFrame, spec: ModelSpec, version: str = "1", inputs: Sequence[str] = ()):
    """Store the model rows and the scaled tables, then return (train, test) read from storage.

    Grid searches read these tables many times, so the cleaning before them should run once.  ``inputs``
    are the paths that ``features`` comes from: tables built before one of their files changed are not picked up.
    """
    version = input_version(stages.spark, *inputs) if inputs else version
    rows = stages.stage("preprocessed", lambda: model_rows(features, spec), version)

    def transformed() -> DataFrame:
        train, test = balanced_tables(rows, spec)
        return train.withColumn("_held_out", F.lit(False)).unionByName(test.withColumn("_held_out", F.lit(True)))

    both = stages.stage("transformed", transformed, version)
    return both.filter("NOT _held_out"), both.filter("_held_out")


def fit_models(
    train: DataFrame,
    test: DataFrame,
    spec: ModelSpec,
    store: ModelStore | None = None,
    logreg_grid=models.LOGREG_GRID,
    mlp_grid=models.MLP_GRID,
    max_iter: int = 100,
) -> dict[str, models.BlockedSearch]:
    """Blocked grid searches for both model families; the winners are stored by name."""
    both = train.unionByName(test)
    args = (both, list(spec.features), spec.label, spec.period, spec.month, list(spec.blocks), spec.test_period)
    found = {
        "logreg": models.blocked_cv_logreg(*args, grid=logreg_grid, max_iter=max_iter),
        "mlp": models.blocked_cv_mlp(*args, grid=mlp_grid),
    }
    if store:
        for name, search in found.items():
            store.save(search.model, name)
    return found


def _scored(model, table: DataFrame, spec: ModelSpec) -> DataFrame:
    assembled = prep.assemble_features(list(spec.features), "_features").transform(table)
    rows = assembled.select(*spec.keys, spec.month, F.col(spec.label).cast("double").alias("label"), F.col("_features").alias("features"))
    return models.score(model, rows)


def choose_thresholds(fitted: dict, train: DataFrame, spec: ModelSpec, steps: int = 100) -> dict[str, float]:
    """Cut-off with the best F1 of each model on the validation months of the training blocks; the held-out period has no say."""
    late = train.filter(prep.blocked_time_split(F.col(spec.month)) == "validation")
    found = {}
    for name, model in fitted.items():
        sweep = metrics.threshold_search(_scored(model, late, spec), "p", "label", steps)
        found[name] = sweep.filter("best").first()["threshold"]  # one row
    return found


def ensemble_predictions(
    fitted: dict, test: DataFrame, spec: ModelSpec, rule: str = "any", thresholds: dict[str, float] | None = None
) -> DataFrame:
    """Score the held-out rows with every model, join on the row key and vote; a null feature is an error.

    With ``thresholds``, as :func:`choose_thresholds` finds them, a model votes by its own cut-off.
    """
    outputs = []
    for name, model in fitted.items():
        scored = _scored(model, test, spec)
        if thresholds:
            scored = metrics.apply_threshold(scored.drop("prediction"), "p", thresholds[name])
        kept = [*spec.keys, F.col("prediction").alias(f"{name}_prediction"), F.col("p").alias(f"{name}_p")]
        outputs.append(scored.select(*kept, *(["label"] if not outputs else [])))
    joined = enrich.prediction_join(outputs, list(spec.keys))
    votes = [F.col(f"{name}_prediction") for name in fitted]
    return joined.withColumn("prediction", metrics.ensemble_vote(votes, rule))


def log_runs(spark: SparkSession, path: str, run: str, found: dict[str, models.BlockedSearch], thresholds: dict[str, float] | None = None) -> None:
    """Append the searches to a metrics table: every grid point, and the winner with its scores on the held-out period."""
    for name, search in found.items():
        for at, row in enumerate(search.grid.collect()):  # one row per grid point
            point = row.asDict()
            means = {k: point.pop(k) for k in ("mean_recall", "mean_f1")}
            metrics.log_metrics(spark, path, f"{run}-{name}-{at}", point, means)
        test = search.test.first().asDict()
        cut = {"threshold": thresholds[name]} if thresholds else {}
        metrics.log_metrics(spark, path, f"{run}-{name}-best", search.best, {**test, **cut})


def ensemble_report(predictions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-class report and weighted summary of the vote."""
    return (
        metrics.class_report(predictions, "label", "prediction"),
        metrics.weighted_metrics(predictions, "label", "prediction"),
    )
