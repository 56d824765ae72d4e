"""Model fitting with blocked time-series validation, importances and feature selection.

Fits are MLlib jobs over one cached table of ``(features, label, block, role)``; folds are filters
on that table.  Independent fits run from a small thread pool, as the built-in cross-validator does.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, NumericType, StructField, StructType

from chronoweave.functions.scalars import key_hash
from chronoweave.operators.clean import columns_of_type
from chronoweave.operators.metrics import binary_scores
from chronoweave.operators.prep import auto_encode_strings, blocked_time_split
from chronoweave.ordering import positions
from chronoweave.scratch import write_scratch
from chronoweave.skew import TASK_ROWS

#: Further steps of a place that lands beyond the last row; on a large table one in many needs a single one.
WALK_STEPS = 16
#: Rows of a part in which moved values meet their rows.
PART_ROWS = 500_000
#: Bins of a feature in a tree fit, which is MLlib's default, and accuracy of the percentiles that bound them.
TREE_BINS = 32
BIN_ACCURACY = 10_000
#: Cells whose weights one task draws.
DRAWN_CELLS = 100_000

#: The grids the published results were found with.
LOGREG_GRID = (
    {"regParam": 0.01, "elasticNetParam": 0.0},
    {"regParam": 0.01, "elasticNetParam": 0.5},
    {"regParam": 0.1, "elasticNetParam": 0.0},
    {"regParam": 0.1, "elasticNetParam": 0.5},
    {"regParam": 1.0, "elasticNetParam": 0.0},
    {"regParam": 1.0, "elasticNetParam": 0.5},
)
MLP_GRID = (
    {"hidden_layers": [10, 2], "maxIter": 50, "stepSize": 0.03},
    {"hidden_layers": [20, 10, 2], "maxIter": 80, "stepSize": 0.05},
    {"hidden_layers": [50, 25, 10, 2], "maxIter": 100, "stepSize": 0.1},
)


@contextmanager
def kept(df: DataFrame):
    """Persist for the duration of a block."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def model_table(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    period: str | None = None,
    month: str | None = None,
    last_train_month: int = 9,
    invalid: str = "error",
    weight: str | None = None,
) -> DataFrame:
    """Only what a fit needs: the vector, the label, and the block, role and weight of the row.

    A null feature is an error unless ``invalid`` says ``skip`` (leave the row out) or ``keep``.
    """
    assembled = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid=invalid).transform(df)
    columns = [F.col("_features").alias("features"), F.col(label).cast("double").alias("label")]
    if period:
        columns.append(F.col(period).alias("block"))
    if month:
        columns.append(blocked_time_split(F.col(month), last_train_month).alias("role"))
    if weight:
        columns.append(F.col(weight).cast("double").alias("weight"))
    return assembled.select(*columns)


def score(model: Model, df: DataFrame) -> DataFrame:
    """Apply a classifier and add ``p``, the probability of the positive class."""
    return model.transform(df).withColumn("p", vector_to_array("probability")[1])


def logreg_baseline(
    df: DataFrame, features: Sequence[str], label: str, month: str, last_train_month: int = 9, **params
) -> tuple[Model, DataFrame]:
    """Train on the first months and report recall, precision and F1 on the rest."""
    table = model_table(df, features, label, month=month, last_train_month=last_train_month)
    with kept(table) as rows:
        model = LogisticRegression(**params).fit(rows.filter("role = 'train'"))
        scored = model.transform(rows.filter("role = 'validation'"))
        result = binary_scores(scored, "label", "prediction").first()
    return model, df.sparkSession.createDataFrame([result])


@dataclass
class BlockedSearch:
    """Result of a blocked grid search: the refitted model, the grid table and the test scores."""

    model: Model
    best: dict
    grid: DataFrame
    test: DataFrame


def blocked_search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    period: str,
    month: str,
    blocks: Sequence[int],
    test_period: int,
    grid: Sequence[dict],
    estimator: Callable[[dict, int], Estimator],
    parallelism: int = 4,
) -> BlockedSearch:
    """Per block fit on its first months and validate on its last; choose by mean F1, refit on all blocks."""
    wanted = F.col(period).isin([*blocks, test_period])
    table = model_table(df.filter(wanted), features, label, period, month)
    spark = df.sparkSession
    with kept(table) as rows:
        width = len(rows.select("features").first()["features"])
        folds = [(i, block) for i in range(len(grid)) for block in blocks]

        def run(job: tuple[int, int]) -> tuple[int, float, float]:
            i, block = job
            fold = rows.filter(F.col("block") == block)
            model = estimator(grid[i], width).fit(fold.filter("role = 'train'"))
            found = binary_scores(model.transform(fold.filter("role = 'validation'")), "label", "prediction").first()
            return i, found["recall"], found["f1"]

        # Every job has its own copy of the local properties: a running query sets and clears its number there.
        jobs = [inheritable_thread_target(spark)(partial(run, fold)) for fold in folds]
        with ThreadPool(min(parallelism, len(folds))) as pool:
            results = pool.map(lambda job: job(), jobs)
        table_rows = []
        for i, params in enumerate(grid):
            mine = [r for r in results if r[0] == i]
            mean_recall = sum(r[1] for r in mine) / len(mine)
            mean_f1 = sum(r[2] for r in mine) / len(mine)
            table_rows.append({**{k: str(v) for k, v in params.items()}, "mean_recall": mean_recall, "mean_f1": mean_f1})
        winner = max(range(len(grid)), key=lambda i: (table_rows[i]["mean_f1"], -i))
        model = estimator(grid[winner], width).fit(rows.filter(F.col("block").isin(list(blocks))))
        held_out = model.transform(rows.filter(F.col("block") == test_period))
        test = binary_scores(held_out, "label", "prediction").first()
    names = [*grid[0], "mean_recall", "mean_f1"]
    schema = ", ".join(f"{n} {'double' if n.startswith('mean_') else 'string'}" for n in names)
    return BlockedSearch(
        model,
        dict(grid[winner]),
        spark.createDataFrame([tuple(r[n] for n in names) for r in table_rows], schema),
        spark.createDataFrame([test]),
    )


def blocked_cv_logreg(
    df, features, label, period, month, blocks, test_period, grid=LOGREG_GRID, max_iter=100, parallelism=4
) -> BlockedSearch:
    """Blocked grid search over logistic regressions."""
    return blocked_search(
        df, features, label, period, month, blocks, test_period, grid,
        lambda params, _: LogisticRegression(maxIter=max_iter, **params), parallelism,
    )


def blocked_cv_mlp(
    df, features, label, period, month, blocks, test_period, grid=MLP_GRID, seed=42, parallelism=4
) -> BlockedSearch:
    """Blocked grid search over multilayer perceptrons; the input width comes from the data."""

    def build(params: dict, width: int) -> Estimator:
        rest = {k: v for k, v in params.items() if k != "hidden_layers"}
        return MultilayerPerceptronClassifier(layers=[width, *params["hidden_layers"]], seed=seed, **rest)

    return blocked_search(df, features, label, period, month, blocks, test_period, grid, build, parallelism)


def _importance_table(df: DataFrame, names: Sequence[str], importances) -> DataFrame:
    rows = [(name, float(importances[i])) for i, name in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def _bin_bounds(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Inner bounds of each feature's bins: all its values if they are no more than ``bins``, else percentiles."""
    points = [i / bins for i in range(1, bins)]
    numbers = df.select(*(F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(features)))
    asked = [
        F.struct(F.approx_count_distinct(v).alias("distinct"), F.percentile_approx(v, points, BIN_ACCURACY).alias("at")).alias(v)
        for v in numbers.columns
    ]
    found = numbers.agg(*asked).first()
    bounds = []
    for v in numbers.columns:
        values = found[v]["at"] or []
        if found[v]["distinct"] <= 2 * bins:  # the count is approximate, so the few values decide themselves
            few = [r[0] for r in numbers.select(v).dropna().distinct().limit(bins + 1).collect()]
            values = sorted(few)[1:] if len(few) <= bins else values
        bounds.append(sorted({x + 0.0 for x in values if math.isfinite(x)}))
    return bounds


def tree_cells(df: DataFrame, features: Sequence[str], label: str, bins: int = TREE_BINS, task_rows: int = TASK_ROWS) -> DataFrame | None:
    """Rows that a tree fit cannot tell apart, merged: bins of the features, label and ``weight``, their number.

    Trees split between the bins of a feature only, so a fit of weighted cells finds the splits that one of
    all rows finds.  Bins are bounded by percentiles of all rows, where a fit of rows takes a sample for them.
    None if the table is small or hardly merges; then rows are fitted as they are.
    """
    kinds = [df.schema[c].dataType for c in features]
    if not features or not all(isinstance(k, (NumericType, BooleanType)) for k in kinds):
        return None
    rows = df.count()
    if rows <= task_rows:
        return None
    bounds = _bin_bounds(df, features, bins)
    raw = [f"v{i}" for i in range(len(features))]
    splits = [[-math.inf, *(at or [0.0]), math.inf] for at in bounds]
    numbers = df.select(*(F.col(f"`{c}`").cast("double").alias(v) for c, v in zip(features, raw)), F.col(label).cast("double").alias("y"))
    # As in a fit of rows a missing number is an error: NaN here, null where the vector is assembled.
    binned = Bucketizer(splitsArray=splits, inputCols=raw, outputCols=[f"b{i}" for i in range(len(features))]).transform(numbers)
    # The cast leaves out that the bucketizer calls its numbers nominal: bins stay in order.
    keys = [*(F.col(f"b{i}").cast("int").alias(c) for i, c in enumerate(features)), F.col("y").alias(label)]
    cells = write_scratch(binned.groupBy(*keys).agg(F.count(F.lit(1)).alias("weight")), "cells").df
    return cells if 2 * cells.count() <= rows else None


def bagged_cells(cells: DataFrame, trees: int, seed: int) -> DataFrame:
    """Add ``w0``, ``w1``, ...: how often a bootstrap sample for each tree takes rows of the cell.

    A bootstrap takes every row a Poisson(1) number of times, so it takes a cell of n equal rows Poisson(n) times.
    """
    keys = [c for c in cells.columns if c != "weight"]
    at = cells.columns.index("weight")

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chance = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            taken = chance.poisson(batch.column(at).to_numpy()[:, None], (batch.num_rows, trees)).astype(np.int32)
            columns = [*batch.columns, *(pa.array(taken[:, t]) for t in range(trees))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *(f"w{t}" for t in range(trees))])

    # Cells are dealt and sorted by all they hold, so a rerun draws the same.
    dealt = cells.repartition(math.ceil(cells.count() / DRAWN_CELLS), *(f"`{c}`" for c in keys))
    schema = StructType([*cells.schema.fields, *(StructField(f"w{t}", IntegerType()) for t in range(trees))])
    return write_scratch(dealt.sortWithinPartitions(*(f"`{c}`" for c in keys)).mapInArrow(drawn, schema), "bags").df


def gbt_importance(
    df: DataFrame, features: Sequence[str], label: str, top: int = 20, task_rows: int = TASK_ROWS, **params
) -> DataFrame:
    """Feature importances of gradient-boosted trees, largest first."""
    settings = {"maxDepth": 5, "maxIter": 20, "stepSize": 0.1, "subsamplingRate": 1.0, "seed": 31} | params
    # A cell stands for its rows unless rows are drawn, weighed or counted one by one.
    merges = settings["subsamplingRate"] == 1.0 and not {"minInstancesPerNode", "validationIndicatorCol", "weightCol"} & settings.keys()
    cells = tree_cells(df, features, label, settings.get("maxBins", TREE_BINS), task_rows) if merges else None
    if cells is None:
        model = GBTClassifier(**settings).fit(model_table(df, features, label))
    else:
        with kept(model_table(cells, features, label, weight="weight")) as table:
            model = GBTClassifier(weightCol="weight", **settings).fit(table)
    return _importance_table(df, features, model.featureImportances).orderBy(F.col("importance").desc(), "feature").limit(top)


def _forest_importances(cells: DataFrame, features: Sequence[str], label: str, trees: int, seed: int, parallelism: int = 4) -> list[float]:
    """Importances of a forest whose trees are fitted each on its own bootstrap sample of the cells."""
    bags = bagged_cells(cells, trees, seed)
    # What a forest of several trees offers to each node by default.
    subset = "sqrt" if trees > 1 else "all"

    def fit(t: int):
        bag = model_table(bags.filter(F.col(f"w{t}") > 0), features, label, weight=f"w{t}")
        tree = RandomForestClassifier(numTrees=1, bootstrap=False, featureSubsetStrategy=subset, weightCol="weight", seed=seed + t)
        model = tree.fit(bag)
        # A forest adds up what its trees gain a row: the impurity of all rows less that of the leaves.
        pure = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, p: a + p * p)
        classes = model.transform(bag).groupBy("label").agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * pure).alias("pure")).collect()
        taken = sum(c["n"] for c in classes)
        gain = sum(c["pure"] for c in classes) / taken - sum((c["n"] / taken) ** 2 for c in classes) if taken else 0.0
        return gain * model.featureImportances.toArray()

    jobs = [inheritable_thread_target(cells.sparkSession)(partial(fit, t)) for t in range(trees)]
    with ThreadPool(min(parallelism, trees)) as pool:
        total = sum(pool.map(lambda job: job(), jobs, chunksize=1))
    return (total / total.sum() if total.sum() else total).tolist()


def rf_feature_selection(
    df: DataFrame, label: str, threshold: float = 0.001, trees: int = 50, seed: int = 42, task_rows: int = TASK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Numeric columns whose forest importance reaches the threshold: (selected table, importances)."""
    features = columns_of_type(df, exclude=[label])
    cells = tree_cells(df, features, label, task_rows=task_rows)
    if cells is None:
        importances = RandomForestClassifier(numTrees=trees, seed=seed).fit(model_table(df, features, label)).featureImportances
    else:
        importances = _forest_importances(cells, features, label, trees, seed)
    table = _importance_table(df, features, importances)
    selected = [name for i, name in enumerate(features) if importances[i] >= threshold]
    return df.select(label, *selected), table


def process_and_select(
    df: DataFrame, label: str, one_hot_limit: int = 20, embed: Sequence[str] = (), threshold: float = 0.01, **params
) -> tuple[DataFrame, DataFrame]:
    """Encode the string columns, then select numeric features with a forest."""
    return rf_feature_selection(auto_encode_strings(df, one_hot_limit, embed), label, threshold, **params)


def permuted_place(place: Column, rows: int, key: int) -> Column:
    """Where a row at ``place`` (0 to ``rows`` - 1) goes: a keyed bijection, computed without seeing other rows.

    Four Feistel rounds permute a grid of about the square root of ``rows`` on either side.  Fewer cells than one
    side lie beyond the last row; a place that lands there moves on, which ends within as many steps.
    """
    wide = max(math.isqrt(max(rows - 1, 0)) + 1, 1)
    high = -(-rows // wide)

    def moved(p: Column) -> Column:
        x, y = F.floor(p / wide), F.pmod(p, F.lit(wide))
        for turn in range(4):
            if turn % 2:
                y = F.pmod(y + key_hash(x, F.lit(4 * key + turn)), F.lit(wide))
            else:
                x = F.pmod(x + key_hash(y, F.lit(4 * key + turn)), F.lit(high))
        return x * wide + y

    steps = F.sequence(F.lit(1), F.lit(min(wide, WALK_STEPS)))
    return F.aggregate(steps, moved(place), lambda p, _: F.when(p >= rows, moved(p)).otherwise(p))


def permuted_variants(df: DataFrame, features: Sequence[str], label: str, order: Sequence[str | Column], seed: int = 42) -> DataFrame:
    """(variant, label, features): the rows as they are, and once per feature with that feature's values moved to other rows.

    Rows are numbered in a total order; every feature then has its own bijection of the numbers.  All moves
    of all features happen in one exchange, and every row is kept.
    """
    held = [f"b{i}" for i in range(len(features))]
    doubles = dict(zip([*features, label], [*held, "y"]))
    # A column that a double holds exactly is ordered by its copy, so it travels once.
    exact = {c for c, kind in df.dtypes if kind in ("double", "float", "int", "smallint", "tinyint")}
    ordered = [doubles[c] if isinstance(c, str) and c in doubles and c in exact else c for c in order]
    carried = [c for c, o in zip(order, ordered) if o is c]
    numbered = positions(df.select(*(F.col(c).cast("double").alias(h) for c, h in doubles.items()), *carried), ordered, "at")
    numbered = write_scratch(numbered.select(*held, "y", (F.col("at") - 1).alias("at")), "numbered").df
    rows = numbered.count()
    own = F.struct(F.col("at").alias("to"), F.lit(-1).alias("which"), *held, "y")
    only = lambda i: [(F.col(h) if h == f"b{i}" else F.lit(None).cast("double")).alias(h) for h in (*held, "y")]
    moves = [F.struct(permuted_place(F.col("at"), rows, seed + i).alias("to"), F.lit(i).alias("which"), *only(i)) for i in range(len(held))]
    # Nothing merges before rows meet, so they are exchanged as they are, into parts that fit a task.
    parts = max(1, math.ceil(rows * (1 + len(held)) / PART_ROWS))
    # A stored part may hold very many of these narrow rows; what one task sends is bounded too.
    dealt = numbered.repartition(math.ceil(rows / TASK_ROWS), "at") if rows > TASK_ROWS else numbered
    sent = dealt.select(F.inline(F.array(own, *moves))).repartition(parts, "to")
    sender = lambda i, h: F.max(F.when(F.col("which") == i, F.col(h)))
    arrived = sent.groupBy("to").agg(
        *(sender(-1, h).alias(h) for h in (*held, "y")), *(sender(i, h).alias(f"m{i}") for i, h in enumerate(held))
    )
    variant = lambda k: F.struct(
        F.lit("" if k is None else features[k]).alias("variant"),
        *(F.col(f"m{i}" if i == k else h).alias(c) for i, (h, c) in enumerate(zip(held, features))),
    )
    return arrived.select(F.col("y").alias(label), F.inline(F.array(variant(None), *map(variant, range(len(held))))))


def permutation_importance(
    model: Model | Callable[[DataFrame], DataFrame],
    df: DataFrame,
    features: Sequence[str],
    label: str,
    order: Sequence[str | Column],
    seed: int = 42,
    invalid: str = "error",
) -> DataFrame:
    """Drop in accuracy when one feature's values are moved between rows; one pass scores all variants.

    ``model`` is a fitted classifier, or a function that adds ``prediction`` to a table of the features.
    Every row counts; a null feature is an error to a classifier unless ``invalid`` is ``keep``.
    """
    variants = permuted_variants(df, features, label, order, seed)
    if isinstance(model, Model):
        vectors = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=invalid)
        scored = model.transform(vectors.transform(variants))
    else:
        scored = model(variants)
    right = F.avg(F.coalesce(F.col("prediction") == F.col(label), F.lit(False)).cast("double"))
    accuracy = {r["variant"]: r["right"] for r in scored.groupBy("variant").agg(right.alias("right")).collect()}  # one row per feature
    drops = [(name, accuracy[""] - accuracy[name]) for name in features] if accuracy else []
    return df.sparkSession.createDataFrame(drops, "feature string, importance double")
