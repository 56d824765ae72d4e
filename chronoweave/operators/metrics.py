"""Evaluation tables from confusion counts; one aggregate each, no collected predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(
        *by, F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; the windows run over classes, not rows."""
    counts = confusion_counts(df, label, prediction, by)
    sides = counts.select(
        *by, "n", F.inline(F.array(
            F.struct(F.col("label").alias("class"), F.lit(True).alias("_actual")),
            F.struct(F.col("prediction").alias("class"), F.lit(False).alias("_actual")),
        )), (F.col("label") == F.col("prediction")).alias("_hit"),
    )
    per_class = sides.groupBy(*by, "class").agg(
        F.sum(F.when(F.col("_actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("_actual"), F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("_actual") & F.col("_hit"), F.col("n")).otherwise(0)).alias("hits"),
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hits", "predicted"), zero)
    recall = F.coalesce(F.try_divide("hits", "support"), zero)
    return per_class.select(
        *by, "class", precision.alias("precision"), recall.alias("recall"),
        F.coalesce(F.try_divide(F.col("hits") * 2, F.col("support") + F.col("predicted")), zero).alias("f1"),
        "support", "hits",
    )


def weighted_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted F1, precision and recall."""
    report = class_report(df, label, prediction, by)
    total = F.sum("support")

    def weighted(name: str) -> Column:
        return (F.sum(F.col(name) * F.col("support")) / total).alias(f"weighted_{name}")

    return report.groupBy(*by).agg(
        (F.sum("hits") / total).alias("accuracy"), weighted("f1"), weighted("precision"), weighted("recall")
    )


def ensemble_vote(predictions: Sequence[Column], rule: str = "any") -> Column:
    """Combine 0/1 predictions: any, strict majority, or all of them."""
    votes = sum(predictions[1:], predictions[0])
    needed = {"any": 1, "majority": len(predictions) // 2 + 1, "all": len(predictions)}
    if rule not in needed:
        raise ValueError(f"unknown rule {rule!r}")
    return F.when(votes >= needed[rule], 1.0).otherwise(0.0)


def threshold_vote(predictions: Sequence[Column], share: float = 0.5) -> Column:
    """1 when the votes reach ``share`` of the models; with two models and 0.5 one vote is enough."""
    votes = sum(predictions[1:], predictions[0])
    return F.when(votes >= len(predictions) * share, 1.0).otherwise(0.0)


def apply_threshold(df: DataFrame, probability: str, cutoff: float, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, F.when(F.col(probability) >= cutoff, 1.0).otherwise(0.0))


def threshold_search(df: DataFrame, probability: str, label: str, steps: int = 100) -> DataFrame:
    """Precision, recall and F1 at each cut-off ``k / steps``, and which one has the best F1.

    Rows are counted once per score bin; the cut-offs then work on at most ``2 * (steps + 1)`` counts.
    """
    p = F.col(probability)
    # The comparison repairs bins that floating-point division puts one too high or too low.
    k = F.floor(p * steps)
    k = F.when((k + 1) / steps <= p, k + 1).when(k / steps > p, k - 1).otherwise(k)
    # Scores outside of [0, 1] are above all cut-offs or below them, and still count.
    k = F.greatest(F.lit(-1), F.least(F.lit(steps), k)).cast("int")
    positive = F.col(label).cast("int") == 1
    bins = df.filter(p.isNotNull()).groupBy(k.alias("bin")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    every = df.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("bin"))
    filled = every.join(bins, "bin", "left").fillna(0, ["pos", "neg"])
    above = Window.orderBy(F.col("bin").desc())  # steps + 2 rows
    swept = filled.select(
        "bin",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        F.sum("pos").over(Window.partitionBy()).alias("actual"),
    ).filter("bin >= 0")
    zero = F.lit(0.0)
    scored = swept.select(
        (F.col("bin") / steps).alias("threshold"), "tp", "fp", (F.col("actual") - F.col("tp")).alias("fn"),
        F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), zero).alias("precision"),
        F.coalesce(F.try_divide("tp", "actual"), zero).alias("recall"),
        F.coalesce(F.try_divide(F.col("tp") * 2, F.col("tp") + F.col("fp") + F.col("actual")), zero).alias("f1"),
    )
    best = F.row_number().over(Window.orderBy(F.col("f1").desc(), "threshold")) == 1
    return scored.withColumn("best", best)


def probability_errors(df: DataFrame, probability: str, label: str) -> DataFrame:
    gap = F.col(probability) - F.col(label)
    return df.agg(F.avg(F.abs(gap)).alias("mae"), F.avg(gap * gap).alias("mse"))


def log_loss(df: DataFrame, probability: str, label: str, edge: float = 1e-15) -> DataFrame:
    """Binary cross-entropy with probabilities kept off 0 and 1."""
    p = F.least(F.greatest(F.col(probability), F.lit(edge)), F.lit(1 - edge))
    y = F.col(label)
    return df.agg((-F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"))


def binary_scores(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Recall, precision and F1 of the positive class."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(y).alias("actual"), F.count_if(p).alias("predicted")
    )
    zero = F.lit(0.0)
    return counts.select(
        *by,
        F.coalesce(F.try_divide("tp", "actual"), zero).alias("recall"),
        F.coalesce(F.try_divide("tp", "predicted"), zero).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp") * 2, F.col("actual") + F.col("predicted")), zero).alias("f1"),
    )


def log_metrics(spark: SparkSession, path: str, run: str, params: dict, metrics: dict) -> None:
    """Append one run to a metrics table: one row per parameter and metric."""
    rows = [(run, "param", k, str(v), None) for k, v in params.items()]
    rows += [(run, "metric", k, None, float(v)) for k, v in metrics.items()]
    spark.createDataFrame(rows, "run string, kind string, name string, text string, value double").coalesce(
        1
    ).write.mode("append").parquet(path)


def metrics_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
