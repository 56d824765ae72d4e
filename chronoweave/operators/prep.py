"""Balancing, imputation, scaling and encoding before a model sees the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    FeatureHasher,
    HashingTF,
    Imputer,
    MinMaxScaler,
    OneHotEncoder,
    RobustScaler,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from chronoweave.functions.scalars import key_hash
from chronoweave.operators import dictionary
from chronoweave.operators.clean import columns_of_type, fill_median
from chronoweave.operators.profile import distinct_ratio
from chronoweave.ordering import exact_quantiles
from chronoweave.skew import small_side


def undersample_majority(df: DataFrame, label: str, block: str, keys: Sequence[str]) -> DataFrame:
    """Keep all positives and, per block, about as many negatives.

    One aggregate finds every block's ratio (at most 1); a key hash picks the rows, so the same rows
    come back on any cluster.  ``keys`` are integer columns that identify a row.
    """
    y = F.col(label)
    counts = df.groupBy(block).agg(F.count_if(y == 1).alias("_pos"), F.count_if(y == 0).alias("_neg"))
    ratios = counts.select(block, F.least(F.coalesce(F.try_divide("_pos", "_neg"), F.lit(1.0)), F.lit(1.0)).alias("_ratio"))
    chosen = key_hash(*map(F.col, keys)) < F.col("_ratio") * F.lit(float(2**32))
    ratios = ratios.withColumnRenamed(block, "_block")
    same = F.col(block).eqNullSafe(F.col("_block"))
    return df.join(small_side(ratios), same).filter((y == 1) | ((y == 0) & chosen)).drop("_ratio").select(*df.columns)


def impute(columns: Sequence[str], strategy: str = "median", suffix: str = "_imputed") -> Imputer:
    return Imputer(strategy=strategy, inputCols=list(columns), outputCols=[f"{c}{suffix}" for c in columns])


def impute_table(df: DataFrame, columns: Sequence[str], strategy: str = "median") -> DataFrame:
    """Add ``{column}_imputed`` columns; one fit serves all columns."""
    numeric = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return impute(columns, strategy).fit(numeric).transform(numeric)


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``{column}_imputed`` columns filled with the exact interpolated median."""
    copies = df.withColumns({f"{c}_imputed": F.col(c).cast("double") for c in columns})
    return fill_median(copies, [f"{c}_imputed" for c in columns], exact=True)


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``{column}_imputed`` of the column's own type, nulls filled with the most frequent value, the smallest one on a tie.

    Values are counted with map-side combine, so a column's values never gather in one task.  Columns
    of one type share an aggregate.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    modes = {}
    for kind in dict.fromkeys(kinds.values()):
        entry = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value")) for c in columns if kinds[c] == kind]
        counts = df.select(F.inline(F.array(*entry))).filter("value IS NOT NULL").groupBy("feature", "value").agg(F.count("*").alias("n"))
        top = counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"))
        modes |= {r["feature"]: r["mode"] for r in top.collect()}  # one row per column
    return df.withColumns({f"{c}_imputed": F.coalesce(F.col(f"`{c}`"), F.lit(modes.get(c)).cast(kinds[c])) for c in columns})


def assemble_features(columns: Sequence[str], out: str = "features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid=invalid)


def minmax_scale(column: str = "features", out: str = "scaled_features") -> MinMaxScaler:
    return MinMaxScaler(inputCol=column, outputCol=out)


def minmax_table(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Column-wise form of the scaler: one aggregate for all bounds, then a projection.

    A constant column becomes 0.5, the middle of the range, as the vector scaler does.
    """
    bounds = df.agg(*(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns)).first()
    scaled = {}
    for c in columns:
        lo, hi = bounds[c]["lo"], bounds[c]["hi"]
        if lo is None:
            scaled[f"{c}{suffix}"] = F.lit(None).cast("double")
        elif lo == hi:
            scaled[f"{c}{suffix}"] = F.when(F.col(c).isNotNull(), F.lit(0.5))
        else:
            scaled[f"{c}{suffix}"] = (F.col(c) - F.lit(lo)) / F.lit(hi - lo)
    return df.withColumns(scaled)


def robust_scale(column: str = "features", out: str = "scaled_features") -> RobustScaler:
    return RobustScaler(inputCol=column, outputCol=out, withCentering=True, withScaling=True)


def robust_table(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled") -> DataFrame:
    """Column-wise form with exact quartiles: distance from the median in interquartile ranges."""
    long = df.select(*(F.col(c).cast("double").alias(c) for c in columns)).unpivot([], list(columns), "feature", "value")
    found = exact_quantiles(long, ["feature"], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}).collect()
    scaled = {}
    for row in found:  # one row per column
        spread = row["q3"] - row["q1"]
        centred = F.col(row["feature"]) - F.lit(row["median"])
        scaled[f"{row['feature']}{suffix}"] = centred / F.lit(spread) if spread else centred * F.lit(0.0)
    return df.withColumns(scaled)


def hash_categoricals(columns: Sequence[str], out: str = "categorical_features", buckets: int = 1000) -> FeatureHasher:
    return FeatureHasher(inputCols=list(columns), outputCol=out, numFeatures=buckets)


def prep_pipeline(columns: Sequence[str], out: str = "scaled_features") -> Pipeline:
    """Median imputation, assembly and min-max scaling."""
    imputed = [f"{c}_imputed" for c in columns]
    return Pipeline(stages=[impute(columns), assemble_features(imputed), minmax_scale(out=out)])


def fit_and_apply(
    pipeline: Pipeline, fit_on: DataFrame, *apply_to: DataFrame
) -> tuple[PipelineModel, list[DataFrame]]:
    """Fit on the unbalanced training rows only and apply the result to each table."""
    model = pipeline.fit(fit_on)
    return model, [model.transform(df) for df in apply_to]


def blocked_time_split(month: Column, last_train_month: int = 9) -> Column:
    """Role of a row inside its block; a column instead of a copy of the table per fold."""
    return F.when(month <= last_train_month, "train").otherwise("validation")


def array_features(df: DataFrame, vector: str, out: str = "features_array") -> DataFrame:
    return df.withColumn(out, vector_to_array(vector))


def vector_total(vector: str) -> Column:
    """Sum of a vector's entries; only those it stores are visited, so a sparse vector stays sparse."""
    return F.aggregate(F.unwrap_udt(vector)["values"], F.lit(0.0), lambda a, b: a + b)


def _vectors(df: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Turn numbers ``{column}_ohe`` into one-hot vectors of the given widths; null becomes the zero vector."""
    # The width stands in the column's metadata, so the encoder looks at no row; the last class is left out.
    named = {c: F.coalesce(F.col(f"`{c}_ohe`"), F.lit(width)).cast("double") for c, width in sizes.items()}
    numbers = df.withColumns({f"_{n}_slot": value for n, value in enumerate(named.values())}).drop(*(f"{c}_ohe" for c in sizes))
    for n, width in enumerate(sizes.values()):
        numbers = numbers.withMetadata(f"_{n}_slot", {"ml_attr": {"type": "nominal", "num_vals": width + 1}})
    slots = [f"_{n}_slot" for n in range(len(sizes))]
    return OneHotEncoder(inputCols=slots, outputCols=[f"{c}_ohe" for c in sizes]).fit(numbers).transform(numbers).drop(*slots)


def encode_columns(
    df: DataFrame, one_hot: Sequence[str] = (), frequency: Sequence[str] = (), tfidf: Sequence[str] = (), features: int = 50
) -> DataFrame:
    """Replace columns by ``{column}_ohe``, ``{column}_freq`` and ``{column}_tfidf``.

    All values are counted and numbered in one dictionary, and all texts share one fit of document
    frequencies, so the jobs do not depend on the number of columns.  Ties in frequency are ordered by value.
    """
    out = df
    if one_hot or frequency:
        values = dictionary.build(df, [*one_hot, *frequency], numbered=one_hot)
        for c in one_hot:
            out = values.attach(out, c, f"{c}_ohe", "number")
        for c in frequency:
            out = values.attach(out, c, f"{c}_freq")
        wide = {c: max(values.distinct.get(c, 0), 1) for c in one_hot}
        out = _vectors(out, wide) if wide else out
    if tfidf:
        for n, c in enumerate(tfidf):
            spaced = out.withColumn(f"_{n}_terms", F.split(F.lower(f"`{c}`"), r"\s"))
            out = HashingTF(inputCol=f"_{n}_terms", outputCol=f"_{n}_hits", numFeatures=features).transform(spaced).drop(f"_{n}_terms")
        hits = [f"_{n}_hits" for n in range(len(tfidf))]
        joined = VectorAssembler(inputCols=hits, outputCol="_hits").transform(out)
        out = IDF(inputCol="_hits", outputCol="_weights").fit(joined).transform(joined).drop("_hits", *hits)
        for n, c in enumerate(tfidf):
            mine = list(range(n * features, (n + 1) * features))
            out = VectorSlicer(inputCol="_weights", outputCol=f"{c}_tfidf", indices=mine).transform(out)
        out = out.drop("_weights")
    return out.drop(*one_hot, *frequency, *tfidf)


def one_hot_encode(df: DataFrame, *columns: str) -> DataFrame:
    """Replace string columns by their one-hot vectors."""
    return encode_columns(df, one_hot=columns)


def frequency_encode(df: DataFrame, *columns: str) -> DataFrame:
    """Replace string columns by the number of rows sharing their value."""
    return encode_columns(df, frequency=columns)


def tfidf_encode(df: DataFrame, *columns: str, features: int = 50) -> DataFrame:
    """Replace text columns by hashed TF-IDF weights of their words."""
    return encode_columns(df, tfidf=columns, features=features)


def encoding_rules(
    df: DataFrame,
    one_hot_limit: int = 20,
    embed: Sequence[str] = (),
    id_share: float = 0.9,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Which encoding each string column gets: drop, one_hot, tfidf or frequency."""
    names = list(columns) if columns is not None else columns_of_type(df, StringType)
    distinct, ratio = F.col("distinct"), F.col("ratio")
    rule = (
        F.when(ratio > id_share, "drop")
        .when(distinct <= one_hot_limit, "one_hot")
        .when(F.col("feature").isin(list(embed)), "tfidf")
        .otherwise("frequency")
    )
    return distinct_ratio(df, names).select("feature", "distinct", rule.alias("rule"))


def auto_encode_strings(
    df: DataFrame, one_hot_limit: int = 20, embed: Sequence[str] = (), id_share: float = 0.9
) -> DataFrame:
    """Encode every string column by its distinct count; all columns are counted in one pass."""
    if not columns_of_type(df, StringType):
        return df
    rules = {r["feature"]: r["rule"] for r in encoding_rules(df, one_hot_limit, embed, id_share).collect()}  # one row per column
    by_rule = {rule: sorted(c for c in rules if rules[c] == rule) for rule in ("one_hot", "frequency", "tfidf", "drop")}
    dropped = by_rule.pop("drop")
    return encode_columns(df.drop(*dropped), **by_rule)
