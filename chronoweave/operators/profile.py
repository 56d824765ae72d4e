"""Counts, distributions and correlations; each report is one or two aggregates over the table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.scalars import named
from chronoweave.operators.dictionary import HEAVY
from chronoweave.ordering import cumulative_counts, exact_quantiles
from chronoweave.scratch import write_scratch
from chronoweave.skew import BROADCAST_ROWS, TASK_ROWS, small_side


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), *columns)


def calendar_counts(df: DataFrame, parts: Sequence[str], label: str, year: str = "year", month: str = "month") -> DataFrame:
    """Rows per calendar parts and label, with a ``month-year`` key."""
    counts = df.groupBy(*parts, label).agg(F.count("*").alias("n"))
    return counts.withColumn("month_year", F.concat_ws("-", F.col(month), F.col(year)))


def band_counts(df: DataFrame, period: str, band: Column, label: str) -> DataFrame:
    return df.groupBy(period, band.alias("band"), label).agg(F.count("*").alias("n"))


def route_counts(df: DataFrame, origin: Sequence[str], target: Sequence[str], label: str) -> DataFrame:
    return df.groupBy(*origin, *target, label).agg(F.count("*").alias("n"))


def route_rollup(routes: DataFrame, area: str) -> DataFrame:
    """Sum route counts to an area; works on the counts, not on the table again."""
    return routes.groupBy(area).agg(F.sum("n").alias("n"))


def grouped_mean(df: DataFrame, group: Sequence[str], value: str, out: str = "mean") -> DataFrame:
    return df.groupBy(*group).agg(F.avg(value).alias(out), F.count(value).alias("n"))


def geo_counts(df: DataFrame, site: str, lat: str, lon: str) -> DataFrame:
    """Rows per place whose coordinates are known."""
    placed = df.filter(F.col(lat).try_cast("double").isNotNull() & F.col(lon).try_cast("double").isNotNull())
    return placed.groupBy(
        site, F.col(lat).try_cast("double").alias(lat), F.col(lon).try_cast("double").alias(lon)
    ).agg(F.count("*").alias("n"))


def class_ratio(df: DataFrame, label: str, block: Sequence[str] = ()) -> DataFrame:
    """Label counts and shares, overall or per block; the window runs over the counts only."""
    counts = df.groupBy(*block, label).agg(F.count("*").alias("n"))
    return counts.withColumn("ratio", F.col("n") / F.sum("n").over(Window.partitionBy(*block)))


def monthly_positive_mean(df: DataFrame, month: str, label: str) -> DataFrame:
    """Positive rows per month and their mean over the months."""
    counts = df.filter(F.col(label) == 1).groupBy(month).agg(F.count("*").alias("n"))
    return counts.withColumn("mean_n", F.avg("n").over(Window.partitionBy()))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*map(named, keys)).agg(F.count("*").alias("n")).filter("n > 1")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole rows that occur more than once."""
    return duplicate_keys(df, df.columns)


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and their percentage per column, from one aggregate."""
    rows = F.count(F.lit(1)).alias("_rows")
    wide = df.agg(rows, *(F.count_if(named(c).isNull()).alias(c) for c in df.columns))
    long = wide.unpivot(["_rows"], [named(c) for c in df.columns], "feature", "nulls")
    return long.select("feature", "nulls", F.round(F.try_divide(F.col("nulls") * 100, "_rows"), 2).alias("percent"))


def _stat_long(df: DataFrame, columns: Sequence[str], stats: dict) -> DataFrame:
    """One aggregate for all columns and statistics, turned into one row per column."""
    packed = [F.struct(*(fn(c).alias(name) for name, fn in stats.items())).alias(c) for c in columns]
    wide = df.agg(*packed)
    entries = F.array(
        *(
            F.struct(F.lit(c).alias("feature"), *(named(c)[name].alias(name) for name in stats))
            for c in columns
        )
    )
    return wide.select(F.inline(entries))


def numeric_profile(
    df: DataFrame, columns: Sequence[str], exact: bool = False, accuracy: int = 10_000, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Nulls, mean, standard deviation, minimum, maximum and median per numeric column."""
    cast = {c: named(c).cast("double") for c in columns}
    stats = {
        "rows": lambda c: F.count(F.lit(1)),
        "nulls": lambda c: F.count_if(named(c).isNull()),
        "mean": lambda c: F.avg(cast[c]),
        "stddev": lambda c: F.stddev_samp(cast[c]),
        "min": lambda c: F.min(cast[c]),
        "max": lambda c: F.max(cast[c]),
    }
    if not exact:
        stats["median"] = lambda c: F.percentile_approx(cast[c], 0.5, accuracy)
        return _stat_long(df, columns, stats)
    long = df.select(*(cast[c].alias(c) for c in columns)).unpivot([], [named(c) for c in columns], "feature", "value")
    medians = exact_quantiles(long, ["feature"], "value", {"median": 0.5}, task_rows).select("feature", "median")
    return _stat_long(df, columns, stats).join(F.broadcast(medians), "feature", "left")  # one row per column


def profile_merge(nulls: DataFrame, stats: DataFrame) -> DataFrame:
    """Null report joined with a statistics report on the column name; both have one row per column."""
    return nulls.join(F.broadcast(stats), "feature", "left")


def time_extent(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def outcome_buckets(df: DataFrame, value: str, late: float = 15) -> DataFrame:
    """Rows that are late, slightly late, and on time or early."""
    v = F.col(value)
    return df.agg(
        F.count_if(v >= late).alias("late"),
        F.count_if((v > 0) & (v < late)).alias("slightly_late"),
        F.count_if(v <= 0).alias("on_time"),
    )


def histogram(df: DataFrame, value: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """Equal-width bins over ``[low, high]``, empty bins included; the last bin holds ``high`` itself.

    Without a value, and without given bounds, there are no bins.
    """
    v = F.col(value).cast("double")
    if low is None or high is None:
        found = df.agg(F.min(v), F.max(v)).first()
        low = found[0] if low is None else low
        high = found[1] if high is None else high
    if low is None or high is None:
        return df.sparkSession.createDataFrame([], "bin int, from double, to double, n long")
    width = (high - low) / bins
    slot = F.least(F.floor((v - low) / width), F.lit(bins - 1)) if width else F.lit(0)
    counts = df.filter(v.between(low, high)).groupBy(slot.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("from"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("to"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def boxplot_stats(
    df: DataFrame, columns: Sequence[str], label: str, whisker: float = 1.5, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Quartiles per feature and class, and whiskers at the extreme values that are not outliers."""
    long = df.select(label, *(F.col(c).cast("double").alias(c) for c in columns))
    long = long.unpivot([label], list(columns), "feature", "value")
    boxes = exact_quantiles(long, ["feature", label], "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, task_rows)
    reach = whisker * (F.col("q3") - F.col("q1"))
    fences = small_side(boxes.select("*", (F.col("q1") - reach).alias("_low"), (F.col("q3") + reach).alias("_high")))
    inlier = F.col("value").between(F.col("_low"), F.col("_high"))
    fences = fences.withColumnsRenamed({"feature": "_feature", label: "_class"})
    same = (F.col("feature") == F.col("_feature")) & F.col(label).eqNullSafe(F.col("_class"))
    return (
        long.join(fences, same)
        .groupBy("feature", label, "rows", "q1", "median", "q3")
        .agg(
            F.min(F.when(inlier, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inlier, F.col("value"))).alias("whisker_high"),
        )
    )


def distinct_ratio(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values and their share of the rows per column.

    Exact counting dedups (column, value) pairs before they meet, so no task holds a column's values.
    Long texts travel as their SHA-256.
    """
    if approximate:
        stats = {
            "rows": lambda c: F.count(F.lit(1)),
            "distinct": lambda c: F.approx_count_distinct(c, 0.01),
        }
        return _stat_long(df, columns, stats).withColumn("ratio", F.try_divide("distinct", "rows"))
    rows = df.count()
    texts = {c: F.col(c).cast("string") for c in columns}
    short = (F.when(F.length(v) > 64, F.sha2(v, 256)).otherwise(v).alias(c) for c, v in texts.items())
    long = df.select(*short).unpivot([], list(columns), "feature", "value")
    found = long.distinct().groupBy("feature").agg(F.count("value").alias("distinct"))
    return found.select(
        "feature", F.lit(rows).alias("rows"), "distinct", F.try_divide("distinct", F.lit(rows)).alias("ratio")
    )


def scalar_sum_count(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.sum(value).alias("total"), F.count(value).alias("n"), F.avg(value).alias("mean"))


def _pair_rows(df: DataFrame, columns: Sequence[str], pair) -> DataFrame:
    """Matrix in long form from one aggregate over the upper triangle."""
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    wide = df.agg(*(pair(columns[i], columns[j]).alias(f"p{i}_{j}") for i, j in pairs))
    cells = [
        F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), F.col(f"p{min(i, j)}_{max(i, j)}").alias("corr"))
        for i in range(len(columns))
        for j in range(len(columns))
    ]
    return wide.select(F.inline(F.array(*cells)))


def pearson_matrix(df: DataFrame, columns: Sequence[str], pairwise: bool = False) -> DataFrame:
    """Correlation of each pair in long form.

    Rows with any null are dropped first, unless ``pairwise`` keeps every row both columns know.
    """
    rows = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    return _pair_rows(rows if pairwise else rows.dropna(), columns, F.corr)


def _with_ranks(df: DataFrame, column: str, ranks: DataFrame, distinct: int, rows: int, broadcast_rows: int) -> DataFrame:
    """Replace the column's values by their ranks; all other columns stay.

    Values that one row in ``HEAVY`` holds are looked up in a broadcast side, and their rows are dealt evenly.
    """
    side = ranks.filter(F.col("feature") == column).select(F.col("value").alias("_value"), F.col("rank").alias("_rank"), "n")
    others = [c for c in df.columns if c != column]
    if distinct <= broadcast_rows:
        found = df.join(F.broadcast(side.drop("n")), F.col(column) == F.col("_value"))
        return found.select(*others, F.col("_rank").alias(column))
    often = F.col("n") * HEAVY > rows
    heavy = F.broadcast(side.filter(often).select("_value", F.col("_rank").alias("_heavy")))
    first = df.join(heavy, F.col(column) == F.col("_value"), "left").drop("_value")
    done = F.col("_heavy").isNotNull()
    # Rows that have their rank already hold no value to join on: they match nothing, wherever their number sends them.
    deal = F.when(done, F.monotonically_increasing_id()).otherwise(F.xxhash64(column))
    first = first.withColumns({"_deal": deal, "_asks": F.when(~done, F.col(column))})
    light = side.filter(~often).select("_value", "_rank", F.xxhash64("_value").alias("_hash"))
    found = first.join(light, (F.col("_deal") == F.col("_hash")) & (F.col("_asks") == F.col("_value")), "left")
    return found.select(*others, F.coalesce("_heavy", "_rank").alias(column))


def spearman_matrix(
    df: DataFrame, columns: Sequence[str], task_rows: int = TASK_ROWS, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rank correlation in long form; tied values share their average rank.

    All columns are ranked in one pass over (column, value) pairs.  A row then looks up its ranks: of a column with few
    distinct values from a broadcast side, else in one exchange on the value, which frequent values skip.
    """
    names = [f"c{i}" for i in range(len(columns))]
    # Adding zero turns -0.0 into 0.0, so that equal values have equal hashes.
    rows = df.select(*((F.col(c).cast("double") + F.lit(0.0)).alias(n) for c, n in zip(columns, names))).dropna()
    rows = write_scratch(rows, "rank-rows").df
    counts = cumulative_counts(rows.unpivot([], names, "feature", "value"), ["feature"], "value", task_rows)
    ranks = counts.select("feature", "value", "n", (F.col("below") + (F.col("n") + 1) / 2).alias("rank"))
    ranks = write_scratch(ranks, "ranks").df
    sizes = ranks.groupBy("feature").agg(F.count(F.lit(1)).alias("distinct"), F.sum("n").alias("rows")).collect()  # one row per column
    wide = rows
    for size in sizes:
        wide = _with_ranks(wide, size["feature"], ranks, size["distinct"], size["rows"], broadcast_rows)
    matrix = _pair_rows(wide, names, F.corr)
    label = lambda c: F.array(*map(F.lit, columns))[F.substring(c, 2, 9).cast("int")].alias(c)
    return matrix.select(label("a"), label("b"), "corr")


def ml_correlation_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """The same matrix from the MLlib implementation, in long form."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip").transform(df)
    matrix = Correlation.corr(vectors.select("features"), "features", method).head()[0].toArray()
    cells = [(a, b, float(matrix[i][j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(cells, "a string, b string, corr double")


def normality_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Skewness, excess kurtosis and the Jarque-Bera statistic with its chi-squared(2) p-value."""
    stats = {
        "n": lambda c: F.count(c),
        "skewness": lambda c: F.skewness(F.col(c).cast("double")),
        "kurtosis": lambda c: F.kurtosis(F.col(c).cast("double")),
    }
    jb = F.col("n") / 6 * (F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4)
    return (
        _stat_long(df, columns, stats)
        .withColumn("jarque_bera", jb)
        .withColumn("p_value", F.exp(-F.col("jarque_bera") / 2))
    )
