"""Projection, filtering, deduplication and null handling."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType

from chronoweave.functions.scalars import key_hash, named
from chronoweave.ordering import exact_quantiles


def typed_projection(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Pin a schema as ``{output: (source, type)}``; text that does not parse becomes null."""
    return df.select(*(F.col(src).try_cast(kind).alias(out) for out, (src, kind) in columns.items()))


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows whose keys are all present; an empty string counts as absent."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    tests = [named(c).isNotNull() & (named(c) != "") if c in text else named(c).isNotNull() for c in columns]
    return df.filter(reduce(and_, tests))


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedup_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order``; copies merge before the shuffle, so a hot key costs one row per task."""
    rest = [named(c) for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*map(named, order))).alias("_row")
    return df.groupBy(*map(named, keys)).agg(first).select(*map(named, keys), "_row.*").select(*map(named, df.columns))


def drop_missing_required(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows null in the given columns, or in any column."""
    return df.dropna(subset=list(columns) if columns else None)


def null_safe_filter(df: DataFrame, column: str, value) -> DataFrame:
    """Rows where the column differs from ``value`` or is null."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def null_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    """Row count and nulls per column from one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *(F.count_if(named(c).isNull()).alias(c) for c in df.columns)).first()
    counts = row.asDict()
    return counts.pop("_rows"), counts


def drop_sparse_columns(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Drop columns whose null share reaches ``share``."""
    rows, nulls = null_counts(df)
    return df.drop(*(c for c, n in nulls.items() if rows and n / rows >= share))


def project_available(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Select the wanted columns that exist; also return the names that do not."""
    present = [c for c in wanted if c in df.columns]
    return df.select(*map(named, present)), [c for c in wanted if c not in df.columns]


def fill_constant(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.fillna(values)


def fill_median(df: DataFrame, columns: Sequence[str], exact: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Replace nulls by the column median: one approximate aggregate, or exact ranks on request."""
    if exact:
        long = df.select(*(named(c).cast("double").alias(c) for c in columns))
        long = long.unpivot([], [named(c) for c in columns], "feature", "value")
        found = exact_quantiles(long, ["feature"], "value", {"median": 0.5}).collect()  # one row per column
        medians = {r["feature"]: r["median"] for r in found}
    else:
        medians = df.agg(*(F.percentile_approx(named(c).cast("double"), 0.5, accuracy).alias(c) for c in columns))
        medians = medians.first().asDict()
    return df.withColumns(
        {c: F.coalesce(named(c).cast("double"), F.lit(medians[c])) for c in columns if medians.get(c) is not None}
    )


def split_by_period(df: DataFrame, period: str, start: int, stop: int, test: int) -> tuple[DataFrame, DataFrame]:
    """Training rows with ``start <= period < stop`` and the held-out period."""
    p = F.col(period)
    return df.filter((p >= start) & (p < stop)), df.filter(p == test)


def range_filter(df: DataFrame, day: str, bounds: DataFrame, bound_day: str, margin_days: int = 1) -> DataFrame:
    """Rows within the first and last day of ``bounds``, widened by a margin.

    The two days are read first so that the filter is a literal range the scan can prune with.
    """
    low, high = bounds.agg(
        F.date_sub(F.min(bound_day), margin_days), F.date_add(F.max(bound_day), margin_days)
    ).first()
    return df.filter(F.col(day).between(F.lit(low), F.lit(high)))


def prefix_filter(df: DataFrame, column: str, prefix: str, out: str | None = None) -> DataFrame:
    """Rows whose code starts with ``prefix``, with the prefix removed."""
    kept = df.filter(F.col(column).startswith(prefix))
    return kept.withColumn(out or column, F.substr(F.col(column), F.lit(len(prefix) + 1)))


def sample_fraction(df: DataFrame, fraction: float, keys: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Fraction of the rows; with integer keys the choice is repeatable on any partitioning."""
    if keys is None:
        return df.sample(False, fraction, seed)
    return df.filter(key_hash(*map(F.col, keys)) < int(fraction * 2**32))


def sample_n_rows(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """``n`` rows with the smallest key hash: a top-k per task and a merge, not a sort of the table."""
    return df.orderBy(key_hash(*map(F.col, keys)), *keys).limit(n)


def columns_of_type(df: DataFrame, kind: type[DataType] = NumericType, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind) and f.name not in skip]


def select_by_type(
    df: DataFrame, kind: type[DataType] = NumericType, exclude: Iterable[str] = (), cast: str | None = None
) -> DataFrame:
    """Columns of a type, minus an exclude list, optionally cast."""
    names = columns_of_type(df, kind, exclude)
    return df.select(*(F.col(c).cast(cast).alias(c) if cast else F.col(c) for c in names))


def drop_columns(df: DataFrame, columns: Sequence[str], rename: dict[str, str] | None = None) -> DataFrame:
    return df.drop(*columns).withColumnsRenamed(rename or {})


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == value)


def expand_rows(df: DataFrame, count: Column, block: int = 10_000, spread: int | None = None) -> DataFrame:
    """Every row ``count`` times (bigint); a null or non-positive count leaves none.

    A row with a count above ``block`` turns into numbered blocks, which are dealt to ``spread`` tasks
    (the shuffle setting by default) and turn into rows there: no value and no task's buffer holds more than ``block``
    rows, or one entry per block.  Other rows stay where they are.
    """
    held = df.select("*", count.cast("long").alias("_count")).filter("_count > 0")

    def repeated(rows: DataFrame, times: Column) -> DataFrame:
        return rows.withColumn("_one", F.explode(F.array_repeat(F.lit(True), times.cast("int")))).select(*(F.col(f"`{c}`") for c in df.columns))

    large = held.filter(F.col("_count") > block)
    blocks = large.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_count") - 1) / block))))
    dealt = blocks.repartition(spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    inside = F.least(F.col("_count") - F.col("_block") * block, F.lit(block))
    return repeated(held.filter(F.col("_count") <= block), F.col("_count")).unionByName(repeated(dealt, inside))


def wide_to_long(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "feature", value: str = "value"
) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def dev_slice(df: DataFrame, key: str, ts: str) -> DataFrame:
    """The smallest key's rows in its first month: a small end-to-end development input."""
    first = first_distinct(df, key)
    chosen = df.filter(F.col(key) == first)
    month = chosen.agg(F.date_trunc("MONTH", F.min(ts))).first()[0]
    return chosen.filter(F.date_trunc("MONTH", F.col(ts)) == F.lit(month))


def first_distinct(df: DataFrame, key: str):
    """Smallest non-empty key."""
    present = F.col(key).isNotNull()
    if isinstance(df.schema[key].dataType, StringType):
        present = present & (F.col(key) != "")
    return df.filter(present).agg(F.min(key)).first()[0]


def table_shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name and type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Positional union; prefer :func:`union_by_name`."""
    return reduce(DataFrame.union, parts)


def union_by_name(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def except_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def global_sort(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order)


def top_k(df: DataFrame, by: str, key: str, k: int) -> DataFrame:
    """Largest ``k`` rows; the key breaks ties."""
    return df.orderBy(F.col(by).desc(), key).limit(k)


def rank_slice(df: DataFrame, by: str, key: str, skip: int, take: int) -> DataFrame:
    """Rows ranked ``skip + 1`` to ``skip + take``."""
    return df.orderBy(F.col(by).desc(), key).offset(skip).limit(take)


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(n)
