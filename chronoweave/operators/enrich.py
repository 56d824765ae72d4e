"""Joins that bring lookups onto a fact table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.operators import dictionary
from chronoweave.scratch import write_scratch
from chronoweave.skew import small_side


def broadcast_equi_join(fact: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that broadcasts the lookup only after its size has been checked."""
    return fact.join(small_side(lookup), list(on), how)


def semi_join_keys(fact: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return fact.join(keys.select(*on), list(on), "left_semi")


def anti_join_keys(fact: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return fact.join(keys.select(*on), list(on), "left_anti")


def hourly_dedup_avg(
    readings: DataFrame, keys: Sequence[str], averages: Sequence[str], firsts: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: averages of numeric readings and the earliest value of the others.

    ``order`` makes "earliest" deterministic.
    """
    return readings.groupBy(*keys).agg(
        *(F.avg(c).alias(c) for c in averages),
        *(F.min_by(c, F.struct(*order)).alias(c) for c in firsts),
    )


def nearest_station_lookup(
    readings: DataFrame, stations: DataFrame, station: str, keys: Sequence[str], distance: str, columns: Sequence[str]
) -> DataFrame:
    """One reading per key from the closest station; the station id breaks ties.

    A station of unknown distance comes after all known ones.

    The station map is joined first (broadcast when it is small), then a min-by aggregate keeps one
    row per key and task before anything is shuffled.
    """
    mapped = readings.join(small_side(stations), station)
    best = F.min_by(
        F.struct(station, *columns), F.struct(F.col(distance).isNull(), distance, station)
    ).alias("_best")
    return mapped.groupBy(*keys).agg(best).select(*keys, "_best.*")


def nearest_reading(
    wanted: DataFrame,
    readings: DataFrame,
    stations: DataFrame,
    station: str,
    site: str,
    bucket: str,
    distance: str,
    columns: Sequence[str],
    first: int = 8,
    max_fan_out: float = 4,
) -> DataFrame:
    """The closest station's reading for just the wanted (site, bucket) pairs.

    ``readings`` has one row per (station, bucket).  While a station serves ``max_fan_out`` sites or fewer
    on average, one join answers all pairs.  With a map of every station to every site that join would
    multiply the readings by the number of sites.  Then the nearest ``first`` stations
    are tried, and only pairs still without a reading go on to the next, larger ring of stations, until
    the map is exhausted.  The result is that of :func:`nearest_station_lookup`.
    """
    size = stations.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(station).alias("stations")).first()
    if size["rows"] <= max_fan_out * size["stations"]:
        every = nearest_station_lookup(readings, stations, station, [site, bucket], distance, columns)
        return every.join(wanted.select(site, bucket), [site, bucket], "left_semi")
    # Several rings may read the readings, so they are computed once.
    readings = write_scratch(readings.select(station, bucket, *columns), "readings").df
    by_distance = Window.partitionBy(site).orderBy(F.asc_nulls_last(distance), station)  # rows of the station map only
    ranked = write_scratch(stations.select(site, station, F.row_number().over(by_distance).alias("_rank")), "ranked").df
    farthest = ranked.agg(F.max("_rank")).first()[0]
    covered = readings.select(bucket).distinct()
    pending = wanted.select(site, bucket).dropna().distinct().join(covered, bucket, "left_semi")
    found: list[DataFrame] = []
    low, high = 0, first
    while low < farthest:
        ring = ranked.filter((F.col("_rank") > low) & (F.col("_rank") <= high))
        tried = pending.join(small_side(ring), site).join(readings, [station, bucket])
        best = tried.groupBy(site, bucket).agg(F.min_by(F.struct(station, *columns), "_rank").alias("_best"))
        # Answered and open pairs come from one written table, so both are computed once.
        asked = write_scratch(pending.join(best, [site, bucket], "left").select(site, bucket, "_best.*"), "nearest").df
        found.append(asked.filter(F.col(station).isNotNull()))
        pending = asked.filter(F.col(station).isNull()).select(site, bucket)
        if pending.isEmpty():
            break
        low, high = high, high * 8
    return reduce(DataFrame.unionByName, found)


def bucket_lookup_join(
    fact: DataFrame, lookup: DataFrame, keys: dict[str, str], bucket: Column, lookup_bucket: str
) -> DataFrame:
    """Left join on key columns and the time bucket observable before the event.

    ``keys`` maps fact columns to lookup columns; the lookup has to hold one row per key and bucket,
    so every fact row comes out once and AQE may split a hot bucket.
    """
    names = {c: f"_r_{c}" for c in (*keys.values(), lookup_bucket)}
    right = lookup.withColumnsRenamed(names)
    same_bucket = bucket == right[names[lookup_bucket]]
    same = reduce(and_, (fact[f] == right[names[k]] for f, k in keys.items()), same_bucket)
    return fact.join(right, same, "left").drop(*names.values())


def frequency_join(df: DataFrame, column: str, out: str) -> DataFrame:
    """Bring each value's row count onto its rows; a null value gets no count."""
    return dictionary.build(df, [column]).attach(df, column, out)


def prediction_join(outputs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Inner join of model outputs on their row key; the query fails on keys that would fan out.

    The aggregate that proves a key unique partitions and sorts the rows as the join wants them, so every output
    is computed and shuffled once.  Rows with a null in the key match nothing.
    """

    def proved(scored: DataFrame) -> DataFrame:
        rest = [c for c in scored.columns if c not in keys]
        rows = scored.dropna(subset=list(keys)).groupBy(*keys).agg(F.first(F.struct(F.lit(0), *rest)).alias("_row"), F.count(F.lit(1)).alias("_n"))
        repeated = F.raise_error(F.lit(f"rows are not unique by {list(keys)}")).cast("boolean")
        return rows.filter(F.when(F.col("_n") > 1, repeated).otherwise(True)).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))

    return reduce(lambda a, b: a.join(b, list(keys)), map(proved, outputs))


def dict_lookup_join(df: DataFrame, values: dict, key: str, out: str, default=None) -> DataFrame:
    """Bring a driver-side mapping onto the rows with a join instead of a function call per row."""
    rows = df.sparkSession.createDataFrame(list(values.items()), [key, out])
    joined = df.join(small_side(rows), key, "left")
    return joined if default is None else joined.fillna({out: default})


def attach_vertex_feature(df: DataFrame, scores: DataFrame, vertex: str, on: str, score: str, out: str) -> DataFrame:
    """Left join a vertex score on the graph's own key."""
    right = scores.select(F.col(vertex).alias(on), F.col(score).alias(out))
    return df.join(small_side(right), on, "left").select(*df.columns, out)
