"""Ordered computations that do not depend on any group fitting into one task.

A plain window sends a whole partition key to one task.  When a key is too large for that, the rows
are range-partitioned on the full sort key, which cuts a hot key into balanced chunks; windows then
run inside chunks and a table with one row per chunk (and key) carries the running state across.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from chronoweave.scratch import write_scratch
from chronoweave.skew import BROADCAST_ROWS, TASK_ROWS, small_side, stored_side, timeline_shape, with_loose_rows

CHUNK = "_chunk"
#: Accuracy of the percentiles that bracket a quantile: their ranks are off by a 10 000th of the rows at most.
BRACKET_ACCURACY = 10_000


def ordered_chunks(df: DataFrame, order: Sequence[Column | str], chunks: int) -> DataFrame:
    """Number contiguous, balanced ranges of the sort order in column ``_chunk``.

    The chunked table is written out: range bounds are sampled, and two readers of an unwritten plan
    could see different bounds.
    """
    ranged = df.repartitionByRange(chunks, *order).withColumn(CHUNK, F.spark_partition_id())
    return write_scratch(ranged, "chunks").df


def _chunk_offsets(sizes: DataFrame, group: Sequence[str], size: str, out: str) -> DataFrame:
    """Running total of the chunks before each chunk; one row per (group, chunk)."""
    before = Window.partitionBy(*group).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(*group, CHUNK, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(out))


def _join_chunks(chunked: DataFrame, per_chunk: DataFrame, chunks: int) -> DataFrame:
    """Join a table with at most one row per chunk; broadcast while the chunk count is small."""
    return chunked.join(F.broadcast(per_chunk) if chunks <= BROADCAST_ROWS else per_chunk, CHUNK)


def positions(
    df: DataFrame, order: Sequence[Column | str], out: str = "position", task_rows: int = TASK_ROWS
) -> DataFrame:
    """Number all rows 1..n in a total order.

    Ranges of the order are numbered where they are sorted, so rows are exchanged once.
    """
    total = df.count()
    if total <= task_rows:
        return df.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("long"))
    chunks = math.ceil(total / task_rows)
    ranged = df.repartitionByRange(chunks, *order).sortWithinPartitions(*order)
    # The id counts a partition's rows from 0 in its lowest 33 bits.
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    chunked = write_scratch(ranged.withColumns({CHUNK: F.spark_partition_id(), out: inside}), "chunks").df
    offsets = _chunk_offsets(chunked.groupBy(CHUNK).agg(F.count("*").alias("_n")), [], "_n", "_before")
    numbered = _join_chunks(chunked, offsets, chunks)
    return numbered.withColumn(out, F.col(out) + F.col("_before")).drop(CHUNK, "_before")


def cumulative_counts(
    df: DataFrame, group: Sequence[str], value: str, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Per group and distinct value: ``n`` rows hold it, ``below`` rows of the group hold less.

    Equal values collapse before the first shuffle, so a value shared by many rows costs one row.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))
    total = df.count()
    if total > task_rows:
        # Distinct values may be far fewer than rows, so they are counted before they are cut into chunks.
        counts = write_scratch(counts, "counts").df
        total = counts.count()
    return _running(counts, group, value, total, task_rows)


def _running(counts: DataFrame, group: Sequence[str], value: str, total: int, task_rows: int) -> DataFrame:
    """Add ``below``, the sum of ``n`` over smaller values of the group; ``total`` bounds the rows of ``counts``."""
    if total <= task_rows:
        before = Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0)))
    chunked = ordered_chunks(counts, [*group, value], math.ceil(total / task_rows))
    before = Window.partitionBy(CHUNK, *group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    sizes = chunked.groupBy(*group, CHUNK).agg(F.sum("n").alias("_n"))
    offsets = _chunk_offsets(sizes, group, "_n", "_before").withColumnsRenamed({c: f"_o_{c}" for c in group})
    inside = chunked.withColumn("_inside", F.coalesce(F.sum("n").over(before), F.lit(0)))
    offsets = offsets.withColumnRenamed(CHUNK, f"_o{CHUNK}")
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in group), F.col(CHUNK) == F.col(f"_o{CHUNK}"))
    return inside.join(offsets, same).select(*counts.columns, (F.col("_inside") + F.col("_before")).alias("below"))


def _same_group(group: Sequence[str], prefix: str) -> Column:
    return reduce(and_, (F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in group))


def _rank_picks(quantiles: dict[str, float], rows: Column, at_rank) -> list[Column]:
    """The values at the two ranks around each quantile; ``at_rank(rank)`` is a row's value if it holds the rank."""
    picks = []
    for name, q in quantiles.items():
        exact = F.lit(q) * (rows - 1)
        picks += [F.max(at_rank(rank)).alias(f"_{name}_{side}") for side, rank in (("lo", F.floor(exact)), ("hi", F.ceil(exact)))]
    return picks


def _interpolated(found: DataFrame, group: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    out = []
    for name, q in quantiles.items():
        exact = F.lit(q) * (F.col("rows") - 1)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out.append((lo + (hi - lo) * (exact - F.floor(exact))).alias(name))
    return found.select(*group, "rows", *out)


def exact_quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    task_rows: int = TASK_ROWS,
    accuracy: int = BRACKET_ACCURACY,
) -> DataFrame:
    """Interpolated quantiles per group, selected by bracketing: nothing sorts all values.

    An approximate percentile a little below and above each quantile gives a bracket that holds the
    ranks wanted.  One more aggregate counts the rows outside the brackets by where they lie, and the
    distinct values inside, about ``4 / accuracy`` of all rows a quantile; only these are ordered.  A
    group whose brackets miss a rank, which the percentiles' error bound rules out for ordinary
    numbers, is ranked in full.  Also returns ``rows``, the number of non-null values of the group.
    """
    v = F.col(value)
    known = df.filter(v.isNotNull()).select(*group, value)
    fractional = isinstance(known.schema[value].dataType, (DoubleType, FloatType))
    ordinary = F.when(~F.isnan(v), v) if fractional else v
    points = [p for q in quantiles.values() for p in (max(0.0, q - 2 / accuracy), min(1.0, q + 2 / accuracy))]
    bounds = known.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"), F.percentile_approx(ordinary, points, accuracy).alias("_at")
    )
    ends = [F.col("_at")[i].alias(f"_b{i}") for i in range(len(points))]
    lows, highs = range(0, len(points), 2), range(1, len(points), 2)
    if group:
        side = stored_side(bounds.select(*(F.col(c).alias(f"_t_{c}") for c in group), "rows", *ends))
        located = known.join(side, _same_group(group, "_t_"))
        bound = [F.col(f"_b{i}") for i in range(len(points))]
    else:
        row = bounds.select("rows", *ends).first()  # one row
        kind = known.schema[value].dataType
        bound = [F.lit(row[f"_b{i}"]).cast(kind) for i in range(len(points))]
        located = known.withColumn("rows", F.lit(row["rows"]))
    inside = reduce(or_, (v.between(bound[i], bound[j]) for i, j in zip(lows, highs)))
    # Rows outside all brackets that have passed the same low ends lie between the same brackets.
    passed = reduce(add, ((v >= bound[i]).cast("int") for i in lows))
    inside, passed = F.coalesce(inside, F.lit(False)), F.coalesce(passed, F.lit(-1))
    cells = located.groupBy(*group, "rows", F.when(inside, v).alias("_in"), F.when(~inside, passed).alias("_passed")).agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("_first"), F.max(v).alias("_last")
    )
    cells = write_scratch(cells, "cells").df
    ranks = _running(cells, group, "_first", cells.count(), task_rows)
    below, n = F.col("below"), F.col("n")

    def at_rank(rank: Column) -> Column:
        # Of a cell between brackets only the ends are known.
        held = F.when(F.col("_in").isNotNull() | (rank == below), F.col("_first")).when(rank == below + n - 1, F.col("_last"))
        return F.when((below <= rank) & (rank < below + n), held)

    picks = _rank_picks(quantiles, F.col("rows"), at_rank)
    found = write_scratch(ranks.groupBy(*group).agg(F.max("rows").alias("rows"), *picks), "selected").df
    missed = reduce(or_, (F.col(f"_{name}_{side}").isNull() for name in quantiles for side in ("lo", "hi")))
    missed = found.filter(missed)
    if missed.isEmpty():
        return _interpolated(found, group, quantiles)
    if not group:
        return _ranked_quantiles(known, group, value, quantiles, task_rows)
    again = small_side(missed.select(*(F.col(c).alias(f"_t_{c}") for c in group)))
    rest = _ranked_quantiles(known.join(again, _same_group(group, "_t_"), "left_semi"), group, value, quantiles, task_rows)
    found = found.join(again, _same_group(group, "_t_"), "left_anti")
    return _interpolated(found, group, quantiles).unionByName(rest)


def _ranked_quantiles(known, group, value, quantiles, task_rows) -> DataFrame:
    """The same from the ranks of all distinct values."""
    ranks = cumulative_counts(known, group, value, task_rows)
    totals = known.groupBy(*group).agg(F.count("*").alias("rows"))
    if group:
        totals = stored_side(totals.withColumnsRenamed({c: f"_t_{c}" for c in group}))
        located = ranks.join(totals, _same_group(group, "_t_"))
    else:
        located = ranks.withColumn("rows", F.lit(totals.first()["rows"]))
    holds = lambda rank: F.when((F.col("below") <= rank) & (rank < F.col("below") + F.col("n")), F.col(value))
    found = located.groupBy(*group).agg(F.max("rows").alias("rows"), *_rank_picks(quantiles, F.col("rows"), holds))
    return _interpolated(found, group, quantiles)


def previous_row(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    columns: Sequence[str],
    out: str,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Struct of ``columns`` from the entity's previous row in ``order``; null for its first row."""
    shape = timeline_shape(df, entity)
    feature = _windowed_previous if shape.largest <= task_rows else _chunked_previous
    return with_loose_rows(df, [entity], shape, lambda rows: feature(rows, entity, order, columns, out, task_rows))


def _windowed_previous(df, entity, order, columns, out, task_rows) -> DataFrame:
    w = Window.partitionBy(entity).orderBy(*order)
    return df.withColumn(out, F.lag(F.struct(*columns)).over(w))


def _chunked_previous(df, entity, order, columns, out, task_rows) -> DataFrame:
    previous = F.struct(*columns)
    chunks = math.ceil(df.count() / task_rows)
    chunked = ordered_chunks(df, [entity, *order], chunks)
    last = chunked.groupBy(CHUNK).agg(
        F.max_by(F.struct(F.col(entity).alias("key"), previous.alias("row")), F.struct(entity, *order)).alias("last")
    )
    carried = last.select(CHUNK, F.lag("last").over(Window.orderBy(CHUNK)).alias("_carried"))
    w = Window.partitionBy(CHUNK, entity).orderBy(*order)
    from_before = F.when(F.col("_carried.key") == F.col(entity), F.col("_carried.row"))
    lagged = _join_chunks(chunked.withColumn("_lag", F.lag(previous).over(w)), carried, chunks)
    return lagged.withColumn(out, F.coalesce("_lag", from_before)).drop(CHUNK, "_lag", "_carried")


def latest_known(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    columns: Sequence[str],
    epoch: str,
    known: str,
    horizon_s: int,
    out: str,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Struct of ``columns`` from the entity's last row in ``order`` that is known ``horizon_s`` seconds before ``epoch``.

    Rows become facts at ``known`` + ``horizon_s`` and questions at ``epoch``; one running maximum over
    both answers all questions, so nothing grows with the square of a timeline.  Facts of the same
    second are known; a row whose ``known`` is null is never a fact, and one without ``epoch`` gets null.
    """
    shape = timeline_shape(df, entity)
    last = _windowed_known if 2 * shape.largest <= task_rows else _chunked_known

    def answered(rows: DataFrame) -> DataFrame:
        fact = F.struct(F.struct(*order).alias("order"), F.struct(*columns).alias("row"))
        facts = rows.filter(F.col(known).isNotNull()).select(
            F.col(entity).alias("_entity"), (F.col(known) + horizon_s).alias("_at"), F.lit(0).alias("_asks"), fact.alias("_fact")
        )
        questions = rows.select(
            F.col(entity).alias("_entity"), F.col(epoch).alias("_at"), F.lit(1).alias("_asks"), F.struct("*").alias("_row")
        )
        found = last(questions.unionByName(facts, allowMissingColumns=True), task_rows)
        return found.filter("_asks = 1").select("_row.*", F.col("_last.row").alias(out))

    return with_loose_rows(df, [entity], shape, answered)


def _windowed_known(timeline: DataFrame, task_rows: int) -> DataFrame:
    w = Window.partitionBy("_entity").orderBy("_at", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    return timeline.withColumn("_last", F.max_by("_fact", "_fact.order").over(w))


def _chunked_known(timeline: DataFrame, task_rows: int) -> DataFrame:
    chunks = math.ceil(timeline.count() / task_rows)
    chunked = ordered_chunks(timeline, ["_entity", "_at", "_asks"], chunks)
    # The last entity of a chunk goes on in the next one, with the best fact of all its chunks so far.
    state = F.struct(F.col("_entity").alias("key"), F.col("_fact").alias("fact"))
    last = chunked.groupBy(CHUNK).agg(F.max_by(state, F.struct("_entity", "_fact.order")).alias("_state"))
    so_far = Window.partitionBy("_state.key").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, 0)
    best = F.struct("_state.key", F.max_by("_state.fact", "_state.fact.order").over(so_far).alias("fact"))
    carried = last.select(CHUNK, best.alias("_best"))
    carried = carried.select(CHUNK, F.lag("_best").over(Window.orderBy(CHUNK)).alias("_carried"))
    w = Window.partitionBy(CHUNK, "_entity").orderBy("_at", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    found = chunked.withColumn("_own", F.max_by("_fact", "_fact.order").over(w))
    found = _join_chunks(found, carried, chunks)
    before = F.when(F.col("_carried.key") == F.col("_entity"), F.col("_carried.fact"))
    newer = F.col("_own").isNull() | (before["order"] > F.col("_own.order"))
    return found.withColumn("_last", F.when(before.isNotNull() & newer, before).otherwise(F.col("_own")))
