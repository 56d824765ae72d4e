"""Point-in-time features over entity and site timelines.

All range frames are given in whole seconds around a bigint epoch column.  Each operator has two
plans with equal results and picks one by measuring the largest group:

* groups fit a task: one window over the entity, so one shuffle and one sort serve all frames;
* some group is too large, or its frames hold so many rows that summing them afresh for every row
  would be quadratic: rows collapse to one per (entity, second) with map-side combine, frames
  become running totals of "enters the frame" and "leaves the frame" deltas per (entity, day), and
  day totals carry over.  No task then holds more than one entity-day of distinct seconds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from chronoweave.ordering import latest_known, previous_row
from chronoweave.skew import FRAME_WORK, TASK_ROWS, may_crowd, timeline_shape, with_loose_rows

HOUR = 3600
DAY = 24 * HOUR
TWO_HOURS = 2 * HOUR
#: Blocks of a float frame, and the shortest block in seconds.
FRAME_BLOCKS = 64
LEAST_BLOCK = 900


@dataclass(frozen=True)
class Frame:
    """Seconds relative to the row, both ends inclusive; ``start=None`` means all history."""

    start: int | None
    end: int

    def window(self, entity: str, epoch: str) -> Window:
        start = Window.unboundedPreceding if self.start is None else self.start
        return Window.partitionBy(entity).orderBy(epoch).rangeBetween(start, self.end)


def frame_totals(
    probes: DataFrame,
    source: DataFrame | None,
    entity: str,
    epoch: str,
    measures: dict[str, Column],
    frames: dict[str, Frame],
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``{measure}_{frame}``: the sum of each measure over ``source`` rows inside each frame.

    ``source=None`` means the probe rows themselves.  Empty frames give 0; rows without an entity or
    a time give null and take part in no frame.
    """
    rows = probes if source is None else source
    # Frames over all history grow row by row; only bounded ones are summed afresh.
    width = max((1 - f.start for f in frames.values() if f.start is not None), default=None)
    shape = timeline_shape(rows, entity, epoch)
    asked = shape if source is None else timeline_shape(probes, entity, epoch)
    if width and may_crowd(shape, asked):
        # Rows per stretch hardly merge before their shuffle, so they are counted only where timelines are long.
        shape = timeline_shape(rows, entity, epoch, width_s=width)
        asked = shape if source is None else timeline_shape(probes, entity, epoch, width_s=width)
    between = asked.largest * shape.peak * 2  # probes times the source rows a frame can hold
    if shape.fits(task_rows) and asked.fits(task_rows) and between <= FRAME_WORK:

        def windowed(df: DataFrame) -> DataFrame:
            if source is None:
                return _window_totals(df, entity, epoch, measures, frames)
            return _tagged_totals(df, source, entity, epoch, measures, frames)

        return with_loose_rows(probes, [entity, epoch], asked, windowed)
    seconds = (
        rows.filter(F.col(entity).isNotNull() & F.col(epoch).isNotNull())
        .select(entity, epoch, *(m.alias(name) for name, m in measures.items()))
        .groupBy(entity, epoch)
        .agg(*(F.sum(name).alias(name) for name in measures))
    )
    wanted = probes.select(entity, epoch).dropna().distinct()
    fractional = any(isinstance(seconds.schema[name].dataType, (DoubleType, FloatType)) for name in measures)
    bounded = all(f.start is not None for f in frames.values())
    if fractional and bounded:
        # Subtracting float totals would leave rounding residue, so frames are summed directly.
        totals = _tiled_totals(wanted, seconds, entity, epoch, list(measures), frames)
    else:
        totals = _swept_totals(wanted, seconds, entity, epoch, list(measures), frames)
    # One row per (entity, second) on the right: a hot key on the left can be split by AQE.
    outputs = [out for out, _, _ in _names(list(measures), frames)]
    return probes.join(totals, [entity, epoch], "left").select(*probes.columns, *outputs)


def _names(measures: Sequence[str], frames: dict[str, Frame]) -> list[tuple[str, str, str]]:
    return [(f"{m}_{f}", m, f) for f in frames for m in measures]


def _window_totals(df, entity, epoch, measures, frames) -> DataFrame:
    held = df.select("*", *(m.alias(f"_m_{name}") for name, m in measures.items()))
    totals = [
        F.coalesce(F.sum(f"_m_{m}").over(frames[f].window(entity, epoch)), F.lit(0)).alias(out)
        for out, m, f in _names(list(measures), frames)
    ]
    return held.select(*df.columns, *totals)


def _tagged_totals(probes, source, entity, epoch, measures, frames) -> DataFrame:
    marked = probes.withColumn("_probe", F.lit(True))
    fed = source.select(
        entity, epoch, *(m.alias(f"_s_{name}") for name, m in measures.items()), F.lit(False).alias("_probe")
    ).dropna(subset=[entity, epoch])
    both = marked.unionByName(fed, allowMissingColumns=True)
    held = {name: F.col(f"_s_{name}") for name in measures}
    totals = _window_totals(both, entity, epoch, held, frames).filter("_probe")
    return totals.select(*probes.columns, *(out for out, _, _ in _names(list(measures), frames)))


def _swept_totals(wanted, seconds, entity, epoch, measures, frames) -> DataFrame:
    names = _names(measures, frames)
    # A source row at second s enters a frame at s - end and leaves it at s - start + 1.
    moves: dict[int, dict[str, int]] = {}
    for name, frame in frames.items():
        moves.setdefault(-frame.end, {})[name] = 1
        if frame.start is not None:
            moves.setdefault(-frame.start + 1, {})[name] = -1
    shifted = [
        F.struct(
            (F.col(epoch) + offset).alias("_at"),
            F.lit(False).alias("_probe"),
            *((F.col(m) * F.lit(signs.get(f, 0))).alias(out) for out, m, f in names),
        )
        for offset, signs in moves.items()
    ]
    deltas = seconds.select(entity, F.explode(F.array(*shifted)).alias("_d")).select(entity, "_d.*")
    asks = wanted.select(entity, F.col(epoch).alias("_at"), F.lit(True).alias("_probe"))
    day = F.floor(F.col("_at") / DAY).alias("_day")
    line = asks.unionByName(deltas, allowMissingColumns=True).select("*", day)
    days = deltas.select("*", day).groupBy(entity, "_day").agg(*(F.sum(out).alias(f"_t_{out}") for out, _, _ in names))
    # Carry covers days without deltas too, so every probed day gets a row.
    days = days.unionByName(asks.select(entity, day).distinct(), allowMissingColumns=True)
    days = days.groupBy(entity, "_day").agg(*(F.sum(f"_t_{out}").alias(f"_t_{out}") for out, _, _ in names))
    earlier = Window.partitionBy(entity).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carry = days.select(entity, "_day", *(F.sum(f"_t_{out}").over(earlier).alias(f"_t_{out}") for out, _, _ in names))
    within = Window.partitionBy(entity, "_day").orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    running = line.select(entity, "_day", "_at", "_probe", *(F.sum(out).over(within).alias(out) for out, _, _ in names))
    zero = F.lit(0)
    return (
        running.filter("_probe")
        .join(carry, [entity, "_day"])
        .select(
            entity,
            F.col("_at").alias(epoch),
            *((F.coalesce(F.col(o), zero) + F.coalesce(F.col(f"_t_{o}"), zero)).alias(o) for o, _, _ in names),
        )
    )


def _block_seconds(frame: Frame) -> int:
    """Length of the blocks that a frame's sums are made of: at most the frame, about ``FRAME_BLOCKS`` a frame."""
    width = frame.end - frame.start + 1
    return min(width, max(LEAST_BLOCK, -(-width // FRAME_BLOCKS)))


def _tiled_totals(wanted, seconds, entity, epoch, measures, frames) -> DataFrame:
    """Sums of float measures in two levels, without subtracting: work is linear however wide a frame is.

    Time is cut into blocks no longer than the frame.  A frame is the end of one block, whole blocks and
    the beginning of another, so it is one running sum from behind, a sum of block totals and one
    running sum from the front.
    """
    out = None
    for name, frame in frames.items():
        names = [(o, m) for o, m, f in _names(measures, frames) if f == name]
        totals = _block_totals(wanted, seconds, entity, epoch, names, frame)
        out = totals if out is None else out.join(totals, [entity, epoch])
    return out


def _block_totals(wanted, seconds, entity, epoch, names, frame) -> DataFrame:
    size = _block_seconds(frame)
    block = lambda at: F.floor(at / size)
    low, high = F.col(epoch) + frame.start, F.col(epoch) + frame.end
    # The two ends of every frame stand among the rows of their blocks.
    both_ends = F.explode(F.array_distinct(F.array(low, high))).alias("_at")
    asks = wanted.select(entity, epoch, both_ends, high.alias("_high"), (block(high) - block(low)).alias("_span"))
    asks = asks.withColumn("_is_high", F.col("_at") == F.col("_high")).drop("_high")
    fed = seconds.select(entity, F.col(epoch).alias("_at"), *(F.col(m).alias(f"_s_{m}") for _, m in names))
    both = asks.unionByName(fed, allowMissingColumns=True).withColumn("_block", block(F.col("_at")))
    line = Window.partitionBy(entity, "_block")
    front = line.orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    back = line.orderBy(F.col("_at").desc()).rangeBetween(Window.unboundedPreceding, 0)
    sums = [F.when(F.col("_is_high"), F.sum(f"_s_{m}").over(front)).otherwise(F.sum(f"_s_{m}").over(back)).alias(o) for o, m in names]
    # A frame of one block is the whole block, which its upper end sums up alone.
    ends = both.select(entity, epoch, "_is_high", "_span", *sums).filter(F.col(epoch).isNotNull() & (F.col("_is_high") | (F.col("_span") > 0)))
    parts = ends.select(entity, epoch, *(o for o, _ in names))
    # From the lower to the upper end it is as many blocks as fit into the frame, or one more.
    fewest = (frame.end - frame.start) // size
    inner = [(span, Window.partitionBy(entity).orderBy("_block").rangeBetween(1 - span, -1)) for span in (fewest, fewest + 1) if span > 1]
    if inner:
        asked = wanted.select(entity, epoch, block(high).alias("_block"), (block(high) - block(low)).alias("_span"))
        totals = fed.groupBy(entity, block(F.col("_at")).alias("_block")).agg(*(F.sum(f"_s_{m}").alias(f"_s_{m}") for _, m in names))
        # Asked blocks without rows of their own need a place too.
        places = asked.select(entity, "_block").distinct().unionByName(totals, allowMissingColumns=True)
        places = places.groupBy(entity, "_block").agg(*(F.sum(f"_s_{m}").alias(f"_s_{m}") for _, m in names))
        held = [F.sum(f"_s_{m}").over(w).alias(f"_{span}_{o}") for span, w in inner for o, m in names]
        middle = asked.join(places.select(entity, "_block", *held), [entity, "_block"])
        chosen = lambda o: F.coalesce(*(F.when(F.col("_span") == span, F.col(f"_{span}_{o}")) for span, _ in inner)).alias(o)
        parts = parts.unionByName(middle.select(entity, epoch, *(chosen(o) for o, _ in names)))
    return parts.groupBy(entity, epoch).agg(*(F.coalesce(F.sum(o), F.lit(0)).alias(o) for o, _ in names))


def _zero_one(flag: Column) -> Column:
    return flag.cast("long")


def trailing_count(
    df: DataFrame,
    site: str,
    epoch: str,
    flags: dict[str, Column],
    horizon_s: int = 1,
    span_s: int = TWO_HOURS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Flagged rows at the site in ``[t - span_s, t - horizon_s]``; rows at t itself never count."""
    totals = frame_totals(
        df, None, site, epoch, {k: _zero_one(v) for k, v in flags.items()}, {"w": Frame(-span_s, -horizon_s)}, task_rows
    )
    return totals.withColumnsRenamed({f"{k}_w": k for k in flags})


def trailing_arrivals(
    departures: DataFrame,
    arrivals: DataFrame,
    site: str,
    epoch: str,
    out: str = "arrivals",
    horizon_s: int = 0,
    span_s: int = TWO_HOURS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """For each departure, arrivals at the same site in ``[t - span_s, t - horizon_s]``."""
    totals = frame_totals(
        departures, arrivals, site, epoch, {"n": F.lit(1).cast("long")}, {"w": Frame(-span_s, -horizon_s)}, task_rows
    )
    return totals.withColumnRenamed("n_w", out)


def trailing_mean(
    df: DataFrame,
    site: str,
    epoch: str,
    values: dict[str, Column],
    horizon_s: int = 1,
    span_s: int = TWO_HOURS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Mean of each value at the site in ``[t - span_s, t - horizon_s]``; null for an empty frame."""
    measures = dict(values)
    measures |= {f"{k}_n": v.isNotNull().cast("long") for k, v in values.items()}
    totals = frame_totals(df, None, site, epoch, measures, {"w": Frame(-span_s, -horizon_s)}, task_rows)
    means = [F.try_divide(F.col(f"{k}_w"), F.col(f"{k}_n_w")).alias(k) for k in values]
    return totals.select(*df.columns, *means)


def min_support_gate(value: Column, support: Column, minimum: int = 3) -> Column:
    """Null unless at least ``minimum`` rows support the value."""
    return F.when(support >= minimum, value)


#: Frames of the three history rates: everything, two weeks, ninety days; all stop two hours before.
HISTORY = {
    "historical": Frame(None, -TWO_HOURS),
    "recent": Frame(-14 * DAY, -TWO_HOURS),
    "short_term": Frame(-90 * DAY, -TWO_HOURS),
}


def history_rates(
    df: DataFrame,
    entity: str,
    epoch: str,
    flags: dict[str, Column],
    frames: dict[str, Frame] | None = None,
    min_support: int = 3,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``{frame}_{flag}_pct``: 100 x share of flagged rows in each frame, all frames in one pass."""
    frames = HISTORY if frames is None else frames
    measures = {k: _zero_one(v) for k, v in flags.items()}
    measures |= {f"{k}_n": v.isNotNull().cast("long") for k, v in flags.items()}
    totals = frame_totals(df, None, entity, epoch, measures, frames, task_rows)
    rates = [
        min_support_gate(
            F.try_divide(F.col(f"{k}_{f}") * 100, F.col(f"{k}_n_{f}")), F.col(f"{k}_n_{f}"), min_support
        ).alias(f"{f}_{k}_pct")
        for f in frames
        for k in flags
    ]
    return totals.select(*df.columns, *rates)


def expanding_rate(df, entity, epoch, flag: Column, out="rate", horizon_s=TWO_HOURS, min_support=3, task_rows=TASK_ROWS):
    """Percentage of flagged rows in all history up to ``t - horizon_s``."""
    return _single_rate(df, entity, epoch, flag, out, Frame(None, -horizon_s), min_support, task_rows)


def rolling_rate(
    df, entity, epoch, flag: Column, days: int, out="rate", horizon_s=TWO_HOURS, min_support=3, task_rows=TASK_ROWS
):
    """Percentage of flagged rows in ``[t - days, t - horizon_s]``."""
    return _single_rate(df, entity, epoch, flag, out, Frame(-days * DAY, -horizon_s), min_support, task_rows)


def _single_rate(df, entity, epoch, flag, out, frame, min_support, task_rows) -> DataFrame:
    rates = history_rates(df, entity, epoch, {"x": flag}, {"f": frame}, min_support, task_rows)
    return rates.withColumnRenamed("f_x_pct", out)


def on_time_flag(delay: Column, limit: float = 15, skip_null: bool = False) -> Column:
    """1 when the delay is within ``limit``; a missing delay counts as on time unless skipped."""
    known = F.when(delay <= limit, 1).otherwise(0)
    return F.when(delay.isNotNull(), known) if skip_null else F.when(delay.isNull(), 1).otherwise(known)


def entity_lag(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    tiebreak: Sequence[str],
    columns: dict[str, str],
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Bring columns of the entity's previous row forward as ``{source: output}``.

    ``tiebreak`` has to make the order total; without it equal times would give arbitrary rows.
    """
    if not tiebreak:
        raise ValueError("a tie-break key is required")
    found = previous_row(df, entity, [*order, *tiebreak], list(columns), "_previous", task_rows)
    return found.select(*df.columns, *(F.col(f"_previous.{src}").alias(out) for src, out in columns.items()))


def entity_lag_known(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    tiebreak: Sequence[str],
    columns: dict[str, str],
    epoch: str,
    known_at: str,
    horizon_s: int = TWO_HOURS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Bring columns of the entity's last row forward whose ``known_at`` is at most ``epoch - horizon_s``.

    Both are in seconds.  Unlike :func:`entity_lag` it never shows a value before it is known.
    """
    if not tiebreak:
        raise ValueError("a tie-break key is required")
    found = latest_known(df, entity, [*order, *tiebreak], list(columns), epoch, known_at, horizon_s, "_known", task_rows)
    return found.select(*df.columns, *(F.col(f"_known.{src}").alias(out) for src, out in columns.items()))


def first_event_flag(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    tiebreak: Sequence[str],
    out: str = "is_first",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """1 for an entity's first row, 0 for later ones, null without an entity."""
    found = previous_row(df, entity, [*order, *tiebreak], [entity], "_previous", task_rows)
    first = F.when(F.col(entity).isNotNull(), F.col("_previous").isNull().cast("int"))
    return found.select(*df.columns, first.alias(out))


def legacy_alias(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Repeat columns under older names as ``{old name: column}``."""
    return df.withColumns({old: F.col(name) for old, name in aliases.items()})
