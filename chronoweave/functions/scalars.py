"""Scalar expressions; all stay inside generated JVM code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Months of each season, and the months around the holidays.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
LAST_SEASON = "Fall"
HOLIDAY_MONTHS = (11, 12, 1)
#: Upper hour bound and name of the six-hour bands.
BANDS = ((6, "1.Early Morning"), (12, "2.Morning"), (18, "3.Afternoon"))
LAST_BAND = "4. Night"


def named(column: str) -> Column:
    """Column of exactly this name, dots and backticks in it included."""
    return F.col("`" + column.replace("`", "``") + "`")


def hhmm_to_timestamp(day: Column, clock: Column) -> Column:
    """Date plus an HHMM integer (2400 is midnight of the next day); null for an impossible clock."""
    midnight = clock == 2400
    digits = F.lpad(F.when(midnight, 0).otherwise(clock).cast("string"), 4, "0")
    stamp = F.try_to_timestamp(
        F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), digits), F.lit("yyyy-MM-dd HHmm")
    )
    return F.when(midnight, stamp + F.expr("INTERVAL 1 DAY")).otherwise(stamp)


def arrival_timestamp(day: Column, departure_clock: Column, arrival_clock: Column) -> Column:
    """Arrival time for a departure date; an arrival clock before departure means the next day."""
    stamp = hhmm_to_timestamp(day, arrival_clock)
    return F.when(arrival_clock < departure_clock, stamp + F.expr("INTERVAL 1 DAY")).otherwise(stamp)


def to_epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970; a range frame has to be ordered by such a bigint."""
    return F.unix_timestamp(ts)


def indicator_flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "quarter": F.quarter(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "iso_weekday": F.weekday(ts) + 1,
        "hour": F.hour(ts),
        "date": F.to_date(ts),
    }


def season(month: Column) -> Column:
    chain = F.lit(LAST_SEASON)
    for name, months in SEASONS.items():
        chain = F.when(month.isin(*months), name).otherwise(chain)
    return chain


def calendar_flags(
    weekday: Column, hour: Column, month: Column, weekend: tuple[int, ...] = (6, 7)
) -> dict[str, Column]:
    """Weekend, business-hours, season and holiday-month columns; ``weekend`` uses ISO weekdays."""
    return {
        "IsWeekend": weekday.isin(*weekend).cast("int"),
        "IsBusinessHours": hour.between(6, 22).cast("int"),
        "SeasonQuarter": season(month),
        "IsHolidayMonth": month.isin(*HOLIDAY_MONTHS).cast("int"),
    }


def time_band(hour: Column) -> Column:
    chain = F.lit(LAST_BAND)
    for bound, name in reversed(BANDS):
        chain = F.when(hour < bound, name).otherwise(chain)
    return F.when(hour.isNotNull(), chain)


def block_hour(block: Column) -> Column:
    """Leading hour of an ``HHMM-HHMM`` block name."""
    return F.try_to_number(F.substring(block, 1, 2), F.lit("99")).cast("int")


def date_shift(day: Column, days: int) -> Column:
    return F.date_add(day, days)


def minutes_of_day(clock: Column) -> Column:
    return F.floor(clock / 100) * 60 + clock % 100


def turnaround(
    day: Column, clock: Column, previous_day: Column, previous_clock: Column, mode: str = "minutes"
) -> Column:
    """Gap from the previous arrival clock to this departure clock, same or next day only.

    ``mode="hhmm"`` subtracts the raw HHMM integers, as older published tables did.
    """
    if mode == "minutes":
        gap, next_day = minutes_of_day(clock) - minutes_of_day(previous_clock), 24 * 60
    elif mode == "hhmm":
        gap, next_day = clock - previous_clock, 2400
    else:
        raise ValueError(f"unknown mode {mode!r}")
    apart = F.datediff(day, previous_day)
    return F.when(apart == 0, gap).when(apart == 1, gap + next_day)


def lookup_bucket(ts: Column, lead_hours: int = 2) -> Column:
    """Start of the hour that is observable ``lead_hours`` before the event."""
    return F.date_trunc("HOUR", ts) - F.expr(f"INTERVAL {int(lead_hours)} HOURS")


def coalesce_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def floor_at_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0))


def concat_pad(*parts: tuple[Column, int], separator: str = "-") -> Column:
    """Join parts after padding each with zeros on the left to its width."""
    return F.concat_ws(separator, *(F.lpad(c.cast("string"), width, "0") for c, width in parts))


def parse_map_literal(text: Column) -> Column:
    """``{'4': 3}`` style text to ``map<string,bigint>`` without evaluating it."""
    return F.from_json(text, "map<string,bigint>")


def expand_multiplicity(item: Column, count: Column) -> Column:
    """One array entry per repetition, for counts that fit one value; ``clean.expand_rows`` has no such limit."""
    return F.array_repeat(item, count.cast("int"))


def cyclic_encode(value: Column, period: float) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def log_transform(value: Column) -> Column:
    return F.log1p(value)


def key_hash(*keys: Column) -> Column:
    """Repeatable number in [0, 2^32) from non-negative integer keys, using plain integer arithmetic.

    Any engine can reproduce it, and it does not depend on partitioning as a seeded sample does.
    """
    folded = F.lit(0).cast("long")
    for key in keys:
        folded = F.pmod(folded * 1_000_003 + F.pmod(key.cast("long"), F.lit(2**31)), F.lit(2**31))
    return F.pmod(folded * F.lit(2_654_435_761), F.lit(2**32))
