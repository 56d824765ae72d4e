"""Size checks that decide between plans; none of them changes a result."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType

from chronoweave.scratch import write_scratch

#: Rows one sorted task may hold before a group is split.
TASK_ROWS = 1_000_000
#: Row visits one task may spend on sliding frames, which are summed afresh for every row.
FRAME_WORK = 2_000_000_000
#: Rows a lookup side may have to be sent to every executor.
BROADCAST_ROWS = 50_000
#: Bytes of text a row of such a side may have.
ROW_BYTES = 1_024


@dataclass(frozen=True)
class Shape:
    """Rows of the largest timeline, rows that belong to none, and a bound on range-frame work.

    ``peak`` is the most rows in one stretch of frame width; ``work`` is the largest product, over
    timelines, of rows and the rows one frame can hold.
    """

    largest: int
    loose: int
    peak: int = 0
    work: int = 0

    def fits(self, task_rows: int) -> bool:
        """Whether every timeline can be sorted, and its frames summed, inside one task."""
        return self.largest <= task_rows and self.work <= FRAME_WORK


def timeline_shape(df: DataFrame, *keys: str, width_s: int | None = None) -> Shape:
    """Measure timelines keyed by ``keys[0]``; a null in any of ``keys`` makes a row loose.

    With ``width_s``, rows are first counted per stretch of that many seconds of ``keys[1]``: a frame
    touches at most two stretches, which bounds its rows however unevenly they lie.
    """
    usable = reduce(and_, (F.col(k).isNotNull() for k in keys))
    stretch = F.floor(F.col(keys[1]) / width_s) if width_s else F.lit(0)
    cells = df.groupBy(keys[0], stretch.alias("_stretch")).agg(
        F.count_if(usable).alias("in"), F.count_if(~usable).alias("out")
    )
    per_key = cells.groupBy(keys[0]).agg(F.sum("in").alias("in"), F.sum("out").alias("out"), F.max("in").alias("peak"))
    row = per_key.agg(
        F.max("in").alias("in"),
        F.sum("out").alias("out"),
        F.max("peak").alias("peak"),
        F.max(F.col("in").cast("double") * F.col("peak") * 2).alias("work"),
    ).first()
    largest, loose = row["in"] or 0, row["out"] or 0
    return Shape(largest, loose, row["peak"] or 0, int(row["work"] or 0)) if width_s else Shape(largest, loose)


def may_crowd(*shapes: Shape) -> bool:
    """Whether frames could be too much work for a task if each held its whole timeline."""
    return 2 * max(s.largest for s in shapes) ** 2 > FRAME_WORK


def with_loose_rows(df: DataFrame, keys: Sequence[str], shape: Shape, feature) -> DataFrame:
    """Apply ``feature`` to rows with complete keys and add the loose rows with null features.

    Loose rows skip the shuffle: they would meet in one partition and get no value from it.
    """
    if not shape.loose:
        return feature(df)
    usable = reduce(and_, (F.col(k).isNotNull() for k in keys))
    return feature(df.filter(usable)).unionByName(df.filter(~usable), allowMissingColumns=True)


def _row_bytes(df: DataFrame) -> Column | None:
    """Bytes of a row; None where a nested column leaves the width open."""
    width = F.lit(8 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif not isinstance(field.dataType, AtomicType):
            return None
    return width


def _measured(df: DataFrame, width: Column, max_rows: int) -> DataFrame:
    """Hint ``df`` for broadcast if one aggregate proves that it has few and narrow rows."""
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.max(width).alias("widest")).first()
    return F.broadcast(df) if size["rows"] <= max_rows and (size["widest"] or 0) <= ROW_BYTES else df


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` if it proves to be small, else leave the join to shuffle.

    Small means at most ``max_rows`` rows of at most ``ROW_BYTES`` each.  The rows stay on the executors:
    only their number and greatest width come to the driver, and both plans give the same rows.
    """
    width = _row_bytes(df)
    return df if width is None else _measured(df, width, max_rows)


def stored_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Like :func:`small_side` for an expensive side of unknown size: computed once, written, measured."""
    written = write_scratch(df, "side").df
    width = _row_bytes(written)
    if width is None:
        return written
    return _measured(written, width, max_rows)
