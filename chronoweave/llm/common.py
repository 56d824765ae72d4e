"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def running_total(values: Column) -> Column:
    """Inclusive running sums of an integer array, in a logarithmic number of linear passes."""
    steps = F.array(*(F.lit(1 << b) for b in range(31)))
    return F.aggregate(
        F.filter(steps, lambda s: s < F.size(values)),
        values,
        lambda sums, s: F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - s), F.lit(0))),
    )


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def row_bytes(df: DataFrame, column: str) -> tuple[int, int]:
    """Number of rows and the widest value of ``column`` in bytes, measured with one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length(column)).alias("w")).first()
    return row["n"], row["w"] or 0


def parts_for(df: DataFrame, per_core: int = 2) -> int:
    """Partitions for Python stages: enough to use every core, never fewer than the shuffle setting."""
    spark = df.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(wanted, per_core * spark.sparkContext.defaultParallelism)


def running_before(df: DataFrame, group: list[str], cell: str, order: list, size: Column, out: str) -> DataFrame:
    """Add the sum of ``size`` before each row, in order of (cell, order) within the group.

    Rows meet only with their own cell; a table of cell sums carries the totals across.
    """
    inside = Window.partitionBy(*group, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_in", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    sums = df.groupBy(*group, cell).agg(F.sum(size).alias("_sum"))
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, cell, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    return rows.join(offsets, [*group, cell]).withColumn(out, F.col("_in") + F.col("_before")).drop("_in", "_before")
