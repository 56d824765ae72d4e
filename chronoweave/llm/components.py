"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.scratch import write_scratch


def _stars(edges: DataFrame) -> DataFrame:
    """One large and one small star step; edges point from the larger node to the smaller one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    below = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(below, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.withColumnRenamed("m", "v").unionByName(moved).distinct()


def components(links: DataFrame) -> DataFrame:
    """Links (u, v) of orderable nodes -> (u, v) where v is the smallest node of u's component.

    The smallest nodes themselves have no row.  Every round is written to the shared folder, so a lost
    executor costs one round.  A hub's links are merged by partial minima before they are shuffled.
    """
    edges = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    table, state = write_scratch(edges, "links"), None
    while True:
        row = table.df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("h")).first()
        if (row["n"], row["h"]) == state or not row["n"]:
            return table.df
        state, old = (row["n"], row["h"]), table
        table = write_scratch(_stars(old.df), "links", row["n"])
        old.discard()
