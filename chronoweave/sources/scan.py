"""Parquet and adjacency-text readers and the parquet sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronoweave.functions.scalars import parse_map_literal


def scan_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a parquet dataset; a given schema saves the footer inspection on large folders."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def adjacency_edges(lines: DataFrame, line: str = "value", node_type: str = "long") -> DataFrame:
    """``node<TAB>{'neighbour': count}`` lines to edges ``(src, dst, weight)``."""
    parts = F.split(F.col(line), "\t", 2)
    return (
        lines.select(parts[0].try_cast(node_type).alias("src"), parse_map_literal(parts[1]).alias("links"))
        .select("src", F.explode("links").alias("dst", "weight"))
        .select("src", F.col("dst").try_cast(node_type).alias("dst"), F.col("weight").cast("long").alias("weight"))
    )


def scan_adjacency(spark: SparkSession, path: str, node_type: str = "long") -> DataFrame:
    """Read adjacency text files into edges."""
    return adjacency_edges(spark.read.text(path), node_type=node_type)


def sink_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    files: int | None = None,
    max_records_per_file: int = 5_000_000,
    cluster_by: Sequence[str] = (),
) -> int:
    """Overwrite ``path`` and return the rows written.

    Without ``files`` the file count follows the data: AQE sizes the rebalanced partitions and
    splits hot ones.  ``files`` forces a round-robin count instead.  Rows are counted from the file
    footers, which neither runs the plan again nor counts a retried task twice.  (An ``Observation``
    would leave a session that fitted classifiers can no longer be serialized with.)

    ``cluster_by`` range-partitions on these columns inside ``partition_by`` and sorts the files, so each
    row group holds a narrow range of them and a filter on them skips the others.
    """
    if cluster_by:
        order = [*partition_by, *cluster_by]
        ranged = df.repartitionByRange(*order) if files is None else df.repartitionByRange(files, *order)
        shaped = ranged.sortWithinPartitions(*order)
    else:
        shaped = df.hint("rebalance", *partition_by) if files is None else df.repartition(files)
    writer = shaped.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def merge_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Union parts by column name."""
    return reduce(DataFrame.unionByName, parts)
