"""Tables written to the cluster's shared checkpoint folder to cut lineage.

Iterative operators and range-partitioned chunks read their own intermediate result more than
once.  Writing it makes every reader see the same rows even after an executor is lost.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Rows to a file of a table that has many more partitions than its rows need.
FILE_ROWS = 4_096

#: Folders written inside each open scope, innermost last.
_SCOPES: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only when running in local mode."""
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if root:
        return root
    root = spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chronoweave-"))
    return spark.sparkContext.getCheckpointDir()


def hadoop_path(spark: SparkSession, path: str):
    """Resolve ``path`` to its Hadoop file system and path object."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


@dataclass
class ScratchTable:
    """A written intermediate table and the folder that holds it."""

    df: DataFrame
    path: str

    def discard(self) -> None:
        """Remove the folder once a later table has replaced this one."""
        fs, path = hadoop_path(self.df.sparkSession, self.path)
        fs.delete(path, True)


def write_scratch(df: DataFrame, label: str, rows: int | None = None) -> ScratchTable:
    """Write ``df`` once and return a frame that reads the written rows.

    ``rows`` is about how many these are: there is then no more than a file for ``FILE_ROWS`` of them, however
    many partitions they come in.  Every file costs an executor a process where the folder is a local one.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    path = f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return ScratchTable(spark.read.schema(df.schema).parquet(path), path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[ScratchTable], ScratchTable]]:
    """Remove the tables written inside when the block ends, but those handed to the yielded function.

    For results that are written before the block ends: a frame still to be evaluated needs its tables.
    """
    paths: list[str] = []
    kept: set[str] = set()

    def keep(table: ScratchTable) -> ScratchTable:
        kept.add(table.path)
        return table

    _SCOPES.append(paths)
    try:
        yield keep
    finally:
        _SCOPES.remove(paths)
        for path in paths:
            if path in kept:
                continue
            fs, at = hadoop_path(spark, path)
            fs.delete(at, True)
