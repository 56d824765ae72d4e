"""Named, versioned pipeline stages and fitted models on shared storage."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.scratch import hadoop_path
from chronoweave.sources.scan import merge_parts, sink_parquet

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.=-]*")


def input_version(spark: SparkSession, *paths: str) -> str:
    """Short fingerprint of input folders: it changes when files are added, rewritten or removed, at any depth.

    Spark lists the files; their content is not read.
    """
    digest = hashlib.sha256()
    for path in paths:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        each = F.xxhash64("path", "length", "modificationTime")
        row = files.agg(F.count("*").alias("n"), F.sum("length").alias("size"), F.bit_xor(each).alias("files")).first()
        digest.update(f"{path}|{row['n']}|{row['size']}|{row['files']}".encode())
    return digest.hexdigest()[:16]


class StageStore:
    """Parquet stages below one folder.

    A stage counts as present only once its write has committed.  Stages carry a version, such as
    :func:`input_version` of what they are built from, so a stage from other input is not picked up.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str, version: str = "1") -> str:
        for part in (name, version):
            if not _NAME.fullmatch(part):
                raise ValueError(f"not a stage name: {part!r}")
        return f"{self.root}/{name}/v={version}"

    def _has(self, path: str) -> bool:
        fs, folder = hadoop_path(self.spark, path)
        return fs.exists(folder)

    def save(
        self, df: DataFrame, name: str, version: str = "1", partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()
    ) -> tuple[int, int]:
        """Write a stage; rows are counted by the write itself.  Returns (rows, columns)."""
        return sink_parquet(df, self.path(name, version), partition_by, cluster_by=cluster_by), len(df.columns)

    def load(self, name: str, version: str = "1") -> DataFrame:
        return self.spark.read.parquet(self.path(name, version))

    def exists(self, name: str, version: str = "1") -> bool:
        return self._has(f"{self.path(name, version)}/_SUCCESS")

    def list(self) -> list[str]:
        """Names that hold at least one committed version."""
        fs, root = hadoop_path(self.spark, self.root)
        if not fs.exists(root):
            return []
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/*/v=*/_SUCCESS")
        found = fs.globStatus(pattern) or []
        return sorted({status.getPath().getParent().getParent().getName() for status in found})

    def delete(self, name: str, version: str = "1") -> bool:
        fs, folder = hadoop_path(self.spark, self.path(name, version))
        return fs.delete(folder, True)

    def stage(
        self,
        name: str,
        build: Callable[[], DataFrame],
        version: str = "1",
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
    ) -> DataFrame:
        """Load the stage if it is present in this version, else build and save it."""
        if not self.exists(name, version):
            self.save(build(), name, version, partition_by, cluster_by)
        return self.load(name, version)

    def merge(self, names: Sequence[str], into: str, version: str = "1") -> DataFrame:
        """Union stages by column name into one stage."""
        return self.stage(into, lambda: merge_parts([self.load(n, version) for n in names]), version)


class ModelStore:
    """Fitted pipelines by run id."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, run_id: str) -> str:
        if not _NAME.fullmatch(run_id):
            raise ValueError(f"not a run id: {run_id!r}")
        return f"{self.root}/{run_id}"

    def save(self, model: Model, run_id: str) -> None:
        wrapped = model if isinstance(model, PipelineModel) else PipelineModel([model])
        wrapped.write().overwrite().save(self.path(run_id))

    def load(self, run_id: str) -> PipelineModel:
        return PipelineModel.load(self.path(run_id))
