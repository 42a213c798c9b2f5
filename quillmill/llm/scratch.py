"""Tables written between the steps of an iterative operator, in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where it is unset, a temporary folder, in local mode only."""
    global _own_root
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _own_root is None:
        _own_root = tempfile.mkdtemp(prefix="quillmill-")
        atexit.register(shutil.rmtree, _own_root, True)
    return f"file://{_own_root}"


class Scratch:
    """Lineage cut by written tables: an executor that is lost takes no intermediate result with it."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self.path(name))
        return self.read(name, df.schema)

    def read(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Deletes tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
