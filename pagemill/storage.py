"""Intermediate tables in the folder all executors share.

Iterative operators cut their lineage by writing a table and reading it back: a lost executor then
costs one task, not the whole chain of rounds. The folder is the session's ``spark.checkpoint.dir``;
only where that is unset and the session runs on this machine alone (tests) a temporary folder of this process is used.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

_local: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, or a temporary one where none is configured and the master is local; other sessions must name one."""
    global _local
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir is unset: on {master} intermediate tables need a folder that all executors share")
    if _local is None:
        _local = tempfile.mkdtemp(prefix="pagemill-")
        atexit.register(shutil.rmtree, _local, ignore_errors=True)
    return f"file://{_local}"


def at_end(spark: SparkSession, path: str) -> None:
    """Has the path deleted when the driver's JVM ends; until then results may still be read from it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)


class Scratch:
    """Tables of one operator run. ``cut`` materialises, ``drop`` frees the disk of rounds no longer needed."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        at_end(spark, self.base)
        self._n = 0

    def path(self, label: str = "t") -> str:
        self._n += 1
        return f"{self.base}/{self._n:03d}-{label}"

    def cut(self, df: DataFrame, label: str = "t") -> DataFrame:
        path = self.path(label)
        df.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def split(self, df: DataFrame, test: Column, label: str = "t") -> tuple[DataFrame | None, DataFrame | None]:
        """Materialises the rows for which ``test`` holds and the others, in one write; null where there are none."""
        path = self.path(label)
        df.withColumn("_side", test).write.mode("overwrite").partitionBy("_side").parquet(path)
        out = []
        for side in ("true", "false"):
            target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_side={side}")
            there = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
            part = self.spark.read.schema(df.schema).parquet(f"{path}/_side={side}") if there else None
            if part is not None:
                part._scratch_path = f"{path}/_side={side}"
            out.append(part)
        return out[0], out[1]

    def drop(self, *frames: DataFrame | None) -> None:
        jvm = self.spark.sparkContext._jvm
        for frame in frames:
            path = getattr(frame, "_scratch_path", None)
            if path:
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def drop_all(self) -> None:
        """Frees all tables of the run, once its result is consumed."""
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.base)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
