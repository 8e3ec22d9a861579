"""Cutting lineage: tables written to the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_DIR = "file:///tmp/checkpoints/fabulon"
#: Lets a write give up the files of its own shuffles at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local one only under a local master."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return LOCAL_DIR


def delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Tables of one operator call, each under a path of its own.

    As a context manager it deletes its tables at the end of the block, but for those that `keep` wrote: what a block returns reads
    kept tables and the caller's own, so that no other call's end can take them away. Without a block all tables stay."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{uuid.uuid4().hex}"
        self.n = 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        delete(self.spark, self.root)

    def cut(self, df: DataFrame) -> DataFrame:
        """Write `df` and return a reader of it: lost executors cost a reread, not a recomputation. The shuffles of the write go with its end."""
        self.n += 1
        return self._written(df, f"{self.root}/t{self.n}")

    def keep(self, df: DataFrame) -> DataFrame:
        """cut, for a small table that the call's result reads: it stays after the block."""
        self.n += 1
        return self._written(df, f"{self.root}-kept/t{self.n}")

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        before = self.spark.conf.get(CLEANUP, None)
        if before is not None:
            self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is not None:
                self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._fabulon_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later plan reads."""
        for df in tables:
            if path := getattr(df, "_fabulon_path", None):
                delete(self.spark, path)
