"""Resumable ingest of annotation rows: a directory stream, upserts by micro-batch, and the keyed fold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from fabulon.operators.joins import KEY, last_wins
from fabulon.operators.scratchpad import SCHEMA, stream_step


def upsert_batch(target: str):
    """foreachBatch: rows of the batch replace those of the same segment. Every batch writes a version of its own, and a marker
    names the version that holds, so that a batch that is run again ends in the same table."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = current(spark, target, batch_id)
        new = last_wins(batch, "arrival")
        out = new if old is None else old.join(new.select(*KEY), KEY, "left_anti").unionByName(new)
        out.write.mode("overwrite").parquet(f"{target}/v{batch_id}")

    return run


def current(spark: SparkSession, target: str, before: int | None = None) -> DataFrame | None:
    """The table as of the last batch (before a batch): the highest version that was committed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    found = [int(s.getPath().getName()[1:]) for s in fs.listStatus(path) if s.getPath().getName().startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    found = [v for v in found if before is None or v < before]
    return spark.read.parquet(f"{target}/v{max(found)}") if found else None


def ingest(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Take in all that is there; a later call goes on after it."""
    return stream.writeStream.foreachBatch(upsert_batch(target)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_memory(stream: DataFrame) -> DataFrame:
    """The scratchpad of each document, after each micro-batch of its rows."""
    return stream.groupBy("doc_id").applyInPandasWithState(stream_step, SCHEMA, "pad string", "update", GroupStateTimeout.NoTimeout)
