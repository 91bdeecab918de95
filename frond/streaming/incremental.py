"""Incremental processing of arriving records, each (rel_path, sha256) once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frond.session import ship
from frond.sources.sinks import ResumeState
from frond.storage import rename, exists


def process_new_files(spark: SparkSession, source: str, schema: str, state_dir: str, out_dir: str, work: Callable[[DataFrame], DataFrame], checkpoint: str, files_per_batch: int = 1000):
    """Run ``work`` over record files as they arrive in ``source``; returns the finished query.

    Structured Streaming remembers files, the state table remembers keys, so a record delivered
    again in another file is not processed again. ``work`` takes rows with rel_path and sha256 and
    returns rows with both and a status. A micro-batch writes its output under its number by a
    rename and then its state; repeated after a failure, it changes nothing that is already there.
    Within a batch, one row for each key is kept.
    """
    ship(spark)
    state = ResumeState(spark, state_dir)

    def each(batch: DataFrame, number: int) -> None:
        target = f"{out_dir}/batch={number}"
        if not exists(spark, target):
            fresh = state.pending(batch.dropDuplicates(["rel_path", "sha256"]))
            staging = f"{out_dir}.staging-{number}"
            work(fresh).write.mode("overwrite").parquet(staging)
            rename(spark, staging, target)
        state.record(str(number), spark.read.parquet(target))

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def class_counts_stream(stream: DataFrame, time: str, cls: str, window: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """(window_start, class, n): counts of a stream by event time; records later than ``late`` are left out."""
    got = stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), F.col(cls)).agg(F.count(F.lit(1)).alias("n"))
    return got.select(F.col("w.start").alias("window_start"), cls, "n")
