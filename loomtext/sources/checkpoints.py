"""Append-only checkpoint log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

N_BUCKETS = 64


def from_messages(messages: DataFrame, key: str = "thread_id") -> DataFrame:
    """Checkpoint rows (state struct, parent link) from (thread, step, n_messages, last_role)."""
    cid = F.concat_ws("-", F.col(key), F.col("step"))
    parent = F.when(F.col("step") > 0, F.concat_ws("-", F.col(key), F.col("step") - 1))
    return messages.select(
        F.col(key).alias("thread_id"), "step", cid.alias("checkpoint_id"), parent.alias("parent_id"),
        F.struct("n_messages", "last_role").alias("state"),
    )


def append(checkpoints: DataFrame, path: str, n_buckets: int = N_BUCKETS) -> None:
    """Append to the log, about a file for each bucket and advisory size.

    Rows are exchanged once by bucket; adaptive execution merges small buckets and splits one with a hot thread.
    """
    bucket = F.pmod(F.xxhash64("thread_id"), F.lit(n_buckets)).cast("int")
    checkpoints.withColumn("bucket", bucket).hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def read_thread(spark: SparkSession, path: str, thread_id: int, n_buckets: int = N_BUCKETS) -> DataFrame:
    """One thread's log; the bucket filter prunes all other partitions."""
    bucket = F.pmod(F.xxhash64(F.lit(thread_id).cast("long")), F.lit(n_buckets)).cast("int")
    return spark.read.parquet(path).where((F.col("bucket") == bucket) & (F.col("thread_id") == thread_id)).drop("bucket")
