"""Streaming faces of the batch operators.

Guards are stateless projections. Operators that number the rows of a thread keep its count in
Spark's state store, so a step reads and writes the counts of its own threads only, and the
checkpoint commits rows and counts together. The rows that one thread has in one step meet in one
task: the source's step size (`maxFilesPerTrigger` and the like) bounds what a hot thread brings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomtext.functions import inference as I
from loomtext.functions import text as X
from loomtext.operators import chunking, guarding
from loomtext.sources import corpus, index


# ---------------------------------------------------------------- stateless guards


def guard_stream(messages: DataFrame, role: str = "role", text: str = "text", **inputs) -> DataFrame:
    """The guard projection without the per-thread limit; works on streams and tables alike."""
    cols = guarding.guard_columns(F.col(role), F.col(text), **inputs)
    return messages.select("*", *[c.alias(n) for n, c in cols.items()])


def write_table(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stateless stream to a Parquet table (exactly once through the checkpoint)."""
    return (
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(**(trigger or {"availableNow": True})).start(path)
    )


# ---------------------------------------------------------------- per-thread counts


def _whole_as(stream: DataFrame, kind: str | None) -> list[Column]:
    """The columns with whole numbers as `kind` (None: as they are declared): pandas holds a long next to nulls as a double."""
    return [F.col(f"`{f.name}`").cast(kind or f.dataType).alias(f.name) if isinstance(f.dataType, T.LongType) else F.col(f"`{f.name}`")
            for f in stream.schema.fields]


def number_rows(stream: DataFrame, key: str, pos: str) -> DataFrame:
    """Add `n_prior`, the number of earlier rows of the thread over all steps.

    The state of a thread is its count. Rows of one step are numbered in the order of `pos` (null last), ties as
    they arrive (so do positions beyond 2^53 that agree in 53 bits); rows without a thread are one thread.
    """
    rows = stream.select(*_whole_as(stream, "string"), F.col(f"`{pos}`").alias("_pos"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("n_prior", T.LongType())])

    def number(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        step = pd.concat(list(frames)).sort_values("_pos", kind="stable", ignore_index=True).drop(columns="_pos")
        step["n_prior"] = step.index + seen
        state.update((seen + len(step),))
        yield step

    return rows.groupBy(key).applyInPandasWithState(number, schema, "n long", "append", GroupStateTimeout.NoTimeout).select(*_whole_as(stream, None), "n_prior")


def session_history(stream: DataFrame, path: str, checkpoint: str, key: str = "thread_id", pos: str = "turn",
                    **trigger) -> StreamingQuery:
    """Append arriving messages to their session below `path`/rows; `seq` is the place in the session."""
    rows = number_rows(stream, key, pos).withColumn("seq", F.col("n_prior") + 1).drop("n_prior")
    return write_table(rows, f"{path}/rows", checkpoint, **trigger)


def rate_limiter(stream: DataFrame, path: str, checkpoint: str, limit: int, key: str = "thread_id",
                 pos: str = "turn", **trigger) -> StreamingQuery:
    """Verdict per arriving call below `path`/rows: blocked from the `limit`-th earlier call on."""
    rows = number_rows(stream, key, pos).withColumnRenamed("n_prior", "prior_calls")
    return write_table(rows.withColumn("rate_limited", F.col("prior_calls") >= limit), f"{path}/rows", checkpoint, **trigger)


def read_history(spark: SparkSession, path: str, key: str, session) -> DataFrame:
    """Messages of one session so far."""
    return spark.read.parquet(f"{path}/rows").where(F.col(key) == session).orderBy("seq")


def closed_sessions(stream: DataFrame, key: str, time: str, gap: str, aggs: list[Column], late: str = "0 seconds") -> DataFrame:
    """One row per session that has ended: key, session_start, session_end and `aggs` (output mode `append`).

    Rows of a thread less than `gap` apart are one session. A session ends, and its state goes, once the newest
    time of all threads, less `late`, has passed its last row by `gap`; rows that come later than that are dropped.
    Rows without a time belong to no session. Sessions of a task are merged before the shuffle where
    `spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition` is set, so a hot thread sends one row per
    task and session.
    """
    window = F.session_window(F.col(time), gap)
    rows = stream.where(F.col(time).isNotNull()).withWatermark(time, late)
    ends = [F.col("session_window")[e].alias(f"session_{e}") for e in ("start", "end")]
    return rows.groupBy(key, window).agg(*aggs).select("*", *ends).drop("session_window")


# ---------------------------------------------------------------- state feeds


def state_values(stream: DataFrame, key: str = "thread_id", pos: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Full state of every thread that changed in a step (use output mode `update`).

    Built-in aggregates: partial sums leave each task before the shuffle.
    """
    return stream.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_messages"), F.max(pos).alias("step"),
        F.max_by(role, pos).alias("last_role"), F.max_by(text, pos).alias("last_text"),
    )


def state_updates(stream: DataFrame, key: str = "thread_id", pos: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Only the changed part: the arriving rows themselves (output mode `append`)."""
    return stream.select(key, F.col(pos).alias("step"), F.col(role).alias("last_role"), F.col(text).alias("last_text"))


def feed_sink(values: DataFrame, path: str, checkpoint: str, written: Callable[[int], None] | None = None, **trigger) -> StreamingQuery:
    """Persist an update-mode feed, one partition per step.

    A step that fails after its write and before its commit is run again and replaces what it wrote.
    `written` is called between the two with the number of the step.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if written:
            written(batch_id)

    return (
        values.writeStream.foreachBatch(run).outputMode("update").option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


# ---------------------------------------------------------------- incremental ingest


def index_stream(documents: DataFrame, index_path: str, checkpoint: str, size: int = 1000, overlap: int = 200,
                 encoder=None, **trigger) -> StreamingQuery:
    """Chunk arriving documents (source, text, collection) and add the chunks not indexed yet."""
    encode = encoder or I.hashed_encoder()

    def run(batch: DataFrame, batch_id: int) -> None:
        chunks = chunking.recursive_chunks(batch, size, overlap)
        chunks = index.content_id(chunks, "source", "chunk_idx", "chunk")
        index.add_documents(chunks, index_path, finish=lambda d: d.withColumn("embedding", encode(F.col("chunk"))))

    return (
        documents.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def watch_files(spark: SparkSession, root: str, pattern: str = "*.{py,md,mdx}", files_per_step: int = 1000) -> DataFrame:
    """Stream of new files below a folder: (source, text, collection).

    Unreadable text is dropped, and so are the paths that a scan excludes (looked for below the root).
    """
    raw = (
        spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_step).load(root)
    )
    path = F.col("_metadata.file_path")
    text = F.try_validate_utf8("value")
    below = X.relative_path(F.regexp_replace(path, "^file:/+", "file:/"), F.lit(_uri(root)))
    kind = F.when(path.endswith(".py"), "py").otherwise(X.file_type(path))
    seen = raw.where(corpus.not_excluded(below, corpus.EXCLUDED))
    return seen.select(path.alias("source"), text.alias("text"), kind.alias("collection")).where(F.col("text").isNotNull())


def _uri(root: str) -> str:
    """A local path as it starts the file paths that Spark reports; other stores' paths stay as they are."""
    return "file:" + quote(root, safe="/@+=:,!$&'()*;~") if root.startswith("/") else root
