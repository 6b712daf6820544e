"""Catalogue: streams. The messages arrive in three steps and each step restarts the stream."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from loomtext.plans.catalog import query, table
from loomtext.plans.queries_guard import _BANNED_SQL, _KIND_SQL, _SAFE_SQL, _TOOL_SQL, PLANTED_SQL, plant
from loomtext.session import scratch_path
from loomtext.streaming import streams


def _steps(spark, sf, start):
    """Write the messages turn range by turn range and run the stream after each: every run
    resumes from its checkpoint, so this is also the restart path."""
    root = scratch_path(spark, "arriving")
    c = table(spark, sf, "conversations").withColumnRenamed("conv_id", "thread_id")
    for lo, hi in [(0, 2), (2, 4), (4, 1 << 40)]:
        c.where((F.col("turn") >= lo) & (F.col("turn") < hi)).write.mode("append").parquet(root)
        stream = spark.readStream.schema(c.schema).parquet(root)
        start(stream).awaitTermination()


def _paths(spark):
    base = scratch_path(spark, "stream")
    return f"{base}/out", f"{base}/checkpoint"


@query("l01_guard_stream", f"""
WITH p AS (SELECT thread_id, turn, role = 'user' AND {_BANNED_SQL} AS kw, CASE WHEN role = 'user' THEN {_KIND_SQL} END AS pii,
    CASE WHEN role = 'user' THEN {_SAFE_SQL} ELSE text END AS safe_text, {_TOOL_SQL} AS tools FROM ({PLANTED_SQL}))
SELECT thread_id, turn, kw AS keyword_blocked, pii, safe_text, tools = 'high' AS needs_approval,
  CASE WHEN kw THEN 'blocked' WHEN tools = 'high' THEN 'high' WHEN pii IS NOT NULL OR tools = 'medium' THEN 'medium' ELSE 'low' END AS risk FROM p""")
def guard_stream(spark, sf):
    out, cp = _paths(spark)

    def start(stream):
        guarded = streams.guard_stream(plant(stream), tool_names=F.col("tool_names"))
        cols = ["thread_id", "turn", "keyword_blocked", "pii", "safe_text", "needs_approval", "risk"]
        return streams.write_table(guarded.select(*cols), out, cp)

    _steps(spark, sf, start)
    return spark.read.parquet(out)


@query("l02_session_history", """
SELECT conv_id AS thread_id, turn, role, md5(text) AS text_md5, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS seq FROM conversations""")
def session_history(spark, sf):
    out, cp = _paths(spark)
    _steps(spark, sf, lambda s: streams.session_history(s, out, cp))
    return spark.read.parquet(f"{out}/rows").select("thread_id", "turn", "role", F.md5("text").alias("text_md5"), "seq")


@query("l03_stream_rate_limit", """
SELECT conv_id AS thread_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS prior_calls,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 5 AS rate_limited FROM conversations""")
def stream_rate_limit(spark, sf):
    out, cp = _paths(spark)
    _steps(spark, sf, lambda s: streams.rate_limiter(s, out, cp, 5))
    return spark.read.parquet(f"{out}/rows").select("thread_id", "turn", "prior_calls", "rate_limited")


@query("l02_closed_sessions", """
WITH e AS (SELECT user_id, event_id, value, epoch_us(ts) AS t FROM events WHERE ts IS NOT NULL),
n AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) < 28800000000 THEN 0 ELSE 1 END AS opens FROM e),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY t) AS no FROM n)
SELECT user_id, count(*) AS n_events, min(event_id) AS first_event, max(event_id) AS last_event, round(sum(value), 4) AS total,
  (max(t) - min(t) + 28800000000) // 1000000 AS seconds
FROM s GROUP BY user_id, no HAVING max(t) + 28800000000 <= (SELECT max(t) - 3600000000 FROM e) - (SELECT max(t) - 3600000000 FROM e) % 1000""")
def closed_sessions(spark, sf):
    """Sessions of users with gaps of eight hours; the stream has taken in all events, those still open stay in its state."""
    out, cp = _paths(spark)
    root = scratch_path(spark, "arriving")
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    day = F.datediff("ts", F.lit("2024-01-01"))
    aggs = [F.count(F.lit(1)).alias("n_events"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"),
            F.round(F.sum("value"), 4).alias("total")]
    for part in (day < 7, (day >= 7) & (day < 21), (day >= 21) | day.isNull()):
        events.where(part).write.mode("append").parquet(root)
        stream = spark.readStream.schema(events.schema).parquet(root)
        streams.write_table(streams.closed_sessions(stream, "user_id", "ts", "8 hours", aggs, "1 hour"), out, cp).awaitTermination()
    seconds = F.expr("(unix_micros(session_end) - unix_micros(session_start)) div 1000000").alias("seconds")
    return spark.read.parquet(out).select("user_id", "n_events", "first_event", "last_event", "total", seconds)


@query("l04_state_values", """
SELECT conv_id AS thread_id, count(*) AS n_messages, max(turn) AS step, arg_max(role, turn) AS last_role, md5(arg_max(text, turn)) AS text_md5
FROM (SELECT c.*, s.hi FROM conversations c, (VALUES (2), (4), (1000000)) s(hi) WHERE c.turn < s.hi)
GROUP BY conv_id, hi HAVING max(turn) >= CASE hi WHEN 2 THEN 0 WHEN 4 THEN 2 ELSE 4 END""")
def state_values(spark, sf):
    """The `values` feed: the full state of each thread after every step that changed it."""
    out, cp = _paths(spark)
    _steps(spark, sf, lambda s: streams.feed_sink(streams.state_values(s), out, cp))
    return spark.read.parquet(out).select("thread_id", "n_messages", "step", "last_role", F.md5("last_text").alias("text_md5"))


@query("l04_state_updates", "SELECT conv_id AS thread_id, turn AS step, role AS last_role, md5(text) AS text_md5 FROM conversations")
def state_updates(spark, sf):
    out, cp = _paths(spark)
    _steps(spark, sf, lambda s: streams.write_table(streams.state_updates(s), out, cp))
    return spark.read.parquet(out).select("thread_id", "step", "last_role", F.md5("last_text").alias("text_md5"))


@query("l06_resume_after_failure", """
SELECT conv_id AS thread_id, count(*) AS n_messages, max(turn) AS step, md5(arg_max(text, turn)) AS text_md5, hi AS batch, true AS failed_once
FROM (SELECT c.*, s.hi FROM conversations c, (VALUES (0, 2), (1, 4), (2, 1000000)) s(hi, below) WHERE c.turn < s.below)
GROUP BY conv_id, hi HAVING max(turn) >= CASE hi WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 4 END""")
def resume_after_failure(spark, sf):
    """Every step fails once between its write and its commit, and is then resumed from the checkpoint."""
    out, cp = _paths(spark)
    failed = set()

    def fail_once(batch_id):
        if batch_id not in failed:
            failed.add(batch_id)
            raise RuntimeError("lost after the write")

    def start(stream):
        first = streams.feed_sink(streams.state_values(stream), out, cp, fail_once)
        try:
            first.awaitTermination()
        except StreamingQueryException:
            pass  # what this query is about
        return streams.feed_sink(streams.state_values(stream), out, cp, fail_once)

    _steps(spark, sf, start)
    return spark.read.parquet(out).select("thread_id", "n_messages", "step", F.md5("last_text").alias("text_md5"), "batch",
                                          F.lit(failed == {0, 1, 2}).alias("failed_once"))


@query("l05_stream_ingest", r"""
SELECT lang AS collection, doc_id, md5(regexp_replace(text, '\s', '', 'g')) AS solid_md5 FROM documents""")
def stream_ingest(spark, sf):
    """Stream all documents into an index twice over; chunks (no overlap) rebuild every text once."""
    out, cp = _paths(spark)
    d = table(spark, sf, "documents")
    source = spark.readStream.schema(d.schema).parquet(f"{sf}/{{documents.parquet}}")  # a pattern may be a file or a folder of files
    docs = source.select("doc_id", F.col("doc_id").cast("string").alias("source"), "text", F.col("lang").alias("collection"))
    for run in ("first", "again"):
        streams.index_stream(docs, out, f"{cp}-{run}", size=1000, overlap=0).awaitTermination()
    # the chunks of one document, so the lists are bounded by a text
    solid = F.regexp_replace("chunk", r"\s", "")
    parts = F.array_sort(F.collect_list(F.struct("chunk_idx", solid.alias("t"))))
    return spark.read.parquet(out).groupBy("collection", "doc_id").agg(
        F.md5(F.array_join(F.transform(parts, lambda p: p["t"]), "")).alias("solid_md5"))
