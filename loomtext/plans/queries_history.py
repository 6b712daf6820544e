"""Catalogue: threads, checkpoints, graphs, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.operators import chunking, graph, history, joins, ranges, stats
from loomtext.plans.catalog import query, table
from loomtext.plans.queries_guard import hot_threads
from loomtext.plans.queries_text import WINDOWS_512
from loomtext.session import cut_lineage, scratch_path
from loomtext.sources import checkpoints as log
from loomtext.sources import index

# ---------------------------------------------------------------- history (H)

_WORDS = r"len(regexp_extract_all(text, '\S+'))"


def _threads(spark, sf):
    return table(spark, sf, "conversations").withColumnRenamed("conv_id", "thread_id")


@query("h01_trim_history", f"""
WITH t AS (SELECT conv_id AS thread_id, turn, role, text, {_WORDS} AS n_tokens,
             turn = min(turn) OVER (PARTITION BY conv_id) AND role = 'system' AS is_sys FROM conversations),
s AS (SELECT *, sum(CASE WHEN is_sys THEN 0 ELSE n_tokens END) OVER (PARTITION BY thread_id ORDER BY turn DESC) AS used,
             sum(CASE WHEN is_sys THEN n_tokens ELSE 0 END) OVER (PARTITION BY thread_id) AS sys_tokens FROM t),
fit AS (SELECT * FROM s WHERE NOT is_sys AND used <= 165 - sys_tokens),
st AS (SELECT thread_id, min(turn) AS m FROM fit WHERE role = 'user' GROUP BY thread_id)
SELECT thread_id, turn, role, n_tokens FROM fit JOIN st USING (thread_id) WHERE turn >= m
UNION ALL SELECT thread_id, turn, role, n_tokens FROM s WHERE is_sys""")
def trim_history(spark, sf):
    return history.trim(_threads(spark, sf), "thread_id", 165).select("thread_id", "turn", "role", "n_tokens")


@query("h02_last_messages", """
SELECT conv_id AS thread_id, turn, role, substr(text, 1, 50) || '...' AS preview, rn AS from_end FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) WHERE rn <= 2""")
def last_messages(spark, sf):
    last = history.last_n(_threads(spark, sf), ["thread_id"], 2)
    return last.select("thread_id", "turn", "role", X.preview(F.col("text"), 50, always=True).alias("preview"), "from_end")


@query("h03_transcripts", """
SELECT conv_id AS thread_id, turn, turn // 4 AS page,
       string_agg(text, chr(10)) OVER (PARTITION BY conv_id, turn // 4 ORDER BY turn) AS transcript FROM conversations""")
def transcripts(spark, sf):
    return history.transcripts(_threads(spark, sf), "thread_id", page_bits=2).select("thread_id", "turn", "page", "transcript")


@query("h03_full_transcripts", """
SELECT conv_id AS thread_id, turn, turn // 64 AS page,
       md5(string_agg(text, chr(10)) OVER (PARTITION BY conv_id, turn // 64 ORDER BY turn)) AS transcript_md5 FROM conversations""")
def full_transcripts(spark, sf):
    t = history.transcripts(_threads(spark, sf), "thread_id")
    return t.select("thread_id", "turn", "page", F.md5("transcript").alias("transcript_md5"))


#: Sixteen conversations one after another are one thread.
LONG_SQL = "SELECT conv_id // 16 AS thread_id, (conv_id % 16) * 32 + turn AS turn, text FROM conversations"


@query("h03_transcript_at", f"""
WITH c AS ({LONG_SQL}), p AS (SELECT thread_id, max(turn) AS upto FROM c GROUP BY thread_id)
SELECT thread_id, upto, md5(string_agg(text, chr(10) ORDER BY turn)) AS transcript_md5, max(turn // 64) - min(turn // 64) AS pages_spanned
FROM c JOIN p USING (thread_id) GROUP BY ALL""")
def transcript_at(spark, sf):
    """Pages of the whole transcript at each thread's last turn, put together here to compare them."""
    c = table(spark, sf, "conversations")
    long = c.select(F.floor(F.col("conv_id") / 16).alias("thread_id"), (F.col("conv_id") % 16 * 32 + F.col("turn")).alias("turn"), "text")
    points = long.groupBy("thread_id").agg(F.max("turn").alias("upto"))
    pages = history.transcript_at(long, points, "thread_id", "upto")
    parts = F.array_sort(F.collect_list(F.struct("page", "transcript")))
    whole = F.array_join(F.transform(parts, lambda x: x["transcript"]), "\n")
    return pages.groupBy("thread_id", "upto").agg(F.md5(whole).alias("transcript_md5"), (F.max("page") - F.min("page")).alias("pages_spanned"))


@query("h04_call_rank", """
SELECT conv_id AS thread_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS prior_calls,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 5 AS rate_limited FROM conversations""")
def call_rank(spark, sf):
    return history.call_ranks(_threads(spark, sf), "thread_id", "turn", 5).select("thread_id", "turn", "prior_calls", "rate_limited")


@query("h05_latest_user_text", """
SELECT conv_id AS thread_id, turn, coalesce(last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS)
  OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING), 'No user message found') AS last_user_text FROM conversations""")
def latest_user_text(spark, sf):
    return history.latest_user_text(_threads(spark, sf), "thread_id").select("thread_id", "turn", "last_user_text")


#: A checkpoint per turn: the running message count and the role that wrote it.
CHECKPOINTS_SQL = """SELECT conv_id AS thread_id, turn AS step, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n_messages,
  role AS last_role FROM conversations"""


def checkpoints(spark, sf, hot=None):
    ranked = history.call_ranks(_threads(spark, sf), "thread_id", "turn", 0, hot_threads(spark, sf) if hot is None else hot)
    return ranked.select("thread_id", F.col("turn").alias("step"), (F.col("prior_calls") + 1).alias("n_messages"), F.col("role").alias("last_role"))


@query("h06_checkpoint_history", f"""
SELECT thread_id, step, n_messages, row_number() OVER (PARTITION BY thread_id ORDER BY step DESC) - 1 AS step_index FROM ({CHECKPOINTS_SQL})""")
def checkpoint_history(spark, sf):
    hot = hot_threads(spark, sf)
    return history.checkpoint_history(checkpoints(spark, sf, hot), "thread_id", hot=hot).select("thread_id", "step", "n_messages", "step_index")


@query("h06_checkpoint_at", f"""
SELECT thread_id, step, n_messages, last_role FROM (
  SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY step DESC) AS rn FROM ({CHECKPOINTS_SQL})) WHERE rn = 4""")
def checkpoint_at(spark, sf):
    return history.checkpoint_at(checkpoints(spark, sf), "thread_id", 3)


_UPDATES_SQL = """SELECT conv_id AS thread_id, 'm' || turn AS msg_id, turn AS seq, text FROM conversations
UNION ALL SELECT conv_id, 'm' || turn, turn + 1000, 'edited: ' || text FROM conversations WHERE turn % 3 = 0"""


@query("h07_merge_messages", f"""
SELECT thread_id, msg_id, first_seq, text, n_versions, row_number() OVER (PARTITION BY thread_id ORDER BY first_seq) AS position FROM (
  SELECT thread_id, msg_id, min(seq) AS first_seq, arg_max(text, seq) AS text, count(*) AS n_versions FROM ({_UPDATES_SQL}) GROUP BY ALL)""")
def merge_messages(spark, sf):
    t = _threads(spark, sf).withColumn("msg_id", F.concat(F.lit("m"), F.col("turn").cast("string")))
    first = t.select("thread_id", "msg_id", F.col("turn").alias("seq"), "text")
    again = t.where(F.col("turn") % 3 == 0).select("thread_id", "msg_id", (F.col("turn") + 1000).alias("seq"), F.concat(F.lit("edited: "), "text").alias("text"))
    return history.merge_messages(first.unionByName(again), "thread_id", "msg_id", "seq", "text", hot_threads(spark, sf))


_STATE_SQL = """SELECT conv_id AS thread_id, turn AS step, CASE WHEN turn % 3 = 0 THEN role || '-' || turn END AS mood,
  CASE WHEN turn % 4 = 1 THEN md5(text) END AS topic, length(text)::BIGINT AS cost,
  CASE WHEN role = 'user' THEN text END AS message FROM conversations"""


def _state_updates(spark, sf):
    turn = F.col("turn")
    return _threads(spark, sf).select(
        "thread_id", turn.alias("step"),
        F.when(turn % 3 == 0, F.concat("role", F.lit("-"), turn.cast("string"))).alias("mood"),
        F.when(turn % 4 == 1, F.md5("text")).alias("topic"), F.length("text").cast("long").alias("cost"),
        F.when(F.col("role") == "user", F.col("text")).alias("message"))


@query("h08_state_fold", f"""
SELECT thread_id, step, last_value(mood IGNORE NULLS) OVER w AS mood_now, last_value(topic IGNORE NULLS) OVER w AS topic_now,
       (sum(cost) OVER w)::BIGINT AS cost_total, count(message) OVER w AS n_appended
FROM ({_STATE_SQL}) WINDOW w AS (PARTITION BY thread_id ORDER BY step ROWS UNBOUNDED PRECEDING)""")
def state_fold(spark, sf):
    return history.fold_state(_state_updates(spark, sf), "thread_id", "step", ["mood", "topic"], ["cost"], "message").select(
        "thread_id", "step", "mood_now", "topic_now", "cost_total", "n_appended")


_FOLDED_SQL = f"""SELECT thread_id, step, last_value(mood IGNORE NULLS) OVER w AS mood, last_value(topic IGNORE NULLS) OVER w AS topic
FROM ({_STATE_SQL}) WINDOW w AS (PARTITION BY thread_id ORDER BY step ROWS UNBOUNDED PRECEDING)"""


@query("h09_fork_with_override", f"""
WITH c AS ({_FOLDED_SQL}), n AS (SELECT thread_id, max(step) AS last FROM c GROUP BY thread_id)
SELECT thread_id, step, CASE WHEN step > 0 THEN step - 1 END AS parent_step, mood, topic FROM c
UNION ALL SELECT thread_id, last + 1, step, 'excited', topic FROM c JOIN n USING (thread_id) WHERE step = 1 AND thread_id % 3 = 0""")
def fork_with_override(spark, sf):
    folded = history.fold_state(_state_updates(spark, sf), "thread_id", "step", ["mood", "topic"])
    c = folded.select("thread_id", "step", F.col("mood_now").alias("mood"), F.col("topic_now").alias("topic"))
    over = table(spark, sf, "conversations").select(F.col("conv_id").alias("thread_id")).where("thread_id % 3 = 0").distinct()
    over = over.select("thread_id", F.lit("excited").alias("mood"), F.lit(None).cast("string").alias("topic"))
    return history.fork(c, over, "thread_id", "step", 1, ["mood", "topic"])


@query("h09_fork_history", f"""
WITH RECURSIVE c AS ({_FOLDED_SQL}), n AS (SELECT thread_id, max(step) AS last FROM c GROUP BY thread_id),
all_rows AS (
  SELECT thread_id, step, CASE WHEN step > 0 THEN step - 1 END AS parent_step, mood, topic FROM c
  UNION ALL SELECT thread_id, last + 1, step, 'excited', topic FROM c JOIN n USING (thread_id) WHERE step = 1 AND thread_id % 3 = 0
  UNION ALL SELECT thread_id, last + 2, last + 1, 'calm', topic FROM c JOIN n USING (thread_id) WHERE step = 1 AND thread_id % 6 = 0
), path AS (
  SELECT thread_id, max(step) AS head, max(step) AS step, 0::BIGINT AS back FROM all_rows GROUP BY thread_id
  UNION ALL SELECT p.thread_id, head, a.parent_step, back + 1 FROM path p JOIN all_rows a USING (thread_id, step) WHERE a.parent_step IS NOT NULL
)
SELECT thread_id, head, step, back, mood, topic FROM path JOIN all_rows USING (thread_id, step)""")
def fork_history(spark, sf):
    """Forks, and forks of forks: the states behind the newest checkpoint of every thread, in order."""
    forked = fork_with_override(spark, sf)
    ids = table(spark, sf, "conversations").select(F.col("conv_id").alias("thread_id")).where("thread_id % 6 = 0").distinct()
    newest = forked.groupBy("thread_id").agg(F.max("step").alias("at"))
    over = ids.join(newest, "thread_id").select("thread_id", "at", F.lit("calm").alias("mood"), F.lit(None).cast("string").alias("topic"))
    twice = cut_lineage(history.fork(forked, over, "thread_id", "step", None, ["mood", "topic"]))
    heads = twice.groupBy("thread_id").agg(F.max("step").alias("head"))
    path = history.ancestry(twice, heads, "thread_id")
    return path.join(twice.drop("parent_step"), ["thread_id", "step"]).select("thread_id", "head", "step", "back", "mood", "topic")


@query("f08_state_as_of_points", f"""
WITH p AS (SELECT conv_id AS thread_id, turn AS point, (turn * 7) % 11 - 2 AS asked FROM conversations)
SELECT p.thread_id, point, asked, step, n_messages, last_role FROM p ASOF LEFT JOIN ({CHECKPOINTS_SQL}) c ON p.thread_id = c.thread_id AND p.asked >= c.step""")
def state_as_of_points(spark, sf):
    """Points in time of every thread, some before its first checkpoint."""
    hot = hot_threads(spark, sf)
    points = _threads(spark, sf).select("thread_id", F.col("turn").alias("point"), (F.col("turn") * 7 % 11 - 2).alias("asked"))
    return joins.state_as_of_points(checkpoints(spark, sf, hot), points, "thread_id", "step", "asked", ["n_messages", "last_role"], hot)


@query("f08_state_as_of", f"""
SELECT thread_id, max(step) AS step, arg_max(n_messages, step) AS n_messages, arg_max(last_role, step) AS last_role
FROM ({CHECKPOINTS_SQL}) WHERE step <= 3 GROUP BY thread_id""")
def state_as_of(spark, sf):
    return joins.state_as_of(checkpoints(spark, sf), "thread_id", "step", 3, ["n_messages", "last_role"])


@query("g04_message_counts", "SELECT conv_id AS thread_id, count(*) AS n_messages FROM conversations GROUP BY conv_id")
def message_counts(spark, sf):
    return stats.message_counts(_threads(spark, sf), "thread_id")


@query("b20_system_prompt", """
SELECT conv_id AS thread_id, -1 AS turn, 'system' AS role, 'Answer in French.' AS text FROM conversations GROUP BY conv_id
UNION ALL SELECT conv_id, turn, role, text FROM conversations""")
def system_prompt(spark, sf):
    return history.with_system_prompt(_threads(spark, sf), "thread_id", "Answer in {language}.", language=F.lit("French"))


@query("a11_checkpoint_log", f"""
SELECT thread_id, step, thread_id || '-' || step AS checkpoint_id, CASE WHEN step > 0 THEN thread_id || '-' || (step - 1) END AS parent_id,
       n_messages, last_role FROM ({CHECKPOINTS_SQL})""")
def checkpoint_log(spark, sf):
    path = scratch_path(spark, "checkpoint-log")
    log.append(log.from_messages(checkpoints(spark, sf)), path)
    return log.read(spark, path).select("thread_id", "step", "checkpoint_id", "parent_id", "state.*")


# ---------------------------------------------------------------- graphs (F9, G6, K7)

_EDGES_SQL = """SELECT DISTINCT src, dst FROM (SELECT url AS src, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS dst FROM pages)"""


def _edges(spark, sf):
    return graph.link_edges(table(spark, sf, "pages"), F.col("url"))


@query("k07_link_edges", _EDGES_SQL)
def link_edges(spark, sf):
    return _edges(spark, sf)


@query("f09_graph_neighbours", f"SELECT src AS node, dst AS neighbour FROM ({_EDGES_SQL}) UNION SELECT dst, src FROM ({_EDGES_SQL})")
def graph_neighbours(spark, sf):
    return graph.neighbours(_edges(spark, sf))


@query("g06_graph_size", f"""
WITH e AS ({_EDGES_SQL}) SELECT (SELECT count(*) FROM (SELECT src FROM e UNION SELECT dst FROM e)) AS n_nodes, (SELECT count(*) FROM e) AS n_edges""")
def graph_size(spark, sf):
    return graph.graph_size(_edges(spark, sf))


@query("j03_node_union", f"SELECT src AS node FROM ({_EDGES_SQL}) UNION SELECT dst FROM ({_EDGES_SQL})")
def node_union(spark, sf):
    e = _edges(spark, sf)
    return e.select(F.col("src").alias("node")).union(e.select("dst")).distinct()


@query("e08_neighbour_pages", f"""
WITH n AS (SELECT src AS file, dst AS x FROM ({_EDGES_SQL}) UNION SELECT dst, src FROM ({_EDGES_SQL})),
r AS (SELECT *, (row_number() OVER (PARTITION BY file ORDER BY x) - 1) // 4 AS page FROM n)
SELECT file, page, string_agg(x, ', ' ORDER BY x) AS text FROM r GROUP BY file, page""")
def neighbour_pages(spark, sf):
    return graph.neighbour_pages(_edges(spark, sf), page_size=4)


# ---------------------------------------------------------------- joins, concatenation, index adds


@query("f01_summary_enrichment", """
SELECT doc_id, source, s.summary FROM documents LEFT JOIN (
  SELECT source, 'Source ' || source || ' has ' || count(*) || ' documents' AS summary FROM documents GROUP BY source
  HAVING right(source, 1) IN ('0', '2', '4', '6', '8')) s USING (source)""")
def summary_enrichment(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    s = d.groupBy("source").count().where(F.right("source", F.lit(1)).isin("0", "2", "4", "6", "8"))
    s = s.select("source", F.concat(F.lit("Source "), "source", F.lit(" has "), F.col("count").cast("string"), F.lit(" documents")).alias("summary"))
    return joins.enrich(d, s, "source", "doc_id")


@query("f05_important_folders", """
SELECT page_id, regexp_extract(url, '^(https?://[^/]+/[^/]+)', 1) AS path FROM pages
WHERE regexp_extract(url, '^https?://[^/]+/([^/]+)', 1) IN ('en', 'fr')""")
def important_folders(spark, sf):
    p = table(spark, sf, "pages").select("page_id", F.regexp_extract("url", r"^(https?://[^/]+/[^/]+)", 1).alias("path"))
    names = spark.createDataFrame([("en",), ("fr",)], "name string")
    return joins.restrict_folders(p, F.broadcast(names))


@query("g07_summary_concat", r"""
WITH s AS (SELECT source, doc_id, nullif(regexp_extract(text, '[^.]+[.]'), '') AS t FROM documents),
r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 16 AS page FROM s WHERE t IS NOT NULL)
SELECT source, page, count(*) AS n_items, string_agg(t, chr(10) || chr(10) ORDER BY doc_id) AS text FROM r GROUP BY source, page""")
def summary_concat(spark, sf):
    d = table(spark, sf, "documents").select(
        "source", ranges.sort_key(F.col("source"), ranges.padded(F.col("doc_id"))).alias("key"),
        F.nullif(X.first_sentence(F.col("text")), F.lit("")).alias("summary"))
    return ranges.paged_concat(d, ["source"], "key", "summary", page_size=16)


_CHUNK_KEY_SQL = f"SELECT lang, source, doc_id, chunk_idx, md5(source || chr(1) || doc_id || chr(1) || chunk_idx || chr(1) || chunk) AS chunk_id FROM ({WINDOWS_512})"


def _keyed_chunks(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    c = chunking.window_chunks(d, 512, 50)
    key = F.concat_ws("\u0001", "source", F.col("doc_id").cast("string"), F.col("chunk_idx").cast("string"), "chunk")
    return c.withColumn("chunk_id", F.md5(key))


@query("f03_anti_join_add", f"SELECT doc_id, chunk_idx::BIGINT AS chunk_idx, chunk_id FROM ({_CHUNK_KEY_SQL}) WHERE lang <> 'en'")
def anti_join_add(spark, sf):
    c = _keyed_chunks(spark, sf)
    return joins.add_new(c, c.where("lang = 'en'"), "chunk_id").select("doc_id", "chunk_idx", "chunk_id")


@query("a09_incremental_add", f"SELECT lang AS collection, count(*) AS n_chunks, count(DISTINCT chunk_id) AS n_ids FROM ({_CHUNK_KEY_SQL}) GROUP BY lang")
def incremental_add(spark, sf):
    """Index the English chunks, then all chunks twice: every chunk is there exactly once."""
    path = scratch_path(spark, "index")
    c = _keyed_chunks(spark, sf).withColumnRenamed("lang", "collection")
    index.add_documents(c.where("collection = 'en'"), path)
    index.add_documents(c, path)
    out = index.add_documents(c, path)
    # two steps: distinct ids are counted after a map-side distinct on (collection, id)
    per_id = out.groupBy("collection", "chunk_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy("collection").agg(F.sum("n").alias("n_chunks"), F.count(F.lit(1)).alias("n_ids"))
