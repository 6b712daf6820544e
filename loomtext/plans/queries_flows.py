"""Catalogue: routing, fallback, bounded loops, ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions import inference as I
from loomtext.plans import ingest, rag, revise
from loomtext.plans.catalog import query, table
from loomtext.plans.split_sql import chunks_sql
from loomtext.plans.queries_retrieval import (
    BASE_SQL, FALLBACK_SQL, GRADE, GRADED_SQL, GROUNDED, TOPICS, USEFUL, chunk_corpus, graded, hits_sql,
    overlap_sql, page_corpus, questions, vocab_sql,
)
from loomtext.session import scratch_path

_ROUTE_SQL = f"CASE WHEN list_has_any({vocab_sql('question')}, {TOPICS!r}) THEN 'vectorstore' ELSE 'websearch' END"


@query("k01_question_router", f"SELECT question_id, {_ROUTE_SQL} AS route FROM (SELECT item_id AS question_id, text AS question FROM benchmark)")
def question_router(spark, sf):
    return rag.route(questions(spark, sf), I.topic_router(TOPICS)).select("question_id", "route")


@query("k01_document_router", f"SELECT doc_id AS question_id, {_ROUTE_SQL} AS route FROM (SELECT doc_id, text AS question FROM documents)")
def document_router(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("question_id"), F.col("text").alias("question"))
    return rag.route(d, I.topic_router(TOPICS)).select("question_id", "route")


@query("j02_fallback_documents", f"{BASE_SQL}, {FALLBACK_SQL} SELECT question_id, md5(fallback_text) AS text_md5 FROM fb")
def fallback_documents(spark, sf):
    f = rag.fallback_documents(questions(spark, sf), page_corpus(spark, sf), 3)
    return f.select("question_id", F.md5("fallback_text").alias("text_md5"))


@query("k02_grade_and_fallback", f"""{BASE_SQL}, {hits_sql(8)}, {GRADED_SQL}, {FALLBACK_SQL},
flagged AS (SELECT question_id, max(rank) + 1 AS rank FROM graded GROUP BY question_id HAVING bool_or(NOT relevant))
SELECT question_id, rank, source, md5(text) AS text_md5 FROM graded WHERE relevant
UNION ALL SELECT question_id, rank, NULL, md5(fallback_text) FROM flagged JOIN fb USING (question_id)""")
def grade_and_fallback(spark, sf):
    docs = rag.with_fallback(graded(spark, sf), questions(spark, sf), page_corpus(spark, sf))
    return docs.select("question_id", "rank", "source", F.md5("text").alias("text_md5"))


def _loop_sql(start: str) -> str:
    """The three passes unrolled; `start` is a CTE (question_id, question, docs, fallback_text)."""
    parts, prev = [], start
    first3 = r"regexp_replace(array_to_string(regexp_extract_all(docs[least({a}, len(docs))::INT], '[^.]+[.]')[1:3], ''), '^\s+|\s+$', '', 'g')"
    for a in (1, 2, 3):
        parts.append(f"""
gen{a} AS (SELECT *, CASE WHEN len(docs) = 0 THEN '' ELSE {first3.format(a=a)} END AS generation,
  array_to_string(docs, chr(10) || chr(10)) AS facts FROM {prev}),
gr{a} AS (SELECT *, {overlap_sql('generation', 'facts')} >= {GROUNDED} AS g, {overlap_sql('question', 'generation')} >= {USEFUL} AS u FROM gen{a}),
out{a} AS (SELECT *, CASE WHEN g AND u THEN 'useful' WHEN {a} = 3 THEN 'max retries' WHEN g THEN 'not useful' ELSE 'not supported' END AS outcome FROM gr{a}),
st{a} AS (SELECT question_id, question, CASE WHEN outcome = 'not useful' AND fallback_text IS NOT NULL THEN list_append(docs, fallback_text) ELSE docs END AS docs,
  fallback_text FROM out{a} WHERE outcome NOT IN ('useful', 'max retries'))""")
        prev = f"st{a}"
    return ",".join(parts)


_LOOP_OUT = " UNION ALL ".join(
    f"SELECT question_id, {a} AS attempts, outcome, md5(generation) AS generation_md5 FROM out{a} WHERE outcome IN ('useful', 'max retries')"
    for a in (1, 2, 3))


@query("k03_answer_loop", f"""{BASE_SQL}, {hits_sql(3)}, {FALLBACK_SQL},
d AS (SELECT question_id, list(text ORDER BY rank) AS docs FROM hits GROUP BY question_id),
st0 AS (SELECT question_id, question, coalesce(docs, []) AS docs, fallback_text FROM questions LEFT JOIN d USING (question_id) LEFT JOIN fb USING (question_id)),
{_loop_sql('st0')} {_LOOP_OUT}""")
def answer_loop(spark, sf):
    q = questions(spark, sf)
    docs = rag.retrieve(q, chunk_corpus(spark, sf), 3).select("question_id", "rank", "text", "source")
    state = rag.loop_state(q, docs, rag.fallback_documents(q, page_corpus(spark, sf), 3))
    out = rag.answer_loop(state, I.overlap_scorer(GROUNDED), I.overlap_scorer(USEFUL))
    return out.select("question_id", "attempts", "outcome", F.md5("generation").alias("generation_md5"))


@query("k05_corrective_answers", f"""{BASE_SQL}, {hits_sql(8)}, {GRADED_SQL}, {FALLBACK_SQL},
rt AS (SELECT *, {_ROUTE_SQL} AS route FROM questions),
flagged AS (SELECT question_id FROM graded GROUP BY question_id HAVING bool_or(NOT relevant)),
docs0 AS (SELECT question_id, rank, text FROM graded JOIN rt USING (question_id) WHERE relevant AND route = 'vectorstore'
  UNION ALL SELECT question_id, 9, fallback_text FROM fb JOIN rt USING (question_id)
  WHERE route = 'websearch' OR question_id IN (SELECT question_id FROM flagged)),
d AS (SELECT question_id, list(text ORDER BY rank) AS docs FROM docs0 GROUP BY question_id),
st0 AS (SELECT question_id, question, coalesce(docs, []) AS docs, fallback_text FROM rt LEFT JOIN d USING (question_id) LEFT JOIN fb USING (question_id)),
{_loop_sql('st0')}, res AS ({_LOOP_OUT})
SELECT res.*, route FROM res JOIN rt USING (question_id)""")
def corrective_answers(spark, sf):
    out = rag.corrective_answers(
        questions(spark, sf), chunk_corpus(spark, sf), page_corpus(spark, sf), router=I.topic_router(TOPICS),
        grader=I.overlap_scorer(GRADE), grounded=I.overlap_scorer(GROUNDED), useful=I.overlap_scorer(USEFUL))
    return out.select("question_id", "route", "attempts", "outcome", F.md5("generation").alias("generation_md5"))


# ---------------------------------------------------------------- critic and revise (K4)

_TERMS = ["the ", "en", "die", "qu", "ar"]


def _critic(draft):
    out = F.when(F.contains(draft, F.lit(_TERMS[0])), F.lit("drop " + _TERMS[0]))
    for t in _TERMS[1:]:
        out = out.when(F.contains(draft, F.lit(t)), F.lit("drop " + t))
    return out


def _reviser(draft, feedback):
    return F.replace(draft, F.substring(feedback, 6, 100), F.lit(""))


_CRITIC_SQL = "CASE " + " ".join(f"WHEN contains(draft, '{t}') THEN 'drop {t}'" for t in _TERMS) + " END"
_REVISE_SQL = "replace(draft, substr({f}, 6, 100), '')"


def _rounds_sql(name: str, start: str, first: int) -> str:
    parts, prev, done = [], start, []
    for i in range(first, 4):
        parts.append(f"{name}j{i} AS (SELECT *, {_CRITIC_SQL} AS feedback FROM {prev})")
        parts.append(f"""{name}s{i} AS (SELECT doc_id, {_REVISE_SQL.format(f='feedback')} AS draft, human, attempts + 1 AS attempts,
  revisions + 1 AS revisions FROM {name}j{i} WHERE NOT (feedback IS NULL OR attempts >= 3))""")
        done.append(f"SELECT * FROM {name}j{i} WHERE feedback IS NULL OR attempts >= 3")
        prev = f"{name}s{i}"
    parts.append(f"{name} AS ({' UNION ALL '.join(done)})")
    return ", ".join(parts)


@query("k04_revise_loop", f"""
WITH a0 AS (SELECT doc_id, text AS draft, CASE WHEN doc_id % 3 = 1 THEN 'drop a' END AS human, 1 AS attempts, 0 AS revisions FROM documents),
{_rounds_sql('a', 'a0', 1)},
b0 AS (SELECT doc_id, {_REVISE_SQL.format(f='human')} AS draft, human, 0 AS attempts, revisions + 1 AS revisions FROM a WHERE human IS NOT NULL),
{_rounds_sql('b', 'b0', 0)}
SELECT doc_id, md5(draft) AS draft_md5, attempts, revisions AS total_revisions, feedback IS NULL AS satisfied FROM a WHERE human IS NULL
UNION ALL SELECT doc_id, md5(draft), attempts, revisions, feedback IS NULL FROM b""")
def revise_loop(spark, sf):
    rest = F.col("doc_id") % 3
    human = F.when(rest == 0, "approved").when(rest == 1, "drop a")
    d = table(spark, sf, "documents").select("doc_id", F.col("text").alias("draft"), human.alias("review"))
    out = revise.revise_loop(d, _critic, _reviser, human="review")
    return out.select("doc_id", F.md5("draft").alias("draft_md5"), "attempts", "total_revisions", "satisfied")


# ---------------------------------------------------------------- ingest (K8)


@query("k08_ingest_coverage", r"""
SELECT lang AS collection, doc_id, md5(regexp_replace(text, '\s', '', 'g')) AS solid_md5,
       (SELECT count(*) FROM documents) AS documents_seen, true AS all_written FROM documents""")
def ingest_coverage(spark, sf):
    """Chunks without overlap, read back from the index, rebuild every text."""
    path = scratch_path(spark, "ingest")
    d = table(spark, sf, "documents").select("doc_id", F.col("doc_id").cast("string").alias("source"), "text", F.col("lang").alias("collection"))
    counts = ingest.ingest(d, path, overlap=0)
    made = spark.read.parquet(path)
    parts = F.array_sort(F.collect_list(F.struct("chunk_idx", F.regexp_replace("chunk", r"\s", "").alias("t"))))
    solid = F.md5(F.array_join(F.transform(parts, lambda p: p["t"]), ""))
    return made.groupBy("collection", "doc_id").agg(solid.alias("solid_md5")).select(
        "*", F.lit(counts["documents"]).alias("documents_seen"), F.lit(counts["chunks"] == made.count()).alias("all_written"))


@query("k08_corpus_ingest", f"""
SELECT lang AS collection, count(*) AS n_chunks, max(length(chunk)) AS max_chars, (SELECT count(*) FROM documents) AS documents_seen,
  sum(count(*)) OVER ()::BIGINT AS chunks_seen
FROM ({chunks_sql("SELECT doc_id, 'text' AS language, text FROM documents", 2048, 200)}) JOIN documents USING (doc_id) GROUP BY lang""")
def corpus_ingest(spark, sf):
    """Chunks per collection, next to the counts observed while writing."""
    path = scratch_path(spark, "ingest")
    d = table(spark, sf, "documents").select("source", "text", F.col("lang").alias("collection"))
    counts = ingest.ingest(d, path)
    out = spark.read.parquet(path).groupBy("collection").agg(F.count(F.lit(1)).alias("n_chunks"), F.max(F.length("chunk")).alias("max_chars"))
    return out.withColumn("documents_seen", F.lit(counts["documents"])).withColumn("chunks_seen", F.lit(counts["chunks"]))
