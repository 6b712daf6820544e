"""Catalogue: embedding, search, context, grading."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions import inference as I
from loomtext.operators import cells, chunking, context, graph, retrieval, stats
from loomtext.plans import rag
from loomtext.plans.catalog import query, table
from loomtext.plans.queries_text import CLEAN_SQL, WINDOWS_512
from loomtext.session import scratch_path
from loomtext.sources import index

TOPICS = ["the", "and"]
GRADE, GROUNDED, USEFUL = 0.45, 0.5, 0.3

# ---------------------------------------------------------------- reference SQL building blocks


def vec_sql(name: str, src: str, key: str, text: str) -> str:
    """CTEs for the stand-in encoder: `{name}_vec(id, b, w)`."""
    return rf"""
{name}_tok AS (SELECT {key} AS id, unnest(regexp_extract_all(lower({text}), '[^ \t\n\r\f\v]+')) AS tok FROM {src}),
{name}_cnt AS (SELECT id, ('0x' || substr(md5(tok), 1, 6))::INT % 64 AS b, count(*) AS c FROM {name}_tok GROUP BY ALL),
{name}_vec AS (SELECT id, b, c / sqrt(sum(c * c) OVER (PARTITION BY id)) AS w FROM {name}_cnt)"""


def rank_sql(name: str, q: str, c: str, k: int) -> str:
    """CTE `{name}(question_id, chunk_id, rank)`: k nearest by squared distance of unit vectors."""
    return f"""
{name} AS (SELECT question_id, chunk_id, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY d, chunk_id) AS rank FROM (
    SELECT q.id AS question_id, c.id AS chunk_id, round(greatest(0, 2 - 2 * sum(q.w * c.w)), 9) AS d
    FROM {q}_vec q JOIN {c}_vec c USING (b) GROUP BY ALL)) WHERE rank <= {k})"""


def hits_sql(k: int, name: str = "hits") -> str:
    return f"""{rank_sql('r_' + name, 'q', 'c', k)},
{name} AS (SELECT question_id, question, chunk_id, rank, corpus.text, source
  FROM r_{name} JOIN corpus USING (chunk_id) JOIN questions USING (question_id))"""


BASE_SQL = f"""WITH corpus AS (SELECT doc_id * 1000000 + chunk_idx AS chunk_id, chunk AS text, source FROM ({WINDOWS_512})),
questions AS (SELECT item_id AS question_id, text AS question FROM benchmark),
{vec_sql('c', 'corpus', 'chunk_id', 'text')}, {vec_sql('q', 'questions', 'question_id', 'question')}"""

#: The same with the chunks of one language only.
FRENCH_SQL = BASE_SQL.replace(f"FROM ({WINDOWS_512})", f"FROM ({WINDOWS_512}) WHERE lang = 'fr'")

#: The second corpus: cleaned pages; `fb(question_id, fallback_text)` holds the top 3 per question.
FALLBACK_SQL = f"""
pg AS (SELECT page_id, {CLEAN_SQL.format(c='html')} AS text FROM pages), {vec_sql('p', 'pg', 'page_id', 'text')},
{rank_sql('r_fb', 'q', 'p', 3)},
fb AS (SELECT question_id, string_agg(pg.text, chr(10) ORDER BY rank) AS fallback_text FROM r_fb JOIN pg ON chunk_id = page_id GROUP BY question_id)"""


def vocab_sql(c: str) -> str:
    return rf"list_distinct(regexp_extract_all(lower({c}), '\S+'))"


def overlap_sql(a: str, b: str) -> str:
    return f"coalesce(len(list_intersect({vocab_sql(a)}, {vocab_sql(b)}))::DOUBLE / nullif(len({vocab_sql(a)}), 0), 0)"


def questions(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))


#: Stored corpora of this session: (application, data, name) -> path. The given tables do not change.
_STORES: dict[tuple[str, str, str], str] = {}


def stored_corpus(spark, sf, name, corpus):
    """A corpus with its vectors, written once in a session and then searched by every query."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORES:
        path = scratch_path(spark, f"corpus-{name}")
        rag.embed(corpus, "text").write.parquet(path)
        _STORES[key] = path
    return spark.read.parquet(_STORES[key])


def chunk_corpus(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", "text")
    c = chunking.window_chunks(d, 512, 50)
    c = c.select((F.col("doc_id") * 1000000 + F.col("chunk_idx")).alias("chunk_id"), F.col("chunk").alias("text"), "source")
    return stored_corpus(spark, sf, "chunks", c)


def page_corpus(spark, sf):
    from loomtext.functions import text as X
    p = table(spark, sf, "pages").select(
        F.col("page_id").alias("chunk_id"), X.clean_markup(F.col("html")).alias("text"), F.lit(None).cast("string").alias("source"))
    return stored_corpus(spark, sf, "pages", p)


def hits(spark, sf, k=8):
    return rag.retrieve(questions(spark, sf), chunk_corpus(spark, sf), k)


# ---------------------------------------------------------------- vectors (E1-E4, F6)


@query("e01_embed_documents", f"WITH {vec_sql('d', 'documents', 'doc_id', 'text')} SELECT id AS doc_id, b AS bucket, round(w, 6) AS weight FROM d_vec")
def embed_documents(spark, sf):
    e = rag.embed(table(spark, sf, "documents").select("doc_id", "text"), "text")
    v = e.select("doc_id", F.posexplode("embedding").alias("bucket", "w")).where("w <> 0")
    return v.select("doc_id", "bucket", F.round("w", 6).alias("weight"))


_ALL_PAIRS = """FROM embeddings q, embeddings c"""
_L2 = "round(pow(list_distance(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 2), 9)"
_COS = "round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 9)"


def _topk_sql(k: int, score: str, name: str, direction: str = "") -> str:
    return f"""SELECT query_id, chunk_id, rank, round({name}, 6) AS {name} FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {name} {direction}, chunk_id) AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id AS chunk_id, {score} AS {name} {_ALL_PAIRS})) WHERE rank <= {k}"""


def _vectors(spark, sf):
    """Every vector is a question against the whole table."""
    e = table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("query_id"), "embedding"), e.select(F.col("vec_id").alias("chunk_id"), "embedding")


@query("e02_topk_l2", _topk_sql(8, _L2, "distance"))
def topk_l2(spark, sf):
    q, c = _vectors(spark, sf)
    return retrieval.topk(q, c, 8).withColumn("distance", F.round("distance", 6))


@query("f06_topk_blocks", _topk_sql(3, _L2, "distance"))
def topk_blocks(spark, sf):
    """The shuffle way, forced and with small blocks."""
    q, c = _vectors(spark, sf)
    found = retrieval.topk(q, c, 3, max_broadcast=0, question_block=1024, corpus_block=1024)
    return found.withColumn("distance", F.round("distance", 6))


@query("e03_topk_cosine", _topk_sql(10, _COS, "similarity", "DESC"))
def topk_cosine(spark, sf):
    q, c = _vectors(spark, sf)
    return retrieval.topk(q, c, 10, metric="cosine").withColumn("similarity", F.round("similarity", 6))


_CODES_SQL = """planes AS (SELECT p, list(CASE WHEN substr(md5(p || ':' || d), 1, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ORDER BY d) AS s
  FROM range(4) t(p), range(64) u(d) GROUP BY p),
codes AS (SELECT vec_id, any_value(embedding::DOUBLE[]) AS v,
  sum(CASE WHEN list_inner_product(embedding::DOUBLE[], s) >= 0 THEN 1 << p::INT ELSE 0 END)::INT AS code
  FROM embeddings, planes GROUP BY vec_id)"""
_NEAR_SQL = f"""WITH {_CODES_SQL}, near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) AS rank FROM (
  SELECT q.vec_id AS query_id, c.vec_id AS chunk_id, round(pow(list_distance(q.v, c.v), 2), 9) AS distance
  FROM codes q JOIN codes c ON bit_count(xor(q.code, c.code)) <= 1))"""


@query("e04_topk_approx", f"{_NEAR_SQL} SELECT query_id, chunk_id, rank, round(distance, 6) AS distance FROM near WHERE rank <= 8")
def topk_approx(spark, sf):
    q, c = _vectors(spark, sf)
    return retrieval.topk_approx(q, c, 8, bits=4, radius=1).withColumn("distance", F.round("distance", 6))


@query("e04_code_recall", f"""{_NEAR_SQL}, truth AS ({_topk_sql(8, _L2, "distance")})
SELECT count(*) AS n_true, count(n.rank) AS n_found, count(n.rank) / count(*) AS recall
FROM truth LEFT JOIN (SELECT * FROM near WHERE rank <= 8) n USING (query_id, chunk_id)""")
def code_recall(spark, sf):
    """What the few codes of `e04_topk_approx` find: the reason why an index should be stored instead."""
    q, c = _vectors(spark, sf)
    found = retrieval.topk_approx(q, c, 8, bits=4, radius=1)
    return retrieval.recall(found, retrieval.topk(q, c, 8), "query_id", "chunk_id")


def _cells(spark, c):
    return cells.build(c, scratch_path(spark, "cells"))


@query("e04_index_search", _topk_sql(8, _L2, "distance"))
def index_search(spark, sf):
    """Write the inverted file and search it until the triangle inequality proves the k-th hit."""
    q, c = _vectors(spark, sf)
    return cells.search(q, _cells(spark, c), 8).withColumn("distance", F.round("distance", 6))


@query("e04_recall", f"""{_NEAR_SQL}, truth AS ({_topk_sql(8, _L2, "distance")})
SELECT count(*) AS n_true, count(n.rank) AS n_found, count(n.rank) / count(*) AS recall,
  count(DISTINCT query_id) AS n_questions, count(DISTINCT query_id) AS n_full, true AS reached
FROM truth LEFT JOIN (SELECT * FROM near WHERE rank <= 8) n USING (query_id, chunk_id)""")
def approx_recall(spark, sf):
    """Both approximate ways against the true neighbours: what the few codes find, and whether the calibrated probes
    of the stored index have rows for every question and a recall of 0.9 or more."""
    q, c = _vectors(spark, sf)
    pair = ["query_id", "chunk_id"]
    truth = retrieval.topk(q, c, 8).select(*pair, F.lit(1).alias("t"))
    probed = cells.search(q, _cells(spark, c), 8, recall=0.9).select(*pair, F.lit(1).alias("f"))
    coded = retrieval.topk_approx(q, c, 8, bits=4, radius=1).select(*pair, F.lit(1).alias("c"))
    both = truth.join(probed, pair, "full").join(coded, pair, "full")
    hit = lambda x: F.count(F.when(F.col("t") == F.col(x), 1))
    each = both.groupBy("query_id").agg(F.count("t").alias("t"), F.count("f").alias("f"), hit("f").alias("hit"), hit("c").alias("n"))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0))
    return each.agg(total("t").alias("n_true"), total("n").alias("n_found"), (F.sum("n") / F.sum("t")).alias("recall"),
                    F.count(F.lit(1)).alias("n_questions"), F.count(F.when(F.col("f") == F.col("t"), 1)).alias("n_full"),
                    (total("hit") >= 0.9 * total("t")).alias("reached"))


# ---------------------------------------------------------------- context (E5-E8, B19)


def _layouts(h):
    items = F.array_sort(F.collect_list(F.struct("rank", "text", "source")))
    g = h.groupBy("question_id").agg(items.alias("items"))
    return g.select("question_id", *[F.md5(context.layout_context(F.col("items"), x)).alias(x) for x in context.LAYOUTS])


@query("e05_context_layouts", f"""{BASE_SQL}, {hits_sql(8)}
SELECT question_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY rank)) AS joined,
  md5(string_agg(chr(10) || chr(10) || 'Chunk Content: ' || text || chr(10) || 'Metadata: ' || '{{"source":"' || source || '"}}' || chr(10), '' ORDER BY rank)) AS blocks,
  md5(string_agg(text, '' ORDER BY rank)) AS bare, md5(string_agg(chr(10) || chr(10) || text, '' ORDER BY rank)) AS "leading"
FROM hits GROUP BY question_id""")
def context_layouts(spark, sf):
    return _layouts(hits(spark, sf))


@query("e06_source_report", f"""{BASE_SQL}, {hits_sql(8)},
f AS (SELECT question_id, source, min(rank) AS r FROM hits GROUP BY ALL)
SELECT question_id, sources, n_sources, n_docs, cited FROM (
  SELECT question_id, array_to_string(list(source ORDER BY rank), ',') AS sources, count(*) AS n_sources, count(*) AS n_docs FROM hits GROUP BY question_id)
JOIN (SELECT question_id, array_to_string(list(source ORDER BY r)[1:3], ',') AS cited FROM f GROUP BY question_id) USING (question_id)""")
def source_report(spark, sf):
    r = context.source_report(hits(spark, sf), ["question_id"])
    return r.withColumn("sources", F.array_join("sources", ",")).withColumn("cited", F.array_join("cited", ","))


@query("b19_cited_sources", f"""{BASE_SQL}, {hits_sql(8)}, f AS (SELECT question_id, source, min(rank) AS r FROM hits GROUP BY ALL)
SELECT question_id, unnest(list(source ORDER BY r)[1:3]) AS source FROM f GROUP BY question_id""")
def cited_sources(spark, sf):
    r = context.source_report(hits(spark, sf), ["question_id"])
    return r.select("question_id", F.explode("cited").alias("source"))


@query("e07_rag_inputs", f"""{BASE_SQL}, {hits_sql(8)},
ctx AS (SELECT question_id, question, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context, count(*) AS n_docs FROM hits GROUP BY ALL)
SELECT question_id, n_docs, md5(context) AS context_md5, md5('Answer only from the context.' || chr(10) || 'Question: ' || question || chr(10)
  || 'Context: ' || context || chr(10) || 'Answer:') AS prompt_md5 FROM ctx""")
def rag_inputs(spark, sf):
    p = rag.rag_inputs(questions(spark, sf), chunk_corpus(spark, sf), 8)
    return p.select("question_id", "n_docs", F.md5("context").alias("context_md5"), F.md5("prompt").alias("prompt_md5"))


@query("e08_code_context", f"""{BASE_SQL}, {hits_sql(3)},
e AS (SELECT DISTINCT src, dst FROM (SELECT url AS src, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS dst FROM pages)),
n AS (SELECT src AS file, dst AS x FROM e UNION SELECT dst, src FROM e),
r AS (SELECT *, (row_number() OVER (PARTITION BY file ORDER BY x) - 1) // 64 AS page FROM n),
pp AS (SELECT file, page, string_agg(x, ', ' ORDER BY x) AS t FROM r GROUP BY file, page)
SELECT question_id, 0 AS part, rank AS piece, 'File: ' || source || chr(10) || 'Content:' || chr(10) || substr(text, 1, 500) || '...' || chr(10) || chr(10) AS text FROM hits
UNION ALL
SELECT item_id, 1, page, 'Current File: ' || file || ' is connected to: ' || t || chr(10) FROM benchmark JOIN pages ON item_id = page_id JOIN pp ON file = url""")
def code_context(spark, sf):
    files = table(spark, sf, "pages").select(F.col("page_id").alias("question_id"), F.col("url").alias("file"))
    current = questions(spark, sf).select("question_id").join(files, "question_id")
    pages = graph.neighbour_pages(graph.link_edges(table(spark, sf, "pages"), F.col("url")))
    return context.code_context(hits(spark, sf, 3), pages, current, "question_id")


# ---------------------------------------------------------------- grading (C9, G3) and index (A8, A10)

GRADED_SQL = f"graded AS (SELECT *, {overlap_sql('question', 'text')} >= {GRADE} AS relevant FROM hits)"


def graded(spark, sf):
    return rag.grade(hits(spark, sf), I.overlap_scorer(GRADE))


@query("c09_relevant_chunks", f"{BASE_SQL}, {hits_sql(8)}, {GRADED_SQL} SELECT question_id, chunk_id, rank, md5(text) AS text_md5 FROM graded WHERE relevant")
def relevant_chunks(spark, sf):
    return graded(spark, sf).where("relevant").select("question_id", "chunk_id", "rank", F.md5("text").alias("text_md5"))


@query("g03_irrelevant_flag", f"""{BASE_SQL}, {hits_sql(8)}, {GRADED_SQL}
SELECT question_id, count(*) AS n_graded, count(*) FILTER (relevant) AS n_relevant, bool_or(NOT relevant) AS any_irrelevant FROM graded GROUP BY question_id""")
def irrelevant_flag(spark, sf):
    return stats.irrelevant_flag(graded(spark, sf), "question_id", F.col("relevant"))


@query("a08_index_build", f"""WITH c AS (SELECT doc_id * 1000000 + chunk_idx AS chunk_id, chunk AS text, lang FROM ({WINDOWS_512})), {vec_sql('c', 'c', 'chunk_id', 'text')}
SELECT chunk_id, lang AS collection, md5(text) AS text_md5, n_buckets FROM c JOIN (SELECT id, count(*) AS n_buckets FROM c_vec GROUP BY id) ON id = chunk_id""")
def index_build(spark, sf):
    return _read_index(spark, _index(spark, sf))


@query("a10_open_collection", f"""WITH c AS (SELECT doc_id * 1000000 + chunk_idx AS chunk_id, chunk AS text, lang FROM ({WINDOWS_512}) WHERE lang = 'fr'), {vec_sql('c', 'c', 'chunk_id', 'text')}
SELECT chunk_id, lang AS collection, md5(text) AS text_md5, n_buckets FROM c JOIN (SELECT id, count(*) AS n_buckets FROM c_vec GROUP BY id) ON id = chunk_id""")
def open_collection(spark, sf):
    return _read_index(spark, _index(spark, sf), "fr")


@query("a10_search_collection", f"""{FRENCH_SQL}, {hits_sql(8)}
SELECT question_id, count(*) AS n_docs, md5(string_agg(text, chr(10) || chr(10) ORDER BY rank)) AS context_md5 FROM hits GROUP BY question_id""")
def search_collection(spark, sf):
    """Write, open, search: only the stored vectors and texts of one collection are read."""
    found = rag.retrieve(questions(spark, sf), index.open_collection(spark, _index(spark, sf), "fr"), 8)
    return context.assemble(found, ["question_id"]).select("question_id", "n_docs", F.md5("context").alias("context_md5"))


def _index(spark, sf) -> str:
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("collection"), "source", "text")
    c = chunking.window_chunks(d, 512, 50)
    c = c.select((F.col("doc_id") * 1000000 + F.col("chunk_idx")).alias("chunk_id"), "collection", "source", F.col("chunk").alias("text"))
    path = scratch_path(spark, "index")
    index.write_collection(rag.embed(c, "text"), path)
    return path


def _read_index(spark, path, collection=None):
    c = spark.read.parquet(path) if collection is None else index.open_collection(spark, path, collection)
    return c.select("chunk_id", "collection", F.md5("text").alias("text_md5"),
                    F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("n_buckets"))
