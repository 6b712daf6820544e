"""Queries of this subpackage over the whole tables, and their reference SQL."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext import session
from loomtext.llm import bestpos, cgk, linechunks, maxent, mixing, nbsvm, ppm, runs, setsketch, tokenfile, toolcalls, vamana, warc
from loomtext.llm.common import fold, table

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
MIN_SCORE = 0.7


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5) == 1)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_warc(table(spark, sf_dir, "pages"), session.scratch_path(spark, "warc"))
    number = lambda c: F.when(F.col(c) != "null", F.col(c).cast("long")).alias(c)
    records = warc.read_warc(spark, files).withColumnRenamed("record_id", "page_id")
    return records.select(number("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"))


def learned_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> nbsvm.Model:
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 4) != 2)
    return nbsvm.fit(docs, labels)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = nbsvm.score(docs, learned_model(spark, docs, sf_dir))
    return scored.select(F.col("_row.doc_id").alias("doc_id"), (fold(F.col("_row.doc_id"), 4) == 2).alias("held_out"), "score",
                         F.when(F.col("score") >= MIN_SCORE, 1).otherwise(0).alias("predicted"))


# Tool calls derived from the conversations: every user turn is a call that depends on the one before
# it, and every other answer is the result of the turn before. Lengths decide the tool and the defects.
TOOLS = [("search", "limit", "integer", True), ("search", "query", "string", True), ("search", "exact", "boolean", False),
         ("summarize", "query", "string", True), ("summarize", "limit", "integer", False)]


def op4_chat_tool_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    chat = table(spark, sf_dir, "conversations")
    call_id = lambda turn: F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    n = F.length("text")
    name = F.when(n % 11 == 0, "translate").when(n % 2 == 0, "search").otherwise("summarize")
    args = F.to_json(F.struct(
        F.when(n % 7 != 0, F.col("text")).alias("query"), F.when(n % 5 != 0, n % 50).alias("limit"),
        F.when(n % 3 == 0, n % 2 == 0).alias("exact"), F.when(n % 13 == 0, n).alias("depth")))
    calls = chat.where("role = 'user'").select(
        "conv_id", call_id(F.col("turn")).alias("call_id"), "turn", name.alias("name"), args.alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(call_id(F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("depends_on"))
    results = chat.where("role = 'assistant'").select(
        "conv_id", call_id(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    schemas = spark.createDataFrame(TOOLS, "name string, field string, type string, required boolean")
    return toolcalls.link(calls, results, schemas)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = setsketch.near_duplicates(table(spark, sf_dir, "documents"), 85, 100)
    return near.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    manifest = tokenfile.write_token_files(table(spark, sf_dir, "documents"), session.scratch_path(spark, "tokens"), path, END_ID)
    return tokenfile.read_token_files(spark, manifest, tokenfile.encoder(path).dtype)


def op7_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vamana.search(vamana.build_index(vectors), vectors.where("vec_id % 20 = 0"), 20)


def op8_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linechunks.remove_repeated(table(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("_doc.doc_id", "_doc.source", "_doc.text", F.col("_copy").alias("copy"),
                        F.col("_copies").alias("copies"), F.col("_order").alias("shuffle_key"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cgk.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_best_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestpos.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def periodic(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of the query's contract: those of every tenth document (by hash) repeat from some word on."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(table(spark, sf_dir, "documents"), ["doc_id"], rewrite=periodic, rewrite_by="doc_id")
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select(
        "_row.doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    guessed = ppm.predict(docs, ppm.fit(docs.where(~held_out)), ["doc_id"])
    return guessed.select("_row.doc_id", (fold(F.col("_row.doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_lm_scoring, op2_warc, op3_quality_classifier, op4_chat_tool_linking, op5_minhash_near_dedup, op6_token_files,
        op7_ann_search, op8_line_chunk_dedup, op9_source_mixing, op10_decontamination,
        op11_best_positions, op12_periodic_runs, op13_ppm_language, pipeline)
}

WARC_SQL = """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
  (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', d + 1, 1), '' ORDER BY k) FROM (
    SELECT k, list_reduce(list_transform(range(5), lambda j: ((('0x' || substr(s, (k * 5 + j)::INT // 4 + 1, 1))::INT >> (3 - (k * 5 + j) % 4)::INT) & 1)),
      lambda a, b: a * 2 + b) AS d FROM (SELECT unnest(range(32)) AS k))) AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM (SELECT page_id, html, sha1(coalesce(html, '')) AS s, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
"""

MIX_SQL = f"""
WITH sizes AS (SELECT source, sum(length(coalesce(text, '')) + 1)::DOUBLE AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM sizes)::DOUBLE * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes
), cdf AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM (
    SELECT source, k, exp(-rate + k * ln(rate) - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: ln(j))), 0)) AS p
    FROM rates, (SELECT unnest(range({mixing.STEPS + 1})) AS k))
), drawn AS (
  SELECT d.doc_id, d.source, d.text, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source
    AND cdf.c <= ('0x' || substr(md5('mix:1:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / {float(1 << 52)!r}::DOUBLE) AS copies
  FROM documents d
)
SELECT doc_id, source, text, copy::INT AS copy, copies::INT AS copies,
  ('0x' || substr(md5('mix:order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy), 1, 15))::BIGINT AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM drawn)
"""

CALLS_SQL = """
WITH RECURSIVE calls AS (
  SELECT conv_id, 'call-' || conv_id || '-' || turn AS call_id, turn, length(text) AS n, text,
    CASE WHEN length(text) % 11 = 0 THEN 'translate' WHEN length(text) % 2 = 0 THEN 'search' ELSE 'summarize' END AS name,
    CASE WHEN turn >= 2 THEN 'call-' || conv_id || '-' || (turn - 2) END AS need
  FROM conversations WHERE role = 'user'
), levels AS (
  SELECT conv_id, call_id, 0 AS level FROM calls c
  WHERE need IS NULL OR NOT EXISTS (SELECT 1 FROM calls d WHERE d.conv_id = c.conv_id AND d.call_id = c.need)
  UNION ALL SELECT c.conv_id, c.call_id, l.level + 1 FROM calls c JOIN levels l ON l.conv_id = c.conv_id AND l.call_id = c.need
), results AS (
  SELECT conv_id, 'call-' || conv_id || '-' || (turn - 1) AS call_id, turn, text AS content FROM conversations WHERE role = 'assistant'
), checked AS (
  SELECT c.*, l.level, r.content, CASE WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
    list_concat(
      CASE WHEN name = 'translate' THEN ['unknown tool'] ELSE list_sort(list_filter([
        CASE WHEN n % 7 = 0 THEN 'missing:query' END,
        CASE WHEN n % 5 = 0 AND name = 'search' THEN 'missing:limit' END,
        CASE WHEN n % 3 = 0 AND name = 'summarize' THEN 'unknown:exact' END,
        CASE WHEN n % 13 = 0 THEN 'unknown:depth' END], lambda x: x IS NOT NULL)) END,
      CASE WHEN need IS NOT NULL AND NOT EXISTS (SELECT 1 FROM calls d WHERE d.conv_id = c.conv_id AND d.call_id = c.need)
        THEN ['no call:' || need] ELSE [] END) AS errors,
    '{' || array_to_string(list_filter([
      CASE WHEN n % 13 = 0 THEN '"depth":' || n END, CASE WHEN n % 3 = 0 THEN '"exact":' || (n % 2 = 0)::VARCHAR END,
      CASE WHEN n % 5 <> 0 THEN '"limit":' || (n % 50) END, CASE WHEN n % 7 <> 0 THEN '"query":' || to_json(text) END],
      lambda x: x IS NOT NULL), ',') || '}' AS args
  FROM calls c JOIN levels l USING (conv_id, call_id) LEFT JOIN results r USING (conv_id, call_id)
)
SELECT conv_id, call_id, turn, name, status, level, errors, 1 AS n_rows,
  '{"arguments":' || args || ',"depends_on":' || CASE WHEN need IS NULL THEN '[]' ELSE '["' || need || '"]' END
  || ',"errors":' || to_json(errors) || ',"id":"' || call_id || '","level":' || level || ',"name":"' || name
  || '","result":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"status":"' || status || '"}' AS message
FROM checked
UNION ALL
SELECT conv_id, call_id, turn, NULL, 'orphan_result', NULL, []::VARCHAR[], 1,
  '{"id":"' || call_id || '","result":' || to_json(content) || ',"status":"orphan_result"}'
FROM results r WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = r.conv_id AND c.call_id = r.call_id)
"""

TERMS_SQL = r"unnest(regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'))"

RANK_SQL = f"""
WITH tf AS (
  SELECT row_id, doc_id, term, count(*)::BIGINT AS tf FROM (
    SELECT row_id, doc_id, {TERMS_SQL.format("text")} AS term FROM (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents))
  GROUP BY ALL
), lengths AS (SELECT row_id, sum(tf)::BIGINT AS n FROM tf GROUP BY row_id),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term
), asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, {TERMS_SQL.format("text")} AS term FROM benchmark) GROUP BY ALL
), scores AS (
  SELECT item_id, row_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (row_id), total GROUP BY ALL
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""

SQL: dict[str, str] = {
    "op2_warc": WARC_SQL, "op4_chat_tool_linking": CALLS_SQL, "op8_line_chunk_dedup": linechunks.reference_sql(),
    "op9_source_mixing": MIX_SQL, "op11_best_positions": RANK_SQL,
}
