"""Catalogue: intake, scalar and text functions, chunking."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions import scalars as S
from loomtext.functions import text as X
from loomtext.operators import chunking, stats
from loomtext.plans.catalog import query, table
from loomtext.plans.split_sql import chunks_sql
from loomtext.sources import corpus, records

# ---------------------------------------------------------------- intake (A)

_SITE = r"^https?://[^/]+"


@query("a03_path_metadata", """
SELECT page_id, regexp_replace(url, '^https?://[^/]+/?', '') AS source, url AS source_path,
       string_split(url, '/')[-1] AS filename,
       CASE WHEN url LIKE '%.mdx' THEN 'mdx' ELSE 'md' END AS filetype
FROM pages""")
def path_metadata(spark, sf):
    p = table(spark, sf, "pages")
    root = F.regexp_extract("url", _SITE, 0)
    u = F.col("url")
    return p.select("page_id", X.relative_path(u, root).alias("source"), u.alias("source_path"),
                    X.file_name(u).alias("filename"), X.file_type(u).alias("filetype"))


def _hrefs():
    return F.regexp_extract_all("html", F.lit(r'href="([^"]+)"'), F.lit(1))


@query("a05_summary_map", """
SELECT page_id, h AS file, CASE WHEN length(h) % 3 = 0 THEN NULL ELSE 'About ' || h END AS summary
FROM (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="([^"]+)"', 1))) AS h FROM pages)""")
def summary_map(spark, sf):
    p = table(spark, sf, "pages")
    files = F.array_distinct(_hrefs())
    entry = F.transform(files, lambda h: F.struct(
        F.when(F.length(h) % 3 != 0, F.concat(F.lit("About "), h)).alias("summary")))
    payload = p.select("page_id", F.to_json(F.map_from_arrays(files, entry)).alias("payload"))
    return records.summary_map(payload, "payload", ["page_id"])


@query("a06_summary_tree", """
WITH f AS (SELECT page_id, page_id || '/' || regexp_extract(url, '^https?://[^/]+/([^/]+)', 1) AS path,
                  CASE WHEN page_id % 4 = 0 THEN '' WHEN page_id % 4 = 1 THEN NULL ELSE 'Folder ' || page_id END AS summary,
                  regexp_extract_all(html, 'href="([^"]+)"', 1) AS hs FROM pages),
c AS (SELECT path, unnest(hs) AS h FROM f WHERE string_split(path, '/')[-1] IN ('en', 'de'))
SELECT 'folder' AS level, path, summary FROM f WHERE length(summary) > 0
UNION ALL
SELECT 'file', path || h, 'File ' || h FROM c WHERE length(h) % 3 <> 0""")
def summary_tree(spark, sf):
    p = table(spark, sf, "pages")
    pid = F.col("page_id").cast("string")
    path = F.concat(pid, F.lit("/"), F.regexp_extract("url", r"^https?://[^/]+/([^/]+)", 1))
    rest = F.col("page_id") % 4
    summary = F.when(rest == 0, "").when(rest != 1, F.concat(F.lit("Folder "), pid))
    folders = p.select(path.alias("path"), summary.alias("summary"), _hrefs().alias("hs")).select(
        "path", "summary",
        F.transform("hs", lambda h: F.struct(
            F.concat("path", h).alias("path"),
            F.when(F.length(h) % 3 != 0, F.concat(F.lit("File "), h)).alias("summary"))).alias("children"),
    )
    important = spark.createDataFrame([("en",), ("de",)], "name string")
    return records.folder_summaries(folders, F.broadcast(important))


def _submissions(spark, sf):
    d = table(spark, sf, "documents")
    reviews = F.transform(X.sentences(F.col("text")), lambda s: F.struct(
        F.md5(s).alias("summary"), (F.length(s) % 10 + 1).cast("double").alias("rating"),
        (F.length(s) % 5 + 1).cast("double").alias("confidence")))
    payload = F.to_json(F.struct(F.col("doc_id").cast("string").alias("submission_id"),
                                 F.col("source").alias("title"), reviews.alias("reviews")))
    return records.parse_submissions(d, payload)


@query("a07_review_flatten", r"""
WITH s AS (SELECT doc_id, regexp_extract_all(text, '[^.]+[.]') AS r FROM documents),
e AS (SELECT doc_id, unnest(r) AS s, unnest(range(len(r))) AS i FROM s)
SELECT doc_id::VARCHAR AS submission_id, i AS review_idx, md5(s) AS summary,
       (length(s) % 10 + 1)::DOUBLE AS rating, (length(s) % 5 + 1)::DOUBLE AS confidence FROM e
UNION ALL SELECT doc_id::VARCHAR, NULL, NULL, NULL, NULL FROM s WHERE len(r) = 0""")
def review_flatten(spark, sf):
    return records.flatten_reviews(_submissions(spark, sf)).select(
        "submission_id", "review_idx", "summary", "rating", "confidence")


@query("g08_review_scores", r"""
WITH s AS (SELECT doc_id, regexp_extract_all(text, '[^.]+[.]') AS r FROM documents)
SELECT doc_id::VARCHAR AS submission_id, len(r) AS n_reviews,
       round(list_avg(list_transform(r, lambda x: (length(x) % 10 + 1)::DOUBLE)), 6) AS mean_rating,
       round(list_avg(list_transform(r, lambda x: (length(x) % 5 + 1)::DOUBLE)), 6) AS mean_confidence
FROM s""")
def review_scores(spark, sf):
    return stats.review_scores(_submissions(spark, sf))


# ---------------------------------------------------------------- scalars (B)

CLEAN_SQL = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
regexp_replace(regexp_replace({c}, '(?m)^---[\s\S]+?---', '', 'g'),
'<[A-Za-z0-9_]+[^>]*>[\s\S]*?</[A-Za-z0-9_]+>', '', 'g'), '<[^>]+/>', '', 'g'),
':::python', '```python', 'g'), ':::js', '```javascript', 'g'), ':::', '```', 'g'),
'<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g')"""


@query("b01_clean_markup", f"""
SELECT page_id, md5(t) AS text_md5, length(t) AS n_chars FROM (SELECT page_id, {CLEAN_SQL.format(c='html')} AS t FROM pages)""")
def clean_markup(spark, sf):
    t = table(spark, sf, "pages").select("page_id", X.clean_markup(F.col("html")).alias("t"))
    return t.select("page_id", F.md5("t").alias("text_md5"), F.length("t").cast("long").alias("n_chars"))


@query("b02_clean_by_type", f"""
SELECT page_id, filetype, md5(CASE WHEN filetype = 'mdx' THEN {CLEAN_SQL.format(c='html')} ELSE html END) AS text_md5
FROM (SELECT page_id, html, CASE WHEN url LIKE '%#top' THEN 'mdx' ELSE 'md' END AS filetype FROM pages)""")
def clean_by_type(spark, sf):
    p = table(spark, sf, "pages").withColumn("filetype", F.when(F.col("url").endswith("#top"), "mdx").otherwise("md"))
    return p.select("page_id", "filetype", F.md5(X.clean_by_type(F.col("html"), F.col("filetype"))).alias("text_md5"))


@query("b03_language_tag", """
SELECT doc_id, path, CASE WHEN path LIKE '%.py' THEN 'python' ELSE 'rust' END AS language FROM (
  SELECT doc_id, source || '/' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.py' WHEN 1 THEN '.rs' ELSE '.txt' END AS path
  FROM documents) WHERE path LIKE '%.py' OR path LIKE '%.rs'""")
def language_tag(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", _code_path().alias("path"))
    return d.withColumn("language", X.language_tag(F.col("path"))).where(F.col("language").isNotNull())


def _code_path():
    r = F.col("doc_id") % 3
    ext = F.when(r == 0, ".py").when(r == 1, ".rs").otherwise(".txt")
    return F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), ext)


@query("b04_word_count", r"SELECT doc_id, len(regexp_extract_all(text, '\S+')) AS n_words FROM documents")
def word_count(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.word_count(F.col("text")).alias("n_words"))


@query("b05_previews", """
SELECT doc_id, substr(text, 1, 500) || '...' AS p500,
       CASE WHEN length(text) > 120 THEN substr(text, 1, 120) || '...' ELSE text END AS p120,
       substr(text, 1, 50) || '...' AS p50, substr(text, 1, 60) || '...' AS p60,
       CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS p200 FROM documents""")
def previews(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", X.preview(t, 500, always=True).alias("p500"), X.preview(t, 120).alias("p120"),
        X.preview(t, 50, always=True).alias("p50"), X.preview(t, 60, always=True).alias("p60"),
        X.preview(t, 200).alias("p200"))


_ANSWER_SQL = """SELECT conv_id, turn, CASE role
  WHEN 'assistant' THEN 'Draft ```json {"datasource": "none"} ``` then ```json' || chr(10) || '{"datasource": "'
       || CASE WHEN turn % 2 = 0 THEN 'vectorstore' ELSE 'websearch' END || '", "binary_score": "Yes", "turn": ' || turn || '}' || chr(10) || '``` done'
  WHEN 'user' THEN '{"binary_score": "no", "explanation": "turn ' || turn || '"}'
  ELSE text END AS answer FROM conversations"""


def _answers(spark, sf):
    turn = F.col("turn").cast("string")
    fenced = F.concat(
        F.lit('Draft ```json {"datasource": "none"} ``` then ```json\n{"datasource": "'),
        F.when(F.col("turn") % 2 == 0, "vectorstore").otherwise("websearch"),
        F.lit('", "binary_score": "Yes", "turn": '), turn, F.lit("}\n``` done"))
    plain = F.concat(F.lit('{"binary_score": "no", "explanation": "turn '), turn, F.lit('"}'))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn",
        F.when(F.col("role") == "assistant", fenced).when(F.col("role") == "user", plain)
        .otherwise(F.col("text")).alias("answer"))


_FENCED_SQL = "string_split(string_split(answer, '```json')[-1], '```')[1]"


@query("b06_fenced_json", f"SELECT conv_id, turn, {_FENCED_SQL} AS body FROM ({_ANSWER_SQL})")
def fenced_json(spark, sf):
    return _answers(spark, sf).select("conv_id", "turn", X.fenced_json(F.col("answer")).alias("body"))


@query("b07_verdict_fields", f"""
SELECT conv_id, turn, TRY_CAST(body AS JSON) ->> '$.datasource' AS datasource,
       TRY_CAST(body AS JSON) ->> '$.binary_score' AS binary_score, TRY_CAST(body AS JSON) ->> '$.explanation' AS explanation,
       coalesce(lower(trim(TRY_CAST(body AS JSON) ->> '$.binary_score')) = 'yes', false) AS is_yes
FROM (SELECT conv_id, turn, {_FENCED_SQL} AS body FROM ({_ANSWER_SQL}))""")
def verdict_fields(spark, sf):
    a = F.col("answer")
    score = X.verdict_field(a, "binary_score")
    return _answers(spark, sf).select(
        "conv_id", "turn", X.verdict_field(a, "datasource").alias("datasource"), score.alias("binary_score"),
        X.verdict_field(a, "explanation").alias("explanation"), X.is_yes(score).alias("is_yes"))


@query("b08_metadata_json", "SELECT doc_id, to_json(struct_pack(source := source, lang := lang))::VARCHAR AS meta FROM documents")
def metadata_json(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", X.metadata_json(source=F.col("source"), lang=F.col("lang")).alias("meta"))


@query("b09_slide_elements", """
SELECT conv_id, turn, to_json(struct_pack(content := text, metadata := struct_pack(
  category_depth := CASE WHEN turn % 3 <> 0 THEN turn::INT END, page_number := (turn // 2 + 1)::INT, category := role)))::VARCHAR AS element
FROM conversations""")
def slide_elements(spark, sf):
    turn = F.col("turn").cast("int")
    e = S.slide_element(F.col("text"), F.when(turn % 3 != 0, turn), (F.floor(turn / 2) + 1).cast("int"), F.col("role"))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.to_json(e, {"ignoreNullFields": "false"}).alias("element"))


@query("b10_prompt_template", """
SELECT doc_id, md5('Question: ' || source || ' {context}?' || chr(10) || 'Context: ' || text || chr(10) || 'Answer:') AS prompt_md5 FROM documents""")
def prompt_template(spark, sf):
    q = F.concat("source", F.lit(" {context}?"))
    p = X.render("Question: {question}\nContext: {context}\nAnswer:", question=q, context=F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(p).alias("prompt_md5"))


@query("b11_date_parts", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%A') AS day, strftime(ts, '%I:%M %p') AS time FROM events""")
def date_parts(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", S.iso_date(ts).alias("date"), S.weekday(ts).alias("day"), S.clock12(ts).alias("time"))


@query("b12_date_shift", """
SELECT event_id, strftime(d, '%Y-%m-%d') AS date, strftime(d, '%A') AS day
FROM (SELECT event_id, ts::DATE + (event_id % 400)::INT AS d FROM events)""")
def date_shift(spark, sf):
    d = S.shift_days(F.col("ts"), (F.col("event_id") % 400).cast("int"))
    return table(spark, sf, "events").select("event_id", S.iso_date(d).alias("date"), S.weekday(d).alias("day"))


@query("b13_arithmetic", """
SELECT event_id, event_id + user_id AS total, event_id * user_id AS product, round(sqrt(value), 9) AS root,
       CASE WHEN user_id >= 50 THEN sqrt(user_id - 50)::DOUBLE ELSE 'NaN'::DOUBLE END AS shifted_root FROM events""")
def arithmetic(spark, sf):
    e, u = F.col("event_id"), F.col("user_id")
    return table(spark, sf, "events").select(
        "event_id", S.add(e, u).alias("total"), S.multiply(e, u).alias("product"),
        F.round(S.square_root(F.col("value")), 9).alias("root"), S.square_root(u - 50).alias("shifted_root"))


_EXPR_SQL = "CASE WHEN event_id % 3 = 0 THEN '(' || event_id || ' + 2) * ' || user_id || ' / 1.5' WHEN event_id % 3 = 1 THEN props ELSE event_type || '()' END"


@query("b14_expression_check", rf"""
SELECT event_id, expression, regexp_matches(expression, '^[0-9+\-*/().\s]+$') AS allowed FROM (SELECT event_id, {_EXPR_SQL} AS expression FROM events)""")
def expression_check(spark, sf):
    e = F.col("event_id").cast("string")
    expr = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("("), e, F.lit(" + 2) * "), F.col("user_id").cast("string"), F.lit(" / 1.5")))
        .when(F.col("event_id") % 3 == 1, F.col("props")).otherwise(F.concat("event_type", F.lit("()")))
    )
    d = table(spark, sf, "events").select("event_id", expr.alias("expression"))
    return d.withColumn("allowed", S.expression_allowed(F.col("expression")))


@query("b15_weather_report", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN
  'Weather in place ' || user_id || ':' || chr(10) || 'Condition: ' || event_type || chr(10) || 'Temperature: ' || value::VARCHAR
  || '°' || CASE WHEN user_id % 2 = 0 THEN 'C' ELSE 'F' END || chr(10) || 'Humidity: ' || (props::JSON ->> '$.k')
  || '%' || chr(10) || 'Wind Speed: ' || (event_id % 30) || ' m/s'
  WHEN event_id % 2 = 0 THEN 'Error getting weather data: no place ' || user_id
  ELSE 'Error getting weather data: Unknown error' END AS report FROM events""")
def weather_report(spark, sf):
    e = table(spark, sf, "events")
    uid = F.col("user_id").cast("string")
    ok = F.concat(
        F.lit('{"status": 200, "weather": [{"description": "'), F.col("event_type"), F.lit('"}], "main": {"temp": "'),
        F.col("value").cast("string"), F.lit('", "humidity": '), F.get_json_object("props", "$.k"),
        F.lit('}, "wind": {"speed": '), (F.col("event_id") % 30).cast("string"), F.lit("}}"))
    message = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(', "message": "no place '), uid, F.lit('"'))).otherwise("")
    bad = F.concat(F.lit('{"status": 404'), message, F.lit("}"))
    rows = e.select("event_id", F.concat(F.lit("place "), uid).alias("place"),
                    F.when(F.col("event_type") == "error", bad).otherwise(ok).alias("payload"),
                    F.when(F.col("user_id") % 2 == 0, "metric").otherwise("imperial").alias("units"))
    parsed = rows.withColumn("answer", S.parse_weather(F.col("payload")))
    return parsed.select("event_id", S.weather_report(F.col("place"), F.col("answer"), F.col("units")).alias("report"))


@query("b16_media_records", """
SELECT event_id, event_type AS codec, CASE WHEN event_id % 5 = 0 THEN 'N/A' ELSE 'mp4' END AS format_name,
       CASE WHEN event_id % 7 = 0 THEN '0x' ELSE user_id || 'x' END || (event_id % 1000) AS resolution,
       CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE value END AS duration,
       CASE event_id % 4 WHEN 0 THEN round(30000 / 1001.0::DOUBLE, 6) WHEN 1 THEN NULL WHEN 2 THEN 0.0 ELSE 25.0 END AS fps,
       'N/A' AS par, 'bt709' AS colorspace, '16:9' AS aspect_ratio FROM events""")
def media_records(spark, sf):
    e = F.col("event_id")
    rate = F.when(e % 4 == 0, "30000/1001").when(e % 4 == 1, "0/0").when(e % 4 == 3, "25/1")
    stream = F.struct(
        F.col("event_type").alias("codec_name"), F.when(e % 7 != 0, F.col("user_id")).alias("width"),
        (e % 1000).alias("height"), rate.alias("r_frame_rate"), F.lit("16:9").alias("display_aspect_ratio"),
        F.lit("bt709").alias("color_space"))
    fmt = F.when(e % 5 != 0, F.struct(F.lit("mp4").alias("format_name"), F.col("value").cast("string").alias("duration")))
    payload = F.to_json(F.struct(F.array(stream).alias("streams"), fmt.alias("format")))
    parsed = table(spark, sf, "events").select("event_id", S.parse_media(payload).alias("probe"))
    out = parsed.select("event_id", S.media_record(F.col("probe")).alias("m")).select("event_id", "m.*")
    return out.withColumn("fps", F.round("fps", 6))


@query("b17_role_labels", """
SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'User' ELSE 'AI' END || ': ' || text AS line FROM conversations""")
def role_labels(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat(X.role_label(F.col("role")), F.lit(": "), F.col("text")).alias("line"))


@query("b18_three_sentences", r"""
SELECT doc_id, regexp_replace(array_to_string(regexp_extract_all(text, '[^.]+[.]')[1:3], ''), '^\s+|\s+$', '', 'g') AS answer FROM documents""")
def three_sentences(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.first_sentences(F.col("text"), 3).alias("answer"))


@query("b21_default_result", r"""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'Error: ' || props
  ELSE coalesce(nullif(regexp_replace(r, '^\s+|\s+$', '', 'g'), ''), 'No results found') END AS answer
FROM (SELECT *, CASE WHEN event_type = 'view' THEN '   ' || chr(10) WHEN event_type = 'click' THEN NULL ELSE '  ' || props || chr(9) END AS r FROM events)""")
def default_result(spark, sf):
    e = table(spark, sf, "events")
    kind = F.col("event_type")
    result = F.when(kind == "view", "   \n").when(kind != "click", F.concat(F.lit("  "), F.col("props"), F.lit("\t")))
    return e.select("event_id", X.inference_text(result, F.when(kind == "error", F.col("props"))).alias("answer"))


@query("b22_thread_keys", "SELECT conv_id, turn, 'test_' || md5(text) AS thread_key FROM conversations")
def thread_keys(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", X.thread_key(F.col("text")).alias("thread_key"))


@query("m01_tool_scalars", rf"""
SELECT event_id, CASE WHEN regexp_matches(expression, '^[0-9+\-*/().\s]+$') THEN 'accepted: ' || expression ELSE 'unsafe expression' END AS calculator,
       'e-mail queued: ' || expression AS send_email, 'deletion queued: ' || expression AS delete_user
FROM (SELECT event_id, {_EXPR_SQL} AS expression FROM events)""")
def tool_scalars(spark, sf):
    from loomtext.functions.inference import TOOLS
    d = expression_check(spark, sf)
    return d.select("event_id", *[t.fn(F.col("expression")).alias(n) for n, t in TOOLS.items()])


# ---------------------------------------------------------------- chunking (D)

_WINDOWS_SQL = """SELECT doc_id, lang, source, i AS chunk_idx, substr(text, (i * {step} + 1)::INT, {size}) AS chunk
FROM (SELECT *, unnest(range(0, 1 + greatest(0, ceil((length(text) - {size}) / {step}.0))::INT)) AS i FROM documents)"""
WINDOWS_512 = _WINDOWS_SQL.format(size=512, step=462)


@query("d03_window_chunks", f"""
SELECT doc_id, chunk_idx::BIGINT AS chunk_idx, length(chunk) AS n_chars, md5(chunk) AS chunk_md5 FROM ({WINDOWS_512})""")
def window_chunks(spark, sf):
    c = chunking.window_chunks(table(spark, sf, "documents").select("doc_id", "text"), 512, 50)
    return c.select("doc_id", "chunk_idx", F.length("chunk").cast("long").alias("n_chars"), F.md5("chunk").alias("chunk_md5"))


@query("d04_global_chunk_ids", f"""
SELECT lang AS language, doc_id, chunk_idx::BIGINT AS chunk_idx,
       source || '_' || (row_number() OVER (PARTITION BY lang ORDER BY source, doc_id, chunk_idx) - 1) AS chunk_id
FROM ({WINDOWS_512})""")
def global_chunk_ids(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("language"), "source", "text")
    c = chunking.window_chunks(docs, 512, 50).drop("chunk")
    return chunking.global_chunk_ids(c, "language", "source", "doc_id").select("language", "doc_id", "chunk_idx", "chunk_id")


def _coverage_sql(lang: str) -> str:
    return r"""
SELECT doc_id, md5(regexp_replace(text, '\s', '', 'g')) AS solid_md5, 0::BIGINT AS n_too_long, true AS all_found FROM (
  SELECT doc_id, {t} AS text FROM documents)""".format(t=lang)


def _coverage(docs, size, language):
    """Per document: the operator's chunks without white space put together, size and substring checks."""
    return _covered(docs, chunking.recursive_chunks(docs, size, 0, language=F.lit(language)), size)


def _covered(docs, made, size):
    parts = F.array_sort(F.collect_list(F.struct("chunk_idx", "chunk")))  # the chunks of one text
    listed = made.groupBy("doc_id").agg(F.transform(parts, lambda p: p["chunk"]).alias("chunks"))
    d = docs.join(listed, "doc_id", "left").withColumn("chunks", F.coalesce("chunks", F.array().cast("array<string>")))
    solid = F.regexp_replace(F.array_join("chunks", ""), r"\s", "")
    return d.select(
        "doc_id", F.md5(solid).alias("solid_md5"),
        F.size(F.filter("chunks", lambda c: F.length(c) > size)).cast("long").alias("n_too_long"),
        F.forall("chunks", lambda c: F.contains(F.col("text"), c)).alias("all_found"),
    )


@query("d01_recursive_coverage", _coverage_sql("text"))
def recursive_coverage(spark, sf):
    return _coverage(table(spark, sf, "documents").select("doc_id", "text"), 512, None)


@query("d02_definition_chunks", f"""
SELECT doc_id, language, chunk_idx, chunk FROM ({chunks_sql(
    "SELECT doc_id, CASE doc_id % 2 WHEN 0 THEN 'python' ELSE 'rust' END AS language, replace(text, '. ', chr(10) || CASE doc_id % 2 WHEN 0 THEN 'def ' ELSE 'fn ' END) AS text FROM documents",
    256, 64)}) JOIN (SELECT doc_id, CASE doc_id % 2 WHEN 0 THEN 'python' ELSE 'rust' END AS language FROM documents) USING (doc_id)""")
def definition_chunks(spark, sf):
    """Sentences made definitions, so that the separators of the languages cut."""
    even = F.col("doc_id") % 2 == 0
    opens = F.concat(F.lit("\n"), F.when(even, "def ").otherwise("fn "))
    d = table(spark, sf, "documents").select("doc_id", F.when(even, "python").otherwise("rust").alias("language"), F.replace("text", F.lit(". "), opens).alias("text"))
    return chunking.recursive_chunks(d, 256, 64, language=F.col("language"))


@query("d02_code_coverage", _coverage_sql("replace(text, '. ', chr(10) || 'def ')"))
def code_coverage(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.replace("text", F.lit(". "), F.lit("\ndef ")).alias("text"))
    return _coverage(d, 1024, "python")


@query("m04_splitter_function", _coverage_sql("text"))
def splitter_function(spark, sf):
    """The splitter called from SQL on a whole table; its chunks rebuild every text."""
    chunking.register_table_splitter(spark, "split_table", size=512, overlap=0)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    docs.createOrReplaceTempView("splitter_documents")
    made = spark.sql("SELECT key AS doc_id, chunk_idx, chunk FROM split_table(TABLE(SELECT doc_id, text, 'text' AS language FROM splitter_documents))")
    return _covered(docs, made, 512)


@query("d01_recursive_chunks", rf"""
SELECT c.doc_id, lang, chunk_idx, chunk, len(regexp_extract_all(chunk, '\S+')) AS n_words
FROM ({chunks_sql("SELECT doc_id, 'text' AS language, text FROM documents", 512, 50)}) c JOIN documents USING (doc_id)""")
def recursive_chunks(spark, sf):
    c = chunking.recursive_chunks(table(spark, sf, "documents").select("doc_id", "lang", "text"), 512, 50)
    return chunking.with_word_count(c)


@query("d02_code_chunks", f"""
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'python' ELSE 'rust' END AS language, chunk_idx, chunk FROM ({chunks_sql(
    "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'python' ELSE 'rust' END AS language, text FROM documents WHERE doc_id % 3 < 2", 1024, 128)})""")
def code_chunks(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", X.language_tag(_code_path()).alias("language"))
    return chunking.recursive_chunks(d.where(F.col("language").isNotNull()), 1024, 128, language=F.col("language"))


# ---------------------------------------------------------------- chunk statistics, unions


@query("g01_chunk_statistics", rf"""
SELECT lang AS language, grouping(lang)::INT AS overall, count(*) AS n_chunks, round(avg(n), 6) AS avg_words,
       min(n) AS min_words, max(n) AS max_words
FROM (SELECT lang, len(regexp_extract_all(chunk, '\S+')) AS n FROM ({WINDOWS_512})) GROUP BY ROLLUP (lang)""")
def chunk_statistics(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("language"), "text")
    return stats.chunk_statistics(chunking.with_word_count(chunking.window_chunks(docs, 512, 50)))


@query("j01_corpus_union", """
SELECT 'doc-' || doc_id AS id, md5(text) AS text_md5, lang, source, NULL AS url FROM documents
UNION ALL SELECT 'page-' || page_id, md5(html), NULL, NULL, url FROM pages
UNION ALL SELECT 'item-' || item_id, md5(text), NULL, NULL, NULL FROM benchmark""")
def corpus_union(spark, sf):
    d = table(spark, sf, "documents").select(F.concat(F.lit("doc-"), "doc_id").alias("id"), F.md5("text").alias("text_md5"), "lang", "source")
    p = table(spark, sf, "pages").select(F.concat(F.lit("page-"), "page_id").alias("id"), F.md5("html").alias("text_md5"), "url")
    b = table(spark, sf, "benchmark").select(F.concat(F.lit("item-"), "item_id").alias("id"), F.md5("text").alias("text_md5"))
    return corpus.union_sources(d, p, b)


@query("c10_present_summaries", r"""
SELECT doc_id, s AS summary FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE regexp_extract(text, '[^.]+[.]') END AS s FROM documents)
WHERE length(s) > 0""")
def present_summaries(spark, sf):
    s = F.when(F.col("doc_id") % 5 != 0, X.first_sentence(F.col("text")))
    d = table(spark, sf, "documents").select("doc_id", s.alias("summary"))
    return d.where(X.present(F.col("summary")))


@query("i01_first_sources", "SELECT doc_id, source, lang FROM documents ORDER BY source, doc_id LIMIT 5")
def first_sources(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source", "lang").orderBy("source", "doc_id").limit(5)


@query("i01_sorted_listing", """
SELECT url FROM pages WHERE NOT contains(url, 'venv') AND NOT contains(url, '.git') AND NOT contains(url, '__pycache__') ORDER BY url""")
def sorted_listing(spark, sf):
    p = table(spark, sf, "pages").select("url")
    return p.where(corpus.not_excluded(F.col("url"), corpus.EXCLUDED)).orderBy("url")
