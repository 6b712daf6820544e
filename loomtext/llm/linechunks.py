"""Removal of repeated passages by content-defined chunks of lines.

A rolling hash over the hashes of a line and the line before it ends a chunk after every line where it
takes one of a fixed share of its values. So borders depend on the lines around them alone, and a
passage that occurs in two documents is cut alike in both, wherever it stands. Chunks of several
lines that occur more than once stay at their first place and go elsewhere, after their bytes have
been compared. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import MAX_BROADCAST_ROWS, stored

DIVISOR = 4  # lines per chunk on average
MIN_LINES = 2
# Fixed values of the rolling hash; reference SQL has them too.
MULTIPLIER, MODULUS = 48271, 2147483647


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def chunks_of(text: Column, divisor: int = DIVISOR) -> Column:
    """The text's chunks; joined by line breaks they are the text.

    Linear in the text: each line gets a mark, `s` if it starts a chunk and `c` if it goes on, the
    marked lines are joined, and the whole is cut before the marks `s`. Every line break is followed
    by a mark, so the cut is exact whatever the text holds.
    """
    lines = F.split(text, "\n", -1)
    hashes = F.transform(lines, line_hash)
    before = F.concat(F.array(F.lit(0).cast("long")), hashes)
    ends = F.zip_with(hashes, F.slice(before, F.lit(1), F.size(hashes)),
                      lambda h, p: F.pmod(h + p * MULTIPLIER, F.lit(MODULUS)) % divisor == divisor - 1)
    starts = F.slice(F.concat(F.array(F.lit(True)), ends), F.lit(1), F.size(ends))
    marked = F.array_join(F.zip_with(lines, starts, lambda line, s: F.concat(F.when(s, "s").otherwise("c"), line)), "\n")
    return F.transform(F.split(F.substring(marked, 2, 2147483647), "\ns", -1), lambda c: F.replace(c, F.lit("\nc"), F.lit("\n")))


def n_lines(chunk: Column) -> Column:
    return F.length(chunk) - F.length(F.replace(chunk, F.lit("\n"), F.lit(""))) + 1


def remove_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """doc_id, text, n_lines, n_removed, n_chunks, removed_chunks for every row.

    The first place of a chunk is the one in the smallest document id, then the smallest chunk number;
    null ids come first. Rows equal in id and text are one document: what stays in one stays in the
    other. A null text stays null and has no lines; an empty text is one empty line. Chunks of fewer
    than `min_lines` lines always stay. Other columns are not read.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    key = F.struct(F.col(doc_id).alias("id"), F.md5(t).alias("sum")).alias("key")
    rows = stored(docs.select(key, F.col(text).isNull().alias("none"), chunks_of(t).alias("chunks")), "line-chunks")
    parts = rows.select("key", F.posexplode("chunks").alias("no", "chunk")).where(n_lines(F.col("chunk")) >= min_lines)
    parts = parts.withColumn("digest", F.md5("chunk"))
    place = F.struct("key", "no")
    places = parts.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = stored(places.where("first != last").select("digest", "first"), "repeated-chunks")
    found = stored(parts.join(repeated, "digest"), "chunk-places")
    first = found.where(F.struct("key", "no") == F.col("first")).groupBy("digest").agg(F.min("chunk").alias("kept"))
    again = found.where(F.struct("key", "no") != F.col("first")).join(first, "digest").where("chunk = kept")
    removed = stored(again.select("key", "no").distinct(), "removed-chunks")
    per_doc = removed.groupBy("key").agg(F.collect_list("no").alias("gone"))
    if removed.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        per_doc = F.broadcast(per_doc)
    gone = F.coalesce(F.col("gone"), F.array().cast("array<int>"))
    out = rows.join(per_doc, "key", "left").select("key", "none", "chunks", gone.alias("gone"))
    keep = F.array_except(F.sequence(F.lit(0), F.size("chunks") - 1), "gone")
    out = out.withColumn("left", F.transform(keep, lambda i: F.col("chunks")[i]))
    out = out.withColumn("clean", F.array_join("left", "\n"))
    clean = F.when(~F.col("none"), F.col("clean"))
    count = F.aggregate("chunks", F.lit(0), lambda n, c: n + n_lines(c))
    lines = F.when(F.col("none"), 0).otherwise(count)
    stays = F.when(F.col("none") | (F.size("left") == 0), 0).otherwise(n_lines(F.col("clean")))
    return out.select(F.col("key.id").alias("doc_id"), clean.alias("text"), lines.alias("n_lines"),
                      (lines - stays).alias("n_removed"), F.size("chunks").alias("n_chunks"), F.size("gone").alias("removed_chunks"))


def reference_sql() -> str:
    """The same result as `remove_repeated` on `documents`, for DuckDB."""
    return f"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM lines
), rolled AS (
  SELECT *, ((h + coalesce(lag(h) OVER w, 0) * {MULTIPLIER}) % {MODULUS}) % {DIVISOR} = {DIVISOR - 1} AS last
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(last::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no
  FROM rolled
), chunks AS (
  SELECT doc_id, no, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n FROM numbered GROUP BY doc_id, no
), ranked AS (
  SELECT *, n >= {MIN_LINES} AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, no) > 1 AS gone FROM chunks
)
SELECT doc_id, coalesce(string_agg(chunk, chr(10) ORDER BY no) FILTER (NOT gone), '') AS text, sum(n)::BIGINT AS n_lines,
  coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed, count(*) AS n_chunks, count(*) FILTER (gone) AS removed_chunks
FROM ranked GROUP BY doc_id
UNION ALL SELECT doc_id, NULL, 0, 0, 1, 0 FROM documents WHERE text IS NULL
"""
