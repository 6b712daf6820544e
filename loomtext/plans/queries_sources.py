"""Catalogue: source files, their definitions and imports, listings and element files, on trees written from the tables."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from loomtext.operators import graph, ranges
from loomtext.plans.catalog import query, table
from loomtext.session import scratch_path
from loomtext.sources import corpus, elements, segments

#: A source text out of each document: an import, then a function and an assignment for every line.
CODE_SQL = r"""SELECT doc_id, lines, 'import os' || chr(10) || array_to_string(list_transform(lines, lambda l, i:
  'def f' || (i - 1) || '():' || chr(10) || '    return "' || l || '"' || chr(10) || chr(10) || 'x' || (i - 1) || ' = 1' || chr(10)), '') AS code
FROM (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '[^A-Za-z \n]', '', 'g'), chr(10)) AS lines FROM documents)"""


def code_files(spark, sf):
    lines = F.split(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^A-Za-z \n]", ""), "\n")

    def body(line, i):
        n = i.cast("string")
        return F.concat(F.lit("def f"), n, F.lit('():\n    return "'), line, F.lit('"\n\nx'), n, F.lit(" = 1\n"))

    code = F.concat(F.lit("import os\n"), F.array_join(F.transform(lines, body), ""))
    return table(spark, sf, "documents").select("doc_id", code.alias("text"))


@query("a01_code_segments", f"""
SELECT doc_id, md5(code) AS rebuilt_md5, len(lines)::BIGINT AS n_functions, len(lines)::BIGINT + 1 AS n_other,
  'f' || (len(lines) - 1) AS last_name FROM ({CODE_SQL})""")
def code_segments(spark, sf):
    """A document per definition; put together again, the spans of a text are the text."""
    spans = segments.code_segments(code_files(spark, sf))
    parts = F.array_sort(F.collect_list(F.struct("segment_idx", "text")))  # the spans of one text
    is_function = F.col("kind") == "function"
    return spans.groupBy("doc_id").agg(
        F.md5(F.array_join(F.transform(parts, lambda p: p["text"]), "")).alias("rebuilt_md5"), F.count_if(is_function).alias("n_functions"),
        F.count_if(F.col("kind") == "other").alias("n_other"), F.max_by("name", F.when(is_function, F.col("start"))).alias("last_name"))


@query("a02_tree_listing", """
SELECT 'lang=' || lang || '/source=' || source AS folder, row_number() OVER (ORDER BY lang, source) AS place
FROM (SELECT DISTINCT lang, source FROM documents WHERE lang <> 'fr')""")
def tree_listing(spark, sf):
    """Documents written by folders, those of one language below an excluded name; the listing's folders in their order."""
    root = scratch_path(spark, "tree")
    d = table(spark, sf, "documents").select("text", F.when(F.col("lang") == "fr", "venv").otherwise(F.col("lang")).alias("lang"), "source")
    d.write.partitionBy("lang", "source").text(root)
    listed = corpus.list_files(spark, root, [".txt"])
    folders = listed.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(F.min("path").alias("first"))
    return ranges.rank(folders.withColumn("_all", F.lit(0)), ["_all"], "first", "place").select("folder", "place")


def page_records(path, content):
    """One JSON record per line."""
    for line in content.split(b"\n"):
        if line:
            try:
                r = json.loads(line)
                yield r["page_id"], "page", r.get("html")
            except ValueError:
                yield ValueError("bad record")


@query("a04_element_files", """
SELECT CASE WHEN page_id % 7 <> 0 THEN page_id END AS page_number, CASE WHEN page_id % 7 <> 0 THEN 'page' END AS category,
  CASE WHEN page_id % 7 <> 0 THEN md5(html) END AS content_md5, CASE WHEN page_id % 7 = 0 THEN 'bad record' END AS error FROM pages""")
def element_files(spark, sf):
    """Pages written as record files, every seventh one cut off, and read back through the data source."""
    root = scratch_path(spark, "elements")
    record = F.to_json(F.struct("page_id", "html"))
    bad = F.col("page_id") % 7 == 0
    table(spark, sf, "pages").select(F.when(bad, F.substring(record, 1, 10)).otherwise(record).alias("value")).write.text(root)
    elements.register(spark, "page_records", "page_number long, category string, content string", page_records)
    read = spark.read.format("page_records").option("pattern", "*.txt").option("groupBytes", 1_000_000).load(root)
    return read.select("page_number", "category", F.md5("content").alias("content_md5"), "error")


@query("k07_import_edges", """
WITH d AS (SELECT doc_id, 'pkg/d' || doc_id || '.py' AS src FROM documents)
SELECT src, NULL AS dst, NULL AS dst_file FROM d WHERE doc_id % 11 = 0
UNION ALL SELECT src, 'os', NULL FROM d WHERE doc_id % 11 <> 0
UNION SELECT a.src, 'pkg.d' || a.doc_id // 2, b.src FROM d a LEFT JOIN d b ON b.doc_id = a.doc_id // 2 WHERE a.doc_id % 11 <> 0
UNION SELECT a.src, 'pkg.d' || a.doc_id % 50, b.src FROM d a LEFT JOIN d b ON b.doc_id = a.doc_id % 50 WHERE a.doc_id % 11 <> 0""")
def import_edges(spark, sf):
    """A module for each document that imports three others, some by everybody; every eleventh does not parse."""
    i = F.col("doc_id")
    name = lambda n: F.concat(F.lit("pkg.d"), n.cast("long").cast("string"))
    text = F.concat(F.lit("import os, "), name(F.floor(i / 2)), F.lit("\nfrom "), name(i % 50), F.lit(" import x\nfrom . import y\n"))
    files = table(spark, sf, "documents").select(
        F.concat(F.lit("pkg/d"), i.cast("string"), F.lit(".py")).alias("source"), F.when(i % 11 == 0, "def (").otherwise(text).alias("text"))
    return graph.import_edges(files)
