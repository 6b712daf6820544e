"""Corpus scans: source trees, listings, paged documents, unions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions import text as X

# Path fragments that exclude a file.
EXCLUDED = ["venv", ".git", "__pycache__"]


def _glob(extensions: list[str]) -> str:
    return "*.{%s}" % ",".join(e.lstrip(".") for e in extensions)


def not_excluded(path: Column, excluded: list[str]) -> Column:
    keep = F.lit(True)
    for part in excluded:
        keep = keep & ~F.contains(path, F.lit(part))
    return keep


def with_path_metadata(df: DataFrame, path: str, root: str = "") -> DataFrame:
    """`source`, `source_path`, `filename`, `filetype` and the same as a metadata map."""
    p = F.col(path)
    out = (
        df.withColumn("source", X.relative_path(p, F.lit(root)))
        .withColumn("source_path", p)
        .withColumn("filename", X.file_name(p))
        .withColumn("filetype", X.file_type(p))
    )
    keys = ["source", "source_path", "filename", "filetype"]
    return out.withColumn("metadata", F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k))]))


def below_root(root: str) -> Column:
    """Path of a row's file below the root, from the files' own columns: conditions on it prune the list of files.

    Both sides are written as in a URI; the fragments looked for have no characters that this changes.
    """
    base = "file:" + quote(root, safe="/@+=:,!$&'()*;~") if root.startswith("/") else root
    return X.relative_path(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/"), F.lit(base))


def scan_tree(spark: SparkSession, root: str, extensions: list[str], excluded: list[str] | None = None,
              max_file_bytes: int | None = None) -> DataFrame:
    """One row per file below `root`, whole text; a file that is not UTF-8 is skipped.

    Paths containing an excluded fragment (looked for below the root) are pruned when the files are
    listed, so excluded files are not opened. Files larger than a task's memory cannot be one row; `max_file_bytes`
    makes such a file an error up front instead of a lost executor.
    """
    raw = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", _glob(extensions)).load(root)
    )
    base = "file:" + root if root.startswith("/") else root
    path = F.regexp_replace(F.col("path"), "^file:/+", "file:/")
    files = raw.where(not_excluded(below_root(root), EXCLUDED if excluded is None else excluded))
    if max_file_bytes:
        too_big = F.raise_error(F.concat(F.lit("file too large: "), F.col("path")))
        files = files.where(F.when(F.col("length") > max_file_bytes, too_big.cast("boolean")).otherwise(True))
    text = F.try_validate_utf8(F.col("content").cast("string"))
    docs = files.select(path.alias("path"), text.alias("text")).where(F.col("text").isNotNull())
    return with_path_metadata(docs, "path", base).drop("path")


def unreadable_files(spark: SparkSession, root: str, extensions: list[str]) -> DataFrame:
    """The log of skipped files."""
    raw = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", _glob(extensions)).load(root)
    )
    bad = F.try_validate_utf8(F.col("content").cast("string")).isNull()
    return raw.where(bad).select("path", "length")


def list_files(spark: SparkSession, root: str, extensions: list[str] | None = None,
               excluded: list[str] | None = None) -> DataFrame:
    """Sorted relative paths; the content column is never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if extensions:
        reader = reader.option("pathGlobFilter", _glob(extensions))
    path = F.regexp_replace(F.col("path"), "^file:/+", "file:/")
    base = "file:" + root if root.startswith("/") else root
    rel = reader.load(root).select(X.relative_path(path, F.lit(base)).alias("path"))
    return rel.where(not_excluded(F.col("path"), EXCLUDED if excluded is None else excluded)).orderBy("path")


def load_documents(spark: SparkSession, root: str, extensions: list[str]) -> DataFrame:
    """Scan with markup cleaning for `mdx` files only."""
    docs = scan_tree(spark, root, extensions)
    return docs.withColumn("text", X.clean_by_type(F.col("text"), F.col("filetype")))


def load_code(spark: SparkSession, root: str) -> DataFrame:
    """Source files with a language tag; other files are dropped."""
    docs = scan_tree(spark, root, sorted(X.LANGUAGE_OF_EXTENSION))
    return docs.withColumn("language", X.language_tag(F.col("source"))).where(F.col("language").isNotNull())


Parser = Callable[[str, bytes], list[tuple[int, str, str]]]


def parsed_elements(spark: SparkSession, root: str, extensions: list[str], parser: Parser) -> DataFrame:
    """Rows (source, page_number, category, content) from a user-supplied bytes -> elements parser."""
    raw = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", _glob(extensions)).load(root).select("path", "content")
    )

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                rows = [(path, *r) for r in parser(path, bytes(content))]
                yield pd.DataFrame(rows, columns=["source", "page_number", "category", "content"])

    return raw.mapInPandas(parse, "source string, page_number int, category string, content string")


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union of differently shaped sources; absent columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
