"""Dependency and link graphs as edge tables."""

from __future__ import annotations

import ast

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.operators import ranges, skew
from loomtext.session import cut_lineage

HREF = r'href="([^"]+)"'


def imported_modules(source: str | None) -> list[str]:
    """Distinct module names a Python text imports; nothing when it does not parse."""
    try:
        nodes = list(ast.walk(ast.parse(source or "")))
    except (SyntaxError, ValueError, MemoryError, RecursionError):  # deep nesting ends the parser
        return []
    plain = {a.name for n in nodes if isinstance(n, ast.Import) for a in n.names}
    return sorted(plain | {n.module for n in nodes if isinstance(n, ast.ImportFrom) and n.module})


def import_edges(files: DataFrame, path: str = "source", text: str = "text") -> DataFrame:
    """Distinct (src, dst) edges; a file without imports is kept as a node with NULL `dst`.

    `dst_file` resolves the module to the file whose path is the module's, if there is one.
    """
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def modules(texts: pa.Array) -> pa.Array:
        return pa.array([imported_modules(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    found = files.select(F.col(path).alias("src"), F.explode_outer(modules(F.col(text))).alias("dst"))
    own = files.groupBy(module_name(F.col(path)).alias("dst")).agg(F.min(path).alias("dst_file"))
    # a module that a large part of all files imports is a hot key of this join
    return skew.skewed_lookup(found.distinct(), own, "dst", "src").select("src", "dst", "dst_file")


def module_name(path: Column) -> Column:
    """`a/b.py` -> `a.b`, `a/__init__.py` -> `a`."""
    return F.regexp_replace(F.regexp_replace(path, r"(/__init__)?\.py$", ""), "/", ".")


def link_edges(pages: DataFrame, node: Column, html: str = "html") -> DataFrame:
    """Distinct (page, href) edges."""
    links = F.regexp_extract_all(F.col(html), F.lit(HREF), F.lit(1))
    return pages.select(node.alias("src"), F.explode(F.array_distinct(links)).alias("dst")).distinct()


def neighbours(edges: DataFrame) -> DataFrame:
    """Successors and predecessors of every node: distinct (node, neighbour) rows, no join."""
    e = edges.where(F.col("dst").isNotNull())
    out = e.select(F.col("src").alias("node"), F.col("dst").alias("neighbour"))
    back = e.select(F.col("dst").alias("node"), F.col("src").alias("neighbour"))
    return out.union(back).distinct()


def neighbour_pages(edges: DataFrame, page_size: int = 64) -> DataFrame:
    """Sorted neighbour names per file in pages: (file, page, text)."""
    # used for the counts, the split points and the pages: computed once
    n = cut_lineage(neighbours(edges)).withColumn("_key", ranges.sort_key(F.col("node"), F.col("neighbour")))
    paged = ranges.paged_concat(n, ["node"], "_key", "neighbour", page_size=page_size, sep=", ")
    return paged.select(F.col("node").alias("file"), "page", "text")


def graph_size(edges: DataFrame) -> DataFrame:
    """Number of nodes (both ends) and of distinct edges."""
    e = edges.select("src", "dst").distinct()
    ends = e.select(F.explode(F.array("src", "dst")).alias("node")).where(F.col("node").isNotNull())
    nodes = ends.select("node").distinct().select(F.lit(1).alias("n"), F.lit(0).alias("e"))
    edge_rows = e.where(F.col("dst").isNotNull()).select(F.lit(0).alias("n"), F.lit(1).alias("e"))
    return nodes.unionAll(edge_rows).agg(F.sum("n").alias("n_nodes"), F.sum("e").alias("n_edges"))
