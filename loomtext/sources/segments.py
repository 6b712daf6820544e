"""Documents per definition: one source text as spans of its top-level functions and classes and the text between.

Spans are whole lines and follow each other without a gap, so the spans of a text in order are the text.
"""

from __future__ import annotations

import ast
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lines as the parser counts them.
LINE = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+\Z")
KINDS = {ast.FunctionDef: "function", ast.AsyncFunctionDef: "function", ast.ClassDef: "class"}
SEGMENT = pa.struct([("segment_idx", pa.int64()), ("kind", pa.string()), ("name", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
SEGMENT_DDL = "array<struct<segment_idx: bigint, kind: string, name: string, start: bigint, length: bigint>>"


def definitions(text: str) -> list[tuple[int, int, str, str]]:
    """(first line, last line, kind, name) of the top-level definitions with their decorators, lines from 1.

    Nothing when the text does not parse. A definition that begins on the last line of another (after
    a semicolon) belongs to that one.
    """
    try:
        body = ast.parse(text).body
    except (SyntaxError, ValueError, MemoryError, RecursionError):  # deep nesting ends the parser
        return []
    found, last = [], 0
    for node in body:
        if type(node) in KINDS:
            first = min([node.lineno, *(d.lineno for d in node.decorator_list)])
            if first > last:
                found.append((first, node.end_lineno, KINDS[type(node)], node.name))
        last = max(last, node.end_lineno)
    return found


def segments(text: str | None) -> list[dict]:
    """Spans (kind, name, start and length in characters) that cover the text; `other` is what lies outside definitions."""
    if not text:
        return []
    borders = list(accumulate((len(x) for x in LINE.findall(text)), initial=0))
    found = definitions(text) if "\f" not in text else []  # a form feed counts differently for the parser
    out, line = [], 0

    def add(kind: str, name: str | None, first: int, last: int) -> None:
        if borders[last] > borders[first]:
            out.append({"segment_idx": len(out), "kind": kind, "name": name, "start": borders[first], "length": borders[last] - borders[first]})

    for first, last, kind, name in found:
        add("other", None, line, first - 1)
        add(kind, name, first - 1, last)
        line = last
    add("other", None, line, len(borders) - 1)
    return out


def code_segments(files: DataFrame, text: str = "text") -> DataFrame:
    """One row per span: the columns of `files`, with the span as `text`, and segment_idx, kind, name, start, length.

    A text that does not parse as Python is one span of kind `other`. An empty or null text has no spans.
    """
    @F.arrow_udf(SEGMENT_DDL)
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([segments(t) for t in texts.to_pylist()], pa.list_(SEGMENT))

    others = [F.col(f"`{c}`") for c in files.columns if c != text]
    rows = files.select(*others, F.col(text).alias("_text"), F.explode(cut(F.col(text))).alias("_s"))
    part = F.substr("_text", F.col("_s.start") + 1, F.col("_s.length"))
    return rows.select(*others, "_s.*", part.alias(text))
