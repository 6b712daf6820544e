"""Chunking: fixed windows (JVM only), recursive splitting (Arrow batches), chunk ids."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.functions import text as X
from loomtext.functions.blocks import in_blocks
from loomtext.operators import ranges, skew
from loomtext.session import cut_lineage

# Separators tried in order, by language.
SEPARATORS = {
    "text": ["\n\n", "\n", " ", ""],
    "python": ["\nclass ", "\ndef ", "\n\tdef ", "\n\n", "\n", " ", ""],
    "rust": ["\nfn ", "\nconst ", "\nlet ", "\nif ", "\nwhile ", "\nfor ", "\nloop ", "\nmatch ",
             "\nconst ", "\n\n", "\n", " ", ""],
}


#: Windows cut from one stretch of a text. Finding a character counts from the start of a string, so a
#: long text is cut to stretches first and each window is looked for in its own.
WINDOWS_PER_STRETCH = 256


def window_chunks(df: DataFrame, size: int = 512, overlap: int = 50, text: str = "text") -> DataFrame:
    """One row per fixed window: columns `chunk_idx` and `chunk` next to the input columns."""
    step, per = size - overlap, WINDOWS_PER_STRETCH
    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / F.lit(float(step))).cast("int"))
    first = F.explode(F.sequence(F.lit(0), last, F.lit(per))).alias("_first")
    stretch = F.col(text).substr(F.col("_first") * step + 1, F.lit(per * step + overlap))
    cut = df.select("*", last.alias("_last"), first).select(*others, "_first", "_last", stretch.alias("_stretch"))
    idx = F.explode(F.sequence("_first", F.least(F.col("_last"), F.col("_first") + per - 1)))
    return cut.select("*", idx.alias("chunk_idx")).select(
        *others,
        F.col("chunk_idx").cast("long").alias("chunk_idx"),
        F.col("_stretch").substr((F.col("chunk_idx") - F.col("_first")) * step + 1, F.lit(size)).alias("chunk"),
    )


def _piece_lengths(text: str, sep: str) -> list[int]:
    """Lengths of the pieces; a piece keeps the separator it starts with."""
    first, *rest = map(len, text.split(sep))
    return ([first] if first else []) + [len(sep) + n for n in rest]


def _pack(text: str, borders: Sequence[int], size: int, overlap: int) -> Iterator[str]:
    """Fill chunks up to `size` with the whole pieces between neighbouring borders, none longer than `size`.

    A chunk after the first starts at the earliest piece that leaves at most `overlap` shared
    characters and room for one new piece. Piece borders are sorted, so each chunk is found by
    two binary searches.
    """
    at, last = 0, len(borders) - 1
    while at < last:
        end = bisect_right(borders, borders[at] + size) - 1
        yield text[borders[at]:borders[end]]
        if end == last:
            return
        at = bisect_left(borders, max(borders[end] - overlap, borders[end + 1] - size), at, end)


def _recursive(text: str, seps: list[str], size: int, overlap: int) -> Iterator[str]:
    """Cut at the coarsest separator present; pieces that are too long go on to finer ones."""
    level = next((i for i, s in enumerate(seps) if not s or s in text), len(seps) - 1)
    finer = seps[level + 1:]
    if not seps[level]:  # every character is a piece: borders by arithmetic
        yield from _pack(text, range(len(text) + 1), size, overlap)
        return
    start, run = 0, []
    for n in _piece_lengths(text, seps[level]):
        if n < size:
            run.append(n)
            continue
        yield from _pack(text, list(accumulate(run, initial=start)), size, overlap)
        long_from = start + sum(run)
        piece = text[long_from:long_from + n]
        yield from _recursive(piece, finer, size, overlap) if finer else [piece]
        start, run = long_from + n, []
    yield from _pack(text, list(accumulate(run, initial=start)), size, overlap)


def split_text(text: str | None, language: str | None = None, size: int = 512, overlap: int = 50) -> list[str]:
    """Chunks of one text: separators from coarse to fine, stripped, empty ones dropped."""
    seps = SEPARATORS.get(language or "text", SEPARATORS["text"])
    return [c for c in (p.strip() for p in _recursive(text or "", seps, size, overlap)) if c]


def recursive_chunks(df: DataFrame, size: int = 512, overlap: int = 50, text: str = "text",
                     language: Column | None = None) -> DataFrame:
    """One row per chunk of the recursive splitter: `chunk_idx`, `chunk`."""
    lang = F.lit("text") if language is None else F.coalesce(language, F.lit("text"))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(texts: pa.Array, langs: pa.Array) -> pa.Array:
        def block(some: pa.Array, languages: pa.Array) -> pa.Array:
            both = zip(some.to_pylist(), languages.to_pylist())
            return pa.array([split_text(t, g, size, overlap) for t, g in both], pa.list_(pa.string()))

        return in_blocks(block, texts, langs)

    arr = df.select(*[c for c in df.columns if c != text], split(F.col(text), lang).alias("_chunks"))
    out = arr.select(*[c for c in arr.columns if c != "_chunks"],
                     F.posexplode("_chunks").alias("chunk_idx", "chunk"))
    return out.withColumn("chunk_idx", F.col("chunk_idx").cast("long"))


def register_splitter(spark, name: str = "split_chunks", size: int = 512, overlap: int = 50) -> None:
    """SQL face of the splitter: a table function `name(text, language)`."""

    @F.udtf(returnType="chunk_idx: bigint, chunk: string")
    class Splitter:
        def eval(self, text: str, language: str):
            for i, c in enumerate(split_text(text, language, size, overlap)):
                yield i, c

    spark.udtf.register(name, Splitter)


def register_table_splitter(spark, name: str = "split_table", key: str = "bigint", size: int = 512, overlap: int = 50) -> None:
    """SQL face for whole tables, by Arrow batches: `name(TABLE(SELECT key, text, language ...))` -> key, chunk_idx, chunk.

    Spark does not take Arrow functions in a LATERAL join, so the key travels along. `key` is its type.
    A null text has no chunks. Rows stay in their tasks.
    """

    @F.arrow_udtf(returnType=f"key {key}, chunk_idx bigint, chunk string")
    class Splitter:
        def eval(self, batch: pa.RecordBatch):
            owner, place, chunks = [], [], []
            for i, (t, g) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                parts = split_text(t, g, size, overlap)
                owner.extend([i] * len(parts))
                place.extend(range(len(parts)))
                chunks.extend(parts)
            yield pa.table({"key": batch.column(0).take(pa.array(owner, pa.int64())), "chunk_idx": pa.array(place, pa.int64()),
                            "chunk": pa.array(chunks, pa.string())})

    spark.udtf.register(name, Splitter)


def global_chunk_ids(chunks: DataFrame, language: str, source: str, doc_key: str,
                     n_blocks: int | None = None, hot_rows: int = skew.HOT_ROWS) -> DataFrame:
    """`chunk_id = {source}_{i}`, where `i` runs over the whole language.

    Documents are ordered by (source, document), chunks by `chunk_idx`. Only per-document
    counts are scanned; chunk text takes part in one join on (language, source, document). The counts
    are checkpointed, so the texts are not chunked again for each use of them.
    """
    rows = chunks.withColumn("_lang", F.struct(language)).withColumn("_doc", F.struct(source, doc_key))  # null is a value here
    counts = cut_lineage(rows.groupBy("_lang", "_doc").agg(F.count(F.lit(1)).alias("n")))
    part = lambda name, c: F.coalesce(c(F.col("_doc")[name]), F.lit(""))
    keyed = counts.withColumn("_key", ranges.sort_key(part(source, lambda c: c), part(doc_key, ranges.padded)))
    offsets = ranges.running_sum(keyed, ["_lang"], "_key", F.col("n"), "_offset",
                                 inclusive=False, n_blocks=n_blocks, hot_rows=hot_rows)
    joined = rows.join(offsets.select("_lang", "_doc", "_offset"), ["_lang", "_doc"]).drop("_lang", "_doc")
    i = F.coalesce(F.col("_offset"), F.lit(0)) + F.col("chunk_idx")
    return joined.withColumn("chunk_id", F.concat_ws("_", F.col(source), i.cast("string"))).drop("_offset")


def with_word_count(chunks: DataFrame, text: str = "chunk") -> DataFrame:
    return chunks.withColumn("n_words", X.word_count(F.col(text)))
