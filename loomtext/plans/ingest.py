"""Corpus ingest: scan, clean, chunk, embed, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loomtext.functions import inference as I
from loomtext.operators import chunking
from loomtext.sources import index


def chunk_documents(docs: DataFrame, size: int = 2048, overlap: int = 200, language: str | None = None) -> DataFrame:
    lang = None if language is None else F.col(language)
    return chunking.recursive_chunks(docs, size, overlap, language=lang)


def ingest(docs: DataFrame, path: str, *, collection: str = "collection", size: int = 2048, overlap: int = 200,
           encoder=None, backend: str = "parquet") -> dict[str, int]:
    """Write the chunks of `docs` (source, text, collection) as an index; returns both counts.

    The counts are observed while the one write job runs; nothing is counted twice.
    """
    seen, made = Observation("documents"), Observation("chunks")
    docs = docs.observe(seen, F.count(F.lit(1)).alias("n"))
    chunks = chunk_documents(docs, size, overlap)
    chunks = index.content_id(chunks, "source", "chunk_idx", "chunk")
    chunks = chunks.withColumn("embedding", (encoder or I.hashed_encoder())(F.col("chunk")))
    chunks = chunks.withColumnRenamed(collection, "collection") if collection != "collection" else chunks
    chunks = chunks.observe(made, F.count(F.lit(1)).alias("n"))
    index.write_collection(chunks, path, backend)
    return {"documents": seen.get["n"], "chunks": made.get["n"]}
