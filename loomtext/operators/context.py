"""Context assembly from ranked chunks. A question has at most k chunks, so lists are bounded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions import text as X

LAYOUTS = ("joined", "blocks", "bare", "leading")


def _ordered(rank: str, *cols: str) -> Column:
    return F.array_sort(F.collect_list(F.struct(F.col(rank).alias("rank"), *[F.col(c) for c in cols])))


def layout_context(items: Column, layout: str, text: str = "text", source: str = "source") -> Column:
    """Render an ordered array of chunk structs.

    `joined`: texts separated by a blank line; `blocks`: content and metadata blocks;
    `bare`: plain concatenation; `leading`: a blank line before each text.
    """
    if layout == "joined":
        return F.array_join(F.transform(items, lambda x: x[text]), "\n\n")
    if layout == "bare":
        return F.array_join(F.transform(items, lambda x: x[text]), "")
    if layout == "leading":
        return F.array_join(F.transform(items, lambda x: F.concat(F.lit("\n\n"), x[text])), "")
    if layout == "blocks":
        return F.array_join(F.transform(items, lambda x: F.concat(
            F.lit("\n\nChunk Content: "), x[text], F.lit("\nMetadata: "),
            X.metadata_json(source=x[source]), F.lit("\n"))), "")
    raise ValueError(f"unknown layout: {layout}")


def assemble(ranked: DataFrame, keys: list[str], layout: str = "joined", *, rank: str = "rank",
             text: str = "text", source: str = "source") -> DataFrame:
    """One row per question: `context`, the `sources` in rank order and counts."""
    items = ranked.groupBy(*keys).agg(_ordered(rank, text, source).alias("_items"))
    sources = F.filter(F.transform("_items", lambda x: x[source]), lambda s: s.isNotNull())
    return items.select(
        *keys,
        layout_context(F.col("_items"), layout, text, source).alias("context"),
        sources.alias("sources"),
        F.size("_items").cast("long").alias("n_docs"),
    )


def source_report(ranked: DataFrame, keys: list[str], *, rank: str = "rank", source: str = "source") -> DataFrame:
    """Sources in rank order, their number, the number of chunks, and up to 3 distinct ones."""
    return assemble(ranked.withColumn("_t", F.lit("")), keys, "bare", rank=rank, text="_t", source=source).select(
        *keys, "sources", F.size("sources").cast("long").alias("n_sources"), "n_docs",
        X.distinct_prefix(F.col("sources"), 3).alias("cited"),
    )


def prompts(contexts: DataFrame, questions: DataFrame, qid: str, question: str, template: str) -> DataFrame:
    """Fill the template's `{question}` and `{context}` for every question; without hits the context is empty."""
    both = questions.join(contexts, qid, "left").withColumn("context", F.coalesce("context", F.lit("")))
    return both.withColumn("prompt", X.render(template, question=F.col(question), context=F.col("context")))


def code_context(snippets: DataFrame, neighbours: DataFrame, current: DataFrame, qid: str,
                 *, cut: int = 500) -> DataFrame:
    """Context pieces for code questions, ordered by (question, part, piece).

    Part 0 holds the ranked snippets (cut, always with dots), part 1 the pages of graph
    neighbours of the question's current file. `neighbours` has (file, page, text) rows, so a
    file with very many neighbours is several rows and never one.
    """
    found = snippets.select(
        qid, F.lit(0).alias("part"), F.col("rank").cast("long").alias("piece"),
        F.concat(F.lit("File: "), F.col("source"), F.lit("\nContent:\n"),
                 X.preview(F.col("text"), cut, always=True), F.lit("\n\n")).alias("text"),
    )
    related = current.join(neighbours, "file").select(
        qid, F.lit(1).alias("part"), F.col("page").alias("piece"),
        F.concat(F.lit("Current File: "), F.col("file"), F.lit(" is connected to: "), F.col("text"),
                 F.lit("\n")).alias("text"),
    )
    return found.unionByName(related)
