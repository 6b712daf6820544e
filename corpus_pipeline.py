"""Corpus preparation: drop low quality, near duplicates and benchmark leaks, mix sources, write token files.

Every stage takes any columns next to doc_id, text and source, whatever their names, and all but the last return
them. Nulls and empty texts are ordinary values, a repeated row is a row of its own, and an empty table gives
an empty one; what a stage does with them is said there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext import session
from loomtext.llm import cgk, mixing, nbsvm, queries, setsketch, tokenfile
from loomtext.llm.common import discard, lookup, stored, table, written


def named(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold of the quality query; a score equal to it is enough.

    A null text is scored as an empty one, which has the score of the model's bias. Rows without an id have no label.
    """
    scored = nbsvm.score(docs, queries.learned_model(spark, docs, sf_dir))
    with session.text_batches(spark):
        return stored(scored.where(F.col("score") >= queries.MIN_SCORE).select("_row.*"), "good")


def numbered_rows(docs: DataFrame) -> DataFrame:
    """(_at, _doc): the rows and a number for each, written once: a later scan may be split otherwise and number anew."""
    return stored(docs.select(F.monotonically_increasing_id().alias("_at"), F.struct(*named(docs)).alias("_doc")), "numbered")


def dropped_rows(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents of `numbered_rows` whose number is not in `gone` (row)."""
    marked = lookup(rows, stored(gone.select(F.col("row").alias("_at"), F.lit(True).alias("_gone")), "gone"), "_at", "_at")
    return marked.where(F.col("_gone").isNull()).select("_doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more: that of the smallest id, of equal ids the first read.

    Repeated rows are such a group. Documents without words all stay, and so do all rows of a group without any id.
    """
    rows = numbered_rows(docs)
    mark = written()
    near = stored(setsketch.near_duplicates(rows.select("_at", "_doc.doc_id", "_doc.text"), 80, 100, row="_at"), "near")
    discard(spark, mark, ("near",))
    grouped = near.where("n_shingles > 0 and component_id is not null")
    stays = grouped.where("kept").groupBy("component_id").agg(F.min("row").alias("stays"))
    gone = lookup(grouped.select("component_id", "row"), stored(stays, "stays"), "component_id", "row").where("row != stays")
    return dropped_rows(rows, gone)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, none with a tenth of its words edited either.

    Documents without words hold none. Rows are judged one by one, with or without an id.
    """
    rows = numbered_rows(docs)
    hits = cgk.find_items(rows.select("_at", "_doc.text"), table(spark, sf_dir, "benchmark"), doc_id="_at")
    with session.text_batches(spark):
        return dropped_rows(rows, hits.select(F.col("doc_id").alias("row")).distinct())


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents such that all sources have the same share of the characters, in random order.

    The number of copies depends on the id, so repeated rows get equally many each, and so do all rows without an id.
    Rows without a source are a source.
    """
    return mixing.mix(docs).select("_doc.*")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents; returns what reading them back gives for each.

    A null or empty text is its end id alone; documents are in the order of their ids, null ones first.
    """
    path = queries.tokenizer_path()
    manifest = tokenfile.write_token_files(docs, session.scratch_path(spark, "tokens"), path, queries.END_ID)
    return tokenfile.read_token_files(spark, manifest, tokenfile.encoder(path).dtype)


STAGES = [
    ("quality classifier", quality), ("near-duplicates", near_dedup), ("decontamination", decontaminate),
    ("mixing", mix_sources), ("token files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each one's result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages learn models and write files: no SQL.
ORACLE_SQL = None
