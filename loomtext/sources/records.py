"""Nested record intake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext import schemas
from loomtext.functions import text as X
from loomtext.operators import joins


def summary_map(df: DataFrame, payload: str, keep: list[str] | None = None) -> DataFrame:
    """JSON object of file -> {summary} to rows (file, summary)."""
    parsed = F.from_json(F.col(payload), schemas.SUMMARY_MAP)
    out = df.select(*(keep or []), F.explode(parsed).alias("file", "entry"))
    return out.select(*(keep or []), "file", F.col("entry")["summary"].alias("summary"))


def read_summary_map(spark: SparkSession, path: str) -> DataFrame:
    return summary_map(spark.read.text(path, wholetext=True), "value")


def folder_summaries(folders: DataFrame, important: DataFrame) -> DataFrame:
    """Summaries of all folders, and of the files of important folders; empty ones are dropped.

    `folders` has path, summary, children(path, summary): one row per folder.
    """
    own = folders.select(F.lit("folder").alias("level"), "path", "summary")
    files = joins.restrict_folders(folders, important).select(F.explode("children").alias("c"))
    files = files.select(F.lit("file").alias("level"), F.col("c")["path"].alias("path"), F.col("c")["summary"].alias("summary"))
    return own.unionByName(files).where(X.present(F.col("summary")))


def read_summary_tree(spark: SparkSession, path: str) -> DataFrame:
    """Folder rows of a summary tree file."""
    tree = spark.read.schema(schemas.SUMMARY_TREE).option("multiLine", True).json(path)
    return tree.select(F.explode("children").alias("f")).select("f.*")


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SUBMISSION).option("multiLine", True).json(path)


def flatten_reviews(submissions: DataFrame, keep: list[str] = ("submission_id",)) -> DataFrame:
    """One row per review; a submission without reviews keeps one row of NULLs."""
    return submissions.select(*keep, F.posexplode_outer("reviews").alias("review_idx", "r")).select(
        *keep, F.col("review_idx").cast("long").alias("review_idx"), "r.*"
    )


def parse_submissions(df: DataFrame, payload: Column) -> DataFrame:
    return df.select(F.from_json(payload, schemas.SUBMISSION).alias("s")).select("s.*")
