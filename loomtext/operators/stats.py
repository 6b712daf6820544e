"""Roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions import guards as G


def chunk_statistics(chunks: DataFrame, language: str = "language", n_words: str = "n_words") -> DataFrame:
    """Count, mean, min and max words per language and overall (`overall` = 1)."""
    c = F.col(n_words)
    return chunks.rollup(language).agg(
        F.grouping(language).cast("int").alias("overall"),
        F.count(F.lit(1)).alias("n_chunks"), F.round(F.avg(c), 6).alias("avg_words"),
        F.min(c).alias("min_words"), F.max(c).alias("max_words"),
    )


def quality_means(frames: DataFrame, key: str, score: Column) -> DataFrame:
    """Mean over the successful scores, total over all frames, message when none succeeded."""
    out = frames.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_frames"), F.count(score).alias("scored_frames"),
        F.round(F.avg(score), 4).alias("mean_score"),
    )
    msg = F.when(F.col("scored_frames") == 0, "failed on all frames").otherwise("ok")
    return out.withColumn("message", msg)


def irrelevant_flag(graded: DataFrame, key: str, relevant: Column) -> DataFrame:
    return graded.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_graded"), F.count_if(relevant).alias("n_relevant"),
        F.bool_or(~relevant).alias("any_irrelevant"),
    )


def message_counts(messages: DataFrame, key: str) -> DataFrame:
    return messages.groupBy(key).agg(F.count(F.lit(1)).alias("n_messages"))


def thread_risk(guarded: DataFrame, key: str) -> DataFrame:
    """Number of blocks and worst risk per thread."""
    return guarded.groupBy(key).agg(
        F.sum("n_blocks").cast("long").alias("n_blocks"),
        G.severity_name(F.max(G.severity(F.col("risk")))).alias("risk"),
    )


def review_scores(submissions: DataFrame) -> DataFrame:
    """Mean rating and confidence per submission, computed inside the row."""
    def mean(field: str) -> Column:
        vals = F.filter(F.transform("reviews", lambda r: r[field]), lambda v: v.isNotNull())
        total = F.aggregate(vals, F.lit(0.0), lambda a, v: a + v)
        return F.round(F.try_divide(total, F.size(vals).cast("double")), 6)

    return submissions.select(
        "submission_id", F.size("reviews").cast("long").alias("n_reviews"),
        mean("rating").alias("mean_rating"), mean("confidence").alias("mean_confidence"),
    )
