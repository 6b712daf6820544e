"""Critic and revise loop over a table of drafts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.session import cut_lineage

MAX_RETRIES = 3


def revise_loop(drafts: DataFrame, critic: Callable[[Column], Column], reviser: Callable[[Column, Column], Column],
                *, human: str | None = None, max_attempts: int = MAX_RETRIES, checkpoint: bool = True) -> DataFrame:
    """Revise each draft until the critic has no feedback or the attempts are used up.

    `critic(draft)` gives feedback text or NULL; `reviser(draft, feedback)` a new draft. The
    first draft counts as one attempt. `human` names a column with a reviewer's feedback: it
    comes before the critic's, is used once after the critic's rounds, resets the counter and
    starts a second series of rounds. `approved` and NULL end the loop.
    """
    human_text = F.lit(None).cast("string") if human is None else F.col(human)
    state = drafts.withColumn("human_feedback", F.when(human_text != "approved", human_text))
    state = state.withColumn("attempts", F.lit(1)).withColumn("total_revisions", F.lit(0))
    first = _rounds(state, critic, reviser, max_attempts, 1, checkpoint)
    if human is None:
        return _report(first)
    waiting = first.where(F.col("human_feedback").isNotNull())
    # the reviewer's revision itself starts the new count at zero
    reworked = waiting.withColumn("draft", reviser(F.col("draft"), F.col("human_feedback"))).withColumn(
        "total_revisions", F.col("total_revisions") + 1
    ).withColumn("attempts", F.lit(0)).withColumn("human_feedback", F.lit(None).cast("string"))
    second = _rounds(reworked.drop("feedback"), critic, reviser, max_attempts, 0, checkpoint)
    return _report(first.where(F.col("human_feedback").isNull()).unionByName(second))


def _rounds(state: DataFrame, critic, reviser, max_attempts: int, start: int, checkpoint: bool) -> DataFrame:
    done = []
    for i in range(start, max_attempts + 1):
        judged = state.withColumn("feedback", critic(F.col("draft")))
        if checkpoint and i < max_attempts:
            judged = cut_lineage(judged)
        stop = F.col("feedback").isNull() | (F.col("attempts") >= max_attempts)
        done.append(judged.where(stop))
        state = judged.where(~stop).withColumn("draft", reviser(F.col("draft"), F.col("feedback"))).withColumn(
            "attempts", F.col("attempts") + 1
        ).withColumn("total_revisions", F.col("total_revisions") + 1).drop("feedback")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _report(df: DataFrame) -> DataFrame:
    return df.withColumn("satisfied", F.col("feedback").isNull()).drop("human_feedback", "feedback")
