"""Joins: enrichment, dispatch, anti-join adds, review decisions, pairing, as-of lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.functions.inference import TOOLS, Tool
from loomtext.operators import scan, skew

def enrich(docs: DataFrame, summaries: DataFrame, key: str, spread: str,
           hot_rows: int = skew.HOT_ROWS, hot: skew.HotKeys | None = None) -> DataFrame:
    """Left join with one summary per key; documents without a summary keep NULLs."""
    return skew.skewed_lookup(docs, summaries, key, spread, "left", hot_rows, hot)


def dispatch_tools(calls: DataFrame, tools: dict[str, Tool] | None = None, *, name: str = "name",
                   args: str = "args") -> DataFrame:
    """Run each call by its registered expression; unknown names are told to retry.

    The left join with the registry is a `when` chain, since the registry is code.
    """
    out = None
    for tool in (tools or TOOLS).values():
        cond, value = F.col(name) == tool.name, tool.fn(F.col(args))
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return calls.withColumn("content", out.otherwise("bad tool name, retry"))


def add_new(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of `incoming` whose (unique) key is not in the index yet."""
    return incoming.join(existing.select(key), key, "left_anti")


def review_outcome(pending: DataFrame, decisions: DataFrame, key: str, *, args: str = "args") -> DataFrame:
    """accept -> original arguments, edit -> edited ones, response -> the reviewer's text;
    any other type is an error, no decision leaves the item pending."""
    d = decisions.select(key, F.col("type").alias("decision"), F.col("args").alias("_new"))
    kind = F.col("decision")
    return pending.join(d, key, "left").withColumn(
        "status",
        F.when(kind.isNull(), "pending").when(kind.isin("accept", "edit", "response"), kind).otherwise("error"),
    ).withColumn(
        "result",
        F.when(kind == "accept", F.concat(F.lit("executed: "), F.col(args)))
        .when(kind == "edit", F.concat(F.lit("executed: "), F.col("_new")))
        .when(kind == "response", F.col("_new")),
    ).drop("_new")


def restrict_folders(folders: DataFrame, important: DataFrame, path: str = "path") -> DataFrame:
    """Left semi join on the last path segment. `important` is the caller's short name list."""
    seg = F.substring_index(F.col(path), "/", -1)
    names = important.select(F.col("name").alias("_name"))
    return folders.join(names, seg == F.col("_name"), "left_semi")


def pair_results(calls: DataFrame, results: DataFrame, call_id: str = "call_id") -> DataFrame:
    """Full outer pairing of calls and results: `paired`, `unanswered` or `orphan`."""
    left = calls.withColumn("_c", F.lit(True))
    right = results.withColumn("_r", F.lit(True))
    return left.join(right, call_id, "full_outer").withColumn(
        "pairing",
        F.when(F.col("_c").isNull(), "orphan").when(F.col("_r").isNull(), "unanswered").otherwise("paired"),
    ).drop("_c", "_r")


def state_as_of(checkpoints: DataFrame, key: str, step: str, at: int, state: list[str]) -> DataFrame:
    """Latest state per thread at or before step `at`: an aggregation, no sort."""
    best = F.max_by(F.struct(step, *state), F.col(step)).alias("_s")
    return checkpoints.where(F.col(step) <= at).groupBy(key).agg(best).select(key, "_s.*")


def state_as_of_points(checkpoints: DataFrame, points: DataFrame, key: str, step: str, at: str, state: list[str],
                       hot: skew.HotKeys | None = None, bits: int = scan.BLOCK_BITS) -> DataFrame:
    """Each row of `points` with the newest checkpoint of its thread at or before its own `at`.

    Both tables are put into one order of places, a checkpoint before the points of the same step, and
    every point takes the last checkpoint so far: one shuffle, and a hot thread is cut into blocks.
    A point before the first checkpoint has a null step and state, and so has one without a place. Steps are
    integers below 2^62. `points` keeps all its columns and repeated rows. Of checkpoints that share a
    thread and step the one with the greatest state counts.
    """
    seen = checkpoints.where(F.col(step).isNotNull()).select(
        F.col(key).alias("_key"), (F.col(step).cast("long") * 2).alias("_pos"), F.struct(F.col(step).alias("s"), F.struct(*state).alias("v")).alias("_seen"))
    asked = points.select(F.col(key).alias("_key"), (F.col(at).cast("long") * 2 + 1).alias("_pos"), F.struct(*points.columns).alias("_point"))
    both = seen.unionByName(asked, allowMissingColumns=True)
    if hot is not None:
        hot = skew.HotKeys(tuple(both.schema["_key"] for _ in hot.fields), hot.rows, hot.hot_rows)
    out = scan.running(both, ["_key"], "_pos", {"_last": ("max", F.col("_seen"))}, hot=hot, bits=bits).where(F.col("_point").isNotNull())
    known = F.when(F.col("_pos").isNotNull(), F.col("_last"))
    return out.select("_point.*", known["s"].alias(step), *[known["v"][c].alias(c) for c in state])
