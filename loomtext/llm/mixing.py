"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate such that its expected share of the output is its share of
the weights. A document's number of copies inverts the Poisson distribution of that rate at a number
between 0 and 1 that is a hash of seed and document id, so every run and every partitioning draws the
same copies. Copies are dealt over all partitions by a hash of their own and sorted by it inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import lookup, stored

#: A rate above this is drawn as a sum of equal independent parts: exp(-rate) stays far from underflow.
MAX_PART_RATE = 64.0
#: Steps of the distribution that are kept: beyond them lies less than 2^-60 for any rate up to 64.
STEPS = 170


def hash52(text: Column) -> Column:
    """The first 13 hexadecimal digits of the MD5 sum as a fraction of 2^52: 0 <= u < 1."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def hash60(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def rates(docs: DataFrame, weights: DataFrame | None, size: Column, source: str) -> DataFrame:
    """(`_key`, `_parts`, `_cdf`): the cumulative Poisson distribution of one part of each source's rate."""
    sizes = docs.groupBy(F.struct(F.col(source)).alias("_key")).agg(F.sum(size).cast("double").alias("_size"))
    if weights is None:
        sizes = sizes.withColumn("_w", F.lit(1.0))
    else:
        w = weights.groupBy(F.struct(F.col(source)).alias("_key")).agg(F.sum("weight").cast("double").alias("_w"))
        sizes = sizes.join(w, "_key", "left").fillna(0.0, ["_w"])
    sizes = stored(sizes, "mix-sizes")
    all_weight, all_size = sizes.agg(F.sum("_w"), F.sum("_size")).first()
    share = F.col("_w") / F.lit(all_weight or 1.0) * F.lit(all_size or 0.0)
    rate = F.when(F.col("_w") > 0, share / F.col("_size")).otherwise(F.lit(0.0))
    one = sizes.select("_key", rate.alias("_rate"))
    one = one.withColumn("_parts", F.greatest(F.lit(1), F.ceil(F.col("_rate") / MAX_PART_RATE)).cast("int"))
    part = F.col("_rate") / F.col("_parts")

    def step(state, k):
        p = state["p"] * part / k
        c = state["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(state["all"], F.array(c)).alias("all"))

    first = F.exp(-part)
    start = F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("all"))
    cdf = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)["all"]
    return one.select("_key", "_parts", cdf.alias("_cdf"))


def copies(parts: Column, cdf: Column, ident: Column, seed: str) -> Column:
    """Number of copies: for each part, how many steps of the distribution lie at or below the hash."""
    def draw(part):
        u = hash52(F.concat(F.lit(f"{seed}:"), part.cast("string"), F.lit(":"), ident))
        return F.size(F.filter(cdf, lambda c: c <= u))

    return F.aggregate(F.transform(F.sequence(F.lit(1), parts), draw), F.lit(0), lambda a, n: a + n)


def mix(docs: DataFrame, weights: DataFrame | None = None, seed: str = "mix", source: str = "source",
        doc_id: str = "doc_id", size: Column | None = None) -> DataFrame:
    """`_doc` (the whole row as a struct), `_copy` (from 1), `_copies`, `_order`: shuffled copies.

    `weights` has `source` and `weight` (default: all sources weigh the same); a source that is not in
    it has weight 0 and gets no copies. `size` is what the weights are shares of, by default the
    characters of `text` plus one. A null source is a source of its own. A null id draws like the
    empty text; rows with the same id draw alike and are copied each. An empty table gives no rows.
    The row travels as a struct, so its columns may have any names.
    """
    size = F.length(F.coalesce(F.col("text"), F.lit(""))) + 1 if size is None else size
    table = stored(rates(docs, weights, size, source), "mix-rates")
    ident = F.coalesce(F.col("_doc")[doc_id].cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    rows = rows.withColumn("_key", F.struct(F.col("_doc")[source].alias(source)))
    spread = rows.withColumn("_id", F.xxhash64(ident))
    drawn = lookup(spread, table, "_key", "_id")
    drawn = drawn.withColumn("_copies", copies(F.col("_parts"), F.col("_cdf"), ident, seed)).where("_copies > 0")
    drawn = drawn.select("_doc", "_copies", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))
    order = hash60(F.concat(F.lit(f"{seed}:order:"), ident, F.lit(":"), F.col("_copy").cast("string")))
    return drawn.withColumn("_order", order).repartition("_order").sortWithinPartitions("_order")
