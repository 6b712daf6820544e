"""Running and whole-group aggregates that do not put a hot group into one task.

A window over a thread sorts the whole thread in one task. That is right for ordinary threads
and wrong for one that holds a third of all rows. So hot groups (see `skew`), and only those,
are cut into blocks of about equally many rows in the order of the position, at quantiles of a sample
of the group: (1) the blocks of hot groups are summarised with a map-side combine, (2) a window
over the short block summaries gives each block its carry, (3) every row combines its block's
carry with a window inside (group, block). Ordinary groups are one block without a carry. Rows are
shuffled once, on (group, block). A table without hot groups takes a plain window.

However positions are spread, a block holds about 2^bits rows (the sample has `SAMPLE_PER_BLOCK` rows for each, so
twice as many is rare), and a group as many summaries as blocks. `MAX_CUTS` bounds the blocks of all groups together:
beyond, blocks grow.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.operators import skew

BLOCK_BITS = 20  # about a million rows per block
SAMPLE_PER_BLOCK = 64
MAX_CUTS = 200_000
#: Strings that separate blocks are cut to so many characters: any string may separate.
CUT_CHARS = 256
BLK = "_blk"

#: name -> (kind, expression); kind is "sum", "min" or "max".
Aggs = dict[str, tuple[str, Column]]


def block_id(pos: Column, bits: int = BLOCK_BITS) -> Column:
    """Floor division of an integer position by 2^bits."""
    return F.shiftright(pos.cast("long"), bits)


def fold(kind: str, c: Column) -> Column:
    return {"sum": F.sum, "min": F.min, "max": F.max}[kind](c)


def combine(kind: str, a: Column, b: Column) -> Column:
    if kind == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    pick = F.least if kind == "min" else F.greatest
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(pick(a, b))


def with_args(df: DataFrame, aggs: Aggs) -> tuple[DataFrame, Aggs]:
    """Rows with the argument expressions as columns, evaluated once before any split."""
    rows = df.select("*", *[e.alias(f"_a_{n}") for n, (_, e) in aggs.items()])
    return rows, {n: (k, F.col(f"_a_{n}")) for n, (k, _) in aggs.items()}


def cut_points(df: DataFrame, keys: list[str], pos: str, hot: skew.HotKeys, bits: int, n_blocks: int | None) -> dict[int, list]:
    """For each hot key (by its number) the sorted positions that separate its blocks.

    They come from a sample by hash of the group's rows. They only set the balance; results do not depend on them.
    """
    total = sum(r[-1] for r in hot.rows)
    size = max(1 << bits, -(-total // MAX_CUTS))
    wanted = F.ceil(F.col("_n") / size).cast("int")
    wanted = wanted if n_blocks is None else F.least(wanted, F.lit(n_blocks))
    at = F.substring(pos, 1, CUT_CHARS) if isinstance(df.schema[pos].dataType, T.StringType) else F.col(pos)
    part = F.shiftrightunsigned(F.xxhash64(*keys, pos), 2) / F.lit(float(1 << 62))
    sample = skew.join_on(df.select(*keys, pos), hot.frame(df.sparkSession, keys), keys, "inner").where(F.col(pos).isNotNull())
    sample = sample.withColumn("_b", wanted).where(F.col("_b") > 1).where(part <= F.col("_b") * SAMPLE_PER_BLOCK / F.col("_n"))
    sample = sample.select("_hot", "_b", at.alias("_p"))
    group = Window.partitionBy("_hot")
    placed = sample.withColumn("_i", F.row_number().over(group.orderBy("_p"))).withColumn("_all", F.count(F.lit(1)).over(group))
    tile = F.floor((F.col("_i") - 1) * F.col("_b") / F.col("_all"))
    cuts = placed.groupBy("_hot", tile.alias("_t")).agg(F.min("_p").alias("_p")).where("_t > 0").toArrow()
    out: dict[int, list] = {}
    for key, p in zip(cuts.column("_hot").to_pylist(), cuts.column("_p").to_pylist()):
        out.setdefault(key, []).append(p)
    return {k: sorted(set(v)) for k, v in out.items()}


def place(df: DataFrame, keys: list[str], pos: str, hot: skew.HotKeys, bits: int = BLOCK_BITS, n_blocks: int | None = None) -> DataFrame:
    """Adds `_hot` (the number of a hot key, else null) and `_blk`: the row's block in a hot group, 0 in every other.

    The block grows with the position; a null position is in the first block.
    """
    cuts = cut_points(df, keys, pos, hot, bits, n_blocks)

    @F.arrow_udf("long")
    def block(number: pa.Array, position: pa.Array) -> pa.Array:
        places = zip(number.to_pylist(), position.to_pylist())
        return pa.array([bisect.bisect_right(cuts.get(k, ()), p) if k is not None and p is not None else 0 for k, p in places], pa.int64())

    return skew.tagged(df, keys, hot).drop("_n", "_splits").withColumn(BLK, block(F.col("_hot"), F.col(pos)) if cuts else F.lit(0).cast("long"))


def running(df: DataFrame, keys: list[str], pos: str, aggs: Aggs, *, inclusive: bool = True, reverse: bool = False,
            bits: int = BLOCK_BITS, n_blocks: int | None = None, hot_rows: int = skew.HOT_ROWS, counted: DataFrame | None = None,
            hot: skew.HotKeys | None = None) -> DataFrame:
    """Add running aggregates per group in the order of the column `pos`.

    `hot` are the hot keys if they are known. Otherwise they are found on `counted`, a cheaper frame with
    at least the rows of `df` per key, or on `df`.
    """
    hot = skew.find(df if counted is None else counted, keys, hot_rows) if hot is None else hot
    rows, args = with_args(df, aggs)
    frame = (Window.unboundedPreceding, 0 if inclusive else -1)
    order = F.col(pos).desc() if reverse else F.col(pos).asc()
    if not hot:
        inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(*frame)
        whole = {n: fold(k, e).over(inside) for n, (k, e) in args.items()}
        return rows.select(*df.columns, *[(F.coalesce(c, F.lit(0)) if args[n][0] == "sum" else c).alias(n) for n, c in whole.items()])
    rows = place(rows, keys, pos, hot, bits, n_blocks)
    blocks = rows.where(F.col("_hot").isNotNull()).groupBy("_hot", BLK).agg(*[fold(k, e).alias(n) for n, (k, e) in args.items()])
    before = Window.partitionBy("_hot").orderBy(F.col(BLK).desc() if reverse else F.col(BLK).asc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select("_hot", BLK, *[fold(k, F.col(n)).over(before).alias(f"_c_{n}") for n, (k, _) in args.items()])
    inside = Window.partitionBy(*keys, BLK).orderBy(order).rowsBetween(*frame)
    joined = rows.join(F.broadcast(carry), ["_hot", BLK], "left")  # at most MAX_CUTS rows and one per hot key
    return joined.select(*df.columns, *[combine(k, fold(k, e).over(inside), F.col(f"_c_{n}")).alias(n) for n, (k, e) in args.items()])


def group_totals(df: DataFrame, keys: list[str], block: Column, aggs: Aggs,
                 hot_rows: int = skew.HOT_ROWS, hot: skew.HotKeys | None = None) -> DataFrame:
    """Add whole-group aggregates to every row.

    Ordinary groups use a window; a hot group's total is aggregated with a map-side combine and
    broadcast (at most one row per hot key) to its rows, which `block` keeps spread.
    """
    hot = skew.find(df, keys, hot_rows) if hot is None else hot
    rows, args = with_args(df, aggs)
    if not hot:
        group = Window.partitionBy(*keys)
        return rows.select(*df.columns, *[fold(k, e).over(group).alias(n) for n, (k, e) in args.items()])
    rows = skew.tagged(rows, keys, hot).withColumn(BLK, F.when(F.col("_hot").isNotNull(), block.cast("long")).otherwise(F.lit(0).cast("long")))
    totals = rows.where(F.col("_hot").isNotNull()).groupBy("_hot").agg(*[fold(k, e).alias(f"_t_{n}") for n, (k, e) in args.items()])
    group = Window.partitionBy(*keys, BLK)
    joined = rows.join(F.broadcast(totals), "_hot", "left")
    return joined.select(
        *df.columns,
        *[F.when(F.col("_hot").isNotNull(), F.col(f"_t_{n}")).otherwise(fold(k, e).over(group)).alias(n) for n, (k, e) in args.items()],
    )
