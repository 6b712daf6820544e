"""Global order without a single sorting task: running sums, ranks and pages over string keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.operators import scan, skew


def sort_key(*cols: Column) -> Column:
    """One string that sorts like the columns: numbers are padded, parts NUL-separated."""
    return F.concat_ws("\u0000", *cols)


def padded(c: Column) -> Column:
    """Integer as a string that sorts like the number, negative ones first."""
    return F.lpad((c.cast("decimal(20,0)") + F.lit(1 << 62) + F.lit(1 << 62)).cast("decimal(20,0)").cast("string"), 20, "0")


def running_sum(df: DataFrame, keys: list[str], order_key: str, value: Column, name: str, *,
                inclusive: bool = True, n_blocks: int | None = None, hot_rows: int = skew.HOT_ROWS,
                counted: DataFrame | None = None, hot: skew.HotKeys | None = None, bits: int = scan.BLOCK_BITS) -> DataFrame:
    """Running sum per group in the order of a unique string key. Only hot groups are sampled and cut.

    `n_blocks` bounds the blocks of each hot group.
    """
    bits = bits if n_blocks is None else 0
    return scan.running(df, keys, order_key, {name: ("sum", value)}, inclusive=inclusive, bits=bits, n_blocks=n_blocks,
                        hot_rows=hot_rows, counted=counted, hot=hot)


def rank(df: DataFrame, keys: list[str], order_key: str, name: str = "rank", n_blocks: int | None = None,
         hot_rows: int = skew.HOT_ROWS, counted: DataFrame | None = None, hot: skew.HotKeys | None = None) -> DataFrame:
    """1-based position of each row in its group."""
    one = F.lit(1).cast("long")
    return running_sum(df, keys, order_key, one, name, n_blocks=n_blocks, hot_rows=hot_rows, counted=counted, hot=hot)


def paged_concat(df: DataFrame, keys: list[str], order_key: str, text: str, *,
                 page_size: int = 64, sep: str = "\n\n", n_blocks: int | None = None,
                 hot_rows: int = skew.HOT_ROWS, hot: skew.HotKeys | None = None) -> DataFrame:
    """Ordered concatenation in pages of at most `page_size` items; NULL texts are dropped.

    Joining the pages of a group in page order with `sep` gives the group's whole text, but no
    row or task ever holds more than one page.
    """
    ranked = rank(df.where(F.col(text).isNotNull()), keys, order_key, "_rank", n_blocks, hot_rows, counted=df, hot=hot)
    paged = ranked.withColumn("page", F.floor((F.col("_rank") - 1) / page_size).cast("long"))
    items = F.array_sort(F.collect_list(F.struct("_rank", F.col(text).alias("t"))))
    return paged.groupBy(*keys, "page").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_join(F.transform(items, lambda x: x["t"]), sep).alias("text"),
    )
