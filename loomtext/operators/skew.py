"""Hot keys: found once per table, handed to every operator, and split.

A key is hot when it holds more rows than one task should take. `find` counts the rows, which ends the
search for most tables. Larger ones take one pass that keeps a mergeable heavy-hitter summary of
the key hashes in every task, and an exact count of the few keys it names. No shuffle of all
keys is needed. The summary surely names a key that holds more than about four rows in `TRACKED`
of the table; a hot key with a smaller share may stay whole, which costs time but no row.

`HotKeys` has at most one entry in `HOT_ROWS` rows of the table, so it may be broadcast. It is a
plain value: find it once for a table and key, and hand it to all operators on that table. A null
key is a key like others.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 5_000_000
#: Entries of the heavy-hitter summary of each task.
TRACKED = 65_536
#: Rows without a key are spread over so many places of a join.
NULL_SALTS = 1 << 20


@dataclass(frozen=True)
class HotKeys:
    """The hot keys of a table with their numbers of rows."""

    fields: tuple[T.StructField, ...]
    rows: tuple[tuple, ...]
    hot_rows: int

    def __bool__(self) -> bool:
        return bool(self.rows)

    def frame(self, spark: SparkSession, names: list[str]) -> DataFrame:
        """`names`, `_n`, `_splits` (how many tasks' worth of rows) and `_hot` (a number) of each key; to be broadcast."""
        schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, self.fields)] + [T.StructField("_n", T.LongType()), T.StructField("_hot", T.IntegerType())])
        made = spark.createDataFrame([(*r, i) for i, r in enumerate(self.rows)], schema)
        return F.broadcast(made.withColumn("_splits", F.ceil(F.col("_n") / self.hot_rows).cast("int")))


def find(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, tracked: int = TRACKED) -> HotKeys:
    """The keys of more than `hot_rows` rows, see the module."""
    fields = tuple(df.schema[k] for k in keys)
    if df.count() <= hot_rows:
        return HotKeys(fields, (), hot_rows)
    item = F.xxhash64(*keys)
    top = df.select(item.alias("_item")).agg(F.expr(f"approx_top_k(_item, {tracked}, {tracked})").alias("top")).first()["top"]
    named = [r["item"] for r in top or [] if r["count"] > hot_rows]
    if not named:
        return HotKeys(fields, (), hot_rows)
    counts = df.where(item.isin(named)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    return HotKeys(fields, tuple(sorted((tuple(r) for r in counts.collect()), key=repr)), hot_rows)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(keys, `_splits`) of the hot keys as a table."""
    return find(df, keys, hot_rows).frame(df.sparkSession, keys).select(*keys, "_splits")


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys, null equal to null; the keys of `left` stay."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def tagged(df: DataFrame, keys: list[str], hot: HotKeys) -> DataFrame:
    """Adds `_hot`, `_n` and `_splits`, null for ordinary keys."""
    return join_on(df, hot.frame(df.sparkSession, keys), keys, "left")


def skewed_lookup(rows: DataFrame, lookup: DataFrame, key: str, spread: str, how: str = "left",
                  hot_rows: int = HOT_ROWS, hot: HotKeys | None = None) -> DataFrame:
    """Equi join where one key may hold a large part of `rows`; `lookup` has unique keys.

    The rows of hot keys are salted by the hash of `spread`, and only their lookup rows are
    repeated. Rows without a key find nothing; in a left join they are spread over the tasks by
    the same hash, so they don't meet in one of them. `hot` is found on `rows` if it is not handed over.
    """
    hot = find(rows.where(F.col(key).isNotNull()), [key], hot_rows) if hot is None else hot

    def salt(n: Column) -> Column:
        return F.pmod(F.xxhash64(spread), n).cast("int")

    without_key = F.when(F.col(key).isNull(), salt(F.lit(NULL_SALTS))) if how == "left" else F.when(F.lit(False), F.lit(0))
    if not hot:
        left = rows.withColumn("_salt", without_key.otherwise(F.lit(0)))
        return left.join(lookup.withColumn("_salt", F.lit(0)), [key, "_salt"], how).drop("_salt")
    n = F.coalesce(F.col("_splits"), F.lit(1))
    left = tagged(rows, [key], hot).withColumn("_salt", without_key.otherwise(salt(n))).drop("_splits", "_n", "_hot")
    right = tagged(lookup, [key], hot).withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("_splits", "_n", "_hot")
    return left.join(right, [key, "_salt"], how).drop("_salt")
