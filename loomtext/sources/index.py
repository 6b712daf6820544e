"""Persisted chunk collections: Parquet or ORC, partitioned by collection and by a hash of the key.

The hash partition (`shard`) of a chunk follows from its key, so an add looks for its keys in the shards
they would be in only. Beside the data every write leaves a membership filter of its keys, in blocks of
bounded size: bits that are set for all keys written and for few others. Keys that the filter does not know
are new, and the index is not read for them. What it may know is looked up in the data, by a pushed-down
list if it is short, else by a join. The filter of an add is stored before its rows, so an add that
fails in between leaves a filter that knows too much, never too little. A whole collection is written
first and its filter made from the keys read back; until then a mark says that the filter does not count.

Files: rows are exchanged once by (collection, shard) before a write, and adaptive execution splits and
merges the pieces by size (`REBALANCE`), so there is about a file for each partition and advisory size.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.operators import joins
from loomtext.session import cut_lineage

BACKENDS = ("parquet", "orc")
SHARDS = 16
#: The membership filter: bits and hash functions per key, keys per block, its folder (not listed with the data).
FILTER_BITS, FILTER_HASHES, BLOCK_KEYS = 10, 7, 26_000
WRITE_ID = r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"
FILTER, PENDING = "_membership", "_membership_pending"
#: Keys that are looked up as a list pushed down to the files; more are joined.
MAX_PUSHED = 1000


def with_shard(chunks: DataFrame, key: str, shards: int = SHARDS) -> DataFrame:
    return chunks.withColumn("shard", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(shards)).cast("int"))


def write_collection(chunks: DataFrame, path: str, backend: str = "parquet", key: str = "chunk_id") -> bool:
    """Write chunks (with vectors) by `collection` and shard; the collections present are replaced whole, others stay."""
    if backend not in BACKENDS:
        raise ValueError(f"unknown index backend: {backend}")
    spark = chunks.sparkSession
    before = _files(spark, path)
    _mark(spark, path, True)
    _write_rows(with_shard(chunks, key), path, key, backend, "overwrite")
    after = _files(spark, path)
    written = {d for d, names in after.items() if names != before.get(d)}
    replaced = {d.rpartition("/")[0] for d in written}
    fs, _ = _file_system(spark, path)
    for d in after.keys() - written:  # a shard that the replaced collection no longer has
        if d.rpartition("/")[0] in replaced:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(d), True)
    stored = existing_keys(chunks, path, key, backend)
    if before and written:  # all files of one write carry its number
        name = next(iter(after[next(iter(written))]))
        stored = stored.where(F.contains(F.col("_metadata.file_name"), F.lit(re.search(WRITE_ID, name)[0])))
    if written:
        _write_filter(stored, path, key)
    _mark(spark, path, False)
    return True


def _files(spark: SparkSession, path: str) -> dict[str, frozenset[str]]:
    """Names of the files in each (collection, shard) folder."""
    fs, place = _file_system(spark, path)
    if not fs.exists(place):
        return {}
    found: dict[str, set[str]] = {}
    for f in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/collection=*/shard=*/*")) or ():
        folder, _, name = f.getPath().toString().rpartition("/")
        found.setdefault(folder, set()).add(name)
    return {d: frozenset(names) for d, names in found.items()}


def _mark(spark: SparkSession, path: str, on: bool) -> None:
    """Say that the filter is behind the data, or that it no longer is."""
    fs, place = _file_system(spark, f"{path}/{PENDING}")
    if on:
        fs.create(place, True).close()
    else:
        fs.delete(place, False)


def _file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return fs.exists(place)


def _write_rows(chunks: DataFrame, path: str, key: str, backend: str, mode: str) -> None:
    """Rows with their shard, sorted so that a key is on one page of a file."""
    placed = chunks.hint("rebalance", "collection", "shard").sortWithinPartitions("collection", "shard", key)
    placed.write.format(backend).mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("collection", "shard").save(path)


def open_collection(spark: SparkSession, path: str, collection: str, backend: str = "parquet") -> DataFrame:
    """One collection; the filter prunes partitions, so other collections are not listed."""
    return spark.read.format(backend).load(path).where(F.col("collection") == collection).drop("shard")


def add_documents(chunks: DataFrame, path: str, key: str = "chunk_id", backend: str = "parquet",
                  finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Append the chunks that are not indexed yet; adding the same chunks again adds nothing.

    `finish` (say, the encoder) runs on the new chunks only, once. The chunks are written down first, as
    their keys and their rows are taken from them.
    """
    spark = chunks.sparkSession
    if not _exists(spark, path):  # an index that does not exist yet is created empty
        with_shard(chunks, key).limit(0).write.format(backend).partitionBy("collection", "shard").save(path)
    incoming = cut_lineage(with_shard(chunks.dropDuplicates([key]), key))
    fresh = joins.add_new(incoming, present_keys(incoming, path, key, backend), key)
    if not fresh.isEmpty():
        _write_filter(fresh.select("shard", key), path, key)
        _write_rows(finish(fresh) if finish else fresh, path, key, backend, "append")
    return spark.read.format(backend).load(path).drop("shard")


def present_keys(incoming: DataFrame, path: str, key: str, backend: str = "parquet") -> DataFrame:
    """The keys of `incoming` (with shards) that the index holds; only shards and pages that may hold one are read."""
    spark = incoming.sparkSession
    maybe = cut_lineage(possible_keys(incoming.select("shard", key), path, key))
    stored = existing_keys(incoming, path, key, backend)
    some = maybe.limit(MAX_PUSHED + 1).collect()
    if len(some) <= MAX_PUSHED:
        shards, keys = sorted({r["shard"] for r in some}), [r[key] for r in some]
        return stored.where(F.col("shard").isin(shards) & F.col(key).isin(keys)).select(key)
    # the condition on the shard makes the side selective, so that its shards prune the partitions at run time
    return stored.join(maybe.where("shard >= 0"), ["shard", key], "left_semi").select(key)


def existing_keys(chunks: DataFrame, path: str, key: str, backend: str = "parquet") -> DataFrame:
    """(key, shard) of all rows of the index, and the files' own columns."""
    names = f"`{key}` {chunks.schema[key].dataType.simpleString()}, collection string, shard int"
    return chunks.sparkSession.read.format(backend).schema(names).load(path).select(key, "shard", "_metadata")


# ---------------------------------------------------------------- membership filter


def _hash(key: str):
    return F.xxhash64(F.col(key).cast("string"), F.lit("member"))


def _places(h: np.ndarray, n_bits: int) -> np.ndarray:
    """Bit numbers of each hash, one row for each hash function."""
    h = h.astype(np.uint64)
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((a[None, :] + np.arange(FILTER_HASHES, dtype=np.uint64)[:, None] * b[None, :]) % np.uint64(n_bits)).astype(np.int64)


def _write_filter(keys: DataFrame, path: str, key: str) -> None:
    """One segment: for each shard as many blocks as its keys need, each built in its own group."""
    keys = keys.select("shard", _hash(key).alias("h"))
    blocks = keys.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK_KEYS).cast("int").alias("n_blocks"))
    placed = keys.join(F.broadcast(blocks), "shard").withColumn("block", F.pmod(F.shiftright("h", 17), F.col("n_blocks")).cast("int"))

    def fill(t: pa.Table) -> pa.Table:
        h = t.column("h").to_numpy()
        bits = np.zeros(-(-len(h) * FILTER_BITS // 64) * 64, bool)
        bits[_places(h, len(bits)).ravel()] = True
        return pa.table({"shard": t.column("shard").slice(0, 1), "n_blocks": t.column("n_blocks").slice(0, 1), "block": t.column("block").slice(0, 1),
                         "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    filled = placed.groupBy("shard", "n_blocks", "block").applyInArrow(fill, "shard int, n_blocks int, block int, bits binary")
    filled.withColumn("segment", F.lit(uuid.uuid4().hex)).write.mode("append").partitionBy("shard").parquet(f"{path}/{FILTER}")


def possible_keys(keys: DataFrame, path: str, key: str) -> DataFrame:
    """Of (shard, key) the rows that the filters of earlier writes may know; all of them if the index has no filter."""
    spark = keys.sparkSession
    if not _exists(spark, f"{path}/{FILTER}") or _exists(spark, f"{path}/{PENDING}"):
        return keys
    shards = [r[0] for r in keys.select("shard").distinct().collect()]
    stored = spark.read.schema("n_blocks int, block int, bits binary, segment string, shard int").parquet(f"{path}/{FILTER}").where(F.col("shard").isin(shards))
    # a row for each shard and write: the filters themselves are not read for it
    segments = F.broadcast(stored.select("shard", "segment", "n_blocks").distinct())
    asked = keys.withColumn("h", _hash(key)).join(segments, "shard").withColumn("block", F.pmod(F.shiftright("h", 17), F.col("n_blocks")).cast("int"))
    asked = asked.select("shard", "segment", "block", key, "h")
    schema = keys.select("shard", key).schema

    def known(left: pa.Table, right: pa.Table) -> pa.Table:
        keep = np.zeros(len(left), bool)
        for data in right.column("bits").to_pylist():
            bits = np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool)
            keep |= bits[_places(left.column("h").to_numpy(), len(bits))].all(axis=0)
        return left.select(["shard", key]).filter(pa.array(keep))

    block = ["shard", "segment", "block"]
    met = asked.groupBy(*block).cogroup(stored.select(*[F.col(c).alias(c) for c in block], "bits").groupBy(*block)).applyInArrow(known, schema)
    return met.dropDuplicates([key])


def content_id(df: DataFrame, *cols: str) -> DataFrame:
    """`chunk_id` from the content, so a changed chunk is a new one and a rescanned one is not."""
    return df.withColumn("chunk_id", F.md5(F.concat_ws("\u0000", *[F.col(c).cast("string") for c in cols])))
