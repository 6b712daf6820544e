"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import threading
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext import session
from loomtext.operators import skew

#: A side of a join is broadcast only when it has been counted and has at most this many rows.
MAX_BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Written(threading.local):
    """(name, path) of the tables that `stored` has written in this thread and nobody discarded."""

    def __init__(self):
        self.tables: list[tuple[str, str]] = []


_WRITTEN = Written()


def written() -> int:
    """A mark for `discard`."""
    return len(_WRITTEN.tables)


def discard(spark: SparkSession, mark: int, keep: tuple[str, ...] = ()) -> None:
    """Remove the tables stored since the mark, but for those named in `keep`. No frame may still need them."""
    for name, path in _WRITTEN.tables[mark:]:
        if name not in keep:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _WRITTEN.tables[mark:] = [x for x in _WRITTEN.tables[mark:] if x[0] in keep]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new table in the shared folder and read it back: computed once, survives lost executors.

    With zstd, a table of texts takes two thirds of the disk it takes with Spark's usual codec.
    """
    spark = df.sparkSession
    path = session.scratch_path(spark, name)
    df.write.parquet(path, compression="zstd")
    _WRITTEN.tables.append((name, path))
    return spark.read.schema(df.schema).parquet(path)


def doc_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; a null text is empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def words(data: bytes) -> list[bytes]:
    """A-Z lower-cased, cut at the bytes 0x20 and 0x09 to 0x0D."""
    return data.lower().split()


def text_blocks(column: pa.Array, n_bytes: int = 8_000_000) -> Iterator[pa.Array]:
    """Slices of a column of bytes, of about `n_bytes` or one text."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + n_bytes, "right")))
        yield column.slice(at, stop - at)
        at = stop


def word_codes(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(different words, number of the word at each place, words of each text) of a column of bytes, cut as `words` does."""
    try:
        body = texts.cast(pa.large_string())
    except pa.ArrowInvalid:  # bytes that are no text
        cut = [t.as_py().lower().split() if lower else t.as_py().split() for t in texts]
        flat = pa.array([w for c in cut for w in c], pa.large_binary()).dictionary_encode()
        return flat.dictionary, flat.indices.to_numpy(), np.array([len(c) for c in cut], np.int64)
    cut = pc.ascii_split_whitespace(body)
    flat, offsets = cut.flatten(), cut.offsets.to_numpy()
    solid = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(solid.to_numpy(zero_copy_only=False))])
    flat = flat.filter(solid)  # an array of its own: Arrow lower-cases slices of a cast column wrongly
    coded = (pc.ascii_lower(flat) if lower else flat).dictionary_encode()
    return coded.dictionary.cast(pa.large_binary()), coded.indices.to_numpy(), np.diff(before[offsets - offsets[0]]).astype(np.int64)


def word_table(texts: pa.Array, lower: bool = True) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The same with the different words as a list."""
    found, index, sizes = word_codes(texts, lower)
    return found.to_pylist(), index, sizes


def tidy(rows: Iterator) -> Iterator:
    """Pass rows on; at the end of a task give back the memory that a reused worker process would keep."""
    try:
        yield from rows
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library


class WordHash(dict):
    """Word -> 64-bit hash, remembered up to a fixed number of words."""

    def __init__(self, limit: int = 300_000, seed: int = 0):
        super().__init__()
        self.limit, self.seed = limit, seed

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word, self.seed)
        if len(self) >= self.limit:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (two multiply-xorshift rounds)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def batches(rows: list[dict], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), size):
        yield pa.RecordBatch.from_pylist(rows[i : i + size], schema=schema)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path inside it for a URI or an absolute path."""
    return pafs.FileSystem.from_uri(uri)


def attempt() -> str:
    """A name no other attempt of any task has, for files written inside tasks."""
    import uuid

    from pyspark import TaskContext

    ctx = TaskContext.get()
    return f"{ctx.partitionId():06d}-{ctx.taskAttemptId()}-{uuid.uuid4().hex[:8]}" if ctx else uuid.uuid4().hex


def lookup(rows: DataFrame, small: DataFrame, key: str, spread: str, rows_bound: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join where one key may hold a large part of `rows`; `small` has unique, stored keys.

    Broadcast if its counted size allows it, else a join that salts hot keys. Null keys find nothing.
    """
    if small.limit(rows_bound + 1).count() <= rows_bound:
        return rows.join(F.broadcast(small), key, "left")
    return skew.skewed_lookup(rows, small, key, spread)
