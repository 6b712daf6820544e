"""Top-k similarity search.

Distances are computed as matrix products over Arrow batches; a task emits at most `k`
candidates per question and batch of the corpus, so neither all pairs nor a whole bucket is
ever materialised. Four ways, chosen by the data:

* few questions (size checked): they are broadcast, the corpus is scanned in place;
* many questions, few corpus rows (size checked): the corpus is broadcast, the questions stay in place;
* many of both: the corpus is written by cells of near vectors, and blocks of questions read those
  cells that their k-th distances so far do not rule out (`cells`);
* approximate: both sides carry a hash code, the corpus is written by code, and only probed codes are read.

Ranks follow (rounded distance, corpus id), so equal vectors rank by id.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.session import cut_lineage, scratch_path

MAX_BROADCAST_QUESTIONS = 8192  # the same bound holds for a corpus
MAX_BROADCAST_CELLS = 16_000_000  # numbers in the matrix that is broadcast, 128 MB
QUESTION_BLOCK = 16384
CORPUS_BLOCK = 65536
_TILE_CELLS = 4_000_000
#: Pairs that are scored exactly at once, rows of a stored cell that are read at once, questions that a task takes at least.
_PAIRS, SCAN_ROWS, MIN_TASK_QUESTIONS = 65_536, 8192, 256
#: Codes of more bits are not stored in folders of their own.
MAX_FOLDER_BITS = 12
DIGITS = 10  # significant digits of a distance that decide ranks; closer ones are ties


def matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 1)


def _scores(q: np.ndarray, c: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """(score, error bound) of all pairs by one product; smaller is nearer: squared distance, or negated cosine."""
    dot = q @ c.T
    qq, cc = (q * q).sum(1), (c * c).sum(1)
    if metric == "cosine":
        scale = np.sqrt(np.outer(np.where(qq > 0, qq, 1.0), np.where(cc > 0, cc, 1.0)))
        return -dot / scale, np.full(len(q), 1e-9)
    return qq[:, None] + cc[None, :] - 2.0 * dot, 1e-12 * (qq + (cc.max() if len(cc) else 0.0))


def _exact(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Scores of matching rows from their own differences: right for short and for long vectors."""
    if metric == "cosine":
        scale = np.linalg.norm(q, axis=1) * np.linalg.norm(c, axis=1)
        return np.round(-np.einsum("ij,ij->i", q, c) / np.where(scale > 0, scale, 1.0), DIGITS - 1) + 0.0
    gap = q - c
    d = np.einsum("ij,ij->i", gap, gap)
    noise = 1e-28 * (np.einsum("ij,ij->i", q, q) + np.einsum("ij,ij->i", c, c))  # rounding of equal vectors
    d = np.where(d <= noise, 0.0, d)
    unit = 10.0 ** (np.floor(np.log10(np.where(d > 0, d, 1.0))) - (DIGITS - 1))
    return np.round(d / unit) * unit


def _smallest(row: np.ndarray, score: np.ndarray, cid: np.ndarray, k: int):
    """The `k` entries per row that come first by (score, id)."""
    order = np.lexsort((cid, score, row))
    row, score, cid = row[order], score[order], cid[order]
    start = np.searchsorted(row, row, side="left")
    keep = np.arange(len(row)) - start < k
    return row[keep], score[keep], cid[keep]


def _block_topk(q: np.ndarray, c: np.ndarray, cid: np.ndarray, k: int, metric: str):
    """Top-k of one question block against one corpus block: (question row, score, corpus id)."""
    tile = max(1, _TILE_CELLS // max(1, len(c)))
    rows, scores, ids = [], [], []
    for a in range(0, len(q), tile):
        d, error = _scores(q[a:a + tile], c, metric)
        if d.shape[1] > k:
            bound = np.partition(d, k - 1, axis=1)[:, k - 1:k] + 2 * error[:, None]
            r, col = np.nonzero(d <= bound)
        else:
            r, col = np.indices(d.shape).reshape(2, -1)
        r, s, i = _smallest(r, _exact(q[a:a + tile][r], c[col], metric), cid[col], k)
        rows.append(r + a)
        scores.append(s)
        ids.append(i)
    return np.concatenate(rows), np.concatenate(scores), np.concatenate(ids)


def final(cands: DataFrame, qid: str, cid: str, k: int, metric: str) -> DataFrame:
    w = Window.partitionBy(qid).orderBy("score", cid)
    ranked = cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    ranked = ranked.withColumn("rank", F.col("rank").cast("long"))
    if metric == "cosine":
        return ranked.select(qid, cid, "rank", (-F.col("score")).alias("similarity"))
    return ranked.select(qid, cid, "rank", F.col("score").alias("distance"))


def out_schema(q: DataFrame, c: DataFrame, qid: str, cid: str) -> T.StructType:
    return T.StructType([
        T.StructField(qid, q.schema[qid].dataType),
        T.StructField(cid, c.schema[cid].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def _broadcast_search(head: list, corpus: DataFrame, schema: T.StructType, qid: str, cid: str,
                      vec: str, k: int, metric: str) -> DataFrame:
    ids = np.array([r[0] for r in head])
    mat = np.array([r[1] for r in head], dtype=np.float64).reshape(len(head), -1)
    shared = corpus.sparkSession.sparkContext.broadcast((ids, mat))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, q = shared.value
        best = None
        for b in batches:
            if not b.num_rows or not len(qids):
                continue
            c_ids = b.column(cid).to_numpy(zero_copy_only=False)
            if c_ids.dtype == object:
                c_ids = c_ids.astype(str)
            got = _block_topk(q, matrix(b.column(vec)), c_ids, k, metric)
            if best is not None:
                got = _smallest(*[np.concatenate(p) for p in zip(best, got)], k)
            best = got
        if best is not None:
            row, score, c_ids = best
            yield pa.RecordBatch.from_arrays(
                [pa.array(qids[row]), pa.array(c_ids), pa.array(score)], names=[qid, cid, "score"]
            )

    return corpus.select(cid, vec).where(F.col(vec).isNotNull()).mapInArrow(search, schema)


def _broadcast_corpus_search(questions: DataFrame, rows: list, schema: T.StructType, qid: str, cid: str,
                             vec: str, k: int, metric: str) -> DataFrame:
    """The few corpus rows go to the questions, whose candidates are complete where they are."""
    ids = np.array([r[0] for r in rows])
    mat = np.array([r[1] for r in rows], dtype=np.float64).reshape(len(rows), -1) if rows else None
    shared = questions.sparkSession.sparkContext.broadcast((ids, mat))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c_ids, c = shared.value
        for b in batches:
            if b.num_rows and c is not None:
                row, score, found = _block_topk(matrix(b.column(1)), c, c_ids, k, metric)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), pa.array(found), pa.array(score)], names=[qid, cid, "score"])

    return questions.select(qid, vec).mapInArrow(search, schema)


def block_search(q: DataFrame, c: DataFrame, schema: T.StructType, qid: str, cid: str, vec: str,
                 k: int, metric: str, question_block: int = QUESTION_BLOCK, corpus_block: int = CORPUS_BLOCK) -> DataFrame:
    """Meet questions and corpus block by block inside each `code`.

    Each code gets as many blocks per side as its size asks for, so a hot code is spread over a
    grid of (question block, corpus block) cells of bounded size. The table of sizes has one row
    per code; codes are few, which bounds what is broadcast.
    """

    def blocks(n: Column, size: int) -> Column:
        return F.ceil(n / F.lit(size)).cast("int")

    per_q = q.groupBy("code").agg(blocks(F.count(F.lit(1)), question_block).alias("nq"))
    per_c = c.groupBy("code").agg(blocks(F.count(F.lit(1)), corpus_block).alias("nc"))
    sizes = F.broadcast(per_q.join(per_c, "code"))
    q, c = q.join(sizes, "code"), c.join(sizes, "code")

    def side(df: DataFrame, key: str, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        cells = df.withColumn(own, F.pmod(F.xxhash64(key), F.col(own_n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1))
        )
        # fresh attributes: both sides may come from the same table
        return cells.select(*[F.col(x).alias(x) for x in ("code", "bq", "bc", key, vec)])

    left = side(q, qid, "bq", "nq", "bc", "nc").groupBy("code", "bq", "bc")
    right = side(c, cid, "bc", "nc", "bq", "nq").groupBy("code", "bq", "bc")

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({qid: pa.array([], a.schema.field(qid).type),
                             cid: pa.array([], b.schema.field(cid).type),
                             "score": pa.array([], pa.float64())})
        qids = a.column(qid).to_numpy()
        c_ids = b.column(cid).to_numpy()
        if c_ids.dtype == object:
            c_ids = c_ids.astype(str)
        row, score, ids = _block_topk(matrix(a.column(vec)), matrix(b.column(vec)), c_ids, k, metric)
        return pa.table({qid: pa.array(qids[row]), cid: pa.array(ids), "score": pa.array(score)})

    return left.cogroup(right).applyInArrow(meet, schema)


# ---------------------------------------------------------------- stored corpus, met by blocks of questions


def few_copies(c: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of equal vectors only the `k` smallest ids can be among the nearest of any question."""
    mark = c @ np.sin(np.arange(1.0, c.shape[1] + 1))
    order = np.lexsort((ids.astype(str) if ids.dtype == object else ids, mark))
    first = np.searchsorted(mark[order], mark[order], side="left")
    place = np.arange(len(c)) - first
    if not (place >= k).any():
        return c, ids
    starts = np.flatnonzero(place == 0)
    other = (c[order] != c[order[first]]).any(axis=1)
    mixed = np.repeat(np.add.reduceat(other, starts) > 0, np.diff(starts, append=len(c)))
    keep = np.sort(order[(place < k) | mixed])
    return c[keep], ids[keep]


class Nearest:
    """The `k` nearest corpus rows so far of a block of questions, which meets the corpus batch by batch.

    A product in single precision rules out rows that are surely farther than the k-th so far; the others
    get their exact score. Memory is bounded by the block, the tile and `_PAIRS`.
    """

    def __init__(self, q: np.ndarray, k: int, metric: str):
        self.q, self.k, self.metric = q, k, metric
        self.score, self.ids, self.id_type = np.full((len(q), k), np.inf), None, None

    def reach(self) -> np.ndarray:
        """Distance within which a row may still count; for cosine on the unit sphere."""
        last = self.score[:, -1]
        return np.sqrt(np.maximum(last if self.metric == "l2" else 2.0 + 2.0 * last, 0.0))

    def meet(self, rows: np.ndarray, batch: pa.RecordBatch, about: np.ndarray | None = None) -> None:
        """Compare the questions `rows` with a batch of (id, vector). `about`: a point near the batch."""
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        if self.ids is None:
            self.ids, self.id_type = np.full(self.score.shape, "" if ids.dtype == object else 0, ids.dtype), batch.column(0).type
        c, ids = few_copies(matrix(batch.column(1)), ids, self.k)
        y = _unit(c) if self.metric == "cosine" else c - (0.0 if about is None else about)
        tile = max(1, _TILE_CELLS // max(1, len(c)))
        for a in range(0, len(rows), tile):
            self._tile(rows[a:a + tile], c, y, ids, about)

    def _tile(self, rows: np.ndarray, c: np.ndarray, y: np.ndarray, ids: np.ndarray, about: np.ndarray | None) -> None:
        l2 = self.metric == "l2"
        x = self.q[rows]
        x = x - (0.0 if about is None else about) if l2 else _unit(x)
        qq, cc = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
        size = max(qq.max(), cc.max())
        kind = np.float32 if 1e-20 < size < 1e30 else np.float64
        error = 2 * float(np.finfo(kind).eps) * (x.shape[1] + 8) * (qq + cc.max())
        if l2:  # (|x|^2 - distance) / 2 as one product
            x, y = np.hstack([x, np.ones((len(x), 1))]), np.hstack([y, -cc[:, None] / 2])
        near = x.astype(kind) @ y.astype(kind).T
        last = self.score[rows, -1]
        least = (qq - last * (1 + 1e-9) - error) / 2 if l2 else -last - error - 2e-9
        some = np.flatnonzero(np.isinf(last))
        if len(some) and len(c) > self.k:  # no bound yet: the k-th of this batch
            least[some] = np.partition(near[some], len(c) - self.k, axis=1)[:, len(c) - self.k] - error[some] - (0.0 if l2 else 2e-9)
            if l2:
                least[some] -= 1e-9 * np.maximum(qq[some] - 2 * least[some], 0)
        row, col = np.nonzero(near >= least.astype(kind)[:, None])
        for a in range(0, len(row), _PAIRS):
            self._add(rows[row[a:a + _PAIRS]], c, ids, col[a:a + _PAIRS])

    def _add(self, at: np.ndarray, c: np.ndarray, ids: np.ndarray, col: np.ndarray) -> None:
        if self.metric == "l2":  # equal vectors: only a smaller id counts
            open_ = (self.score[at, -1] > 0) | (ids[col] < self.ids[at, -1])
            at, col = at[open_], col[open_]
        score, found = _exact(self.q[at], c[col], self.metric), ids[col]
        last = self.score[at, -1]
        better = (score < last) | ((score == last) & (found < self.ids[at, -1]))
        at, score, found = at[better], score[better], found[better]
        if not len(at):
            return
        own, inverse = np.unique(at, return_inverse=True)
        row = np.concatenate([np.repeat(np.arange(len(own)), self.k), inverse])
        score, found = np.concatenate([self.score[own].ravel(), score]), np.concatenate([self.ids[own].ravel(), found])
        order = np.lexsort((found.astype(str) if found.dtype == object else found, score, row))
        keep = order[np.arange(len(row)) - np.searchsorted(row[order], row[order], side="left") < self.k]
        self.score[own], self.ids[own] = score[keep].reshape(-1, self.k), found[keep].reshape(-1, self.k)


def _unit(v: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(length > 0, length, 1.0)


def _blocks_of(it: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Blocks of `size` rows of a task's batches."""
    held: list[pa.RecordBatch] = []
    for b in it:
        while len(b):
            part = b.slice(0, size - sum(map(len, held)))
            b = b.slice(len(part))
            held.append(part)
            if sum(map(len, held)) == size:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _stored_batches(path: str, cell: int, columns: list[str], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of a stored cell, read from its files."""
    fs, root = pafs.FileSystem.from_uri(path)
    files = fs.get_file_info(pafs.FileSelector(f"{root}/cell={cell}", allow_not_found=True))
    for f in sorted(files, key=lambda f: f.path):
        if not f.base_name.startswith(("_", ".")):
            with fs.open_input_file(f.path) as source:
                for batch in pq.ParquetFile(source).iter_batches(size, columns=columns):
                    if len(batch):
                        yield batch.select(columns)


def scan_search(q: DataFrame, path: str, visits: Callable, schema: T.StructType, qid: str, cid: str, vec: str, k: int, metric: str,
                question_block: int = QUESTION_BLOCK, corpus_block: int = CORPUS_BLOCK) -> DataFrame:
    """Blocks of questions (qid, vec, cell) meet a corpus that is stored below `path` by cells; neither is repeated in a shuffle.

    Questions are exchanged once, near ones together. A task reads the cells that `visits(vectors, cells of the questions, nearest so far)`
    names, with the questions that have to meet each and a point near it, and holds one block of either side.
    """
    spark, n = q.sparkSession, q.count()
    tasks = max(-(-n // question_block), 3 * spark.sparkContext.defaultParallelism)
    tasks = max(1, min(tasks, -(-n // MIN_TASK_QUESTIONS)))
    placed = q.repartitionByRange(tasks, "cell", F.xxhash64(qid)).sortWithinPartitions("cell").select(qid, vec, "cell")
    size = min(corpus_block, SCAN_ROWS)

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks_of(it, question_block):
            best = Nearest(matrix(block.column(1)), k, metric)
            for cell, rows, about in visits(best.q, block.column(2).to_numpy(), best):
                for batch in _stored_batches(path, cell, [cid, vec], size):
                    best.meet(rows, batch, about)
            row, place = np.nonzero(np.isfinite(best.score))
            if len(row):
                yield pa.RecordBatch.from_arrays([block.column(0).combine_chunks().take(pa.array(row)), pa.array(best.ids[row, place], best.id_type),
                                                  pa.array(best.score[row, place])], [qid, cid, "score"])

    return placed.mapInArrow(search, schema)


def topk(questions: DataFrame, corpus: DataFrame, k: int = 8, *, qid: str = "query_id",
         cid: str = "chunk_id", vec: str = "embedding", metric: str = "l2",
         max_broadcast: int = MAX_BROADCAST_QUESTIONS, question_block: int = QUESTION_BLOCK,
         corpus_block: int = CORPUS_BLOCK, stored: bool = True) -> DataFrame:
    """Exact `k` nearest corpus rows per question: `qid, cid, rank, distance|similarity`.

    `stored=False` says that the vectors are still to be computed; ways that read them more than
    once then write them to the shared folder first.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric: {metric}")
    q = questions.select(qid, vec).where(F.col(vec).isNotNull())
    c = corpus.select(cid, vec).where(F.col(vec).isNotNull())

    def few(size) -> bool:
        return size["n"] <= max_broadcast and size["numbers"] <= MAX_BROADCAST_CELLS

    def measured(df: DataFrame):
        dims = F.size(vec)
        return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(dims), F.lit(0)).alias("numbers"), F.max(dims).alias("dims")).first()

    if not stored:
        q = cut_lineage(q)  # measured first, then read again; the corpus is scanned once if the questions are few
    if few(measured(q)):
        cands = _broadcast_search(q.collect(), c, out_schema(q, c, qid, cid), qid, cid, vec, k, metric)
        return final(cands, qid, cid, k, metric)
    if not stored:
        c = cut_lineage(c)
    size = measured(c)
    if few(size):
        cands = _broadcast_corpus_search(q, c.collect(), out_schema(q, c, qid, cid), qid, cid, vec, k, metric)
        return final(cands, qid, cid, k, metric)
    from loomtext.operators import cells  # which is built on this module

    index = cells.build(c, scratch_path(c.sparkSession, "cells"), key=cid, vec=vec, metric=metric, size=(size["n"], size["dims"]),
                        cells=max(1, -(-size["n"] // corpus_block)), lasting=False, rounds=1)  # searched once: any centres prove
    return cells.search(q, index, k, qid=qid, cid=cid, vec=vec, question_block=question_block, corpus_block=corpus_block)


def plane_signs(bits: int, dims: int) -> np.ndarray:
    """Hyperplanes with +1/-1 entries by rule: the first hex digit of md5("plane:dim") is < 8."""
    return np.array([
        [1.0 if hashlib.md5(f"{p}:{d}".encode()).hexdigest()[0] < "8" else -1.0 for d in range(dims)]
        for p in range(bits)
    ])


def hash_code(vec: Column, bits: int, dims: int) -> Column:
    """Bit p of the code is set when the vector lies on the non-negative side of plane p."""
    planes = plane_signs(bits, dims)
    weights = 1 << np.arange(bits)

    @F.arrow_udf("int")
    def code(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.int32())
        return pa.array(((matrix(vectors) @ planes.T >= 0) * weights).sum(axis=1).astype(np.int32))

    return code(vec)


def probe_masks(bits: int, radius: int) -> list[int]:
    """All bit masks that flip at most `radius` bits."""
    return [sum(1 << b for b in flips)
            for r in range(radius + 1) for flips in itertools.combinations(range(bits), r)]


def topk_approx(questions: DataFrame, corpus: DataFrame, k: int = 8, *, bits: int = 10,
                radius: int = 2, dims: int = 64, qid: str = "query_id", cid: str = "chunk_id",
                vec: str = "embedding", metric: str = "l2", question_block: int = QUESTION_BLOCK,
                corpus_block: int = CORPUS_BLOCK, stored: bool = True) -> DataFrame:
    """Approximate top-k: a question meets only corpus rows whose code is within `radius` flips.

    Candidates are ranked by exact distance. `radius = bits` probes everything and is exact.
    """
    if bits > 16:
        raise ValueError("at most 16 bits: the table of code sizes is broadcast")
    q = questions.select(qid, vec).where(F.col(vec).isNotNull())
    c = corpus.select(cid, vec).where(F.col(vec).isNotNull())
    if not stored:
        q, c = cut_lineage(q), cut_lineage(c)
    schema = out_schema(q, c, qid, cid)
    coded = c.withColumn("code", hash_code(F.col(vec), bits, dims))
    if bits <= MAX_FOLDER_BITS:
        asked = cut_lineage(q.withColumn("cell", hash_code(F.col(vec), bits, dims)))
        return final(_code_scan(asked, coded, probe_masks(bits, radius), schema, qid, cid, vec, k, metric, question_block, corpus_block), qid, cid, k, metric)
    masks = F.array(*[F.lit(m) for m in probe_masks(bits, radius)])
    probes = q.withColumn("own", hash_code(F.col(vec), bits, dims)).withColumn("mask", F.explode(masks))
    probes = probes.select(qid, vec, F.col("own").bitwiseXOR(F.col("mask")).alias("code"))
    cands = block_search(probes, coded, schema, qid, cid, vec, k, metric, question_block, corpus_block)
    return final(cands, qid, cid, k, metric)


def _code_scan(q: DataFrame, coded: DataFrame, masks: list[int], schema: T.StructType, qid: str, cid: str, vec: str, k: int, metric: str,
               question_block: int, corpus_block: int) -> DataFrame:
    """The corpus is written once by code; a block of questions reads the codes that one of them probes."""
    path = scratch_path(q.sparkSession, "codes")
    coded.withColumnRenamed("code", "cell").hint("rebalance", "cell").write.partitionBy("cell").parquet(path)

    def visits(_, own: np.ndarray, best: Nearest) -> Iterator[tuple]:
        for code in np.unique(np.unique(own)[:, None] ^ np.array(masks)[None, :]):
            yield int(code), np.flatnonzero(np.isin(own ^ code, masks)), None

    return scan_search(q, path, visits, schema, qid, cid, vec, k, metric, question_block, corpus_block)


def recall(found: DataFrame, truth: DataFrame, qid: str = "query_id", cid: str = "chunk_id") -> DataFrame:
    """Share of the true neighbours that were found, over all questions."""
    hit = truth.select(qid, cid).join(found.select(qid, cid, F.lit(1).alias("hit")), [qid, cid], "left")
    return hit.agg(
        F.count(F.lit(1)).alias("n_true"), F.count("hit").alias("n_found"),
        F.try_divide(F.count("hit").cast("double"), F.count(F.lit(1)).cast("double")).alias("recall"),
    )
