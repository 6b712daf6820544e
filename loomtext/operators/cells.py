"""Stored inverted file: vectors kept by the cell of their nearest centre, searched with proven or calibrated probes.

Centres are learned by Lloyd rounds in Spark on a bounded sample. Every vector is stored in the
partition of its cell with its distance to the centre. A question reads the cells next to it only.
How many depends on what is asked for:

* `recall=1`: after its own cell the k-th distance so far bounds what can still count.
  By the triangle inequality a cell whose centre is farther than this distance plus its radius
  holds nothing nearer; all other cells are met, from near to far, and each narrows the bound. The result is exact.
* `recall<1`: as many cells as held that share of the true neighbours of stored sample questions,
  plus two standard errors. The calibration is stored with the index.

A question always gets enough cells for `k` rows. Near questions form blocks, and the task of a block reads
the cells it needs from the stored files (see `retrieval.scan_search`): nothing is repeated in a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.operators import retrieval
from loomtext.session import cut_lineage, scratch_path

#: Centres: at most so many, and so many numbers in all; they are sent to every task.
MAX_CELLS, MAX_NUMBERS = 4096, 16_000_000
#: Rows of the sample on which centres are learned, per centre, and rounds over it.
SAMPLE_PER_CELL, ROUNDS = 64, 6
#: Stored vectors that serve as questions of the calibration, and the neighbours looked up for each.
CALIBRATION_QUESTIONS, CALIBRATION_K = 256, 16
#: Bounds hold up to rounding: a cell is ruled out only if it is farther by this share.
SLACK = 1e-6


@dataclass
class Index:
    """An opened index: centres, number and radius of the vectors of each cell, and what calibration found."""

    path: str
    metric: str
    centres: np.ndarray
    sizes: np.ndarray
    radius: np.ndarray
    found_by: np.ndarray  # share of true neighbours in the first 1, 2, ... cells
    looked_up: int
    columns: str = ""  # of the stored rows, where they are known without reading them

    def probes(self, recall: float) -> int:
        """Cells whose share of the neighbours looked up reaches `recall` with two standard errors to spare."""
        if not self.looked_up:
            return len(self.centres)
        share = self.found_by - 2 * np.sqrt(self.found_by * (1 - self.found_by) / max(self.looked_up, 1))
        enough = np.flatnonzero(share >= recall)
        return int(enough[0]) + 1 if len(enough) else len(self.centres)


def _placed(vectors: np.ndarray, metric: str) -> np.ndarray:
    """Vectors as they are compared: for cosine on the unit sphere, where squared distance is 2 - 2 * similarity."""
    if metric == "l2":
        return vectors
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(length > 0, length, 1.0)


def _distances(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (v * v).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * (v @ centres.T)
    return np.sqrt(np.maximum(d, 0.0))


def _nearest(v: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and exact distance to its centre."""
    tile = max(1, 4_000_000 // max(1, len(centres)))
    cell = np.concatenate([_distances(v[a : a + tile], centres).argmin(1) for a in range(0, len(v), tile)] or [np.zeros(0, np.int64)])
    return cell, np.linalg.norm(v - centres[cell], axis=1)


def sample_by_hash(df: DataFrame, key: str, rows: int, n: int) -> DataFrame:
    """About `rows` of the `n` rows, by a hash of the key."""
    share = min(1.0, rows / max(n, 1))
    return df.where(F.shiftrightunsigned(F.xxhash64(key), 2) <= F.lit(share * float(1 << 62)))


def learn_centres(vectors: DataFrame, key: str, vec: str, cells: int, metric: str = "l2", rounds: int = ROUNDS,
                  sample: int = SAMPLE_PER_CELL, n: int | None = None) -> np.ndarray:
    """Centres after Lloyd rounds over at most about `cells * sample` of the `n` vectors, chosen by a hash of the key.

    Only sums and counts per cell and task leave the tasks. A cell that loses all its vectors keeps its centre.
    """
    spark = vectors.sparkSession
    n = vectors.count() if n is None else n
    path = scratch_path(spark, "centres-sample")
    # the sample is bounded, and so is the number of its files
    sample_by_hash(vectors.select(key, vec), key, cells * sample, n).repartition(
        max(1, min(64, cells * sample // 20_000))).write.parquet(path)
    rows = spark.read.schema(vectors.select(key, vec).schema).parquet(path)
    first = rows.orderBy(F.xxhash64(key, F.lit(7)), key).limit(cells).select(vec).toArrow()
    centres = np.unique(_placed(retrieval.matrix(first.column(0)), metric), axis=0)
    for _ in range(rounds if len(centres) > 1 else 0):
        sent = spark.sparkContext.broadcast(centres)

        def partial(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = sent.value
            total, count = np.zeros_like(c), np.zeros(len(c), np.int64)
            for b in it:
                v = _placed(retrieval.matrix(b.column(0)), metric)
                cell = _nearest(v, c)[0]
                np.add.at(total, cell, v)
                count += np.bincount(cell, minlength=len(c))
            own = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(count[own]), pa.array(list(total[own]), pa.list_(pa.float64()))], ["cell", "n", "total"])

        def add(t: pa.Table) -> pa.Table:
            n = t.column("n").to_numpy().sum()
            mean = retrieval.matrix(t.column("total")).sum(0) / n
            return pa.table({"cell": t.column("cell").slice(0, 1), "centre": pa.array([mean], pa.list_(pa.float64()))})

        moved = rows.select(vec).mapInArrow(partial, "cell long, n long, total array<double>").groupBy("cell").applyInArrow(
            add, "cell long, centre array<double>").toArrow()
        sent.destroy()
        centres = centres.copy()
        centres[moved.column("cell").to_numpy()] = retrieval.matrix(moved.column("centre"))
    return centres


def assign(vectors: DataFrame, vec: str, centres: np.ndarray, metric: str = "l2") -> DataFrame:
    """Adds `cell` and `reach`, the distance to its centre. A null vector belongs to no cell and is left out."""
    sent = vectors.sparkSession.sparkContext.broadcast(centres)
    vectors = vectors.where(F.col(vec).isNotNull())
    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema] + ["cell int", "reach double"])
    at = vectors.columns.index(vec)

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            cell, reach = _nearest(_placed(retrieval.matrix(b.column(at)), metric), sent.value)
            fields = [*b.schema, pa.field("cell", pa.int32()), pa.field("reach", pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(reach)], schema=pa.schema(fields))

    return vectors.mapInArrow(place, out)


def build(vectors: DataFrame, path: str, *, key: str = "chunk_id", vec: str = "embedding", metric: str = "l2",
          cells: int | None = None, lasting: bool = True, rounds: int = ROUNDS, size: tuple[int, int] | None = None) -> Index:
    """Write the vectors below `path`, a partition for each cell, and the centres with their calibration beside them.

    All columns are kept. The default number of cells is the square root of the number of vectors.
    An index that does not last is only searched exactly and by the caller: it has no calibration and cannot be opened again.
    `size` is the number of vectors and of their dimensions, if the caller has counted them.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric: {metric}")
    spark = vectors.sparkSession
    some = vectors.where(F.col(vec).isNotNull())
    n, dims = size or some.agg(F.count(F.lit(1)), F.max(F.size(vec))).first()
    dims = max(dims or 1, 1)
    cells = max(1, min(cells or math.isqrt(n), MAX_CELLS, MAX_NUMBERS // dims))
    centres = learn_centres(some, key, vec, cells, metric, rounds, n=n) if n else np.zeros((0, dims))
    # one exchange by cell; the hint lets adaptive execution split a hot cell and merge small ones
    assign(some, vec, centres, metric).hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/vectors")
    index = Index(path, metric, centres, np.zeros(len(centres), np.int64), np.zeros(len(centres)), np.ones(len(centres)), 0, _ddl(some))
    stored = stored_vectors(spark, index)
    per_cell = stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")).toArrow()
    index.sizes[per_cell.column("cell").to_numpy()] = per_cell.column("n").to_numpy()
    index.radius[per_cell.column("cell").to_numpy()] = per_cell.column("radius").to_numpy()
    if not lasting:
        return index
    some.limit(0).write.parquet(f"{path}/columns")
    index.found_by, index.looked_up = _calibrate(stored, index, key, vec)
    rows = [(i, c.tolist(), int(m), float(r), float(s), index.looked_up) for i, (c, m, r, s) in enumerate(zip(centres, index.sizes, index.radius, index.found_by))]
    spark.createDataFrame(rows, "cell int, centre array<double>, n long, radius double, found_by double, looked_up long").withColumn(
        "metric", F.lit(metric)).coalesce(1).write.parquet(f"{path}/centres")
    return index


def open_index(spark: SparkSession, path: str) -> Index:
    rows = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()
    pick = lambda c: np.array([r[c] for r in rows])
    return Index(path, rows[0]["metric"] if rows else "l2", pick("centre").reshape(len(rows), -1 if rows else 0), pick("n"), pick("radius"), pick("found_by"),
                 rows[0]["looked_up"] if rows else 0)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def stored_vectors(spark: SparkSession, index: Index) -> DataFrame:
    """The stored rows, with `reach` and `cell`. An empty index has no files, so the columns are kept apart."""
    index.columns = index.columns or _ddl(spark.read.parquet(f"{index.path}/columns"))
    return spark.read.schema(f"{index.columns}, reach double, cell int").parquet(f"{index.path}/vectors")


def _order(index: Index, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of each question, nearest centre first, and the distances by cell."""
    d = _distances(_placed(q, index.metric), index.centres)
    return np.argsort(d, axis=1, kind="stable"), d


def _calibrate(stored: DataFrame, index: Index, key: str, vec: str) -> tuple[np.ndarray, int]:
    """Share of the true neighbours of stored sample rows that the first 1, 2, ... cells hold."""
    m, n = len(index.centres), int(index.sizes.sum())
    if n < 2:
        return np.ones(m), 0
    asked = sample_by_hash(stored.select(F.col(key).alias("_q"), vec), "_q", CALIBRATION_QUESTIONS, n).limit(2 * CALIBRATION_QUESTIONS)
    # a column read twice needs names of its own on one side
    near = retrieval.topk(asked, stored.select(F.col(key).alias("_c"), vec), CALIBRATION_K + 1, qid="_q", cid="_c", vec=vec, metric=index.metric)
    near = near.where("_q != _c").select("_q", "_c")
    cell_of = stored.select(F.col(key).alias("_c"), "cell")
    held = near.join(cell_of, "_c").join(asked.withColumnRenamed(vec, "_v"), "_q").select("_v", "cell").toArrow()
    if not held.num_rows:
        return np.ones(m), 0
    order, _ = _order(index, retrieval.matrix(held.column("_v")))
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(m)[None, :].repeat(len(order), 0), 1)
    place = rank[np.arange(len(order)), held.column("cell").to_numpy()]
    return np.cumsum(np.bincount(place, minlength=m)) / len(place), held.num_rows


def search(questions: DataFrame, index: Index, k: int = 8, *, recall: float = 1.0, qid: str = "query_id", cid: str = "chunk_id",
           vec: str = "embedding", question_block: int = retrieval.QUESTION_BLOCK, corpus_block: int = retrieval.CORPUS_BLOCK,
           report: dict | None = None) -> DataFrame:
    """`qid, cid, rank, distance|similarity`: `k` rows for each question with a vector, or all if there are fewer.

    `recall=1` gives exactly the nearest, see the module. Below 1 the nearest of the calibrated cells; more
    than `CALIBRATION_K` neighbours were never calibrated and are searched exactly. Only partitions of probed cells are
    read. `report` receives the number of (question, cell) meetings and of all there could be, by a run of its own.
    """
    spark = questions.sparkSession
    q = questions.select(qid, vec).where(F.col(vec).isNotNull())
    if not len(index.centres):
        nothing = retrieval.out_schema(q, stored_vectors(spark, index), qid, cid)
        return retrieval.final(spark.createDataFrame([], nothing), qid, cid, k, index.metric)
    schema = retrieval.out_schema(q, stored_vectors(spark, index), qid, cid)
    q = cut_lineage(assign(q, vec, index.centres, index.metric).drop("reach"))
    exact = recall >= 1 or k > CALIBRATION_K
    sent = spark.sparkContext.broadcast((index.metric, index.centres, index.sizes, index.radius))
    few = index.probes(recall)

    def nearest(v: np.ndarray) -> np.ndarray:
        """[questions, cells] the calibrated cells, and as many as `k` rows take."""
        metric, centres, sizes, _ = sent.value
        out = np.zeros((len(v), len(centres)), bool)
        for a in range(0, len(v), 1024):
            order = np.argsort(_distances(_placed(v[a : a + 1024], metric), centres), axis=1, kind="stable")
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            wanted = (np.arange(len(centres))[None, :] < few) | (before < k)  # the rows of earlier cells do not suffice
            np.put_along_axis(out[a : a + 1024], order, wanted, 1)
        return out & (sizes > 0)[None, :]

    def visits(v: np.ndarray, own: np.ndarray, best: retrieval.Nearest) -> Iterator[tuple]:
        metric, centres, sizes, radius = sent.value
        about = centres if metric == "l2" else [None] * len(centres)
        place = _placed(v, metric)
        if exact:
            for c in np.unique(own):  # its own cell gives each question a first bound
                yield int(c), np.flatnonzero(own == c), about[c]
        else:
            chosen = nearest(v)
        for c in np.argsort(np.linalg.norm(centres - place.mean(0), axis=1), kind="stable"):
            if exact:
                # a zero vector is never nearer than the sphere shows, so the bound also holds for it
                d = np.linalg.norm(place - centres[c], axis=1)
                meets = (d - radius[c] <= best.reach() * (1 + SLACK) + SLACK * d) & (own != c) & (sizes[c] > 0)
            else:
                meets = chosen[:, c]
            if meets.any():
                yield int(c), np.flatnonzero(meets), about[c]

    path = f"{index.path}/vectors"
    if report is not None:
        def counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in retrieval._blocks_of(it, question_block):
                best = retrieval.Nearest(retrieval.matrix(block.column(1)), k, index_metric)
                for cell, rows, about in visits(best.q, block.column(2).to_numpy(), best):
                    for batch in retrieval._stored_batches(path, cell, [cid, vec], corpus_block):
                        best.meet(rows, batch, about)
                    yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([len(rows)], pa.int64())], ["cell", "n"])

        index_metric = index.metric
        met = q.select(qid, vec, "cell").mapInArrow(counted, "cell int, n long").agg(F.sum("n"), F.count_distinct("cell")).first()
        report["all"] = q.count() * int((index.sizes > 0).sum())
        report["met"], report["cells_read"] = [met[0] or 0], [met[1]]
    found = retrieval.scan_search(q, path, visits, schema, qid, cid, vec, k, index.metric, question_block, corpus_block)
    return retrieval.final(found, qid, cid, k, index.metric)
