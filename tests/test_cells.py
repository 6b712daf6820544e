"""The stored inverted file against brute force, its pruning, its calibration and its edges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.operators import cells, retrieval
from tests.test_retrieval import _brute, _frame, _got


def _clusters(rnd, n, dims, groups, spread=0.05):
    centre = rnd.normal(size=(groups, dims)) * 3
    return centre[rnd.integers(0, groups, n)] + rnd.normal(scale=spread, size=(n, dims))


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_proven_search_is_exact(spark, folder, metric):
    rnd = np.random.default_rng(11)
    c = np.vstack([_clusters(rnd, 500, 12, 9), rnd.normal(size=(200, 12)), np.zeros((3, 12))])
    c[100:350] = c[0]  # a third of all vectors is one
    q = np.vstack([c[[0, 5, 420, 650]], rnd.normal(size=(8, 12)), c[600:601] * 7])
    index = cells.build(_frame(spark, "chunk_id", range(len(c)), c).repartition(5), f"{folder}/x", metric=metric, cells=20)
    qf = _frame(spark, "query_id", range(len(q)), q)
    want = _got(retrieval.topk(qf, _frame(spark, "chunk_id", range(len(c)), c), 6, metric=metric))
    assert _got(cells.search(qf, index, 6)) == want
    again = cells.open_index(spark, f"{folder}/x")
    assert np.allclose(again.centres, index.centres) and again.metric == metric and again.looked_up == index.looked_up
    assert _got(cells.search(qf, again, 6, question_block=3, corpus_block=40)) == want
    if metric == "l2":
        assert want == _brute(q, c, 6)


def test_only_possible_cells_are_read(spark, folder):
    rnd = np.random.default_rng(12)
    c = _clusters(rnd, 3000, 16, 40)
    frame = _frame(spark, "chunk_id", range(len(c)), c)
    index = cells.build(frame, f"{folder}/x", cells=40)
    q = c[:5] + rnd.normal(scale=0.01, size=(5, 16))
    qf, report = _frame(spark, "query_id", range(5), q), {}
    found = cells.search(qf, index, 4, report=report)
    assert _got(found) == _got(retrieval.topk(qf, frame, 4))
    assert sum(report["met"]) < 0.4 * report["all"] and max(report["cells_read"]) < 25
    rows = cells.stored_vectors(spark, index).where(F.col("cell").isin([1, 2]))
    assert "PartitionFilters: [cell" in rows._jdf.queryExecution().toString().replace("\n", " ")
    assert rows.count() == index.sizes[1] + index.sizes[2]
    # each vector lies in the cell of its nearest centre, within the radius kept for it
    for r in cells.stored_vectors(spark, index).sample(0.05, 1).collect():
        d = np.linalg.norm(index.centres - np.array(r.embedding, float), axis=1)
        assert d[r.cell] <= d.min() + 1e-9 and abs(d[r.cell] - r.reach) < 1e-9 and r.reach <= index.radius[r.cell] + 1e-9


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_is_reached_on_given_vectors(spark, folder, sf):
    e = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select(F.col("vec_id").alias("chunk_id"), "embedding")
    index = cells.build(e, f"{folder}/x")
    q = e.where("chunk_id % 7 = 0").select(F.col("chunk_id").alias("query_id"), "embedding")
    found = cells.search(q, index, 8, recall=0.9)
    got = retrieval.recall(found, retrieval.topk(q, e, 8)).first()
    assert got.recall >= 0.9 and found.count() == 8 * q.count()


def test_recall_saves_cells_where_vectors_cluster(spark, folder):
    rnd = np.random.default_rng(13)
    c = _clusters(rnd, 4000, 24, 60, 0.3)
    frame = _frame(spark, "chunk_id", range(len(c)), c)
    index = cells.build(frame, f"{folder}/x")
    assert index.looked_up > 1000 and index.probes(0.95) <= len(index.centres) // 4
    qf = _frame(spark, "query_id", range(50), c[:50] + rnd.normal(scale=0.1, size=(50, 24)))
    report = {}
    found = cells.search(qf, index, 8, recall=0.95, report=report)
    assert retrieval.recall(found, retrieval.topk(qf, frame, 8)).first().recall >= 0.95
    assert len(report["met"]) == 1 and report["met"][0] < 0.3 * report["all"]


def test_edges(spark, folder):
    c = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0]), (3, [0.0, 1.0])], "chunk_id long, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id long, embedding array<float>")
    index = cells.build(c, f"{folder}/a")
    for recall in (1.0, 0.5):
        assert [(r.query_id, r.chunk_id, r["rank"]) for r in cells.search(q, index, 9, recall=recall).orderBy("rank").collect()] == [(1, 1, 1), (1, 3, 2), (1, 3, 3)]
    assert cells.search(q.limit(0), index, 3).collect() == []
    empty = cells.build(c.limit(0), f"{folder}/b")
    assert cells.search(q, empty, 3).collect() == [] and len(cells.open_index(spark, f"{folder}/b").centres) == 0


def test_recall_query_compares_with_true_neighbours(spark):
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.001"
    got = entry.queries()["e04_recall"](spark, sf).first()
    codes = entry.queries()["e04_code_recall"](spark, sf).first()
    assert (got.n_true, got.n_found, got.recall) == (codes.n_true, codes.n_found, codes.recall) and got.n_found > 0
    assert got.reached and got.n_full == got.n_questions == spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert "list_distance" in entry.oracle_sql()["e04_recall"]


def test_searches_repeat_no_vector_in_a_shuffle(spark):
    rnd = np.random.default_rng(5)
    v = rnd.normal(size=(600, 8)).astype(np.float32)
    q, c = _frame(spark, "query_id", range(600), v), _frame(spark, "chunk_id", range(600), v)
    for found in (retrieval.topk(q, c, 3, max_broadcast=0, question_block=64, corpus_block=32), retrieval.topk_approx(q, c, 3, bits=3, radius=3, dims=8)):
        assert _got(found) == _brute(v, v, 3)
        assert "CoGroup" not in found._jdf.queryExecution().toString()


def test_nearest_holds_few_pairs_of_many_copies(monkeypatch):
    import pyarrow as pa
    seen, exact = [], retrieval._exact
    monkeypatch.setattr(retrieval, "_exact", lambda q, c, m: seen.append(len(q)) or exact(q, c, m))
    c = np.ones((4000, 4))
    best = retrieval.Nearest(np.ones((100, 4)), 3, "l2")
    for a in (2000, 0):
        best.meet(np.arange(100), pa.record_batch({"id": pa.array(range(a, a + 2000)), "v": pa.array(c[a:a + 2000].tolist())}))
    assert best.ids.tolist() == [[0, 1, 2]] * 100 and sum(seen) <= 600
