"""Search ways against brute force, ties, planted neighbours, contexts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.operators import context, graph, retrieval


def _frame(spark, name, ids, mat):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, mat)], f"{name} long, embedding array<float>")


def _brute(q, c, k, metric="l2"):
    q, c = q.astype(np.float32).astype(float), c.astype(np.float32).astype(float)
    out = set()
    for i, v in enumerate(q):
        d = ((c - v) ** 2).sum(1) if metric == "l2" else -(c @ v) / np.linalg.norm(c, axis=1) / np.linalg.norm(v)
        for rank, j in enumerate(sorted(range(len(c)), key=lambda j: (round(d[j], 9), j))[:k], 1):
            out.add((i, j, rank))
    return out


def _got(df):
    return {(r.query_id, r.chunk_id, r["rank"]) for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    rnd = np.random.default_rng(7)
    c = rnd.normal(size=(300, 16))
    c[100:200] = c[0]  # a third of the corpus is one vector: ties must rank by id
    return rnd.normal(size=(25, 16)), c


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_ways_agree_with_brute_force(spark, data, metric):
    q, c = data
    q = np.vstack([q, c[:1]])
    qf, cf = _frame(spark, "query_id", range(len(q)), q), _frame(spark, "chunk_id", range(len(c)), c).repartition(6)
    want = _brute(q, c, 5, metric)
    assert _got(retrieval.topk(qf, cf, 5, metric=metric)) == want
    assert _got(retrieval.topk(qf, cf, 5, metric=metric, max_broadcast=3, question_block=10, corpus_block=64)) == want
    # more questions than corpus rows: the corpus goes to the questions
    few = cf.where("chunk_id < 15")
    asked = _got(retrieval.topk(qf, few, 5, metric=metric, max_broadcast=20))
    assert asked == _brute(q, c[:15], 5, metric) == _got(retrieval.topk(qf, few, 5, metric=metric, max_broadcast=0))
    assert _got(retrieval.topk(qf, cf.limit(0), 5, metric=metric, max_broadcast=20)) == set()
    assert _got(retrieval.topk_approx(qf, cf, 5, metric=metric, bits=3, radius=3, dims=16, question_block=8, corpus_block=32)) == want


def test_k_larger_than_corpus_and_null_vectors(spark):
    qf = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id long, embedding array<float>")
    cf = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], "chunk_id long, embedding array<float>")
    for m in (10, 0):
        assert _got(retrieval.topk(qf, cf, 9, max_broadcast=m)) == {(1, 1, 1), (1, 3, 2)}


def test_approx_finds_planted_neighbours_with_few_comparisons(spark):
    rnd = np.random.default_rng(3)
    c = rnd.normal(size=(2000, 64))
    q = c[:40] + rnd.normal(scale=0.02, size=(40, 64))
    qf, cf = _frame(spark, "query_id", range(40), q), _frame(spark, "chunk_id", range(2000), c)
    found = retrieval.topk_approx(qf, cf, 1, bits=6, radius=1)
    assert sum(r.query_id == r.chunk_id for r in found.collect()) >= 38
    codes = cf.select(retrieval.hash_code(F.col("embedding"), 6, 64).alias("c")).groupBy("c").count()
    share = codes.agg(F.sum(F.col("count") * F.col("count"))).first()[0] * 7 / 2000**2
    assert share < 0.2  # 7 of 64 codes are probed


def test_string_ids(spark, data):
    q, c = data
    qf = _frame(spark, "query_id", range(len(q)), q)
    cf = _frame(spark, "n", range(len(c)), c).select(F.format_string("c%04d", "n").alias("chunk_id"), "embedding")
    want = {(i, f"c{j:04d}", r) for i, j, r in _brute(q, c, 4)}
    assert _got(retrieval.topk(qf, cf, 4)) == want
    assert _got(retrieval.topk(qf, cf, 4, max_broadcast=0, question_block=10, corpus_block=50)) == want


def test_layouts_and_sources(spark):
    rows = [(1, 2, "b", "s1"), (1, 1, "a", "s2"), (1, 3, "c", "s1"), (1, 4, "d", None)]
    df = spark.createDataFrame(rows, "question_id int, rank int, text string, source string")
    got = {x: context.assemble(df, ["question_id"], x).first().context for x in context.LAYOUTS}
    assert got["joined"] == "a\n\nb\n\nc\n\nd" and got["bare"] == "abcd" and got["leading"] == "\n\na\n\nb\n\nc\n\nd"
    assert got["blocks"].startswith('\n\nChunk Content: a\nMetadata: {"source":"s2"}\n\n\nChunk Content: b')
    r = context.source_report(df, ["question_id"]).first()
    assert (r.sources, r.n_sources, r.n_docs, r.cited) == (["s2", "s1", "s1"], 3, 4, ["s2", "s1"])
    with pytest.raises(ValueError):
        context.assemble(df, ["question_id"], "other")


def test_import_graph(spark):
    files = [
        ("a.py", "import os, pkg.b\nfrom pkg import c\nfrom . import x\nimport os\n"),
        ("pkg/b.py", "import a"),
        ("bad.py", "def ("),
    ]
    df = spark.createDataFrame(files, "source string, text string")
    edges = graph.import_edges(df)
    assert {tuple(r) for r in edges.collect()} == {
        ("a.py", "os", None), ("a.py", "pkg.b", "pkg/b.py"), ("a.py", "pkg", None), ("pkg/b.py", "a", "a.py"), ("bad.py", None, None)}
    size = graph.graph_size(edges).first()
    assert (size.n_nodes, size.n_edges) == (7, 4)
    assert {tuple(r) for r in graph.neighbours(edges).where("node = 'a'").collect()} == {("a", "pkg/b.py")}


def test_unstored_vectors_take_the_same_ways(spark, data):
    """Vectors computed by an encoder: small and large question sets agree with stored ones."""
    from loomtext.functions import inference as I
    texts = spark.createDataFrame([(i, f"word{i % 7} item{i} common") for i in range(60)] + [(99, "  ")], "chunk_id long, text string")
    enc = I.hashed_encoder()
    c = texts.select("chunk_id", enc(F.col("text")).alias("embedding"))
    q = texts.where("chunk_id < 9").select(F.col("chunk_id").alias("query_id"), enc(F.col("text")).alias("embedding"))
    want = _got(retrieval.topk(q, c, 3, stored=False))
    assert len(want) == 27 and {(i, i, 1) for i in range(9)} <= want
    assert _got(retrieval.topk(q, c, 3, max_broadcast=0, question_block=4, corpus_block=16, stored=False)) == want
    assert _got(retrieval.topk_approx(q, c, 3, bits=4, radius=4, stored=False)) == want


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e6])
def test_ranks_do_not_depend_on_length(spark, scale):
    q = spark.createDataFrame([(0, [1.0 * scale, 0.0])], "query_id long, embedding array<double>")
    c = spark.createDataFrame([(1, [5.0 * scale, 0.0]), (2, [2.0 * scale, 0.0]), (3, [1.1 * scale, 0.0]), (4, [1.1 * scale, 0.0])],
                              "chunk_id long, embedding array<double>")
    rows = retrieval.topk(q, c, 4).orderBy("rank").collect()
    assert [r.chunk_id for r in rows] == [3, 4, 2, 1]


def test_question_without_hits_has_a_prompt(spark):
    from loomtext.operators import context

    asked = spark.createDataFrame([(1, "a"), (2, "b")], "question_id long, question string")
    ctx = spark.createDataFrame([(1, "text")], "question_id long, context string")
    got = context.prompts(ctx, asked, "question_id", "question", "{question}|{context}")
    assert {r.question_id: r.prompt for r in got.collect()} == {1: "a|text", 2: "b|"}
