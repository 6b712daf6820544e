"""The queries over whole small tables: against SQL, brute force, round trips or held-out accuracy."""

import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

from loomtext.llm import cgk, queries
from loomtext.llm.common import words
from tests import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.fixture(scope="module")
def docs(con):
    return {i: t or "" for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, con, name):
    assert oracle.compare(con, queries.QUERIES[name](spark, SF), queries.SQL[name]) is None


def test_lm_scoring(spark, docs):
    rows = queries.op1_lm_scoring(spark, SF).collect()
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in docs}
    tokens = {i: words(t.encode()) + [b"\n"] for i, t in docs.items()}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        ws = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(ws), n)
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    kept_back = [r for r in rows if r.held_out]
    assert sum(r.score for r in kept_back) > sum(r.base_score for r in kept_back)


def test_quality(spark, con):
    rows = {r.doc_id: r for r in queries.op3_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    big = oracle.connect("/root/testdata/sf0.01")
    labels = dict(big.execute("SELECT doc_id, quality FROM labels").fetchall())
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(rows) == 1000 and all(rows[i].held_out for i in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    good, bad = [i for i in held if labels[i] == 1], [i for i in held if labels[i] == 0]
    assert np.mean([rows[i].predicted for i in good]) >= 0.97
    assert np.mean([rows[i].predicted == 0 for i in bad]) >= 0.9


def sets_of(docs):
    out = {}
    for i, t in docs.items():
        w = words(t.encode())
        k = min(5, len(w))
        out[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    return out


def test_near_duplicates(spark, docs):
    sets = sets_of(docs)
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    for r in queries.op5_minhash_near_dedup(spark, SF).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)


def test_token_files(spark, docs):
    from tokenizers import Tokenizer

    tok, start = Tokenizer.from_file(queries.tokenizer_path()), 0
    rows = {r.doc_id: r for r in queries.op6_token_files(spark, SF).collect()}
    assert sorted(rows) == sorted(docs)
    for i in sorted(docs):
        ids = tok.encode(docs[i], add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_nearest_neighbours(spark, con):
    vec = con.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, x = np.array([i for i, _ in vec]), np.array([v for _, v in vec], np.float32).astype(float)
    got = {}
    for r in queries.op7_ann_search(spark, SF).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [i for i in ids.tolist() if i % 20 == 0]
    found = 0
    for q, rows in got.items():
        s = x @ x[ids == q][0]
        true = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, 21))
        assert all(score == pytest.approx(s[ids == i][0], abs=1e-12) for _, i, score in rows)
        assert [(-score, i) for _, i, score in rows] == sorted((-score, i) for _, i, score in rows)
        found += len({i for _, i, _ in rows} & set(ids[true].tolist()))
    assert found >= 0.95 * 20 * len(got)


def test_decontamination(spark, con, docs):
    items = {i: words(t.encode()) for i, t in con.execute("SELECT item_id, text FROM benchmark").fetchall()}
    true = set()
    for d, t in docs.items():
        w = words(t.encode())
        have = set(w)
        for i, item in items.items():
            k = cgk.edits_allowed(len(item))
            if sum(x not in have for x in item) <= k:  # otherwise more than k words have to be edited
                got = cgk.best_alignment(item, w, k)
                if got:
                    true.add((d, i, got[1], got[2] - got[1], got[0]))
    rows = queries.op10_decontamination(spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {x[:2] for x in true}
    assert {(r.doc_id, r.item_id, r.edits) for r in rows} == {(*x[:2], x[4]) for x in true}


def test_pipeline(spark, docs):
    import corpus_pipeline
    from loomtext.llm.common import table

    now = table(spark, SF, "documents")
    columns = now.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [r.doc_id for r in now.collect()]
        from loomtext.llm.common import stored

        now = stored(stage(spark, now, SF), "stage")
        assert now.columns == columns
        kept.append((name, set(before), [r.doc_id for r in now.collect()]))
    quality, near, clean, mixed = kept
    sets = sets_of(docs)
    left = near[2]
    assert len(left) == len(set(left))
    for k, a in enumerate(sorted(left)):
        for b in sorted(left)[k + 1 :]:
            both = len(sets[a] & sets[b])
            assert not sets[a] or 100 * both < 80 * (len(sets[a]) + len(sets[b]) - both) or not sets[b]
    for gone in near[1] - set(left):
        assert any(sets[gone] and 100 * len(sets[gone] & sets[b]) >= 50 * len(sets[gone] | sets[b]) for b in left)
    leaks = {r.doc_id for r in queries.op10_decontamination(spark, SF).collect()}
    assert set(clean[2]) == set(left) - leaks
    assert set(mixed[2]) <= set(clean[2])
    out = queries.pipeline(spark, SF).collect()
    assert Counter(r.doc_id for r in out) == Counter(mixed[2])
    ends = sorted((r.start, r.start + r.n_tokens) for r in out)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_descent_solves_the_dual():
    """Against projected gradient steps on the same dual problem."""
    from loomtext.llm import nbsvm

    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 40, 12)).astype(np.int32) for _ in range(60)]
    y = np.where(rng.random(60) < 0.4, 1.0, -1.0)
    ratio = rng.normal(size=40)
    w, bias = nbsvm.dual_coordinate_descent(rows, y, ratio, epochs=400)
    x = np.zeros((60, 41))
    for i, f in enumerate(rows):
        x[i, f], x[i, 40] = ratio[f] / np.sqrt(len(f)), 1.0
    share = np.array([(y < 0).sum(), (y > 0).sum()])
    upper = 60 / 2 / share[(y > 0).astype(int)]
    q, a = (x @ x.T) * np.outer(y, y), np.zeros(60)
    for _ in range(60_000):
        a = np.clip(a - (q @ a - 1) / np.linalg.norm(q, 2), 0, upper)
    want = (a * y) @ x
    objective = lambda v: 0.5 * v @ v + (upper * np.maximum(0, 1 - y * (x @ v))).sum()
    assert objective(np.append(w, bias)) == pytest.approx(objective(want), rel=1e-3)


def test_classifier_on_many_rows_and_small_bounds(spark):
    """More labels than the bounds take: the fit stops, and every row still has a score."""
    from loomtext.llm import nbsvm

    rows = spark.range(900).selectExpr("id as doc_id", "if(id % 2 = 0, concat('good fine words ', id), concat('bad!!! JUNK ### ', id)) as text", "cast(id % 2 = 0 as int) as quality")
    for bounds in ({}, {"max_rows": 60}, {"max_features": 300}):
        model = nbsvm.fit(rows, rows.select("doc_id", "quality"), **bounds)
        got = nbsvm.score(rows, model).select("_row.quality", "score").collect()
        assert len(got) == 900 and np.mean([(r.score > 0.5) == (r.quality == 1) for r in got]) > 0.97
    assert model.slope > 0


def test_stored_texts_are_packed_well(spark, tmp_path):
    """The pipeline keeps three tables of texts at a time: packed as Spark does by itself, they passed its disk."""
    from loomtext.llm.common import stored

    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows.write.parquet(str(tmp_path / "usual"), compression="snappy")
    kept = stored(rows, "packed")
    size = lambda df: sum(os.path.getsize(f.removeprefix("file://")) for f in df.inputFiles())
    assert size(kept) < 0.8 * size(spark.read.parquet(str(tmp_path / "usual")))
    assert sorted(kept.collect()) == sorted(rows.collect())


def test_descent_keeps_no_copy_of_its_rows():
    """The rows of a fit fill a worker once; with their scaled values beside them, an executor passed its memory."""
    import tracemalloc

    from loomtext.llm import nbsvm

    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 1 << nbsvm.BITS, 1000)).astype(np.int32) for _ in range(2000)]
    y, ratio = np.where(rng.random(2000) < 0.4, 1.0, -1.0), rng.normal(size=1 << nbsvm.BITS)
    tracemalloc.start()
    try:
        nbsvm.dual_coordinate_descent(rows, y, ratio, epochs=1)
        assert tracemalloc.get_traced_memory()[1] < sum(f.nbytes for f in rows) / 2 + ratio.nbytes
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("max_rows, max_features", [(301, 10**6), (301, 300), (10**6, 10**6)])
def test_fits_see_the_first_rows_without_their_fold(spark, max_rows, max_features):
    """Each row of the sample reaches the fits once, also of ids that occur many times."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from loomtext.llm import nbsvm

    rng = np.random.default_rng(5)
    rows = [(i % 100, i % 2, np.unique(rng.integers(0, 999, rng.integers(0, 30))).astype(np.int32).tobytes()) for i in range(200)]
    rows = [r for r in rows for _ in range(3)]
    train = spark.createDataFrame(rows, "id long, y int, f binary").repartition(5).withColumns({
        "tie": F.xxhash64("f"), "key": F.xxhash64(F.lit("fit"), "id"), "fold": (F.col("id") % nbsvm.FOLDS).cast("int")})
    train = train.withColumn("row", F.row_number().over(Window.orderBy("id", "tie")).cast("long")).persist()
    want = sorted(((r.key, r.y, r.tie, r.fold, np.frombuffer(r.f, np.int32)) for r in train.collect()), key=lambda r: r[:3])[:max_rows]
    sample = nbsvm.first_rows(train, len(rows), max_rows)
    assert sorted((r.key, r.y, r.tie) for r in sample.collect()) == [r[:3] for r in want]
    ratio = rng.normal(size=1 << nbsvm.BITS)
    got = nbsvm.fitted(sample, ratio, max_features)
    assert sorted(got) == list(range(nbsvm.FOLDS + 1))
    for without, (w, bias) in got.items():
        own = [r for r in want if r[3] != without]
        own = own[: np.searchsorted(np.cumsum([len(r[4]) for r in own]), max_features, "right")]
        v, b = nbsvm.dual_coordinate_descent([r[4] for r in own], np.array([r[1] for r in own]) * 2.0 - 1, ratio)
        assert bias == b and (w == v * ratio).all()
    train.unpersist()


def test_probabilities_of_all_words_sum_to_one(spark):
    """Under a learned model, after any context: head words by their softmax, the words of each tail class by counts."""
    from pyspark.sql import functions as F

    from loomtext.llm import maxent

    rows = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id as id", "cast(coalesce(text, '') as binary) as data")
    counts = maxent.count_words(rows).cache()
    vocab = maxent.vocabulary(counts)
    tables = maxent.train(rows, vocab)
    assert any(t.any() for t in tables)
    rng = np.random.default_rng(0)
    for _ in range(20):
        before = rng.integers(0, maxent.SYMBOLS, 3).astype(np.int32)
        ctx = maxent.contexts(np.append(before, 0), np.array([4]))[:, 3:].repeat(maxent.START, axis=1)
        p = np.exp(maxent.log_probs(vocab, tables, np.arange(maxent.START), ctx))
        assert p.sum() == pytest.approx(1, abs=1e-4)
    head = counts.orderBy(F.desc("n"), "word").limit(maxent.HEAD)
    tail = counts.join(head, "word", "left_anti").groupBy(maxent.tail_class_column(F.col("word")).alias("c")).agg(F.sum(F.col("n") + 0.5).alias("mass"))
    for r in tail.collect():  # the words of a class and one unseen word
        assert (r.mass + 0.5) / vocab.tail_total[r.c] == pytest.approx(1)


def test_scores_are_sums_of_word_scores(spark, docs):
    """The score of a text, put together word by word from the model's parts."""
    from loomtext.llm import maxent

    rows = spark.createDataFrame([(i, t) for i, t in list(docs.items())[:40]], "doc_id long, text string")
    from pyspark.sql import functions as F

    got = {r.doc_id: r for r in maxent.score(rows, F.col("doc_id") % 4 == 0).collect()}
    training = rows.where("doc_id % 4 != 0").selectExpr("doc_id as id", "cast(text as binary) as data")
    counts = maxent.count_words(training)
    vocab, table = maxent.vocabulary(counts), {bytes(r.word): r.n for r in counts.collect()}
    tables = maxent.train(training, vocab)
    reader = maxent.Reader(vocab)
    for i, text in list(docs.items())[:12]:
        tokens = words(text.encode())
        places = np.array([reader[w] for w in tokens], np.int64)
        y = np.append(reader.symbols(places), vocab.end_symbol).astype(np.int32)
        lp = maxent.log_probs(vocab, tables, y, maxent.contexts(y, np.array([len(y)])))
        for j, w in enumerate([*tokens, maxent.END]):
            if y[j] >= maxent.HEAD:
                lp[j] += math.log((table.get(maxent.key_of(w), 0) + 0.5) / vocab.tail_total[y[j] - maxent.HEAD])
        assert got[i].score == pytest.approx(lp.sum() / math.log(10), rel=2e-3)


def test_stages_on_nulls_repeats_and_nothing(spark):
    """Each stage alone, on rows that are unlike documents, with columns named like internal ones, and on no rows."""
    import corpus_pipeline as pipeline
    from pyspark.sql import functions as F

    good = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) between 800 and 3000").limit(40).collect()}
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(i, t, "a", 1, "x") for i, t in good.items()] + [(900, list(good.values())[0], "a", 2, None)] * 2
    rows += [(None, None, None, None, None), (901, None, "b", 3, "y"), (902, "", "b", 3, "y"), (None, "two words", "c", 4, "z"), (903, "so " + item + " there", "c", 5, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _at long, `row` string").withColumn("score", F.lit(0.5)).withColumn("n", F.lit(1))
    for name, stage in pipeline.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, SF)
            got = out.collect()
            if name != "token files":
                assert out.columns == docs.columns
            assert got == [] or df is docs
    near = pipeline.near_dedup(spark, docs, SF).collect()
    assert sum(r.doc_id == 900 for r in near) == 0 and {901, 902} <= {r.doc_id for r in near} and len(near) == len(rows) - 2
    clean = pipeline.decontaminate(spark, docs, SF).collect()
    assert 903 not in {r.doc_id for r in clean} and sum(r.doc_id is None for r in clean) == 2
    mixed = pipeline.mix_sources(spark, docs, SF).groupBy("doc_id", "source").count().collect()
    assert all(r["count"] % 2 == 0 for r in mixed if r.doc_id == 900)
    tokens = pipeline.token_files(spark, docs, SF).collect()
    assert len(tokens) == len(rows) and {r.n_tokens for r in tokens if r.doc_id in (901, 902)} == {1}
