"""Nulls, empty and long texts, ties, repeated rows, empty tables and foreign columns."""

import random
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtext import session
from loomtext.llm import cgk, linechunks, maxent, mixing, nbsvm, queries, setsketch, tokenfile, toolcalls, vamana, warc
from loomtext.llm.common import WordHash, fold, stored, word_table, words

LONG = "word " * 60_000
ROWS = [
    (1, "one two three four five six seven", "a", 1, 2.0), (1, "one two three four five six seven", "a", 1, 2.0),
    (2, "ONE two three four five\nsix seven", None, 2, None), (3, None, "b", 3, 1.0), (4, "", "b", 4, 1.0),
    (None, "a null id with some words in it", "a", 5, 1.0), (5, LONG, "a", 6, 1.0), (6, " \t\n ", None, 7, 1.0),
    (7, "x", "c", 8, 1.0),
]
DDL = "doc_id long, text string, source string, row long, score double"  # the last two clash with names used inside


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DDL).coalesce(2)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


def test_token_files(spark, docs, none):
    path = queries.tokenizer_path()
    enc = tokenfile.encoder(path)
    for df, n in ((docs, len(ROWS)), (none, 0)):
        manifest = tokenfile.write_token_files(df, session.scratch_path(spark, "tokens"), path)
        got = tokenfile.read_token_files(spark, manifest, enc.dtype).collect()
        assert len(got) == n
    rows = sorted(got_rows := tokenfile.read_token_files(spark, tokenfile.write_token_files(
        docs, session.scratch_path(spark, "tokens"), path), enc.dtype).collect(), key=lambda r: r.start)
    assert rows[0].doc_id is None and [r.doc_id for r in rows[1:]] == [1, 1, 2, 3, 4, 5, 6, 7]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and len(got_rows) == len(ROWS)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 6)} == {1}


@pytest.mark.parametrize("text", ["It's 2024, ÄÖ ß naïve", "<|endoftext|> a<|startoftext|>b", "ΟΔΟΣ İstanbul ﬁ x́", "a b c\x1cd", "K Å don't we'll"])
def test_words_encode_as_the_whole(text):
    enc = tokenfile.encoder(queries.tokenizer_path())
    assert np.frombuffer(enc(text.encode()), enc.dtype).tolist() == enc.tok.encode(text, add_special_tokens=False).ids


def test_mixing(spark, docs, none):
    rows = mixing.mix(docs, spark.createDataFrame([("a", 1.0), ("b", 3.0), (None, 1.0)], "source string, weight double")).collect()
    assert all(r._doc.source != "c" and 1 <= r._copy <= r._copies for r in rows)
    assert mixing.mix(none).collect() == []
    many = mixing.mix(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.when(F.col("id") < 1990, "p").otherwise("q").alias("source")))
    shares = {r.s: r.n for r in many.groupBy(F.col("_doc.source").alias("s")).agg(F.count("*").alias("n")).collect()}
    assert abs(shares["p"] - 1000) < 150 and abs(shares["q"] - 1000) < 150  # a rate of 100 is drawn in parts


def test_near_duplicates(docs, none):
    rows = {}
    for r in setsketch.near_duplicates(docs, 85, 100).collect():
        rows.setdefault(r.id, []).append(r)
    assert [r.kept for r in rows[1]] == [True, True] and rows[2][0].component_id == 1 and not rows[2][0].kept
    assert all(rows[i][0].kept and rows[i][0].n_shingles == 0 for i in (3, 4, 6))
    assert rows[None][0].component_id is None and rows[None][0].kept and rows[5][0].n_shingles == 1
    assert setsketch.near_duplicates(none).collect() == []


def test_near_copies_of_one_text(spark):
    """A star's centre need not be near all members of its bucket: chains of small edits are one component."""
    rng, base = np.random.default_rng(3), [f"w{i}" for i in range(400)]
    texts, now = [], list(base)
    for i in range(60):
        now = list(now)
        now[int(rng.integers(400))] = f"new{i}"
        texts.append((i, " ".join(now)))
    got = setsketch.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), 85, 100).collect()
    assert {r.component_id for r in got} == {0}


def test_sketch_estimates():
    rng, h = np.random.default_rng(1), WordHash()
    for share in (0.5, 0.8, 0.95):
        words = [str(i).encode() for i in range(2000)]
        same = int(2000 * 2 * share / (1 + share))
        x = setsketch.registers(np.unique(h.of(words)))
        y = setsketch.registers(np.unique(h.of(words[:same] + [b"y%d" % i for i in range(2000 - same)])))
        e = setsketch.estimate([(x > y).sum()], [(x < y).sum()], np.array([2000.0]), np.array([2000.0]))[0]
        assert abs(e - share) < 0.16
    both = np.unique(h.of([b"a", b"b", b"c"]))
    assert (setsketch.merge(setsketch.registers(both[:2]), setsketch.registers(both[1:])) == setsketch.registers(both)).all()


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(1, "two THREE four"), (2, None), (3, ""), (None, "null id with"), (4, "word word word")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.start) for r in cgk.find_items(docs, items).collect()}
    assert got == {(1, 1, 1), (2, 1, 1), (None, None, 1), (5, 4, 0)}
    assert cgk.find_items(none, items).collect() == [] and cgk.find_items(docs, items.limit(0)).collect() == []


def test_edited_items_are_found():
    rng = np.random.default_rng(5)
    items = [(i, " ".join(f"i{i}w{rng.integers(30)}" for _ in range(int(rng.integers(12, 60)))).encode()) for i in range(60)]
    index, found = cgk.Items(items, 0.1), 0
    for i, ws in enumerate(index.words):
        w = list(ws)
        for _ in range(cgk.edits_allowed(len(w))):
            w[int(rng.integers(len(w)))] = b"edited"
        found += i in {h[0] for h in index.hits([b"before"] * 20 + w + [b"after"] * 20)}
    assert found >= 58


def edited(rng, item: list, kind: str) -> list:
    w = list(item)
    for _ in range(cgk.edits_allowed(len(item))):
        what = ("change", "delete", "insert")[int(rng.integers(3))] if kind == "mixed" else kind
        at = int(rng.integers(len(w)))
        w[at : at + (what != "insert")] = [] if what == "delete" else [b"edit%d" % rng.integers(1000)]
    return w


@pytest.mark.parametrize("kind", ["change", "delete", "insert", "mixed"])
def test_long_items_with_all_allowed_edits_are_found(kind):
    rng = np.random.default_rng(11)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 400, n)).encode()) for i, n in enumerate([100, 150, 200, 250, 300] * 6)]
    index = cgk.Items(items, 0.1)
    for i, ws in enumerate(index.words):
        text = [b"before"] * 20 + edited(rng, ws, kind) + [b"after"] * 20
        assert i in {h[0] for h in index.hits(text)}


def nearest(item: list, text: list, bound: int) -> tuple[int, int, int] | None:
    prev = [(0, j) for j in range(len(text) + 1)]
    for i, a in enumerate(item, 1):
        row = [(i, 0)]
        for j, b in enumerate(text, 1):
            row.append(min((prev[j - 1][0] + (a != b), prev[j - 1][1]), (prev[j][0] + 1, prev[j][1]), (row[-1][0] + 1, row[-1][1])))
        prev = row
    (edits, start), end = min((v, j) for j, v in enumerate(prev))
    return (edits, start, end) if edits <= bound else None


def test_every_occurrence_is_found_at_its_best_place():
    rng = np.random.default_rng(3)
    for share in (0.0, 0.1, 0.3, 1.0):
        for v in (2, 4, 30):
            items = [(i, " ".join(f"w{x}" for x in rng.integers(0, v, rng.integers(1, 32))).encode()) for i in range(12)]
            index = cgk.Items(items, share)
            for _ in range(8):
                text = [b"w%d" % x for x in rng.integers(0, v + 1, rng.integers(1, 60))]
                at = int(rng.integers(len(text)))
                text[at:at] = edited(rng, index.words[int(rng.integers(12))], "mixed")
                best = [(i, nearest(ws, text, cgk.edits_allowed(len(ws), share))) for i, ws in enumerate(index.words)]
                assert index.hits(text) == [(i, b[1], b[2] - b[1], b[0]) for i, b in best if b]


def test_walks_find_what_the_lossless_lookup_finds():
    """Edited copies of all lengths and kinds between foreign words: the recall asked for, against intact pieces."""
    from tests.llm.pieces import PieceItems

    rng = np.random.default_rng(8)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 500, n)).encode()) for i, n in enumerate(list(range(3, 60)) + [100, 200, 300])]
    walks, pieces = cgk.Items(items, 0.1), PieceItems(items, 0.1)
    found = 0
    for kind in ("change", "delete", "insert", "mixed"):
        for ws in walks.words:
            text = [b"w%d" % x for x in rng.integers(0, 500, 60)] + edited(rng, ws, kind) + [b"w%d" % x for x in rng.integers(0, 500, 60)]
            want, got = pieces.hits(text), walks.hits(text)
            assert want and set(got) <= set(want)
            found += got == want
    assert found >= 0.99 * 4 * len(items)


def test_walks_grow_with_the_edits():
    needed = [cgk.walks_needed(n, cgk.walk_steps(n, 0.1)) for n in (9, 20, 100, 300)]
    assert needed[0] == 1 and needed[1] < needed[3] and needed[2] < needed[3] < 60
    assert cgk.walks_needed(40, cgk.walk_steps(40, 0.3), 0.3) == 0
    # the share of copies whose sampled keys agree is what the simulation says, on other copies than it saw
    items, copies, sizes = cgk.edited_copies(100, 10, seed=99)
    agreed = np.zeros(len(items), bool)
    for walk in range(needed[2]):
        for row in range(len(items)):
            a = cgk.sampled(items[row], np.zeros(1, np.int64), np.full(1, 100), walk, 180)
            b = cgk.sampled(copies[row][: sizes[row]], np.zeros(1, np.int64), np.full(1, sizes[row]), walk, 180)
            agreed[row] |= (a == b).any()
    assert agreed.mean() >= 0.985


def test_repeated_rows_are_reported_each(spark, monkeypatch):
    monkeypatch.setattr(cgk, "BLOCK_WORDS", 4)  # several passes
    rows = spark.createDataFrame([(1, "a b c d", "x"), (1, "a b c d", "x"), (2, "e f g", "y")], "doc_id long, text string, edits string")
    items = spark.createDataFrame([(7, "b c"), (7, "b c"), (8, "f g"), (9, "q")], "item_id long, text string")
    got = sorted(tuple(r) for r in cgk.find_items(rows, items).collect())
    assert got == [(1, 7, 1, 2, 0)] * 4 + [(2, 8, 1, 2, 0)]


def test_warc(spark, none):
    pages = spark.createDataFrame([(1, "u", "same"), (2, None, "same"), (2, "v", "same"), (None, "w", "same"), (3, "line\nbreak", None),
                                   (4, "x", ""), (5, "y", "\x1f\x8b\x08 not a member " + LONG)], "page_id long, url string, html string").coalesce(1)
    files = warc.write_warc(pages, session.scratch_path(spark, "warc"))
    for size in (1 << 20, 37):
        rows = warc.read_warc(spark, files, size).collect()
        assert len(rows) == 7
        kinds = sorted((r.record_id, r.record_type, r.refers_to) for r in rows)
        assert [k for k in kinds if k[0] == "2"] == [("2", "response", None), ("2", "revisit", "2")] or \
            sorted(str(k) for k in kinds if k[0] == "2") == sorted(map(str, [("2", "response", None), ("2", "revisit", "2")]))
        assert ("1", "revisit", "2") in kinds and ("null", "revisit", "2") in kinds and ("3", "revisit", "4") in kinds
        assert {r.payload_bytes for r in rows if r.record_id in "12"} == {4}
    assert warc.read_warc(spark, warc.write_warc(none.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html")),
                                                 session.scratch_path(spark, "warc"))).collect() == []


@pytest.fixture()
def resplit(spark, monkeypatch, tmp_path):
    """Runs work on a table of ten files whose scans are split otherwise after the first job, as when executors join."""
    import corpus_pipeline
    from loomtext.llm import common

    key = "spark.sql.files.minPartitionNum"

    def moved(df, name):
        out = common.stored(df, name)
        spark.conf.set(key, "64")
        return out

    def run(rows: list, ddl: str, work):
        for i in range(10):
            spark.createDataFrame(rows[i::10], ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
        spark.conf.set(key, "1")
        got = work(spark.read.schema(ddl).parquet(str(tmp_path / "t"))).collect()
        assert spark.conf.get(key) == "64"
        return got

    for module in (setsketch, warc, corpus_pipeline):
        monkeypatch.setattr(module, "stored", moved)
    yield run
    spark.conf.unset(key)


def texts_of(n: int) -> list[str]:
    return [" ".join(f"t{i}w{j}" for j in range(30)) for i in range(n)]


def test_near_dedup_when_scans_are_split_otherwise(spark, resplit):
    import corpus_pipeline

    rows = [(i, t) for i, t in enumerate(texts_of(40))] + [(100 + i, t + " more") for i, t in enumerate(texts_of(20))]
    got = resplit(rows, "doc_id long, text string", lambda d: corpus_pipeline.near_dedup(spark, d, ""))
    assert sorted(r.doc_id for r in got) == list(range(40))


def test_near_duplicates_when_scans_are_split_otherwise(resplit):
    rows = [(i, t) for i, t in enumerate(texts_of(40))] + [(100 + i, t + " more") for i, t in enumerate(texts_of(20))]
    got = resplit(rows, "doc_id long, text string", setsketch.near_duplicates)
    assert {r.id: r.component_id for r in got} == {i: i % 100 for i, _ in rows}


def test_decontamination_when_scans_are_split_otherwise(spark, resplit, tmp_path):
    import corpus_pipeline

    texts = texts_of(60)
    spark.createDataFrame(list(enumerate(texts[:20])), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = resplit(list(enumerate(texts)), "doc_id long, text string", lambda d: corpus_pipeline.decontaminate(spark, d, str(tmp_path)))
    assert sorted(r.doc_id for r in got) == list(range(20, 60))


def test_warc_when_scans_are_split_otherwise(spark, resplit):
    rows = [(i, "u", f"body {i % 20}") for i in range(60)]
    got = resplit(rows, "page_id long, url string, html string",
                  lambda p: warc.read_warc(spark, warc.write_warc(p, session.scratch_path(spark, "warc"))))
    assert {int(r.record_id): r.refers_to and int(r.refers_to) for r in got} == {i: 40 + i % 20 if i < 40 else None for i in range(60)}
    assert sorted(bytes(r.payload) for r in got if r.record_type == "response") == sorted(f"body {i}".encode() for i in range(20))


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (5, 0), (None, 1), (7, None)], "doc_id long, quality int")
    model = nbsvm.fit(docs, labels)
    rows = nbsvm.score(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows) and rows[0]._row.row == 1
    only = nbsvm.fit(docs, labels.where("quality = 1"))
    assert {r.score > 0.5 for r in nbsvm.score(docs, only).collect()} == {True}
    assert nbsvm.fit(none, labels).score(np.zeros(0, np.int32)) == 0.5 and nbsvm.score(none, model).collect() == []


def test_lm_scoring(spark, docs, none):
    rows = maxent.score(docs, fold(F.col("doc_id"), 5) == 1).collect()
    assert len(rows) == len(ROWS) and all(np.isfinite(r.score) and r.score < 0 for r in rows)
    assert maxent.score(none, F.lit(False)).collect() == []
    unseen = maxent.score(docs, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens) for r in unseen} == {(0, 0)}
    assert maxent.tail_class(b"a") == spark.range(1).select(maxent.tail_class_column(F.lit("a").cast("binary"))).first()[0]


def test_words_of_slices(spark, monkeypatch):
    texts = ["One two", "x", "a B\tc  d", "", "Ä é E", "one B"]
    column = pa.array([t.encode() for t in texts], pa.binary())
    for at in range(len(texts)):
        found, index, sizes = word_table(column.slice(at))
        assert [found[i] for i in index] == [w for t in texts[at:] for w in words(t.encode())]
        assert sizes.tolist() == [len(words(t.encode())) for t in texts[at:]]
    monkeypatch.setattr(maxent, "LEARN_BYTES", 8)  # texts are scored slice by slice
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = sorted(maxent.score(table, F.lit(False)).collect(), key=lambda r: r.doc_id)
    assert [(r.n_tokens, r.n_known) for r in rows] == [(len(words(t.encode())) + 1,) * 2 for t in texts]


def test_words_of_a_block_are_looked_up_together():
    """A block takes no Python call for each of its words; places and symbols are those of the words one by one."""
    long, known = "y" * 70, [b"the", b"a", maxent.key_of(b"y" * 70), b"seldom"]
    symbols = np.array([0, 1, 2, maxent.HEAD + maxent.tail_class(b"seldom")], np.int32)
    none = np.zeros(0, np.float32)
    reader = maxent.Reader(maxent.Vocabulary(b"\n".join(known), np.arange(4), symbols, 3, 1, none, none, none, 9, 5))
    texts = ["The a", " ".join(f"w{i:x}" for i in range(20_000)), "", f"{long} {'z' * 65} é q seldom a", long + "x"]
    column = pa.array([t.encode() for t in texts], pa.binary())
    reader.block(column.slice(3))  # what is made once for a process
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        found, index, sizes, places = reader.block(column)
    finally:
        sys.setprofile(None)
    assert calls["call"] < 1000
    flat = [maxent.key_of(w) for t in texts for w in words(t.encode())]
    place = {w: i for i, w in enumerate(known)}
    assert [place.get(w, -1 - maxent.tail_class(w)) for w in flat] == places[index].tolist()
    assert [w for w in found.take(pa.array(index)).to_pylist()] == flat and sizes.tolist() == [len(words(t.encode())) for t in texts]
    assert (reader.symbols_of(found) == reader.symbols(places)).all() and reader[b"q"] == -1 - maxent.tail_class(b"q")


@pytest.mark.parametrize("flush", (2, 1000))
def test_counts_of_words(spark, monkeypatch, flush):
    monkeypatch.setattr(maxent, "FLUSH_WORDS", flush)
    texts = ["a B b", "", None, "c " * 9 + "x" * 80, "b " + "x" * 80, "é"] * 3
    rows = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("cast(coalesce(text, '') as binary) as data")
    true = Counter(maxent.key_of(w) for t in texts for w in words((t or "").encode())) + Counter({maxent.END: len(texts)})
    assert {bytes(r.word): r.n for r in maxent.count_words(rows).collect()} == true
    assert maxent.count_words(rows.limit(0)).collect() == []


def test_steps_sum_the_gradients_of_a_row():
    """Rows with one, several and very many gradients; features whose rows are apart take one step each."""
    rng = np.random.default_rng(4)
    rows = np.stack([rng.zipf(1.3, 4000) % 50, 50 + rng.integers(0, 2000, 4000), np.full(4000, 2100)]).astype(np.int16)
    grad = rng.normal(size=(4000, 8)).astype(np.float32)
    table, squares, seen = np.ones((2200, 8), np.float32), np.ones((2200, 8), np.float32), np.zeros(2200, np.float32)
    sums = np.zeros((2200, 8))
    for r in rows:
        np.add.at(sums, r, grad)
    maxent.update(table, squares, seen, rows, grad)
    assert np.allclose(squares, 1 + sums**2, rtol=1e-3, atol=1e-3)
    assert np.allclose(table, 1 - maxent.STEP * sums / np.sqrt(1 + sums**2), atol=1e-4)
    assert (seen == np.bincount(rows.ravel(), minlength=2200)).all()


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)) * rng.uniform(0.5, 3, (300, 1))
    rows = [(i, [float(v) for v in x[i]]) for i in range(300)]
    rows += [(400, rows[0][1]), (401, rows[0][1]), (401, rows[0][1]), (500, None), (501, [0.0] * 8), (502, [None] + [1.0] * 7),
             (503, [float("nan")] * 8), (504, [1.0, 2.0]), (None, rows[1][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vamana.search(vamana.build_index(vectors, shard_rows=256), vectors.where("vec_id in (0, 20, 500, 504)"), 20).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert set(by) == {0, 20} and all(len(v) == 20 and not {500, 501, 502, 503, 504} & set(v) for v in by.values())
    scores = [(-(x[0] @ x[i]), i) for i in range(1, 300)] + [(-(x[0] @ x[0]), 400), (-(x[0] @ x[0]), 401)]
    true = [i for _, i in sorted(scores)[:20]]
    assert len(set(true) & set(by[0])) >= 18 and {400, 401} <= set(by[0])
    empty = vectors.limit(0)
    assert vamana.search(vamana.build_index(empty), vectors, 3).collect() == []


def test_line_chunks(spark, docs, none):
    rows = {(r.doc_id, r.text) for r in linechunks.remove_repeated(docs).collect()}
    assert (3, None) in rows and (4, "") in rows and len(linechunks.remove_repeated(docs).collect()) == len(ROWS)
    assert linechunks.remove_repeated(none).collect() == []
    shared = "\n".join(f"shared line number {i}" for i in range(40))
    two = spark.createDataFrame([(i, f"own {i}\nmore {i}\n{shared}\nend {i}") for i in range(2)], "doc_id long, text string")
    out = {r.doc_id: r for r in linechunks.remove_repeated(two).collect()}
    assert out[0].n_removed == 0 and out[1].n_removed >= 20 and out[1].text.startswith("own 1\nmore 1")
    odd = spark.createDataFrame([(1, "\ns\nc\n\nsx\ncx\n")], "doc_id long, text string")
    assert linechunks.remove_repeated(odd).first().text == "\ns\nc\n\nsx\ncx\n"


def test_tool_calls(spark):
    calls = spark.createDataFrame([
        (1, "a", 0, "f", '{"b":1,"a":"x"}', []), (1, "b", 1, "f", '{"a":2}', ["a", "zz"]), (1, "c", 2, "g", "{", ["b"]),
        (1, "d", 3, "f", None, ["e"]), (1, "e", 4, "f", '{"a":"y","c":1.5}', ["d"]), (1, "a", 5, "f", "{}", None),
        (2, None, 0, "f", "{}", None), (None, "q", 0, None, "{}", None), (3, "r", 0, "f", '{"a":"z"}', None), (3, "r", 0, "f", '{"a":"z"}', None),
    ], "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>")
    results = spark.createDataFrame([(1, "a", 1, "ok"), (1, "a", 2, "again"), (9, "a", 1, "lost"), (None, "a", 1, "?")],
                                    "conv_id long, call_id string, turn long, content string")
    schemas = spark.createDataFrame([("f", "a", "string", True), ("f", "b", "integer", False), (None, "x", "string", None)],
                                    "name string, field string, type string, required boolean")
    rows = {(r.conv_id, r.call_id, r.turn, r.status): r for r in toolcalls.link(calls, results, schemas).collect()}
    assert len(rows) == 12
    assert rows[1, "a", 0, "linked"].message == (
        '{"arguments":{"a":"x","b":1},"depends_on":[],"errors":[],"id":"a","level":0,"name":"f","result":"ok","status":"linked"}')
    assert rows[1, "b", 1, "no_result"].level == 1 and rows[1, "b", 1, "no_result"].errors == ["type:a", "no call:zz"]
    assert rows[1, "c", 2, "no_result"].level == 2 and rows[1, "c", 2, "no_result"].errors == ["unknown tool"]
    assert rows[1, "d", 3, "no_result"].errors == ["no object", "cycle"] and rows[1, "e", 4, "no_result"].errors == ["unknown:c", "cycle"]
    assert rows[1, "a", 5, "repeated_call"].errors == ["missing:a"] and rows[3, "r", 0, "no_result"].n_rows == 2
    assert {(2, None, 0, "no_id"), (None, "q", 0, "no_id"), (1, "a", 2, "repeated_result"), (9, "a", 1, "orphan_result"), (None, "a", 1, "no_id")} <= set(rows)
    assert toolcalls.link(calls.limit(0), results.limit(0), schemas).collect() == []


def test_levels_of_chains_joins_and_cycles(spark):
    rng = random.Random(4)
    needs = {0: {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(37)}}  # a chain
    needs[1] = {f"c{i}": [f"c{j}" for j in rng.sample(range(i), min(i, rng.choice([0, 1, 1, 1, 2, 3])))] for i in range(60)}
    needs[2] = {"a": ["c"], "b": ["a"], "c": ["b"], "d": ["a"], "e": ["d", "f"], "f": [], "g": ["f", "f", None, "none"], "h": ["h"], "i": ["f", "g"]}
    needs[3] = {f"s{i}": ["hub"] for i in range(9)} | {"hub": []}  # a star

    def level(conv, call, above=()):
        if call in above:
            return None
        below = [level(conv, n, (*above, call)) for n in needs[conv][call] if n in needs[conv]]
        return None if None in below else 1 + max(below, default=-1)

    rows = [(conv, call, need) for conv in needs for call, need in needs[conv].items()]
    calls = spark.createDataFrame(rows, "conv_id long, call_id string, depends_on array<string>")
    got = {(r.conv_id, r.call_id): r.level for r in toolcalls.levels(calls).collect()}
    want = {(c, k): level(c, k) for c in needs for k in needs[c] if any(n in needs[c] for n in needs[c][k])}
    assert got == {k: v for k, v in want.items() if v is not None}


def test_crc_folds(spark):
    got = spark.createDataFrame([(7,), (None,)], "doc_id long").select(fold(F.col("doc_id"), 5)).collect()
    assert [r[0] for r in got] == [zlib.crc32(b"7") % 5, 0]


@pytest.mark.parametrize("kind", ["unit", "gaussian", "unequal"])
def test_recall_on_full_shards(spark, monkeypatch, kind):
    """16,384 vectors and a query set of several blocks, against all products."""
    rng, n, dims, k = np.random.default_rng(4), 16_384, 48, 20
    x = rng.normal(size=(n, dims)).astype(np.float32)
    if kind != "gaussian":
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "unequal":
        x *= rng.uniform(0.3, 3, (n, 1)).astype(np.float32)
    monkeypatch.setattr(vamana, "QUERY_ROWS", 64)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    index = vamana.build_index(vectors)
    assert index.count() == (1 if kind == "unit" else index.select("band").distinct().count())
    asked = list(range(0, n, 100))
    got = {}
    for r in vamana.search(index, vectors.where("vec_id % 100 = 0"), k).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for i in asked:
        score = x.astype(np.float64) @ x[i].astype(np.float64)
        score[i] = -np.inf
        hits += len(got[i] & set(np.argsort(-score)[:k].tolist()))
    assert hits / (k * len(asked)) >= 0.93


def test_lengths_without_limits(spark):
    rows = [(1, [1e200, 0.0]), (2, [1e-200, 1e-200]), (3, [1.0, 1.0]), (4, [-1.0, 2.0]), (5, [1e308, 1e308])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vamana.search(vamana.build_index(vectors), vectors.where("vec_id = 3"), 2).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [5, 1]


def test_encoding_holds_a_small_block():
    import tracemalloc
    enc = tokenfile.encoder(queries.tokenizer_path())
    rng = random.Random(3)
    texts = pa.array([" ".join(f"w{rng.randrange(500)}" for _ in range(600)).encode() for _ in range(3000)], pa.binary())  # 7 MB
    tracemalloc.start()
    n = sum(int(counts.sum()) for _, counts in enc.texts(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n >= 600 * 3000 and peak < 100_000_000


def sent_bytes(spark, text_bytes=200_000):
    """Bytes of each Arrow batch that a Python step gets of 60 texts in one partition."""
    def sizes(it):
        for batch in it:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["n"])

    rows = spark.range(60, numPartitions=1).select(F.expr(f"repeat('x', {text_bytes})").alias("text"))
    return [r.n for r in rows.mapInArrow(sizes, "n long").collect()]


def test_batches_of_texts_are_bounded_by_bytes(spark):
    assert max(sent_bytes(spark)) > 10_000_000  # Spark's own bound
    with session.text_batches(spark):
        got = sent_bytes(spark)
        assert max(got) <= session.BATCH_BYTES + 500_000 and sum(got) >= 60 * 200_000
        assert len(sent_bytes(spark, 5_000_000)) == 60  # a longer text is a batch of its own
    assert spark.conf.get(session.BATCH_SETTING, None) is None
    spark.conf.set(session.BATCH_SETTING, "1000000")
    try:
        with session.text_batches(spark):
            assert max(sent_bytes(spark)) < 1_500_000
        assert spark.conf.get(session.BATCH_SETTING, None) == "1000000"
    finally:
        spark.conf.unset(session.BATCH_SETTING)


def test_texts_of_the_stages_go_out_in_bounded_batches(spark, docs, monkeypatch):
    import corpus_pipeline

    bounds = {}

    def noted(df, name, write=stored):
        bounds.setdefault(name, set()).add(spark.conf.get(session.BATCH_SETTING, None))
        return write(df, name)

    for module in (corpus_pipeline, nbsvm, setsketch, tokenfile):
        monkeypatch.setattr(module, "stored", noted)
    sf_dir = "/root/testdata/sf0.001"
    corpus_pipeline.quality(spark, docs, sf_dir)
    corpus_pipeline.near_dedup(spark, docs, sf_dir)
    bounds.pop("gone")
    corpus_pipeline.decontaminate(spark, docs, sf_dir)
    corpus_pipeline.token_files(spark, docs, sf_dir)
    for name in ("nbsvm-train", "good", "sketches", "sets", "links", "gone", "token-manifest"):
        assert bounds[name] == {str(session.BATCH_BYTES)}, name
    assert spark.conf.get(session.BATCH_SETTING, None) is None
