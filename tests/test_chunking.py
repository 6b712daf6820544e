"""Splitter properties, fixed windows, chunk ids, the SQL face."""

import random
import re

import duckdb
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomtext.operators import chunking
from loomtext.operators.chunking import split_text
from loomtext.plans.split_sql import chunks_sql

ALPHABET = st.text(alphabet="ab é\n\t.", max_size=300)


def _solid(s):
    return re.sub(r"\s", "", s)


@settings(max_examples=300, deadline=None)
@given(ALPHABET, st.integers(2, 40), st.integers(0, 30), st.sampled_from([None, "python", "rust"]))
def test_split_properties(text, size, overlap, lang):
    overlap = min(overlap, size - 1)
    chunks = split_text(text, lang, size, overlap)
    assert all(0 < len(c) <= size and c == c.strip() and c in text for c in chunks)
    assert _solid("".join(split_text(text, lang, size, 0))) == _solid(text)
    at = 0  # order: every chunk starts no earlier than the one before
    for c in chunks:
        found = text.find(c, max(0, at - size))
        assert found >= 0
        at = max(at, found)


def test_split_cases():
    assert split_text("", None, 10, 0) == []
    assert split_text(None, None, 10, 0) == []
    assert split_text("0123456789", None, 10, 0) == ["0123456789"]
    assert split_text("01234567890", None, 10, 0) == ["0123456789", "0"]
    assert split_text("01234567890", None, 10, 3) == ["0123456789", "7890"]
    assert split_text("para one\n\npara two\n\npara three", None, 20, 0) == ["para one\n\npara two", "para three"]
    assert split_text("aa bb cc dd", None, 5, 2) == ["aa bb", "cc", "dd"]  # a piece keeps its separator
    assert split_text("aa bb cc dd", None, 6, 3) == ["aa bb", "bb cc", "cc dd"]
    code = "import os\n\ndef a():\n    return 1\n\ndef b():\n    return 2\n"
    assert split_text(code, "python", 30, 0) == ["import os", "def a():\n    return 1", "def b():\n    return 2"]


def test_long_run_without_a_blank():
    text = "é7" * 2_000_000
    for overlap in (0, 50):
        chunks = split_text(text, None, 512, overlap)
        assert chunks[0] + "".join(c[overlap:] for c in chunks[1:]) == text
    assert split_text("abc", None, 1, 0) == ["a", "b", "c"]


def test_window_chunks_cover(spark):
    stretch = 256 * 462
    lengths = [0, 1, 511, 512, 513, 974, 975, 5000, stretch, stretch + 49, stretch + 50, stretch + 51, stretch + 512, 3 * stretch + 7]
    rows = [(i, ("aé7" * n)[:n]) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = chunking.window_chunks(df, 512, 50)
    assert got.where(F.length("chunk") > 512).count() == 0
    for i, text in rows:
        part = [r.chunk for r in got.where(F.col("doc_id") == i).orderBy("chunk_idx").collect()]
        assert part[0] + "".join(p[50:] for p in part[1:]) == text


def test_global_ids_run_over_the_language(spark):
    docs = [(i, "hot.py" if i % 2 else f"s{i % 7}.py", "python" if i % 3 else "rust") for i in range(60)]
    rows = [(d, s, g, c) for d, s, g in docs for c in range(1 + d % 4)]
    df = spark.createDataFrame(rows, "doc_id long, source string, language string, chunk_idx long").repartition(5)
    for n_blocks, hot_rows in ((2, 1), (9, 1), (2000, 10**6)):
        got = chunking.global_chunk_ids(df, "language", "source", "doc_id", n_blocks=n_blocks, hot_rows=hot_rows)
        got = {(r.doc_id, r.chunk_idx): r.chunk_id for r in got.collect()}
        for lang in ("python", "rust"):
            order = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[1], r[0], r[3]))
            assert [got[r[0], r[3]] for r in order] == [f"{r[1]}_{i}" for i, r in enumerate(order)]


def test_sql_face(spark):
    chunking.register_splitter(spark, "split_chunks", 5, 0)
    got = spark.sql("SELECT chunk_idx, chunk FROM split_chunks('aa bb cc', 'text') ORDER BY 1").collect()
    assert [tuple(r) for r in got] == [(0, "aa bb"), (1, "cc")]
    got = spark.sql("SELECT id, chunk FROM VALUES (1, 'aa bb cc') t(id, x), LATERAL split_chunks(x, 'text') ORDER BY chunk").collect()
    assert [tuple(r) for r in got] == [(1, "aa bb"), (1, "cc")]


def test_chunk_ids_keep_null_languages_and_sources_apart(spark):
    rows = [(None, "s", 1, 0), ("en", "s", 1, 0), ("en", "t", 1, 0), ("en", "t", 1, 1), ("en", None, 2, 0)]
    df = spark.createDataFrame(rows, "language string, source string, doc_id long, chunk_idx long")
    got = {tuple(r) for r in chunking.global_chunk_ids(df, "language", "source", "doc_id").select(
        "language", "source", "doc_id", "chunk_idx", "chunk_id").collect()}
    assert got == {(None, "s", 1, 0, "s_0"), ("en", None, 2, 0, "0"), ("en", "s", 1, 0, "s_1"),
                   ("en", "t", 1, 0, "t_2"), ("en", "t", 1, 1, "t_3")}


def test_reference_sql_of_the_splitter():
    rng = random.Random(5)
    bits = ["\n\n", "\n", " ", "a", "bcd" * 3, "é" * 40, "\ndef ", "\nclass ", "\nfn ", "\nlet ", "\t", "\u3000"]
    for language in ("text", "python", "rust", None):
        texts = [None, ""] + ["".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(100)]
        con = duckdb.connect()
        con.register("texts", pa.table({"doc_id": range(len(texts)), "language": pa.array([language] * len(texts), pa.string()), "text": texts}))
        got = {}
        for doc, i, chunk in con.execute(chunks_sql("SELECT * FROM texts", 20, 7)).fetchall():
            got.setdefault(doc, {})[i] = chunk
        for doc, text in enumerate(texts):
            assert [c for _, c in sorted(got.get(doc, {}).items())] == chunking.split_text(text, language, 20, 7)


def test_batches_are_handled_in_blocks(monkeypatch):
    import pyarrow as pa
    from loomtext.functions import blocks
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 10)
    texts, seen = [None, "", "Ä b", "x" * 30, "one", "two", "three four", None], []

    def make(some, others):
        seen.append((some.to_pylist(), others.to_pylist()))
        return pa.array([None if t is None else t.split() for t in some.to_pylist()], pa.list_(pa.string()))

    column = pa.array(texts)
    assert blocks.in_blocks(make, column, column).to_pylist() == [None if t is None else t.split() for t in texts]
    assert [t for part, _ in seen for t in part] == texts and all(a == b for a, b in seen) and len(seen) > 3
    assert all(len(a) == 1 or sum(len((t or "").encode()) for t in a) <= 10 for a, _ in seen)
    assert blocks.in_blocks(make, column.slice(0, 0), column.slice(0, 0)).to_pylist() == []
