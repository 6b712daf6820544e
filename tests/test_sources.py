"""File scans, record intake, index and checkpoint tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from loomtext.plans import ingest
from loomtext.sources import checkpoints, corpus, index, records


@pytest.fixture
def tree(folder):
    files = {
        "a.md": b"# A", "docs/b.mdx": b"<Tip />\n:::python\nx\n:::", "src/m.py": b"import os", "src/r.rs": b"fn main() {}",
        "venv/lib.py": b"no", "src/__pycache__/m.py": b"no", "src/bad.py": b"\xff\xfe\x00bad", "src/x.txt": b"text",
    }
    for name, content in files.items():
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(content)
    return folder


def test_scan_skips_bad_and_excluded(spark, tree):
    got = {r.source: r for r in corpus.scan_tree(spark, tree, [".py", ".md", ".mdx"]).collect()}
    assert sorted(got) == ["a.md", "docs/b.mdx", "src/m.py"]
    assert got["docs/b.mdx"].filetype == "mdx" and got["docs/b.mdx"].filename == "b.mdx"
    assert got["a.md"].metadata["source"] == "a.md" and got["a.md"].text == "# A"
    bad = corpus.unreadable_files(spark, tree, [".py"]).collect()
    assert [r.path.rsplit("/", 1)[1] for r in bad] == ["bad.py"]


def test_scan_refuses_oversized_file(spark, tree):
    with pytest.raises(Exception, match="file too large"):
        corpus.scan_tree(spark, tree, [".md"], max_file_bytes=1).collect()


def test_cleaning_by_type_and_code_language(spark, tree):
    docs = {r.source: r.text for r in corpus.load_documents(spark, tree, [".md", ".mdx"]).collect()}
    assert docs["docs/b.mdx"] == "```python\nx\n```" and docs["a.md"] == "# A"
    assert {r.source: r.language for r in corpus.load_code(spark, tree).collect()} == {"src/m.py": "python", "src/r.rs": "rust"}


def test_sorted_listing(spark, tree):
    got = [r.path for r in corpus.list_files(spark, tree).collect()]
    assert got == ["a.md", "docs/b.mdx", "src/bad.py", "src/m.py", "src/r.rs", "src/x.txt"]


def test_parser_hook(spark, tree):
    def pages(path, content):
        return [(i, "line", t) for i, t in enumerate(content.decode().split("\n"), 1)]

    got = corpus.parsed_elements(spark, tree, [".mdx"], pages).orderBy("page_number").collect()
    assert [(r.page_number, r.content) for r in got] == [(1, "<Tip />"), (2, ":::python"), (3, "x"), (4, ":::")]


def _dump(folder, name, value):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f)
    return path


def test_summary_files(spark, folder):
    p = _dump(folder, "map.json", {"a.py": {"summary": "A"}, "b.py": {"summary": None}})
    assert {tuple(r) for r in records.read_summary_map(spark, p).collect()} == {("a.py", "A"), ("b.py", None)}
    tree = {"path": "r", "summary": None, "children": [
        {"path": "r/core", "summary": "Core", "children": [{"path": "r/core/a", "summary": "A"}, {"path": "r/core/b", "summary": ""}]},
        {"path": "r/misc", "summary": None, "children": [{"path": "r/misc/c", "summary": "C"}]}]}
    folders = records.read_summary_tree(spark, _dump(folder, "tree.json", tree))
    important = spark.createDataFrame([("core",)], "name string")
    got = {tuple(r) for r in records.folder_summaries(folders, important).collect()}
    assert got == {("folder", "r/core", "Core"), ("file", "r/core/a", "A")}


def test_submission_file(spark, folder):
    rec = {"submission_id": "s1", "title": "t", "authors": ["x"], "reviews": [
        {"summary": "ok", "rating": 6, "confidence": 3, "flag_for_ethics_review": ["none"]}, {"summary": "no", "rating": 3, "confidence": None}],
        "metareview": None, "decision": None, "comments": {"author": [], "reviewer": [{"title": None, "comment": "c"}]}}
    subs = records.read_submissions(spark, _dump(folder, "s.json", rec))
    flat = records.flatten_reviews(subs).orderBy("review_idx").collect()
    assert [(r.submission_id, r.review_idx, r.summary, r.rating) for r in flat] == [("s1", 0, "ok", 6.0), ("s1", 1, "no", 3.0)]
    from loomtext.operators import stats
    r = stats.review_scores(subs).first()
    assert (r.n_reviews, r.mean_rating, r.mean_confidence) == (2, 4.5, 3.0)


def test_index_add_is_idempotent_and_encodes_only_new(spark, folder):
    path = f"{folder}/index"
    seen = spark.sparkContext.accumulator(0)
    rows = [(f"c{i}", "x" if i % 2 else "y", f"t{i}") for i in range(10)]
    df = spark.createDataFrame(rows, "chunk_id string, collection string, text string")

    def finish(d):
        def count(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return d.mapInArrow(count, d.schema)

    index.add_documents(df.limit(4), path, finish=finish)
    index.add_documents(df, path, finish=finish)
    out = index.add_documents(df, path, finish=finish)
    assert out.count() == 10 and seen.value == 10
    assert index.open_collection(spark, path, "x").count() == 5
    with pytest.raises(ValueError):
        index.write_collection(df, path, backend="unknown")


def test_rebuild_replaces_only_its_collections(spark, folder):
    path = f"{folder}/index"
    df = spark.createDataFrame([("1", "x"), ("2", "y")], "chunk_id string, collection string")
    index.write_collection(df, path)
    index.write_collection(spark.createDataFrame([("3", "x")], df.schema), path)
    assert {r.chunk_id for r in spark.read.parquet(path).collect()} == {"3", "2"}


def test_ingest_counts(spark, folder):
    docs = spark.createDataFrame([("a", "word " * 1000, "x"), ("b", "short", "x"), ("c", "", "y")], "source string, text string, collection string")
    counts = ingest.ingest(docs, f"{folder}/index", size=500, overlap=50)
    got = spark.read.parquet(f"{folder}/index")
    assert counts == {"documents": 3, "chunks": got.count()}
    assert got.where("source = 'a'").count() > 10 and got.where(F.length("chunk") > 500).count() == 0


def test_checkpoint_log(spark, folder):
    m = spark.createDataFrame([(1, 0, 1, "user"), (1, 1, 2, "assistant"), (2, 0, 1, "user")], "thread_id long, step long, n_messages long, last_role string")
    checkpoints.append(checkpoints.from_messages(m), f"{folder}/log")
    checkpoints.append(checkpoints.from_messages(m.select("thread_id", (F.col("step") + 2).alias("step"), "n_messages", "last_role").where("thread_id = 1")), f"{folder}/log")
    got = checkpoints.read_thread(spark, f"{folder}/log", 1).orderBy("step").collect()
    assert [(r.step, r.parent_id, r.state.last_role) for r in got][:2] == [(0, None, "user"), (1, "1-0", "assistant")]
    assert len(got) == 4 and checkpoints.read(spark, f"{folder}/log").count() == 5


def test_union_of_shapes(spark):
    a = spark.createDataFrame([(1, "x")], "id int, t string")
    b = spark.createDataFrame([(2, 5.0)], "id int, v double")
    assert sorted(tuple(r) for r in corpus.union_sources(a, b).collect()) == [(1, "x", None), (2, None, 5.0)]


def _bytes_read(spark, folder, act):
    """Key bytes that an add may read: sizes of the data files its plan lists after pruning."""
    return sum(os.path.getsize(f.replace("file://", "")) for f in act.inputFiles())


def test_small_add_hardly_reads_the_index(spark, folder):
    path = f"{folder}/index"
    big = index.content_id(spark.range(60_000).selectExpr("id", "if(id % 3 = 0, 'x', 'y') as collection"), "id")
    index.write_collection(big, path)
    all_keys = index.existing_keys(big, path, "chunk_id")
    # ten new rows: the filter knows (nearly) none of them, so no file of the index is read
    ten = index.with_shard(index.content_id(spark.range(100_000, 100_010).selectExpr("id", "'y' as collection"), "id"), "chunk_id")
    maybe = index.possible_keys(ten, path, "chunk_id")
    assert maybe.count() <= 1
    found = index.present_keys(ten, path, "chunk_id")
    assert _bytes_read(spark, path, found) < 0.1 * _bytes_read(spark, path, all_keys)
    # ten old rows: a pushed-down list on their shards; all are found
    old = index.with_shard(big.limit(10), "chunk_id")
    present = index.present_keys(old, path, "chunk_id")
    assert present.count() == 10
    plan = present._jdf.queryExecution().executedPlan().toString()
    assert "shard" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] and "In(chunk_id" in plan
    # no key that was written is ever unknown to the filter
    assert index.possible_keys(index.with_shard(big, "chunk_id").select("shard", "chunk_id"), path, "chunk_id").count() == 60_000
    out = index.add_documents(big.unionByName(ten.drop("shard")), path)
    assert out.count() == 60_010 and out.select("chunk_id").distinct().count() == 60_010


def test_large_add_prunes_shards_at_run_time(spark, folder):
    path = f"{folder}/index"
    big = index.content_id(spark.range(20_000).selectExpr("id", "'x' as collection"), "id")
    index.write_collection(big, path)
    few_shards = index.with_shard(big, "chunk_id").where("shard in (2, 5)")
    assert few_shards.count() > index.MAX_PUSHED
    present = index.present_keys(few_shards, path, "chunk_id")
    assert present.count() == few_shards.count()
    assert "dynamicpruning" in present._jdf.queryExecution().executedPlan().toString().lower()


def test_writes_make_few_files(spark, folder):
    path = f"{folder}/index"
    many = index.content_id(spark.range(5000).repartition(64).selectExpr("id", "concat('c', id % 3) as collection"), "id")
    index.write_collection(many, path)
    files = [f for f in index.existing_keys(many, path, "chunk_id").inputFiles()]
    assert len(files) <= 3 * index.SHARDS
    log = checkpoints.from_messages(spark.range(2000).repartition(40).selectExpr("id as thread_id", "0L as step", "1L as n_messages", "'user' as last_role"))
    checkpoints.append(log, f"{folder}/log")
    assert len(spark.read.parquet(f"{folder}/log").inputFiles()) <= checkpoints.N_BUCKETS
    assert checkpoints.read(spark, f"{folder}/log").count() == 2000


def test_rebuilt_collection_loses_old_shards_and_filter_follows(spark, folder):
    path = f"{folder}/index"
    old = index.content_id(spark.range(300).selectExpr("id", "if(id < 200, 'a b/c', 'y') as collection"), "id")
    index.write_collection(old, path)
    index.write_collection(index.content_id(spark.range(1000, 1003).selectExpr("id", "'a b/c' as collection"), "id"), path)
    assert {(r.collection, r.n) for r in spark.read.parquet(path).groupBy("collection").agg(F.count("*").alias("n")).collect()} == {("a b/c", 3), ("y", 100)}
    # the three new keys are known, and keys that went may be added again
    assert index.add_documents(index.content_id(spark.range(998, 1004).selectExpr("id", "'y' as collection"), "id"), path).count() == 106
    assert index.add_documents(old, path).count() == 306


def test_interrupted_write_never_duplicates(spark, folder, monkeypatch):
    path = f"{folder}/index"
    rows = index.content_id(spark.range(50).selectExpr("id", "'x' as collection"), "id")
    monkeypatch.setattr(index, "_write_filter", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        index.write_collection(rows, path)
    monkeypatch.undo()
    assert index.add_documents(rows, path).count() == 50
    monkeypatch.setattr(index, "_write_rows", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        index.add_documents(index.content_id(spark.range(60).selectExpr("id", "'x' as collection"), "id"), path)
    monkeypatch.undo()
    assert index.add_documents(index.content_id(spark.range(60).selectExpr("id", "'x' as collection"), "id"), path).count() == 60
