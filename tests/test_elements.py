"""Definitions as documents, pruned scans and the element data source."""

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomtext.sources import corpus, elements, segments

SOURCE = '''"""Doc."""
import os


@mark
@other(1)
def one(a,
        b=2):
    def inner():
        pass
    return inner  # kept
x = 1; y = 2
async def two(): return 1
class Three:
    def method(self):
        pass

if x:
    def hidden():
        pass
'''


def test_definitions_and_the_text_between():
    got = segments.segments(SOURCE)
    assert [(s["kind"], s["name"]) for s in got] == [
        ("other", None), ("function", "one"), ("other", None), ("function", "two"), ("class", "Three"), ("other", None)]
    texts = [SOURCE[s["start"] : s["start"] + s["length"]] for s in got]
    assert "".join(texts) == SOURCE and texts[1].startswith("@mark") and texts[1].endswith("# kept\n") and texts[2] == "x = 1; y = 2\n"


PIECES = ["def f():\n    pass\n", "class A: pass\r\n", "x = 1\r", "é = '''\n\n'''\n", "@d\ndef g(): return 1", "\n", "def (", "\x0c", " ", "# ü\n", ";", "if 1:\n  def h(): pass\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=8))
def test_spans_rebuild_any_text(parts):
    text = "".join(parts)
    got = segments.segments(text)
    assert "".join(text[s["start"] : s["start"] + s["length"]] for s in got) == text
    assert [s["segment_idx"] for s in got] == list(range(len(got))) and all(s["length"] > 0 for s in got)


def test_segments_of_a_table(spark):
    rows = [("a.py", SOURCE, 1), ("bad.py", "def (", 2), ("empty.py", "", 3), ("null.py", None, 4), ("deep.py", "(" * 5000, 5), ("wide.py", "é = '🙂'\ndef f(): pass", 6)]
    got = segments.code_segments(spark.createDataFrame(rows, "source string, text string, start_line int")).collect()
    by = {}
    for r in sorted(got, key=lambda r: r.segment_idx):
        by.setdefault(r.source, []).append(r)
    assert "".join(r.text for r in by["a.py"]) == SOURCE and len(by["a.py"]) == 6 and by["a.py"][0].start_line == 1
    assert [(r.kind, r.text) for r in by["bad.py"]] == [("other", "def (")] and len(by["deep.py"]) == 1
    assert [r.text for r in by["wide.py"]] == ["é = '🙂'\n", "def f(): pass"]
    assert "empty.py" not in by and "null.py" not in by


def test_excluded_files_are_not_opened(spark, folder):
    for name in ("a.py", "venv/b.py", "x y/c.py", "x y/.git/d.py"):
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "w") as f:
            f.write("x = 1")
    os.chmod(f"{folder}/venv/b.py", 0)
    scan = corpus.scan_tree(spark, folder, [".py"])
    assert sorted(r.source for r in scan.collect()) == ["a.py", "x y/c.py"]
    metrics = scan._jdf.queryExecution()
    assert "file_path" in metrics.executedPlan().toString()


def lines(path, content):
    for line in content.decode().split("\n"):
        if line == "bad":
            yield ValueError("not a record")
        elif line == "crash":
            raise KeyError(path)
        elif line:
            yield (line, len(line))


def test_elements_are_read_with_their_errors(spark, folder):
    os.makedirs(f"{folder}/in/sub")
    files = {"a.txt": "one\nbad\ntwo", "sub/b.txt": "x\ncrash\nnever", "sub/c.md": "no", "_log.txt": "no", "e.txt": ""}
    for name, text in files.items():
        with open(f"{folder}/in/{name}", "w") as f:
            f.write(text)
    elements.register(spark, "lines", "text string, size int", lines)
    df = spark.read.format("lines").option("pattern", "*.txt").option("groupBytes", 11).load(f"{folder}/in")
    assert df.rdd.getNumPartitions() == 2
    got = {(r.source, r.record): (r.text, r.size, r.error) for r in df.collect()}
    assert got == {("a.txt", 0): ("one", 3, None), ("a.txt", 1): (None, None, "not a record"), ("a.txt", 2): ("two", 3, None),
                   ("sub/b.txt", 0): ("x", 1, None), ("sub/b.txt", 1): (None, None, "KeyError: 'sub/b.txt'")}
    assert spark.read.format("lines").load(f"{folder}/in/a.txt").count() == 3
    assert spark.read.format("lines").option("pattern", "*.none").load(f"{folder}/in").collect() == []


def test_groups_have_a_bound():
    rnd = random.Random(2)
    sizes = [(f"f{i:03d}", rnd.randrange(1, 60)) for i in range(200)] + [("huge", 1000)]
    groups = elements.dealt(sizes, 100)
    size = dict(sizes)
    assert sorted(p for g in groups for p in g) == sorted(size)
    assert all(len(g) == 1 or sum(size[p] for p in g) <= 100 for g in groups) and len(groups) < 90


def test_bad_path_is_an_error(spark, folder):
    elements.register(spark, "lines", "text string, size int", lines)
    with pytest.raises(Exception):
        spark.read.format("lines").load(f"{folder}/nowhere").collect()
