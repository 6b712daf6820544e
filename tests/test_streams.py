"""Stream results equal batch results; sessions are isolated; a restart resumes."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomtext.streaming import streams
from tests import oracle

SCHEMA = "thread_id string, turn long, role string, text string"
MESSAGES = [
    ("abc2", 0, "user", "Hi, I am Bo"), ("abc2", 1, "assistant", "Hello Bo"), ("abc3", 0, "user", "what is my name?"),
    ("abc2", 2, "user", "hack it"), ("abc3", 1, "assistant", "I do not know"), ("abc2", 3, "user", "mail a@b.org"),
]


def _feed(spark, folder, rows, i):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")


def test_guard_stream_equals_batch(spark, folder):
    for i in range(0, 6, 3):
        s = _feed(spark, folder, MESSAGES[i:i + 3], i)
        streams.write_table(streams.guard_stream(s), f"{folder}/out", f"{folder}/cp").awaitTermination()
    want = streams.guard_stream(spark.createDataFrame(MESSAGES, SCHEMA))
    key = ["thread_id", "turn", "risk", "safe_text", "n_blocks"]
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/out").select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))


def test_sessions_are_isolated_and_numbered(spark, folder):
    for i in range(0, 6, 2):
        s = _feed(spark, folder, MESSAGES[i:i + 2], i)
        streams.session_history(s, f"{folder}/out", f"{folder}/cp").awaitTermination()
    two = [(r.seq, r.text) for r in streams.read_history(spark, f"{folder}/out", "thread_id", "abc2").collect()]
    three = [(r.seq, r.text) for r in streams.read_history(spark, f"{folder}/out", "thread_id", "abc3").collect()]
    assert two == [(1, "Hi, I am Bo"), (2, "Hello Bo"), (3, "hack it"), (4, "mail a@b.org")]
    assert three == [(1, "what is my name?"), (2, "I do not know")]


def test_rate_limit_counts_over_steps(spark, folder):
    for i in range(5):
        s = _feed(spark, folder, [("t", 2 * i, "user", "a"), ("t", 2 * i + 1, "user", "b"), (f"o{i}", 0, "user", "c"), (None, i, None, None)], i)
        streams.rate_limiter(s, f"{folder}/out", f"{folder}/cp", 5).awaitTermination()
    rows = spark.read.parquet(f"{folder}/out/rows")
    got = rows.where("thread_id = 't'").orderBy("turn").collect()
    assert [(r.turn, r.prior_calls, r.rate_limited) for r in got] == [(i, i, i >= 5) for i in range(10)]
    assert [r.prior_calls for r in rows.where("thread_id is null").orderBy("turn").collect()] == list(range(5))
    assert rows.where("thread_id like 'o%' and prior_calls = 0").count() == 5


def test_whole_numbers_next_to_nulls_keep_their_digits(spark, folder):
    big = (1 << 53) + 1
    spark.createDataFrame([("t", big, big + 2), ("t", big + 1, None), ("t", None, 5)], "thread_id string, turn long, n long").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("thread_id string, turn long, n long").parquet(f"{folder}/in")
    streams.session_history(stream, f"{folder}/out", f"{folder}/cp").awaitTermination()
    got = spark.read.parquet(f"{folder}/out/rows").orderBy("seq").collect()
    assert [(r.turn, r.n) for r in got] == [(big, big + 2), (big + 1, None), (None, 5)]


def test_sessions_close_behind_the_newest_time(spark, folder):
    schema = "thread_id string, at timestamp, n long"
    ticks = [  # minutes
        [("a", 0, 1), ("a", 9, 2), ("b", 5, 3), (None, 1, 4), ("a", None, 9)], [("a", 30, 5), ("b", 14, 6)], [("a", 60, 7), ("b", 3, 8)],
    ]
    for rows in ticks:
        made = spark.createDataFrame(rows, "thread_id string, m int, n long").withColumn("at", F.timestamp_seconds(F.col("m") * 60))
        made.select("thread_id", "at", "n").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        closed = streams.closed_sessions(stream, "thread_id", "at", "10 minutes", [F.sum("n").alias("n")])
        streams.write_table(closed, f"{folder}/out", f"{folder}/cp").awaitTermination()
    got = spark.read.parquet(f"{folder}/out").select("thread_id", F.unix_seconds("session_start") / 60, F.unix_seconds("session_end") / 60, "n")
    # b's row of minute 3 comes after minute 30 was seen; the session of minute 60 is still open
    want = {(None, 1, 11, 4), ("a", 0, 19, 3), ("a", 30, 40, 5), ("b", 5, 24, 9)}
    assert set(map(tuple, got.collect())) == want and got.count() == 4


def test_resume_after_failure_repeats_the_step_once(spark, folder):
    s = _feed(spark, folder, [("t", i, "user", "x") for i in range(4)], 0)
    # rows leave the state operator, then the step fails before anything is committed
    lost = streams.number_rows(s, "thread_id", "turn").withColumn("seq", F.col("n_prior") + 1).drop("n_prior")
    lost = lost.withColumn("text", F.when(F.col("seq") > 3, F.raise_error(F.lit("lost"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="lost"):
        streams.write_table(lost, f"{folder}/out/rows", f"{folder}/cp").awaitTermination()
    streams.session_history(s, f"{folder}/out", f"{folder}/cp").awaitTermination()
    s = _feed(spark, folder, [("t", 4, "user", "y")], 1)
    streams.session_history(s, f"{folder}/out", f"{folder}/cp").awaitTermination()
    got = spark.read.parquet(f"{folder}/out/rows").select("turn", "seq").orderBy("turn").collect()
    assert [tuple(r) for r in got] == [(i, i + 1) for i in range(5)]


def test_state_feeds(spark, folder):
    for i in (0, 3):
        s = _feed(spark, folder, MESSAGES[i:i + 3], i)
        streams.feed_sink(streams.state_values(s), f"{folder}/values", f"{folder}/cp1").awaitTermination()
        streams.write_table(streams.state_updates(s), f"{folder}/updates", f"{folder}/cp2").awaitTermination()
    values = sorted((r.batch, r.thread_id, r.n_messages, r.last_text) for r in spark.read.parquet(f"{folder}/values").collect())
    assert values == [(0, "abc2", 2, "Hello Bo"), (0, "abc3", 1, "what is my name?"), (1, "abc2", 4, "mail a@b.org"), (1, "abc3", 2, "I do not know")]
    assert spark.read.parquet(f"{folder}/updates").count() == 6


def test_new_files_reach_the_index_once(spark, folder):
    os.makedirs(f"{folder}/src/venv")

    def put(name, data):
        with open(f"{folder}/src/{name}", "wb") as f:
            f.write(data)

    def run(cp):
        docs = streams.watch_files(spark, f"{folder}/src")
        streams.index_stream(docs, f"{folder}/index", f"{folder}/{cp}", size=40, overlap=0).awaitTermination()
        return spark.read.parquet(f"{folder}/index")

    put("a.md", b"alpha beta gamma. " * 5)
    put("bad.md", b"\xff\xfe")
    put("venv/lib.py", b"import os")
    first = run("cp").count()
    assert first >= 2
    put("b.mdx", b"delta")
    put("c.py", b"import sys")
    out = run("cp")
    assert out.count() == first + 2 and out.where("collection = 'mdx'").count() == 1
    assert out.where("collection = 'py'").count() == 1 and out.where("source like '%venv%'").count() == 0
    assert run("fresh").count() == first + 2  # a full rescan adds nothing
    assert out.where(F.col("embedding").isNull()).count() == 0


def test_stream_ingest_of_a_folder_of_files(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    assert oracle.compare(con, entry.queries()["l05_stream_ingest"](spark, folder), entry.oracle_sql()["l05_stream_ingest"]) is None
