"""Hot keys found by a summary, blocks of sparse positions, null keys, and how often plans read their table."""

import random

import pytest
from pyspark.sql import functions as F

from loomtext.operators import history, ranges, scan, skew
from loomtext.plans import catalog


def test_summary_names_the_hot_keys(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("k"))
    want = {r.k: r["count"] for r in rows.groupBy("k").count().where("count > 100").collect()}
    assert len(want) == 2
    for tracked in (65_536, 1024):  # also when most keys do not fit the summary
        hot = skew.find(rows, ["k"], 100, tracked)
        assert dict(hot.rows) == want and bool(hot)
    assert not skew.find(rows, ["k"]) and skew.find(rows, ["k"]).rows == ()
    assert skew.find(rows.limit(0), ["k"], 0).rows == ()


def test_sparse_positions_stay_in_small_blocks(spark):
    """Positions a million apart in one group: every block holds at most four times the rows asked for."""
    df = spark.range(40_000).select(F.lit("hot").alias("k"), (F.col("id") * 1_000_003 - 7_000_000_000).alias("p"), (F.col("id") % 11).alias("v"))
    df = df.unionByName(spark.range(50).select(F.lit("cold").alias("k"), F.col("id").alias("p"), F.lit(1).cast("long").alias("v")))
    hot = skew.find(df, ["k"], 1000)
    blocks = scan.place(df, ["k"], "p", hot, bits=9).groupBy("k", scan.BLK).count().collect()
    sizes = [r["count"] for r in blocks if r.k == "hot"]
    assert len(sizes) >= 40 and max(sizes) <= 4 * 512 and sum(sizes) == 40_000
    assert [r[scan.BLK] for r in blocks if r.k == "cold"] == [0]
    got = {r.p: r.s for r in scan.running(df, ["k"], "p", {"s": ("sum", F.col("v"))}, bits=9, hot=hot).where("k = 'hot'").collect()}
    total = 0
    for i in range(40_000):
        total += i % 11
        assert got[i * 1_000_003 - 7_000_000_000] == total


@pytest.mark.parametrize("hot_rows", [3, 10**6])
def test_null_keys_are_a_group(spark, hot_rows):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, "a", "b"]), i * 50, rnd.choice(["user", "tool"]), rnd.randrange(5)) for i in range(90)]
    df = spark.createDataFrame(rows, "k string, p long, role string, v long")
    hot = skew.find(df, ["k"], hot_rows)
    run = scan.running(df, ["k"], "p", {"n": ("sum", F.lit(1).cast("long"))}, bits=2, hot=hot)
    total = scan.group_totals(df, ["k"], F.col("p") % 4, {"n": ("sum", F.lit(1).cast("long"))}, hot=hot)
    for key in (None, "a", "b"):
        own = sorted(r[1] for r in rows if r[0] == key)
        assert [r.n for r in sorted((r for r in run.collect() if r.k == key), key=lambda r: r.p)] == list(range(1, len(own) + 1))
        assert {r.n for r in total.collect() if r.k == key} == {len(own)}


def test_lookup_of_null_and_hot_keys(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id") % 40).alias("k"))
    small = spark.range(30).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    want = {(r.id, r.k, r.v) for r in rows.join(small, "k", "left").collect()}
    for hot_rows in (100, 10**6):
        joined = skew.skewed_lookup(rows, small, "k", "id", hot_rows=hot_rows)
        got = [(r.id, r.k, r.v) for r in joined.collect()]
        assert len(got) == 3000 and set(got) == want
        assert skew.skewed_lookup(rows, small, "k", "id", "inner", hot_rows=hot_rows).count() == sum(v is not None for _, _, v in want)


def test_padded_numbers_sort(spark):
    values = [-(2**63), -5, -1, 0, 7, 10, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", ranges.padded(F.col("v")).alias("s"))
    assert [r.v for r in sorted(df.collect(), key=lambda r: r.s)] == values


def scans(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count("FileScan")


@pytest.mark.parametrize("name,most", [
    ("c03_rate_limit", 1), ("k06_guarded_messages", 2), ("h07_merge_messages", 2), ("h01_trim_history", 1), ("h05_latest_user_text", 1),
    ("h08_state_fold", 1), ("h06_checkpoint_history", 1), ("c11_clamped_slice", 1), ("g05_thread_risk", 2)])
def test_plans_read_their_tables_once(spark, name, most):
    """One more job counts the rows of the table to see that no thread can be hot."""
    assert scans(catalog.builders()[name](spark, "/root/testdata/sf0.001")) <= most


def test_hot_threads_handed_over(spark):
    rnd = random.Random(9)
    rows = [(1 if i % 2 else i % 9, i, rnd.choice(["user", "assistant"]), f"t{i}", f"m{i % 40}") for i in range(300)]
    df = spark.createDataFrame(rows, "thread_id long, turn long, role string, text string, msg_id string")
    hot = skew.find(df, ["thread_id"], 50)
    assert [r[0] for r in hot.rows] == [1]
    key = lambda d: sorted(map(tuple, d.collect()), key=repr)
    assert key(history.call_ranks(df, "thread_id", "turn", 5, hot)) == key(history.call_ranks(df, "thread_id", "turn", 5))
    assert key(history.latest_user_text(df, "thread_id", hot=hot)) == key(history.latest_user_text(df, "thread_id"))
    assert key(history.merge_messages(df, "thread_id", "msg_id", "turn", "text", hot)) == key(history.merge_messages(df, "thread_id", "msg_id", "turn", "text"))
    assert key(history.trim(df, "thread_id", 30, bits=3, hot=hot)) == key(history.trim(df, "thread_id", 30))
