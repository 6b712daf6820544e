"""States as of many points, and the ancestry of forks, against brute force."""

import random

import pytest

from loomtext.operators import history, joins, skew


@pytest.mark.parametrize("hot_rows,bits", [(5, 2), (10**6, 20)])
def test_state_as_of_points(spark, hot_rows, bits):
    rnd = random.Random(3)
    states = [(k, s, f"{k}-{s}") for k in ("a", "b", "c", None) for s in sorted(rnd.sample(range(0, 400, 3), 90 if k == "a" else 4))]
    points = [(rnd.choice(["a", "a", "b", None, "nobody"]), rnd.randrange(-5, 420), i) for i in range(200)] + [("a", None, 900), ("b", 7, 901), ("b", 7, 901)]
    c = spark.createDataFrame(states, "thread string, step long, mood string")
    p = spark.createDataFrame(points, "thread string, t long, n int")
    hot = skew.find(c, ["thread"], hot_rows)
    got = sorted(((r.thread, r.t, r.n, r.step, r.mood) for r in joins.state_as_of_points(c, p, "thread", "step", "t", ["mood"], hot, bits).collect()), key=repr)
    want = []
    for k, t, n in points:
        best = max((s for s in states if s[0] == k and t is not None and s[1] <= t), key=lambda s: s[1], default=(None, None, None))
        want.append((k, t, n, best[1], best[2]))
    assert got == sorted(want, key=repr)
    assert joins.state_as_of_points(c.limit(0), p, "thread", "step", "t", ["mood"]).where("step is not null").count() == 0
    assert joins.state_as_of_points(c, p.limit(0), "thread", "step", "t", ["mood"]).collect() == []


def test_ancestry_of_forks_of_forks(spark):
    rnd = random.Random(4)
    rows = []
    for key in (1, 2):
        for s in range(60 if key == 1 else 1):
            rows.append((key, s, None if s == 0 else (s - 1 if s < 40 else rnd.randrange(s))))
    rows.append((3, 5, 4))  # a parent that is not there
    up = {(k, s): p for k, s, p in rows}
    df = spark.createDataFrame(rows, "thread long, step long, parent_step long")
    heads = [(1, 59), (1, 45), (1, 39), (2, 0), (3, 5), (7, 1)]
    got = {tuple(r) for r in history.ancestry(df, spark.createDataFrame(heads, "thread long, head long"), "thread").collect()}
    want = set()
    for key, head in heads:
        s, back = head, 0
        while s is not None and (key, s) in up:
            want.add((key, head, s, back))
            s, back = up[key, s], back + 1
    assert got == want and len({x for x in want if x[1] == 39}) == 40


def test_circles_are_an_error(spark):
    df = spark.createDataFrame([(1, 0, 2), (1, 1, 0), (1, 2, 1)], "thread long, step long, parent_step long")
    with pytest.raises(ValueError):
        history.ancestry(df, spark.createDataFrame([(1, 2)], "thread long, head long"), "thread")


def test_fork_of_a_fork_keeps_links(spark):
    c = spark.createDataFrame([(1, 0, "sad"), (1, 1, "sad"), (2, 0, "ok")], "thread_id int, step long, mood string")
    over = spark.createDataFrame([(1, "excited")], "thread_id int, mood string")
    once = history.fork(c, over, "thread_id", "step", 0, ["mood"])
    again = history.fork(once, spark.createDataFrame([(1, 2, "calm")], "thread_id int, at long, mood string"), "thread_id", "step", None, ["mood"])
    assert {tuple(r) for r in again.where("thread_id = 1").collect()} == {(1, 0, None, "sad"), (1, 1, 0, "sad"), (1, 2, 0, "excited"), (1, 3, 2, "calm")}
