"""Block scans and range ranks against brute force, with a hot group."""

import random

from pyspark.sql import functions as F

from loomtext.operators import history, ranges, scan, skew


def _rows(seed=1, n=400):
    rnd = random.Random(seed)
    rows, seen = [], set()
    while len(rows) < n:
        key = 0 if rnd.random() < 0.5 else rnd.randrange(1, 6)  # half of all rows in one group
        pos = rnd.randrange(0, 700) if key == 0 else rnd.randrange(0, 60)
        if (key, pos) not in seen:
            seen.add((key, pos))
            rows.append((key, pos, rnd.randrange(-5, 6), rnd.choice([None, "a", "b", "c"])))
    return rows


def _brute(rows, inclusive, reverse):
    out = {}
    for k, p, _, _ in rows:
        def before(q):
            return (q > p if reverse else q < p) or (inclusive and q == p)
        part = sorted((r for r in rows if r[0] == k and before(r[1])), key=lambda r: r[1])
        marked = [r for r in part if r[3] is not None]
        out[k, p] = (sum(r[2] for r in part), max([r[1] for r in marked], default=None),
                     min([r[2] for r in part], default=None))
    return out


def test_running_matches_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k int, p long, v long, t string").repartition(5)
    for bits, hot_rows in ((1, 1), (3, 30), (16, 10**6)):
        for inclusive in (True, False):
            for reverse in (True, False):
                aggs = {"s": ("sum", F.col("v")), "m": ("max", F.when(F.col("t").isNotNull(), F.col("p"))), "lo": ("min", F.col("v"))}
                got = scan.running(df, ["k"], "p", aggs, inclusive=inclusive, reverse=reverse, bits=bits, hot_rows=hot_rows)
                got = {(r.k, r.p): (r.s, r.m, r.lo) for r in got.collect()}
                assert got == _brute(rows, inclusive, reverse), (bits, inclusive, reverse)


def test_group_totals(spark):
    rows = _rows(2)
    df = spark.createDataFrame(rows, "k int, p long, v long, t string")
    for hot_rows in (1, 50, 10**6):
        aggs = {"hi": ("max", F.col("p")), "n": ("sum", F.lit(1))}
        got = scan.group_totals(df, ["k"], scan.block_id(F.col("p"), 2), aggs, hot_rows=hot_rows).collect()
        assert len(got) == len(rows)
        for r in got:
            same = [x for x in rows if x[0] == r.k]
            assert (r.hi, r.n) == (max(x[1] for x in same), len(same))


def test_rank_and_pages_with_few_split_points(spark):
    rnd = random.Random(3)
    items = [("hot" if i % 3 else f"g{i % 5}", f"{rnd.randrange(10**6):06d}-{i}", None if i % 11 == 0 else f"t{i}") for i in range(300)]
    df = spark.createDataFrame(items, "g string, k string, t string").repartition(4)
    for n_blocks, hot_rows in ((1, 1), (7, 1), (1000, 30), (5, 10**6)):
        got = {(r.g, r.k): r["rank"] for r in ranges.rank(df, ["g"], "k", n_blocks=n_blocks, hot_rows=hot_rows).collect()}
        for g in {i[0] for i in items}:
            keys = sorted(i[1] for i in items if i[0] == g)
            assert [got[g, k] for k in keys] == list(range(1, len(keys) + 1))
    pages = ranges.paged_concat(df, ["g"], "k", "t", page_size=8, sep="|", hot_rows=20).orderBy("g", "page").collect()
    for g in {i[0] for i in items}:
        whole = "|".join(p.text for p in pages if p.g == g)
        assert whole == "|".join(i[2] for i in sorted((i for i in items if i[0] == g), key=lambda i: i[1]) if i[2])
        assert all(p.n_items <= 8 for p in pages)


def test_salted_lookup_keeps_every_row(spark):
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    got = skew.skewed_lookup(rows, lookup, "k", "id", hot_rows=30)
    assert {(r.id, r.k, r.v) for r in got.collect()} == {(r.id, r.k, r.v) for r in rows.join(lookup, "k", "left").collect()}
    assert got.count() == 1000
    assert skew.hot_keys(rows, ["k"], 30).collect()[0]["_splits"] > 5


def _brute_trim(msgs, budget):
    out = []
    for key in {m[0] for m in msgs}:
        part = sorted((m for m in msgs if m[0] == key), key=lambda m: m[1])
        system = part[:1] if part[0][2] == "system" else []
        room = budget - sum(m[3] for m in system)
        kept = []
        for m in reversed(part[len(system):]):
            if sum(x[3] for x in kept) + m[3] > room:
                break
            kept.insert(0, m)
        while kept and kept[0][2] != "user":
            kept.pop(0)
        out += system + kept
    return {(m[0], m[1]) for m in out}


def test_trim_matches_brute_force(spark):
    rnd = random.Random(5)
    msgs = []
    for key in range(12):
        n = 200 if key == 0 else rnd.randrange(1, 20)
        for t in range(n):
            role = "system" if t == 0 and key % 2 else rnd.choice(["user", "assistant", "system", "tool"])
            msgs.append((key, t, role, rnd.randrange(0, 9)))
    df = spark.createDataFrame(msgs, "thread_id int, turn long, role string, n long")
    for budget in (0, 3, 17, 40, 10_000):
        for bits, hot_rows in ((1, 1), (3, 50), (16, 10**6)):
            got = history.trim(df, "thread_id", budget, tokens=F.col("n"), bits=bits, hot_rows=hot_rows)
            assert {(r.thread_id, r.turn) for r in got.collect()} == _brute_trim(msgs, budget), (budget, bits)


def test_trim_keeps_system_even_if_too_long(spark):
    msgs = [(1, 0, "system", "a b c d e"), (1, 1, "user", "hi"), (1, 2, "assistant", "yes")]
    df = spark.createDataFrame(msgs, "thread_id int, turn long, role string, text string")
    assert [r.turn for r in history.trim(df, "thread_id", 3).collect()] == [0]
    assert sorted(r.turn for r in history.trim(df, "thread_id", 7).collect()) == [0, 1, 2]
    # two tokens left: the assistant row fits but may not start the history
    assert sorted(r.turn for r in history.trim(df, "thread_id", 6).collect()) == [0]


def test_merge_fork_and_lookup(spark):
    u = [(1, "a", 0, "x"), (1, "b", 1, "y"), (1, "a", 5, "x2"), (1, "c", 2, "z")]
    df = spark.createDataFrame(u, "thread_id int, msg_id string, seq long, text string")
    got = history.merge_messages(df, "thread_id", "msg_id", "seq", "text").orderBy("position").collect()
    assert [(r.msg_id, r.text, r.position) for r in got] == [("a", "x2", 1), ("b", "y", 2), ("c", "z", 3)]
    c = spark.createDataFrame([(1, 0, "sad"), (1, 1, "sad"), (2, 0, "ok")], "thread_id int, step long, mood string")
    over = spark.createDataFrame([(1, "excited")], "thread_id int, mood string")
    forked = history.fork(c, over, "thread_id", "step", 1, ["mood"])
    assert [tuple(r) for r in forked.where("step = 2").collect()] == [(1, 2, 1, "excited")]
    assert forked.count() == 4
    assert history.checkpoint_at(c, "thread_id", 1).collect()[0].step == 0
    assert history.checkpoint_at(c, "thread_id", 9).count() == 0
