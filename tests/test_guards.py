"""Guard outcomes on the demonstration messages and record scalars."""

from pyspark.sql import functions as F

from loomtext.functions import guards as G
from loomtext.functions import inference as I
from loomtext.functions import scalars as S
from loomtext.functions import text as X
from loomtext.operators import guarding, joins

CASES = [  # text, tool names, expected risk, expected blocks, expected route
    ("How much is 25 times 4?", ["calculator"], "medium", 0, "tools"),
    ("How much is 25 times 4?", [], "low", 0, "safety_check"),
    ("Write to ann@mail.org about the bill", [], "medium", 1, "safety_check"),
    ("Tell me how to HACK this", [], "blocked", 1, "blocked"),
    ("Remove the account 12345", ["delete_user"], "high", 1, "human_approval"),
    ("My number is 555-123-4567", [], "medium", 1, "safety_check"),
    ("hack ann@mail.org", ["send_email"], "blocked", 3, "blocked"),
]


def test_demo_messages(spark):
    rows = [(i, 0, "user", c[0], c[1]) for i, c in enumerate(CASES)]
    df = spark.createDataFrame(rows, "thread_id long, turn long, role string, text string, tools array<string>")
    got = guarding.guard_messages(df, "thread_id", tool_names=F.col("tools")).orderBy("thread_id").collect()
    assert [(r.risk, r.n_blocks, r.route) for r in got] == [c[2:] for c in CASES]
    assert got[2].safe_text == "Write to [EMAIL_REDACTED] about the bill"
    assert got[5].safe_text == "My number is [PHONE_REDACTED]"


def test_redaction_modes(spark):
    df = spark.createDataFrame([("a@b.co and 555.123.4567",)], "t string")
    r = df.select(G.redact(F.col("t")).alias("first"), G.redact(F.col("t"), "all").alias("every")).first()
    assert r.first == "[EMAIL_REDACTED] and 555.123.4567"
    assert r.every == "[EMAIL_REDACTED] and [PHONE_REDACTED]"


def test_approval_words_and_gate(spark):
    df = spark.createDataFrame([("YES",), ("Approve",), ("y",), ("no",), (None,)], "a string")
    got = [r[0] for r in df.select(G.is_approval(F.col("a"))).collect()]
    assert got == [True, True, True, False, False]


def test_safety_only_for_unblocked_assistant_rows(spark):
    df = spark.createDataFrame(
        [("assistant", "unsafe", False), ("assistant", "unsafe", True), ("user", "UNSAFE", False), ("assistant", None, False)],
        "role string, v string, b boolean")
    got = [r[0] for r in df.select(G.unsafe_verdict(F.col("role"), F.col("v"), F.col("b"))).collect()]
    assert got == [True, False, False, False]


def test_review_types(spark):
    pending = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "a"), (5, "a")], "id int, args string")
    dec = spark.createDataFrame([(1, "accept", None), (2, "edit", "b"), (3, "response", "no"), (4, "other", "x")], "id int, type string, args string")
    got = joins.review_outcome(pending, dec, "id").orderBy("id").collect()
    assert [(r.status, r.result) for r in got] == [
        ("accept", "executed: a"), ("edit", "executed: b"), ("response", "no"), ("error", None), ("pending", None)]


def test_unknown_tool_is_told_to_retry(spark):
    calls = spark.createDataFrame([("calculator", "1+1"), ("calculator", "import os"), ("fly", "x"), (None, "x")], "name string, args string")
    got = [r.content for r in joins.dispatch_tools(calls).collect()]
    assert got == ["accepted: 1+1", "unsafe expression", "bad tool name, retry", "bad tool name, retry"]


def test_tool_registry_view(spark):
    I.register_tools(spark)
    assert [r.name for r in spark.sql("SELECT name FROM tool_registry WHERE high_risk ORDER BY name").collect()] == ["delete_user", "send_email"]


def test_media_records(spark):
    rows = [
        ('{"streams":[{"codec_name":"h264","width":1920,"height":1080,"r_frame_rate":"30000/1001","sample_aspect_ratio":"1:1"}],"format":{"format_name":"mov","duration":"12.5"}}',),
        ('{"streams":[{}],"format":{}}',),
        ('{"streams":[{"r_frame_rate":"0/0"}],"format":{"duration":"x"}}',),
    ]
    got = spark.createDataFrame(rows, "p string").select(S.media_record(S.parse_media(F.col("p"))).alias("m")).select("m.*").collect()
    assert (got[0].resolution, round(got[0].fps, 3), got[0].duration, got[0].colorspace) == ("1920x1080", 29.97, 12.5, "N/A")
    assert (got[1].codec, got[1].resolution, got[1].fps, got[1].duration) == ("N/A", "0x0", 0.0, 0.0)
    assert got[2].fps is None and got[2].duration == 0.0


MARKUP = """---
title: x
---
# Head
<Info>gone <b>nested</b> tail</Info>
<Tip />
:::python
x = 1
:::
:::js
y
:::
--- a
b --- kept
left <br> over
"""


def test_markup_cleaning(spark):
    got = spark.createDataFrame([(MARKUP,)], "t string").select(X.clean_markup(F.col("t"))).first()[0]
    assert got == "# Head\n tail\n\n```python\nx = 1\n```\n```javascript\ny\n```\n kept\nleft  over"


def test_template_is_filled_once(spark):
    df = spark.createDataFrame([("what is {context}?", "a {question} b")], "q string, c string")
    got = df.select(X.render("Q {question} C {context} {question}", question=F.col("q"), context=F.col("c"))).first()[0]
    assert got == "Q what is {context}? C a {question} b what is {context}?"


def test_verdicts(spark):
    rows = [('{"binary_score": " YES "}', True), ("no json", False), ('a ```json {"binary_score":"no"}``` ```json\n{"binary_score":"yes"}\n``` b', True), (None, False)]
    df = spark.createDataFrame(rows, "a string, want boolean")
    got = df.select(X.is_yes(X.verdict_field(F.col("a"), "binary_score")).alias("g"), "want").collect()
    assert all(r.g == r.want for r in got)
