"""Catalogue: guards, tool calls and review decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions import guards as G
from loomtext.operators import guarding, history, joins, skew, stats
from loomtext.plans.catalog import query, table

# ---------------------------------------------------------------- derived inputs

#: Messages with planted hits: an e-mail address, a phone number, a banned word, or both kinds
#: of personal data.
PLANTED_SQL = """SELECT conv_id AS thread_id, turn, role, text || CASE (conv_id + turn) % 7
  WHEN 1 THEN ' mail bob.s@evil-site.com now' WHEN 2 THEN ' call 555-123-4567 today'
  WHEN 3 THEN ' how to HACK it' WHEN 4 THEN ' x@y.org or 555.123.4567' ELSE '' END AS text,
  CASE (conv_id * 3 + turn) % 5 WHEN 0 THEN ['send_email'] WHEN 1 THEN ['calculator']
  WHEN 2 THEN ['calculator', 'delete_user'] ELSE []::VARCHAR[] END AS tool_names,
  CASE WHEN conv_id % 3 = 0 THEN true WHEN conv_id % 3 = 1 THEN false END AS approved,
  CASE toxic WHEN 1 THEN 'Rating: unsafe' WHEN 0 THEN 'SAFE' END AS verdict
FROM conversations LEFT JOIN labels ON conv_id = doc_id"""


def plant(messages):
    """Planted texts, tool names and approvals: a projection, for tables and streams."""
    tid = F.col("thread_id")
    kind = (tid + F.col("turn")) % 7
    extra = (
        F.when(kind == 1, " mail bob.s@evil-site.com now").when(kind == 2, " call 555-123-4567 today")
        .when(kind == 3, " how to HACK it").when(kind == 4, " x@y.org or 555.123.4567").otherwise("")
    )
    t = (tid * 3 + F.col("turn")) % 5

    def names(*n):
        return F.array(*[F.lit(x) for x in n])

    tools = (
        F.when(t == 0, names("send_email")).when(t == 1, names("calculator"))
        .when(t == 2, names("calculator", "delete_user")).otherwise(F.array().cast("array<string>"))
    )
    return messages.withColumn("text", F.concat("text", extra)).withColumn("tool_names", tools).withColumn(
        "approved", F.when(tid % 3 == 0, True).when(tid % 3 == 1, False)
    )


def hot_threads(spark, sf) -> skew.HotKeys:
    """Found once for the table, for every operator on its threads."""
    return skew.find(table(spark, sf, "conversations").withColumnRenamed("conv_id", "thread_id"), ["thread_id"])


def planted(spark, sf, hot: skew.HotKeys | None = None):
    verdict = F.when(F.col("toxic") == 1, "Rating: unsafe").when(F.col("toxic") == 0, "SAFE")
    # a thread id meets one label, and a thread's rows are spread by its turns
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("thread_id"), "toxic")
    c = table(spark, sf, "conversations").withColumnRenamed("conv_id", "thread_id")
    c = skew.skewed_lookup(c, labels, "thread_id", "turn", hot=hot_threads(spark, sf) if hot is None else hot)
    return plant(c).withColumn("verdict", verdict).drop("toxic")


#: Tool calls out of the event log; every `view` asks for a tool that is not registered.
CALLS_SQL = """SELECT event_id AS call_id, user_id AS thread_id, event_id AS seq,
  CASE event_type WHEN 'purchase' THEN 'send_email' WHEN 'error' THEN 'delete_user' WHEN 'click' THEN 'calculator'
  WHEN 'view' THEN 'web_lookup' END AS name,
  CASE WHEN event_type = 'click' THEN value || ' * ' || user_id ELSE props END AS args
FROM events WHERE event_type <> 'signup'"""


def tool_calls(spark, sf):
    kind = F.col("event_type")
    name = (
        F.when(kind == "purchase", "send_email").when(kind == "error", "delete_user")
        .when(kind == "click", "calculator").when(kind == "view", "web_lookup")
    )
    math = F.concat(F.col("value").cast("string"), F.lit(" * "), F.col("user_id").cast("string"))
    return table(spark, sf, "events").where(kind != "signup").select(
        F.col("event_id").alias("call_id"), F.col("user_id").alias("thread_id"), F.col("event_id").alias("seq"),
        name.alias("name"), F.when(kind == "click", math).otherwise(F.col("props")).alias("args"),
    )


DECISIONS_SQL = f"""SELECT call_id, CASE call_id % 5 WHEN 0 THEN 'accept' WHEN 1 THEN 'edit' WHEN 2 THEN 'response' ELSE 'skip' END AS type,
  CASE call_id % 5 WHEN 1 THEN 'edited ' || args WHEN 2 THEN 'reviewer says no' END AS args
FROM ({CALLS_SQL}) WHERE name IN ('send_email', 'delete_user') AND call_id % 5 <> 4"""


def decisions(spark, sf):
    r = F.col("call_id") % 5
    c = tool_calls(spark, sf).where(F.col("name").isin(G.HIGH_RISK_TOOLS)).where(r != 4)
    return c.select(
        "call_id", F.when(r == 0, "accept").when(r == 1, "edit").when(r == 2, "response").otherwise("skip").alias("type"),
        F.when(r == 1, F.concat(F.lit("edited "), "args")).when(r == 2, "reviewer says no").alias("args"),
    )


# ---------------------------------------------------------------- guards (C)

_BANNED_SQL = "(" + " OR ".join(f"contains(lower(text), '{w}')" for w in G.BANNED_WORDS) + ")"
_KIND_SQL = f"CASE WHEN regexp_matches(text, '{G.EMAIL_PATTERN}') THEN 'email' WHEN regexp_matches(text, '{G.PHONE_PATTERN}') THEN 'phone' END"
_MAIL_SQL = f"regexp_replace(text, '{G.EMAIL_PATTERN}', '{G.EMAIL_MARK}', 'g')"
_SAFE_SQL = f"""CASE {_KIND_SQL} WHEN 'email' THEN {_MAIL_SQL}
  WHEN 'phone' THEN regexp_replace(text, '{G.PHONE_PATTERN}', '{G.PHONE_MARK}', 'g') ELSE text END"""
_TOOL_SQL = "CASE WHEN len(tool_names) = 0 THEN 'low' WHEN list_has_any(tool_names, ['send_email', 'delete_user']) THEN 'high' ELSE 'medium' END"


@query("c01_keyword_block", f"SELECT thread_id, turn, role = 'user' AND {_BANNED_SQL} AS blocked FROM ({PLANTED_SQL})")
def keyword_block(spark, sf):
    return planted(spark, sf).select("thread_id", "turn", G.keyword_block(F.col("role"), F.col("text")).alias("blocked"))


@query("c01_terms_in_documents", """
SELECT doc_id, contains(lower(text), 'license') OR contains(lower(text), 'password') OR contains(lower(text), 'key') AS hit FROM documents""")
def terms_in_documents(spark, sf):
    terms = ["license", "password", "key"]
    return table(spark, sf, "documents").select("doc_id", G.has_banned_word(F.col("text"), terms).alias("hit"))


@query("c02_redact_messages", f"""
SELECT thread_id, turn, {_KIND_SQL} AS kind, {_SAFE_SQL} AS safe_first,
       regexp_replace({_MAIL_SQL}, '{G.PHONE_PATTERN}', '{G.PHONE_MARK}', 'g') AS safe_all FROM ({PLANTED_SQL})""")
def redact_messages(spark, sf):
    t = F.col("text")
    return planted(spark, sf).select("thread_id", "turn", G.pii_kind(t).alias("kind"), G.redact(t).alias("safe_first"),
                                     G.redact(t, "all").alias("safe_all"))


@query("c02_redact_documents", f"SELECT doc_id, {_KIND_SQL} AS kind, md5({_SAFE_SQL}) AS safe_md5 FROM documents")
def redact_documents(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", G.pii_kind(t).alias("kind"), F.md5(G.redact(t)).alias("safe_md5"))


@query("c03_rate_limit", f"""
SELECT call_id, thread_id, row_number() OVER (PARTITION BY thread_id ORDER BY seq) - 1 AS prior_calls,
       row_number() OVER (PARTITION BY thread_id ORDER BY seq) - 1 >= 5 AS rate_limited FROM ({CALLS_SQL})""")
def rate_limit(spark, sf):
    return history.call_ranks(tool_calls(spark, sf), "thread_id", "seq", G.CALL_LIMIT).select(
        "call_id", "thread_id", "prior_calls", "rate_limited")


@query("c04_tool_risk", f"SELECT thread_id, turn, {_TOOL_SQL} AS risk, {_TOOL_SQL} = 'high' AS needs_approval FROM ({PLANTED_SQL})")
def tool_risk(spark, sf):
    risk = G.tool_risk(F.col("tool_names"))
    return planted(spark, sf).select("thread_id", "turn", risk.alias("risk"), (risk == "high").alias("needs_approval"))


@query("c05_approval_gate", f"""
SELECT c.call_id, c.name, coalesce(lower(d.type) IN ('accept', 'approve', 'yes', 'y'), false) AS approved,
       CASE WHEN c.name IN ('send_email', 'delete_user') AND NOT coalesce(d.type = 'accept', false) THEN 'blocked' ELSE 'allowed' END AS gate
FROM ({CALLS_SQL}) c LEFT JOIN ({DECISIONS_SQL}) d USING (call_id)""")
def approval_gate(spark, sf):
    answers = decisions(spark, sf).select(
        "call_id", F.when(F.col("type") == "accept", "YES").otherwise(F.col("type")).alias("answer"))
    c = tool_calls(spark, sf).join(answers, "call_id", "left")
    approved = G.is_approval(F.col("answer"))
    return c.select("call_id", "name", approved.alias("approved"),
                    G.approval_status(F.col("name").isin(G.HIGH_RISK_TOOLS), approved).alias("gate"))


@query("c06_output_safety", f"""
SELECT thread_id, turn, role = 'assistant' AND coalesce(contains(upper(verdict), 'UNSAFE'), false) AS unsafe FROM ({PLANTED_SQL})""")
def output_safety(spark, sf):
    return planted(spark, sf).select(
        "thread_id", "turn", G.unsafe_verdict(F.col("role"), F.col("verdict"), F.lit(False)).alias("unsafe"))


GUARDED_SQL = f"""
WITH p AS (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY turn) - 1 AS prior_calls,
    role = 'user' AND {_BANNED_SQL} AS kw, CASE WHEN role = 'user' THEN {_KIND_SQL} END AS pii,
    CASE WHEN role = 'user' THEN {_SAFE_SQL} ELSE text END AS safe_text, {_TOOL_SQL} AS tools FROM ({PLANTED_SQL})),
f AS (SELECT *, prior_calls >= 5 AS limited, tools = 'high' AS needs,
    role = 'assistant' AND NOT (kw OR prior_calls >= 5) AND coalesce(contains(upper(verdict), 'UNSAFE'), false) AS unsafe FROM p),
guarded AS (SELECT thread_id, turn, kw AS keyword_blocked, pii, safe_text, limited AS rate_limited, needs AS needs_approval, unsafe,
    CASE WHEN kw OR limited OR unsafe THEN 'blocked' WHEN tools = 'high' THEN 'high'
         WHEN pii IS NOT NULL OR tools = 'medium' THEN 'medium' ELSE 'low' END AS risk,
    kw::INT + (pii IS NOT NULL)::INT + limited::INT + needs::INT + unsafe::INT AS n_blocks,
    CASE WHEN kw OR limited OR unsafe THEN 'blocked' WHEN needs AND NOT coalesce(approved, false) THEN 'human_approval'
         WHEN len(tool_names) > 0 THEN 'tools' ELSE 'safety_check' END AS route FROM f)"""


def guarded(spark, sf):
    hot = hot_threads(spark, sf)
    out = guarding.guard_messages(
        planted(spark, sf, hot), "thread_id", hot=hot, tool_names=F.col("tool_names"), approved=F.col("approved"), verdict=F.col("verdict"))
    return out.select("thread_id", "turn", "keyword_blocked", "pii", "safe_text", "rate_limited", "needs_approval", "unsafe",
                      "risk", "n_blocks", "route")


@query("c07_guard_composition", f"{GUARDED_SQL} SELECT thread_id, turn, risk, n_blocks, route FROM guarded")
def guard_composition(spark, sf):
    return guarded(spark, sf).select("thread_id", "turn", "risk", "n_blocks", "route")


@query("k06_guarded_messages", f"{GUARDED_SQL} SELECT * FROM guarded")
def guarded_messages(spark, sf):
    return guarded(spark, sf)


@query("g05_thread_risk", f"""{GUARDED_SQL} SELECT thread_id, sum(n_blocks)::BIGINT AS n_blocks,
  ['low', 'medium', 'high', 'blocked'][max(list_position(['low', 'medium', 'high', 'blocked'], risk))] AS risk FROM guarded GROUP BY thread_id""")
def thread_risk(spark, sf):
    return stats.thread_risk(guarded(spark, sf), "thread_id")


@query("c08_model_input", f"""{GUARDED_SQL} SELECT thread_id, g.turn, safe_text
FROM guarded g JOIN conversations c ON thread_id = c.conv_id AND g.turn = c.turn WHERE c.role <> 'user' OR contains(safe_text, 'REDACTED')""")
def model_input(spark, sf):
    p = planted(spark, sf)
    safe = F.when(F.col("role") == "user", G.redact(F.col("text"))).otherwise(F.col("text"))
    p = p.select("thread_id", "turn", "role", safe.alias("safe_text"))
    return p.where(G.keeps_in_model_input(F.col("role"), F.col("safe_text"))).select("thread_id", "turn", "safe_text")


@query("c11_clamped_slice", """
SELECT event_id, user_id, t - f AS "offset", l - f AS duration FROM (
  SELECT event_id, user_id, epoch_us(ts) AS t, min(epoch_us(ts)) OVER (PARTITION BY user_id) AS f,
         max(epoch_us(ts)) OVER (PARTITION BY user_id) AS l FROM events)
WHERE l - f > 100000000000 AND t - f BETWEEN 100000000000 AND least(2550000000000, l - f)""")
def clamped_slice(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return history.clamp_slice(e, "user_id", "event_id", micros, 100_000_000_000, 2_550_000_000_000).drop("ts")


@query("c12_ends_in_tool_call", f"""
SELECT thread_id, arg_max(len(tool_names), turn) > 0 AS has_tool_calls,
       CASE WHEN arg_max(len(tool_names), turn) > 0 THEN 'tools' ELSE 'end' END AS route FROM ({PLANTED_SQL}) GROUP BY thread_id""")
def ends_in_tool_call(spark, sf):
    return history.ends_in_tool_call(planted(spark, sf), "thread_id", "turn", F.size("tool_names"))


# ---------------------------------------------------------------- tool calls and reviews (F)


@query("f02_tool_dispatch", rf"""
SELECT call_id, name, CASE name WHEN 'calculator' THEN CASE WHEN regexp_matches(args, '^[0-9+\-*/().\s]+$') THEN 'accepted: ' || args ELSE 'unsafe expression' END
  WHEN 'send_email' THEN 'e-mail queued: ' || args WHEN 'delete_user' THEN 'deletion queued: ' || args
  ELSE 'bad tool name, retry' END AS content FROM ({CALLS_SQL})""")
def tool_dispatch(spark, sf):
    return joins.dispatch_tools(tool_calls(spark, sf)).select("call_id", "name", "content")


@query("f04_review_decisions", f"""
SELECT c.call_id, CASE WHEN d.type IS NULL THEN 'pending' WHEN d.type IN ('accept', 'edit', 'response') THEN d.type ELSE 'error' END AS status,
       CASE d.type WHEN 'accept' THEN 'executed: ' || c.args WHEN 'edit' THEN 'executed: ' || d.args WHEN 'response' THEN d.args END AS result
FROM ({CALLS_SQL}) c LEFT JOIN ({DECISIONS_SQL}) d USING (call_id) WHERE c.name IN ('send_email', 'delete_user')""")
def review_decisions(spark, sf):
    pending = tool_calls(spark, sf).where(F.col("name").isin(G.HIGH_RISK_TOOLS))
    return joins.review_outcome(pending, decisions(spark, sf), "call_id").select("call_id", "status", "result")


@query("f07_call_results", f"""
WITH c AS ({CALLS_SQL}), r AS (SELECT event_id AS call_id, 'result ' || props AS content FROM events WHERE event_id % 10 <> 0)
SELECT call_id, name, content, CASE WHEN name IS NULL THEN 'orphan' WHEN content IS NULL THEN 'unanswered' ELSE 'paired' END AS pairing
FROM c FULL OUTER JOIN r USING (call_id)""")
def call_results(spark, sf):
    results = table(spark, sf, "events").where(F.col("event_id") % 10 != 0).select(
        F.col("event_id").alias("call_id"), F.concat(F.lit("result "), "props").alias("content"))
    calls = tool_calls(spark, sf).select("call_id", "name")
    return joins.pair_results(calls, results).select("call_id", "name", "content", "pairing")


@query("g02_quality_means", """
SELECT user_id, count(*) AS total_frames, count(s) AS scored_frames, round(avg(s), 4) AS mean_score,
       CASE WHEN count(s) = 0 THEN 'failed on all frames' ELSE 'ok' END AS message
FROM (SELECT user_id, CASE WHEN event_type <> 'error' AND user_id % 10 <> 3 THEN value END AS s FROM events) GROUP BY user_id""")
def quality_means(spark, sf):
    ok = (F.col("event_type") != "error") & (F.col("user_id") % 10 != 3)
    e = table(spark, sf, "events").select("user_id", F.when(ok, F.col("value")).alias("score"))
    return stats.quality_means(e, "user_id", F.col("score"))
