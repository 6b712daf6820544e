"""All guards on a message table in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions import guards as G
from loomtext.operators import history, skew


def guard_columns(role: Column, text: Column, *, prior_calls: Column | None = None,
                  tool_names: Column | None = None, approved: Column | None = None,
                  verdict: Column | None = None, limit: int = G.CALL_LIMIT) -> dict[str, Column]:
    """Verdicts of every guard on the original row, the sticky risk, the block count, the route.

    Severity only rises (low < medium < high < blocked); `n_blocks` counts the guards that
    fired; the redacted text replaces the text.
    """
    no = F.lit(False)
    keyword = G.keyword_block(role, text)
    pii = F.when(role == "user", G.pii_kind(text))
    limited = no if prior_calls is None else prior_calls >= limit
    tools = F.lit("low") if tool_names is None else G.tool_risk(tool_names)
    has_tools = no if tool_names is None else F.coalesce(F.size(tool_names) > 0, no)
    needs = tools == "high"
    ok = no if approved is None else F.coalesce(approved, no)
    unsafe = no if verdict is None else G.unsafe_verdict(role, verdict, keyword | limited)
    blocked = keyword | limited | unsafe
    fired = [keyword, pii.isNotNull(), limited, needs, unsafe]
    rank = F.greatest(
        F.when(blocked, 4).otherwise(1), F.when(pii.isNotNull(), 2).otherwise(1), G.severity(tools)
    )
    n_blocks = fired[0].cast("int")
    for f in fired[1:]:
        n_blocks = n_blocks + f.cast("int")
    return {
        "keyword_blocked": keyword,
        "pii": pii,
        "safe_text": F.when(role == "user", G.redact(text)).otherwise(text),
        "rate_limited": limited,
        "needs_approval": needs,
        "unsafe": unsafe,
        "risk": G.severity_name(rank),
        "n_blocks": n_blocks,
        "route": F.when(blocked, "blocked").when(needs & ~ok, "human_approval")
        .when(has_tools, "tools").otherwise("safety_check"),
    }


def guard_messages(messages: DataFrame, key: str, pos: str = "turn", role: str = "role", text: str = "text",
                   hot: skew.HotKeys | None = None, **inputs: Column) -> DataFrame:
    """Guard a message table; the rate limit counts earlier rows of the thread."""
    ranked = history.call_ranks(messages, key, pos, G.CALL_LIMIT, hot).drop("rate_limited")
    cols = guard_columns(F.col(role), F.col(text), prior_calls=F.col("prior_calls"), **inputs)
    return ranked.select("*", *[c.alias(n) for n, c in cols.items()])
