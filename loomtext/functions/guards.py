"""Guard verdicts as Column expressions over one message row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Banned words, personal-data patterns and marks, risky tools, call limit,
# approving answers, severity order.
BANNED_WORDS = ["hack", "bomb", "exploit", "illegal", "jailbreak", "phish"]
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE_PATTERN = r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"
EMAIL_MARK = "[EMAIL_REDACTED]"
PHONE_MARK = "[PHONE_REDACTED]"
HIGH_RISK_TOOLS = ["send_email", "delete_user"]
CALL_LIMIT = 5
APPROVALS = ["approve", "yes", "y"]
SEVERITIES = ["low", "medium", "high", "blocked"]


def has_banned_word(text: Column, banned: list[str] | None = None) -> Column:
    """Case-insensitive substring match against a fixed term list."""
    low = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in banned or BANNED_WORDS])


def keyword_block(role: Column, text: Column, banned: list[str] | None = None) -> Column:
    return (role == "user") & has_banned_word(text, banned)


def pii_kind(text: Column) -> Column:
    """`email`, else `phone`, else NULL: the first kind found wins."""
    return F.when(text.rlike(EMAIL_PATTERN), "email").when(text.rlike(PHONE_PATTERN), "phone")


def redact(text: Column, mode: str = "first") -> Column:
    """Mask personal data; `first` masks only the winning kind, `all` masks both kinds."""
    no_mail = F.regexp_replace(text, EMAIL_PATTERN, EMAIL_MARK)
    if mode == "all":
        return F.regexp_replace(no_mail, PHONE_PATTERN, PHONE_MARK)
    if mode != "first":
        raise ValueError(f"unknown redaction mode: {mode}")
    kind = pii_kind(text)
    return (
        F.when(kind == "email", no_mail)
        .when(kind == "phone", F.regexp_replace(text, PHONE_PATTERN, PHONE_MARK))
        .otherwise(text)
    )


def tool_risk(names: Column) -> Column:
    """Risk of the tool names a message asks for (array, may be NULL or empty)."""
    risky = F.arrays_overlap(names, F.array(*[F.lit(n) for n in HIGH_RISK_TOOLS]))
    return (
        F.when(F.coalesce(F.size(names) <= 0, F.lit(True)), "low")
        .when(risky, "high")
        .otherwise("medium")
    )


def is_approval(answer: Column) -> Column:
    return F.coalesce(F.lower(answer).isin(APPROVALS), F.lit(False))


def approval_status(needs: Column, approved: Column) -> Column:
    return F.when(needs & ~F.coalesce(approved, F.lit(False)), "blocked").otherwise("allowed")


def unsafe_verdict(role: Column, verdict: Column, already_blocked: Column) -> Column:
    """Only an assistant row that is not blocked yet can fail; a missing verdict passes."""
    return (
        (role == "assistant")
        & ~already_blocked
        & F.coalesce(F.contains(F.upper(verdict), F.lit("UNSAFE")), F.lit(False))
    )


def severity(name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), name).cast("int")


def severity_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), rank)


def keeps_in_model_input(role: Column, text: Column) -> Column:
    """History filter before the model: user rows stay only when they were redacted."""
    return (role != "user") | F.contains(text, F.lit("REDACTED"))
