"""Thread history. Hot threads are cut into blocks (see `scan`); pass `hot` where they are known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.functions import text as X
from loomtext.operators import scan, skew
from loomtext.session import cut_lineage


def call_ranks(messages: DataFrame, key: str, pos: str, limit: int, hot: skew.HotKeys | None = None) -> DataFrame:
    """Number of earlier calls in the thread and the rate-limit verdict."""
    one = F.lit(1).cast("long")
    out = scan.running(messages, [key], pos, {"prior_calls": ("sum", one)}, inclusive=False, hot=hot)
    return out.withColumn("rate_limited", F.col("prior_calls") >= limit)


def trim(messages: DataFrame, key: str, budget: int, *, pos: str = "turn", role: str = "role",
         tokens: Column | None = None, text: str = "text", bits: int = scan.BLOCK_BITS,
         hot_rows: int = skew.HOT_ROWS, hot: skew.HotKeys | None = None) -> DataFrame:
    """Newest whole messages that fit the budget, starting on a user row, plus the system row.

    The system row is the first message only; its cost is taken off the budget, and it stays
    even if nothing else fits. Threads take one shuffle and windows over it. Blocks of hot
    threads get the tokens of later blocks and the thread's system row from the block
    summaries.
    """
    hot = skew.find(messages, [key], hot_rows) if hot is None else hot
    tokens = X.word_count(F.col(text)) if tokens is None else tokens
    sys_pos = F.when(F.col(role) == "system", F.col(pos))
    rows = messages.withColumn("_tok", tokens.cast("long"))
    rows = scan.place(rows, [key], pos, hot, bits) if hot else rows
    part = Window.partitionBy(key, *([scan.BLK] if hot else []))
    down = part.orderBy(F.col(pos).desc()).rowsBetween(Window.unboundedPreceding, 0)
    everything = part.orderBy(F.col(pos).desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    facts = {
        "_later": F.lit(0).cast("long"), "_first": F.min(pos).over(everything), "_sys_pos": F.min(sys_pos).over(everything),
        "_sys_tok": F.min_by("_tok", sys_pos).over(everything),
    }
    if hot:
        carry = F.broadcast(_later_blocks(rows.where(F.col("_hot").isNotNull()), pos, sys_pos))
        facts = {n: F.when(F.col("_hot").isNotNull(), F.col(f"_c{n}")).otherwise(c) for n, c in facts.items()}

    def fitting(some: DataFrame) -> DataFrame:
        some = some.join(carry, ["_hot", scan.BLK], "left") if hot else some
        extra = ["_hot", scan.BLK] if hot else []
        seen = some.select(*messages.columns, "_tok", *extra, F.sum("_tok").over(down).alias("_here"), *[c.alias(n) for n, c in facts.items()])
        has_sys = F.coalesce(F.col("_sys_pos") == F.col("_first"), F.lit(False))
        # the system row is the oldest, so it never counts into what is newer than another row
        used = F.col("_later") + F.col("_here") + F.when(has_sys, F.col("_sys_tok")).otherwise(0)
        marked = seen.withColumn("_is_sys", has_sys & (F.col(pos) == F.col("_sys_pos")))
        return marked.withColumn("_fits", ~F.col("_is_sys") & (used <= budget)).where(F.col("_fits") | F.col("_is_sys"))

    user_pos = F.when(F.col("_fits") & (F.col(role) == "user"), F.col(pos))
    kept, start = fitting(rows), F.min(user_pos).over(part)
    if hot:
        of_hot = fitting(rows.where(F.col("_hot").isNotNull())).groupBy("_hot").agg(F.min(user_pos).alias("_hot_start"))
        kept = kept.join(F.broadcast(of_hot), "_hot", "left")
        start = F.when(F.col("_hot").isNotNull(), F.col("_hot_start")).otherwise(start)
    kept = kept.withColumn("_start", start).where(F.col("_is_sys") | F.coalesce(F.col(pos) >= F.col("_start"), F.lit(False)))
    return kept.select(*messages.columns, F.col("_tok").alias("n_tokens"))


def _later_blocks(rows: DataFrame, pos: str, sys_pos: Column) -> DataFrame:
    """For each block of a hot thread the tokens of later blocks, and the thread's first row and system row."""
    blocks = rows.groupBy("_hot", scan.BLK).agg(
        F.sum("_tok").alias("_sum"), F.min(pos).alias("_first"), F.min(sys_pos).alias("_sys_pos"), F.min_by("_tok", sys_pos).alias("_sys_tok"))
    later = Window.partitionBy("_hot").orderBy(F.col(scan.BLK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_hot")
    return blocks.select(
        "_hot", scan.BLK, F.coalesce(F.sum("_sum").over(later), F.lit(0)).alias("_c_later"), F.min("_first").over(whole).alias("_c_first"),
        F.min("_sys_pos").over(whole).alias("_c_sys_pos"), F.min_by("_sys_tok", "_sys_pos").over(whole).alias("_c_sys_tok"))


def last_n(messages: DataFrame, keys: list[str], n: int, pos: str = "turn") -> DataFrame:
    """The newest `n` rows per group; the rank filter trims each partition before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(F.col(pos).desc())
    ranked = messages.withColumn("from_end", F.row_number().over(w)).where(F.col("from_end") <= n)
    return ranked.withColumn("from_end", F.col("from_end").cast("long"))


def transcripts(messages: DataFrame, key: str, pos: str = "turn", text: str = "text", page_bits: int = 6) -> DataFrame:
    """Transcript at each turn, in pages of consecutive turns.

    `transcript` joins the page's texts up to the row; a page's last row is the closed page. The
    full transcript at a turn is the closed earlier pages followed by the row, so a long thread
    costs linear space and one page per task.
    """
    page = scan.block_id(F.col(pos), page_bits)
    w = Window.partitionBy(key, "page").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    paged = messages.withColumn("page", page)
    return paged.withColumn("transcript", F.array_join(F.collect_list(text).over(w), "\n"))


def transcript_at(messages: DataFrame, points: DataFrame, key: str, at: str = "at", pos: str = "turn", text: str = "text",
                  page_bits: int = 6) -> DataFrame:
    """Whole transcripts at the given turns: (key, at, page, transcript), one row per page.

    `points` holds the distinct (key, at) asked for. The pages of a point in order, joined by newlines,
    are all texts of the thread up to that turn; a page has at most 2^page_bits positions.
    """
    rows = messages.select(key, pos, text).join(points.select(key, at), key).where(F.col(pos) <= F.col(at))
    items = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(text).alias("t"))))
    paged = rows.groupBy(key, at, scan.block_id(F.col(pos), page_bits).alias("page")).agg(items.alias("_items"))
    return paged.select(key, at, "page", F.array_join(F.transform("_items", lambda x: x["t"]), "\n").alias("transcript"))


def latest_user_text(messages: DataFrame, key: str, pos: str = "turn", role: str = "role", text: str = "text",
                     default: str = "No user message found", hot: skew.HotKeys | None = None) -> DataFrame:
    """Text of the newest user row at or before each turn."""
    seen = F.when(F.col(role) == "user", F.struct(F.col(pos).alias("p"), F.col(text).alias("t")))
    out = scan.running(messages, [key], pos, {"_seen": ("max", seen)}, hot=hot)
    return out.withColumn("last_user_text", F.coalesce(F.col("_seen")["t"], F.lit(default))).drop("_seen")


def checkpoint_history(checkpoints: DataFrame, key: str, step: str = "step", hot: skew.HotKeys | None = None) -> DataFrame:
    """Index of each checkpoint counted from the newest (0)."""
    one = F.lit(1).cast("long")
    return scan.running(checkpoints, [key], step, {"step_index": ("sum", one)}, inclusive=False, reverse=True, hot=hot)


def checkpoint_at(checkpoints: DataFrame, key: str, index: int, step: str = "step") -> DataFrame:
    """The checkpoint `index` steps back; threads that are shorter give no row."""
    w = Window.partitionBy(key).orderBy(F.col(step).desc())
    ranked = checkpoints.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= index + 1)
    return ranked.where(F.col("_i") == index + 1).drop("_i")


def merge_messages(updates: DataFrame, key: str, msg_id: str, seq: str, text: str, hot: skew.HotKeys | None = None) -> DataFrame:
    """Append, or replace the text of an id that exists while keeping its first place.

    With hot threads the merged rows are used several times and therefore written once.
    """
    hot = skew.find(updates, [key]) if hot is None else hot
    merged = updates.groupBy(key, msg_id).agg(
        F.min(seq).alias("first_seq"), F.max_by(text, seq).alias(text), F.count(F.lit(1)).alias("n_versions"),
    )
    one = F.lit(1).cast("long")
    return scan.running(cut_lineage(merged) if hot else merged, [key], "first_seq", {"position": ("sum", one)}, hot=hot)


def fold_state(updates: DataFrame, key: str, step: str, overwrite: list[str], summed: list[str] = (),
               counted: str | None = None, hot: skew.HotKeys | None = None) -> DataFrame:
    """State at each step: last written value per overwrite field, running sums, append count."""
    aggs: scan.Aggs = {}
    for f in overwrite:
        written = F.when(F.col(f).isNotNull(), F.struct(F.col(step).alias("p"), F.col(f).alias("v")))
        aggs[f"_f_{f}"] = ("max", written)
    for f in summed:
        aggs[f"{f}_total"] = ("sum", F.col(f))
    if counted:
        aggs["n_appended"] = ("sum", F.col(counted).isNotNull().cast("long"))
    out = scan.running(updates, [key], step, aggs, hot=hot)
    for f in overwrite:
        out = out.withColumn(f"{f}_now", F.col(f"_f_{f}")["v"]).drop(f"_f_{f}")
    return out


def fork(checkpoints: DataFrame, overrides: DataFrame, key: str, step: str, at: int | None, fields: list[str],
         next_step: DataFrame | None = None) -> DataFrame:
    """All checkpoints plus one child per overridden thread.

    The child copies the state at step `at` (with None, at the step in the override's own column `at`), takes
    the override's non-NULL fields, gets the next free step and points at its parent. A table
    that was forked before keeps its parent links.
    """
    newest = checkpoints.groupBy(key).agg(F.max(step).alias("_last")) if next_step is None else next_step
    o = overrides.select(key, (F.lit(at) if at is not None else F.col("at")).alias("_at"), *[F.col(f).alias(f"_o_{f}") for f in fields])
    base = checkpoints if at is None else checkpoints.where(F.col(step) == at)
    child = base.join(o, key).where(F.col(step) == F.col("_at")).join(newest, key).select(
        key, (F.col("_last") + 1).alias(step), F.col(step).alias("parent_step"),
        *[F.coalesce(F.col(f"_o_{f}"), F.col(f)).alias(f) for f in fields],
    )
    linked = "parent_step" in checkpoints.columns
    parent = F.col("parent_step") if linked else F.when(F.col(step) > 0, F.col(step) - 1)
    return checkpoints.select(key, step, parent.alias("parent_step"), *fields).unionByName(child)


def ancestry(checkpoints: DataFrame, heads: DataFrame, key: str, step: str = "step", parent: str = "parent_step") -> DataFrame:
    """The whole history of checkpoints by parent links: (key, head, step, back), `back` 0 at the head itself.

    `heads` has distinct (key, head). Pointer doubling: each round doubles how far back both the links
    and the paths found so far reach, so a path of n checkpoints takes about log2(n) rounds. Joins are on
    (key, step), so a long thread is spread. A parent that does not exist ends the path; links that
    run in a circle are an error.
    """
    link = checkpoints.select(key, F.col(step).alias("_from"), F.col(parent).alias("_to"))
    own = checkpoints.select(key, F.col(step).alias("_to"))
    links = cut_lineage(link.where("_to is not null").join(own, [key, "_to"], "left_semi"))
    found = heads.select(key, "head").join(checkpoints.select(key, F.col(step).alias("head")), [key, "head"], "left_semi")
    found = cut_lineage(found.select(key, "head", F.col("head").alias(step), F.lit(0).cast("long").alias("back")))
    reach, most = 1, checkpoints.count()
    while not links.isEmpty():
        if reach > most:
            raise ValueError("parent links run in a circle")
        step_on = links.select(F.col(key).alias("_k"), "_from", "_to")
        further = found.join(step_on, (F.col(key) == F.col("_k")) & (F.col(step) == F.col("_from"))).select(
            key, "head", F.col("_to").alias(step), (F.col("back") + reach).alias("back"))
        found = cut_lineage(found.unionByName(further))
        then = links.select(F.col(key).alias("_k"), F.col("_from").alias("_via"), F.col("_to").alias("_end"))
        links = cut_lineage(links.join(then, (F.col(key) == F.col("_k")) & (F.col("_to") == F.col("_via"))).select(key, "_from", F.col("_end").alias("_to")))
        reach *= 2
    return found


def with_system_prompt(messages: DataFrame, key: str, template: str | None, *, pos: str = "turn",
                       role: str = "role", text: str = "text", **values: Column) -> DataFrame:
    """Put a system row (turn -1) before every thread, if a system prompt is set.

    `values` fill the prompt's placeholders and are constant per call.
    """
    if not template:
        return messages
    threads = messages.groupBy(key).agg(F.min(pos).alias("_p"))
    system = threads.select(
        key, F.lit(-1).cast(messages.schema[pos].dataType).alias(pos), F.lit("system").alias(role),
        X.render(template, **values).alias(text),
    )
    return system.unionByName(messages.select(key, pos, role, text))


def ends_in_tool_call(messages: DataFrame, key: str, pos: str, n_calls: Column) -> DataFrame:
    """Does the newest message of each thread ask for a tool? An aggregation, no sort."""
    last = F.max_by(n_calls, F.col(pos))
    return messages.groupBy(key).agg(F.coalesce(last > 0, F.lit(False)).alias("has_tool_calls")).withColumn(
        "route", F.when(F.col("has_tool_calls"), "tools").otherwise("end")
    )


def clamp_slice(items: DataFrame, key: str, unique_pos: str, at: Column, start: int, end: int,
                hot: skew.HotKeys | None = None) -> DataFrame:
    """Rows of each item at offsets in [start, min(end, duration)]; items ending by `start` are skipped.

    `at` is the row's place in the item; offsets count from the item's first row and its
    duration is the largest offset. `unique_pos` is an integer that spreads the rows of an item
    over blocks.
    """
    rows = items.withColumn("_at", at)
    aggs: scan.Aggs = {"_first": ("min", F.col("_at")), "_last": ("max", F.col("_at"))}
    total = scan.group_totals(rows, [key], scan.block_id(F.col(unique_pos)), aggs, hot=hot)
    placed = total.select(
        *items.columns, (F.col("_at") - F.col("_first")).alias("offset"), (F.col("_last") - F.col("_first")).alias("duration")
    )
    return placed.where((F.col("duration") > start) & F.col("offset").between(F.lit(start), F.least(F.lit(end), F.col("duration"))))
