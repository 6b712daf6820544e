"""Tool calls of conversations: linked with their results, ordered, checked and written as canonical JSON.

Only DataFrame functions are used. Calls and results meet in a hash join on (conversation, call id).
The order among calls that use each other's results comes from rounds over the dependency edges, in
which chains are halved: a call's level is one more than the highest among the calls it depends on. Arguments are parsed
to variants, whose objects keep their keys sorted, checked against the fields of the tool's schema,
and written without blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import lookup, stored

ID = ["conv_id", "call_id"]
TYPES = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN"}


def kind_of(v: Column) -> Column:
    """JSON type of a variant."""
    t = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | (t == "VOID"), "null").when(t == "STRING", "string").when(t == "BIGINT", "integer")
        .when(t == "BOOLEAN", "boolean").when(t.startswith("ARRAY"), "array").when(t.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of all calls with dependencies that are no part of a cycle and depend on none.

    Calls with one dependency form trees, whose steps are doubled in each round until they end at a
    call with none or several. Only the latter take rounds one by one, as many as their longest chain.
    """
    node, to = F.struct(*ID).alias("node"), F.struct("conv_id", F.col("need").alias("call_id")).alias("to")
    known = calls.select(*ID)
    need = F.explode("depends_on").alias("need")
    edges = calls.select(*ID, need).where("need is not null").distinct()
    edges = stored(edges.join(known.withColumnRenamed("call_id", "need"), ["conv_id", "need"], "left_semi").select(node, to), "call-edges")
    roots = stored(known.select(node).join(edges, "node", "left_anti").withColumn("level", F.lit(0).cast("long")), "call-level")
    degree = stored(edges.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("to").alias("to")), "call-degree")
    steps = chains(degree.where("n = 1").select("node", "to"))
    several = joined_levels(edges.join(degree.where("n > 1").select("node"), "node", "left_semi"), steps, roots)
    ends = stored(roots.unionAll(several).withColumnRenamed("node", "to"), "call-level")
    single = lookup(steps.where("not open"), ends, "to", "node").where("level is not null")
    out = several.unionAll(single.select("node", F.col("level") + F.col("d")))
    return out.select("node.conv_id", "node.call_id", F.col("level").cast("int").alias("level"))


def chains(single: DataFrame) -> DataFrame:
    """(node, to, d, open): the end `to` of each chain of calls with one dependency, `d` steps away.

    Each round doubles the steps of the open ones. What is open after a round that closed nothing
    leads into a cycle, and stays open.
    """
    single = stored(single, "call-steps")
    marks = single.select(F.col("node").alias("to"), F.lit(True).alias("mark"))
    steps = stored(lookup(single, marks, "to", "node").select(
        "node", "to", F.lit(1).cast("long").alias("d"), F.coalesce("mark", F.lit(False)).alias("open")), "call-steps")
    n_open, before = steps.where("open").count(), -1
    while n_open and n_open != before:
        hop = steps.select(F.col("node").alias("to"), F.col("to").alias("far"), F.col("d").alias("more"), F.col("open").alias("far_open"))
        moved = lookup(steps.where("open").drop("open"), hop, "to", "node")
        moved = moved.select("node", F.col("far").alias("to"), F.col("d") + F.col("more"), "far_open")
        steps = stored(moved.unionAll(steps.where("not open")).toDF("node", "to", "d", "open"), "call-steps")
        n_open, before = steps.where("open").count(), n_open
    return steps


def joined_levels(edges: DataFrame, steps: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, level) of calls with several dependencies, given as `edges`; chains in between are one step."""
    ends = steps.select(F.col("node").alias("to"), F.col("to").alias("end"), "d")
    edges = lookup(stored(edges.select("node", "to"), "call-edges"), ends, "to", "node").select(
        "node", F.coalesce("end", "to").alias("to"), (F.coalesce("d", F.lit(0)) + 1).alias("d"), F.lit(None).cast("long").alias("have"))
    ready, out = roots, roots.limit(0)
    while True:
        found = lookup(edges, ready.withColumnRenamed("node", "to"), "to", "node")
        marked = stored(found.select("node", "to", "d", F.coalesce("have", F.col("level") + F.col("d")).alias("have")), "call-edges")
        full = marked.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.count("have").alias("n_have"), F.max("have").alias("level"))
        ready = stored(full.where("n = n_have").select("node", "level"), "call-level")
        if not ready.limit(1).count():
            return out
        out = out.unionAll(ready)
        edges = marked.join(ready.select("node"), "node", "left_anti")


def argument_errors(args: Column, fields: Column) -> Column:
    """Sorted list of what is wrong with parsed arguments; `fields` is null for an unknown tool."""
    values = F.try_variant_get(args, "$", "map<string,variant>")
    missing = F.transform(
        F.filter(fields, lambda f: f["required"] & ~F.coalesce(F.map_contains_key(values, f["field"]), F.lit(False))),
        lambda f: F.concat(F.lit("missing:"), f["field"]))
    typed = F.map_from_entries(F.transform(fields, lambda f: F.struct(f["field"], f["type"])))
    wrong = F.transform(F.map_entries(values), lambda e: F.when(
        ~F.map_contains_key(typed, e["key"]), F.concat(F.lit("unknown:"), e["key"])).when(
        (kind_of(e["value"]) != typed[e["key"]]) & ~((typed[e["key"]] == "number") & (kind_of(e["value"]) == "integer")),
        F.concat(F.lit("type:"), e["key"])))
    return (
        F.when(fields.isNull(), F.array(F.lit("unknown tool")))
        .when(args.isNull() | values.isNull(), F.array(F.lit("no object")))
        .otherwise(F.array_sort(F.array_compact(F.concat(missing, wrong))))
    )


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per distinct call, and one per distinct result that belongs to no row of a call.

    `calls`: conv_id, call_id, turn, name, arguments (JSON text), depends_on (call ids of the same
    conversation). `results`: conv_id, call_id, turn, content. `schemas`: name, field, type (string,
    integer, number, boolean, array, object), required.

    Returns conv_id, call_id, turn, name, status, level, errors, n_rows, message. Status: `linked`;
    `no_result`; `repeated_call` for a call whose id an earlier one has (by turn, then name and
    arguments); `repeated_result` and `orphan_result` likewise; `no_id` where conversation or call id
    is null. `level` orders the calls of a conversation so that each comes after those it depends on;
    it is 0 without dependencies and null in a cycle (error `cycle`). A dependency that is no call is
    ignored and reported. Rows equal in all columns are one row with `n_rows` of them. Empty tables
    give no rows; other columns are not read.
    """
    cols = ["conv_id", "call_id", "turn", "name", "arguments", "depends_on"]
    calls = stored(calls.select(*cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")), "calls")
    results = results.select(*ID, "turn", "content").groupBy(*ID, "turn", "content").agg(F.count(F.lit(1)).alias("n_rows"))
    results = stored(results, "results")
    has_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    rank = F.struct("turn", "name", "arguments", "depends_on")
    first = calls.where(has_id).groupBy(*ID).agg(F.min(rank).alias("head"))
    named = calls.withColumn("rank", rank).join(first, ID, "left")
    heads = stored(named.where(F.col("rank") == F.col("head")).select(*cols, "n_rows"), "call-heads")
    other = named.where(F.coalesce(F.col("rank") != F.col("head"), F.lit(True))).select(
        *cols, "n_rows", F.when(has_id, "repeated_call").otherwise("no_id").alias("status"))
    answer = F.struct("turn", "content")
    first_answer = results.where(has_id).groupBy(*ID).agg(F.min(answer).alias("answer"))
    level = levels(heads)
    cyclic = F.exists(F.coalesce("depends_on", F.array().cast("array<string>")), lambda d: d.isNotNull())
    known = heads.select("conv_id", F.col("call_id").alias("need"), F.lit(True).alias("is_call"))
    gaps = heads.select(*ID, F.explode("depends_on").alias("need")).where("need is not null").distinct().join(
        known, ["conv_id", "need"], "left").groupBy(*ID).agg(
        F.sort_array(F.collect_list(F.when(F.col("is_call").isNull(), F.concat(F.lit("no call:"), "need")))).alias("gaps"),
        F.count("is_call").alias("n_deps"))
    linked = heads.join(first_answer, ID, "left").join(level, ID, "left").join(gaps, ID, "left")
    n_deps = F.coalesce(F.col("n_deps"), F.lit(0))
    linked = linked.withColumn("level", F.when(n_deps == 0, 0).otherwise(F.col("level"))).withColumn(
        "status", F.when(F.col("answer").isNull(), "no_result").otherwise("linked")).withColumn(
        "order_errors", F.concat(F.coalesce("gaps", F.array().cast("array<string>")),
                                 F.when(F.col("level").isNull() & cyclic, F.array(F.lit("cycle"))).otherwise(F.array().cast("array<string>"))))
    empty = F.array().cast("array<string>")
    all_calls = linked.select(*cols, "n_rows", "status", "level", "order_errors", "answer").unionByName(
        other.select(*cols, "n_rows", "status", F.lit(None).cast("int").alias("level"), empty.alias("order_errors"),
                     F.lit(None).cast(linked.schema["answer"].dataType).alias("answer")))
    fields = schemas.where("name is not null").groupBy("name").agg(F.sort_array(F.collect_set(F.struct(
        "field", "type", F.coalesce("required", F.lit(False)).alias("required")))).alias("fields"))
    checked = lookup(all_calls, stored(fields, "schemas"), "name", "call_id").withColumn("args", F.try_parse_json("arguments"))
    checked = checked.withColumn("errors", F.concat(argument_errors(F.col("args"), F.col("fields")), "order_errors"))
    message = F.to_json(F.struct(
        F.col("args").alias("arguments"), "depends_on", "errors", F.col("call_id").alias("id"), "level", "name",
        F.col("answer.content").alias("result"), "status"), {"ignoreNullFields": "false"})
    done = checked.select(*ID, "turn", "name", "status", "level", "errors", "n_rows", message.alias("message"))
    spare = results.join(first_answer, ID, "left").join(heads.select(*ID, F.lit(True).alias("called")), ID, "left")
    spare = spare.where(~(F.coalesce("called", F.lit(False)) & F.coalesce(answer == F.col("answer"), F.lit(False))))
    kind = F.when(~has_id, "no_id").when(F.col("called"), "repeated_result").otherwise("orphan_result")
    text = F.to_json(F.struct(F.col("call_id").alias("id"), F.col("content").alias("result"), kind.alias("status")), {"ignoreNullFields": "false"})
    return done.unionByName(spare.select(
        *ID, "turn", F.lit(None).cast("string").alias("name"), kind.alias("status"), F.lit(None).cast("int").alias("level"),
        empty.alias("errors"), "n_rows", text.alias("message")))
