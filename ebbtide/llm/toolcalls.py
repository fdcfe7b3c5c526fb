"""Chat formatting: tool calls linked to their results, ordered, validated and serialised, in DataFrame operations only.

Messages are calls (id, tool name, JSON arguments) or results (the id of the call they answer, content), and
may name the message they come after. Results meet calls in a hash join by identifier. The topological order
is by depth: pointers to the preceding message are doubled until they reach a first message, so a chain of
any length takes a logarithmic number of joins. Arguments are held against a schema per tool, and every
message becomes canonical JSON: keys sorted, no white space, numbers in shortest form.

Defined results: messages without an id link with nothing and have depth 0; a message after one that does not
exist is a first message (status ``dangling``); messages in a cycle have no depth (status ``cycle``); of
messages with equal ids the smallest call stands for the id, and all rows stay; a result whose call is missing
is ``unanswerable``, a call without result ``open``; arguments that are no JSON object, unknown tools, missing,
unknown and ill-typed fields are listed as errors. Output is a row per message, never a conversation as one
value, so a conversation with a third of all rows is as good as any.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.llm.shared import attach, written

MOST_DOUBLINGS = 64


@dataclass(frozen=True)
class Argument:
    kind: str  # string, integer, number, boolean, object or array
    required: bool = True


_KINDS = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|DECIMAL.*)", "boolean": "BOOLEAN", "object": "OBJECT.*", "array": "ARRAY.*"}

#: The tools that the turns of a plain conversation stand for.
CHAT_TOOLS = {
    "reply": {"prompt": Argument("string"), "turn": Argument("integer")},
    "configure": {"instructions": Argument("string"), "turn": Argument("integer")},
}


def depths(messages: DataFrame) -> DataFrame:
    """id, depth, cyclic: how many messages come before each id along the pointers ``after``."""
    ids = messages.where("id IS NOT NULL").groupBy("id").agg(F.min("after").alias("after"))
    state = written(ids.select("id", F.col("after").alias("to"), F.lit(1).cast("long").alias("step"), F.lit(0).cast("long").alias("depth")), "chat-links")
    # ``to`` is the message ``step`` places ahead; a pointer beyond the first message becomes null and is final.
    for doubling in range(MOST_DOUBLINGS):
        ahead = state.select(F.col("id").alias("a_id"), F.col("to").alias("a_to"), F.col("depth").alias("a_depth"), F.col("step").alias("a_step"))
        there = F.col("a_id").isNotNull()
        moved = state.where("to IS NOT NULL").join(ahead, F.col("to") == F.col("a_id"), "left").select(
            "id", "a_to", F.when(there & F.col("a_to").isNotNull(), F.col("step") + F.col("a_step")).otherwise(F.col("step")).alias("step"),
            F.when(~there, F.col("depth")).when(F.col("a_to").isNull(), F.col("step") + F.col("a_depth")).otherwise(F.col("depth")).alias("depth"),
        ).withColumnRenamed("a_to", "to")
        state = written(state.where("to IS NULL").unionByName(moved), "chat-links")
        waiting = state.where("to IS NOT NULL").count()
        if not waiting or 2**doubling > state.count():
            break
    return state.select("id", F.when(F.col("to").isNull(), F.col("depth")).alias("depth"), F.col("to").isNotNull().alias("cyclic"))


def argument_errors(name: Column, parsed: Column, arguments: Column, tools: dict[str, dict[str, Argument]]) -> Column:
    """What is wrong with the arguments of a call, as an array of strings."""
    keys = F.map_keys(F.from_json(arguments, "map<string,string>"))
    by_tool = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit(""))))
    for tool, fields in sorted(tools.items()):
        wrong = []
        for field, rule in sorted(fields.items()):
            kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))
            absent = kind.isNull() | kind.isin("VOID")
            wrong.append(F.when(absent & F.lit(rule.required), F.lit(f"missing {field}")).when(~absent & ~kind.rlike(f"^{_KINDS[rule.kind]}$"), F.lit(f"{field} is not {rule.kind}")))
        extra = F.transform(F.array_sort(F.array_except(keys, F.array(*[F.lit(f) for f in sorted(fields)]))), lambda k: F.concat(F.lit("unknown "), k))
        by_tool = F.when(name == tool, F.concat(F.array_compact(F.array(*wrong)), F.coalesce(extra, F.array().cast("array<string>")))).otherwise(by_tool)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return F.when(F.coalesce(is_object, F.lit(False)), by_tool).otherwise(F.array(F.lit("arguments are no JSON object")))


def linked(messages: DataFrame, tools: dict[str, dict[str, Argument]]) -> DataFrame:
    """All columns of the messages plus depth, n_results, status, errors and json."""
    order = written(depths(messages), "chat-depths")
    calls = messages.where("kind = 'call' AND id IS NOT NULL").groupBy("id").agg(F.min(F.struct("name", "arguments")).alias("call"))
    answers = messages.where("kind = 'result' AND call_id IS NOT NULL").groupBy("call_id").agg(F.count("*").alias("n"))
    # One row per call that somebody answers, with the number of its results: tells hot calls before the join.
    targets = written(
        calls.join(answers.hint("shuffle_hash"), F.col("id") == F.col("call_id")).select(F.col("id").alias("target"), "n", F.col("call.name").alias("called")), "chat-calls",
    )
    copies = messages.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n"))
    known = written(
        order.join(copies, "id").join(targets.select(F.col("target").alias("id"), F.col("n").alias("n_results")), "id", "left"), "chat-ids",
    )
    after = messages.where("after IS NOT NULL").groupBy("after").agg(F.count("*").alias("n"))
    before = written(copies.select("id").join(after, F.col("id") == F.col("after")).select(F.col("after").alias("before_id"), "n", F.lit(True).alias("before")), "chat-before")
    rows = attach(messages.withColumn("__call", F.col("call_id")), targets.select(F.col("target").alias("__call"), "n", "called"), "__call", "n", ["conv_id", "turn"])
    rows = attach(rows.withColumn("__id", F.col("id")), known.withColumnRenamed("id", "__id"), "__id", "n", ["conv_id", "turn"])
    rows = attach(rows.withColumn("__after", F.col("after")), before.withColumnRenamed("before_id", "__after"), "__after", "n", ["conv_id", "turn"])
    is_call = F.coalesce(F.col("kind") == "call", F.lit(False))
    parsed = F.try_parse_json("arguments")
    status = (
        F.when(F.coalesce("cyclic", F.lit(False)), "cycle").when(F.col("after").isNotNull() & F.col("before").isNull(), "dangling")
        .when(is_call & F.col("n_results").isNull(), "open").when(~is_call & F.col("called").isNull(), "unanswerable").otherwise("linked")
    )
    out = rows.withColumns({
        "depth": F.when(F.coalesce("cyclic", F.lit(False)), F.lit(None).cast("long")).otherwise(F.coalesce("depth", F.lit(0).cast("long"))),
        "n_results": F.coalesce("n_results", F.lit(0).cast("long")),
        "status": status,
        "errors": F.when(is_call, argument_errors(F.col("name"), parsed, F.col("arguments"), tools)).otherwise(F.array().cast("array<string>")),
    })
    quoted = lambda c: F.coalesce(_quoted(c), F.lit("null"))
    pair = lambda key, value: F.concat(F.lit(f'"{key}":'), value)
    call = F.concat_ws(",", pair("arguments", F.coalesce(F.to_json(parsed), F.lit("null"))), pair("id", quoted("id")), pair("name", quoted("name")), F.lit('"type":"call"'))
    result = F.concat_ws(",", pair("call_id", quoted("call_id")), pair("content", quoted("content")), pair("id", quoted("id")), pair("name", quoted("called")), F.lit('"type":"result"'))
    return out.withColumn("json", F.concat(F.lit("{"), F.when(is_call, call).otherwise(result), F.lit("}"))).select(
        *messages.columns, "depth", "n_results", "status", "errors", "json",
    )


def _quoted(column: str) -> Column:
    """A string as a JSON string: what to_json writes between the braces of a one-field object."""
    inner = F.to_json(F.struct(F.col(column).alias("v")))
    return F.when(F.col(column).isNotNull(), F.substring(inner, F.lit(6), F.length(inner) - 6))


def chat_messages(turns: DataFrame) -> DataFrame:
    """Turns of conversations as calls and results: what a user or system turn asks for, an assistant or tool turn returns.

    A turn is known as conversation:turn and comes after the turn before it, which is the call that it answers.
    """
    identifier = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string"))
    turn = F.col("turn").cast("long")
    is_result = F.coalesce(F.col("role").isin("assistant", "tool"), F.lit(False))
    name = F.when(F.col("role") == "system", "configure").when(F.col("role") == "user", "reply")
    field = F.when(F.col("role") == "system", F.to_json(F.struct(F.col("text").alias("instructions"), turn.alias("turn")))).otherwise(F.to_json(F.struct(F.col("text").alias("prompt"), turn.alias("turn"))))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), identifier(turn).alias("id"),
        F.when(turn > 0, identifier(turn - 1)).alias("after"), F.when(is_result, "result").otherwise("call").alias("kind"),
        F.when(is_result, identifier(turn - 1)).alias("call_id"), F.when(~is_result, name).alias("name"),
        F.when(~is_result, field).alias("arguments"), F.when(is_result, F.col("text")).alias("content"),
    )


def chat_report(turns: DataFrame) -> DataFrame:
    """Per turn: its place in the order, how it links, what is wrong with it, and its canonical JSON."""
    return linked(chat_messages(turns), CHAT_TOOLS).select(
        "conv_id", "turn", "kind", "depth", "call_id", "n_results", "status", F.array_join("errors", "; ").alias("errors"), "json",
    )
