"""Tool calls of chats: linked with their results, checked, ordered and serialised, in SQL functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.storage import stored

CALL = "conv_id long, call_id string, turn long, name string, arguments string, needs array<string>"
RESULT = "conv_id long, call_id string, turn long, content string"
#: What a message's text must look like to hold calls or a result.
CALLS_TEXT = "tool_calls array<struct<id: string, name: string, arguments: string, needs: array<string>>>"
RESULT_TEXT = "tool_call_id string, content string"
#: A tool's parameters: name, JSON type, whether required.
REPLY_SCHEMA = {"reply": {"text": ("string", True), "turn": ("integer", True)}}


def _messages(table: DataFrame) -> DataFrame:
    return table.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )


def read_calls(table: DataFrame) -> DataFrame:
    """Calls in assistant messages whose text is {"tool_calls": [{id, name, arguments, needs}, ...]}."""
    rows = _messages(table).where((F.col("role") == "assistant") & F.col("text").startswith("{"))
    calls = rows.select("conv_id", "turn", F.explode(F.from_json("text", CALLS_TEXT)["tool_calls"]).alias("c")).where("c is not null")
    return calls.select("conv_id", F.col("c.id").alias("call_id"), "turn", "c.name", "c.arguments", "c.needs")


def read_results(table: DataFrame) -> DataFrame:
    """Results in tool messages whose text is {"tool_call_id": ..., "content": ...}."""
    rows = _messages(table).where((F.col("role") == "tool") & F.col("text").startswith("{"))
    found = rows.withColumn("r", F.from_json("text", RESULT_TEXT)).where("r.tool_call_id is not null")
    return found.select("conv_id", F.col("r.tool_call_id").alias("call_id"), "turn", "r.content")


def unreadable_messages(table: DataFrame) -> DataFrame:
    """Messages that are to hold calls or a result and do not, or not all of them: rows of ``link_calls``, the text as result."""
    rows = _messages(table)
    calls = F.from_json("text", CALLS_TEXT)["tool_calls"]
    no_calls = calls.isNull() | (F.size(calls) == 0) | F.exists(calls, lambda c: c.isNull())
    no_result = ~F.coalesce(F.col("text").startswith("{"), F.lit(False)) | F.from_json("text", RESULT_TEXT)["tool_call_id"].isNull()
    problem = F.when((F.col("role") == "assistant") & F.col("text").startswith('{"tool_calls"') & no_calls, "unreadable calls")
    problem = problem.when((F.col("role") == "tool") & no_result, "unreadable result")
    none = F.lit(None).cast("string")
    body = F.struct(none.alias("arguments"), none.alias("call_id"), none.alias("name"), F.col("text").alias("result"))
    return rows.withColumn("problems", problem).where("problems is not null").select(
        "conv_id", none.alias("call_id"), "turn", none.alias("name"), F.lit(None).cast("long").alias("position"),
        F.lit("unreadable").alias("status"), "problems", F.lit(False).alias("valid"), canonical_json(body).alias("json"),
    )


def turns_as_calls(table: DataFrame) -> DataFrame:
    """Every user turn as a call of the tool ``reply``, which needs the user turn before it."""
    rows = _messages(table).where(F.col("role") == "user")
    turn = F.col("turn")
    return rows.select(
        "conv_id",
        F.concat(F.lit("turn-"), turn.cast("string")).alias("call_id"),
        "turn",
        F.lit("reply").alias("name"),
        F.to_json(F.struct("text", "turn")).alias("arguments"),
        F.when(turn >= 2, F.array(F.concat(F.lit("turn-"), (turn - 2).cast("string")))).otherwise(F.array().cast("array<string>")).alias("needs"),
    )


def turns_as_results(table: DataFrame) -> DataFrame:
    """Every assistant turn as the result of the user turn right before it."""
    rows = _messages(table).where((F.col("role") == "assistant") & ~F.coalesce(F.col("text").startswith('{"tool_calls"'), F.lit(False)))
    call_id = F.concat(F.lit("turn-"), (F.col("turn") - 1).cast("string"))
    return rows.select("conv_id", call_id.alias("call_id"), "turn", F.col("text").alias("content"))


def _once(rows: DataFrame, *order: str) -> DataFrame:
    """Adds again: whether an earlier row has the same identifier."""
    within = Window.partitionBy("conv_id", "call_id").orderBy(*order)
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    return rows.withColumn("again", known & (F.row_number().over(within) > 1))


def _kind(value: Column) -> Column:
    """The JSON type of a VARIANT value."""
    schema = F.schema_of_variant(value)
    return (
        F.when(schema.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
        .when(schema.startswith("DECIMAL") | schema.isin("DOUBLE", "FLOAT"), F.when(schema.rlike(r",0\)$"), "integer").otherwise("number"))
        .when(schema == "STRING", "string").when(schema == "BOOLEAN", "boolean").when(schema == "VOID", "null")
        .when(schema.startswith("ARRAY"), "array").when(schema.startswith("OBJECT"), "object").otherwise("unknown")
    )


def argument_problems(name: Column, arguments: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """What is wrong with a call's arguments: an array of texts, empty if nothing.

    Arguments must be a JSON object; required ones present, all of the schema's
    type (an integer is a number too), and none unknown to it.
    """
    value = F.try_parse_json(arguments)
    given = F.json_object_keys(arguments)
    none = F.array().cast("array<string>")
    by_tool = none
    for tool, fields in schemas.items():
        checks = []
        for field, (kind, required) in fields.items():
            own = F.try_variant_get(value, f"$['{field}']", "variant")
            missing = ~F.array_contains(given, field)
            fits = _kind(own).isin(kind, *(["integer"] if kind == "number" else []))
            bad = F.when(missing, F.lit(f"missing {field}") if required else F.lit(None).cast("string"))
            checks.append(bad.when(~missing & ~F.coalesce(fits, F.lit(False)), f"wrong type of {field}"))
        unknown = F.transform(F.array_except(given, F.array(*map(F.lit, fields))), lambda k: F.concat(F.lit("unknown "), k))
        by_tool = F.when(name == tool, F.concat(F.array_compact(F.array(*checks)), F.array_sort(unknown))).otherwise(by_tool)
    known = F.coalesce(name.isin(*schemas), F.lit(False))
    return (
        F.when(~known, F.array(F.lit("unknown tool")))
        .when(value.isNull() | given.isNull(), F.array(F.lit("no JSON object")))
        .otherwise(by_tool)
    )


def dependency_levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of calls that stand in a conversation whose turns are no valid order.

    Where every call needs earlier ones only, the turns themselves are the
    order and no row is returned. Other conversations are peeled: each round
    takes the calls whose needs are all taken. A call on a cycle, or behind one, has level null.
    """
    own = calls.select("conv_id", "call_id", "turn")
    ahead = own.select("conv_id", F.col("call_id").alias("need"), F.col("turn").alias("need_turn"))
    edges = stored(needs.join(ahead, ["conv_id", "need"]).join(own, ["conv_id", "call_id"]), "needs")
    late = (F.col("need_turn") > F.col("turn")) | (F.col("need_turn") == F.col("turn")) & (F.col("need") >= F.col("call_id"))
    tangled = stored(edges.where(late).select("conv_id").distinct(), "tangled")
    left = stored(own.select("conv_id", "call_id").join(tangled, "conv_id", "left_semi"), "left")
    open_ = stored(edges.select("conv_id", "call_id", "need").join(tangled, "conv_id", "left_semi"), "open")
    done, level = [], 0
    while True:
        ready = stored(left.join(open_, ["conv_id", "call_id"], "left_anti"), "ready")
        if ready.isEmpty():
            break
        done.append(ready.withColumn("level", F.lit(level)))
        left = stored(left.join(ready, ["conv_id", "call_id"], "left_anti"), "left")
        open_ = stored(open_.join(ready.withColumnRenamed("call_id", "need"), ["conv_id", "need"], "left_anti"), "open")
        level += 1
    return reduce(DataFrame.unionByName, done, left.withColumn("level", F.lit(None).cast("int")))


def link_calls(
    calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]
) -> DataFrame:
    """One row per call and per result without one: conv_id, call_id, turn, name, position, status, problems, valid, json.

    Calls and results meet by (conv_id, call_id). Status is answered, unanswered,
    orphan (a result without a call), duplicate (an identifier used before, by
    turn, then content) or cyclic. Position counts a conversation's first-named
    calls so that each follows those it needs, else by turn; it is null for
    orphans, duplicates and cyclic calls. Calls that need an unknown call have
    that problem. json is canonical: sorted names, no blanks, absent values left out.

    A null conv_id or identifier links with nothing. Repeated rows are
    duplicates. Empty tables give no rows.
    """
    first = _once(calls, "turn", "name", "arguments")
    answers = _once(results, "turn", "content")
    main = first.where("not again").drop("again")
    needs = main.select("conv_id", "call_id", F.explode("needs").alias("need")).where("need is not null").distinct()
    known = main.select("conv_id", F.col("call_id").alias("need"))
    lost = needs.join(known, ["conv_id", "need"], "left_anti").select("conv_id", "call_id").distinct().withColumn("lost", F.lit(True))
    levels = dependency_levels(main, needs).withColumn("tangled", F.lit(True))
    found = answers.where("not again").select("conv_id", "call_id", F.col("content").alias("result"), F.lit(True).alias("has_result"))
    keys = ["conv_id", "call_id"]
    linked = main.join(found, keys, "left").join(lost, keys, "left").join(levels, keys, "left")
    cyclic = F.coalesce(F.col("tangled") & F.col("level").isNull(), F.lit(False))
    linked = linked.withColumn(
        "status", F.when(cyclic, "cyclic").when(F.col("has_result"), "answered").otherwise("unanswered")
    )
    order = Window.partitionBy("conv_id", cyclic).orderBy(F.coalesce("level", F.lit(0)), "turn", "call_id")
    position = F.when(~cyclic & F.col("conv_id").isNotNull(), (F.row_number().over(order) - 1).cast("long"))
    again = first.where("again").drop("again", "needs").withColumn("status", F.lit("duplicate"))
    orphans = answers.where("not again").drop("again").join(main.select(*keys), keys, "left_anti").withColumn("status", F.lit("orphan"))
    repeats = answers.where("again").drop("again").withColumn("status", F.lit("duplicate"))
    rows = (
        linked.select("conv_id", "call_id", "turn", "name", "arguments", "result", "status", "lost", position.alias("position"))
        .unionByName(again, allowMissingColumns=True)
        .unionByName(orphans.unionByName(repeats).withColumnRenamed("content", "result"), allowMissingColumns=True)
    )
    is_call = F.col("name").isNotNull() | F.col("arguments").isNotNull()
    problems = F.concat(
        argument_problems(F.col("name"), F.col("arguments"), schemas),
        F.when(F.coalesce("lost", F.lit(False)), F.array(F.lit("unknown need"))).otherwise(F.array().cast("array<string>")),
    )
    problems = F.when(is_call, problems).otherwise(F.array().cast("array<string>"))
    body = F.struct(
        F.coalesce(F.to_json(F.try_parse_json("arguments")), F.to_json(F.col("arguments").try_cast("variant"))).alias("arguments"),
        "call_id", "name", "result",
    )
    return rows.withColumn("problems", problems).select(
        "conv_id", "call_id", "turn", "name", "position", "status", F.array_join("problems", ", ").alias("problems"),
        ((F.size("problems") == 0) & F.col("status").isin("answered", "unanswered")).alias("valid"), canonical_json(body).alias("json"),
    )


def canonical_json(body: Column) -> Column:
    """{"arguments":...,"id":...,"name":...,"result":...} with the arguments' names sorted."""
    part = lambda name, text: F.concat(F.lit(f'"{name}":'), text)
    quoted = lambda column: F.to_json(column.cast("variant"))
    return F.concat(
        F.lit("{"),
        F.array_join(
            F.array_compact(
                F.array(
                    part("arguments", body["arguments"]), part("id", quoted(body["call_id"])),
                    part("name", quoted(body["name"])), part("result", quoted(body["result"])),
                )
            ),
            ",",
        ),
        F.lit("}"),
    )


def link_conversations(table: DataFrame) -> DataFrame:
    """Tool calls and turns of a conversations table (conv_id, turn, role, text), linked and serialised.

    Call and tool messages that cannot be read have a row of status unreadable.
    Roles other than user, assistant and tool, such as system, have no row.
    """
    calls = turns_as_calls(table).unionByName(read_calls(table))
    results = turns_as_results(table).unionByName(read_results(table))
    return link_calls(calls, results, REPLY_SCHEMA).unionByName(unreadable_messages(table))


def chat_samples(linked: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and the canonical JSON array of its valid calls in order."""
    rows = linked.where(F.col("valid") & F.col("position").isNotNull()).groupBy("conv_id")
    items = F.array_sort(F.collect_list(F.struct("position", "json")))["json"]
    return rows.agg(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")).alias("json"))
