"""Chat formatting: tool calls linked to their results, checked, ordered and written as canonical JSON.

All of it is DataFrame expressions, one row per message, call or result; no
conversation is gathered into one row, so one with very many turns is spread
like any other.

A message's text is a tool call when its role is ``assistant`` and it is a
JSON object (or array of objects) with ``tool_calls``, or with a ``name`` and
``arguments``; a tool result when its role is ``tool``, with an identifier in
``tool_call_id``.  Anything else is a plain message.

Linking.  Calls and results meet in a hash join on conversation and
identifier.  The first call (in message order) of an identifier owns it; a
later call of the same identifier is ``repeated``, a result without a call is
``orphan``, a second result is ``repeated`` too, and a call without a result
is ``open``.

Order.  A result follows its call.  Messages keep the order of their turns,
except that a result that stands before its call is moved right behind it:
its place is the later of the two turns.  (place, rank, turn, part) is a
topological order of the links and of the turns that agree with them; within
a place, messages and calls come before results.

Arguments are checked against the schema of their tool (``tools``: name,
required names, and types by name); the status is ``ok``, ``unknown tool``,
``no object``, ``missing:<names>`` or ``type:<names>``.

Canonical JSON has its keys in code point order, no white space, and numbers
as the parser reads them.  Null text is empty text, a null role is ``user``;
a message with no conversation or turn is kept under null and never linked.
Repeated rows are separate messages; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that variant schemas give the types of JSON values.
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "boolean": ("BOOLEAN",), "number": ("BIGINT", "DECIMAL", "DOUBLE"),
         "array": ("ARRAY",), "object": ("OBJECT",)}


def tool_schemas(spark: SparkSession, schemas: dict[str, dict[str, str]], required: dict[str, list[str]] | None = None) -> DataFrame:
    """(tool, names, required): the arguments of every tool and their types; all are required unless told otherwise."""
    rows = [(name, types, sorted((required or {}).get(name, types))) for name, types in schemas.items()]
    return spark.createDataFrame(rows, "tool string, names map<string,string>, required array<string>")


def with_tool_use(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the turns at ten times their number, and a tool call and its result after user turns.

    Real conversations without tools thus become ones with them, by Spark and
    for every user turn that has a conversation and a number.  By h, the crc32 of
    ``conv_id:turn``: the call has no identifier (h % 13 = 0), one that others
    share (h % 11 = 0) or its own; its tool is unknown (h % 17 = 0), its arguments
    are no object (h % 19 = 0), lack the query (h % 7 = 0) or have a text as number
    (h % 3 = 0); the result is missing (h % 5 = 0), names another call
    (h % 31 = 0), stands before its call (h % 23 = 0) or comes twice (h % 29 = 0).
    """
    ten = F.col("turn").cast("long") * 10
    own = conversations.select("conv_id", ten.alias("turn"), "role", "text")
    h = F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    asked = conversations.where((F.lower("role") == "user") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("text", F.lit("")).alias("text"), h.alias("h"))
    every = lambda n, of=0: F.col("h") % n == of
    name = lambda kind: F.concat(F.lit(kind), F.col("turn").cast("string"))
    call_id = F.when(every(13), F.lit(None).cast("string")).when(every(11), F.lit("same")).otherwise(name("c"))
    text = F.col("text")
    tool = F.when(every(17), "weather").when(every(19) | every(7), "search").when(every(3, 1), "calculate").otherwise("search")
    said = lambda **fields: F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())))
    arguments = (F.when(every(17), said(query=text)).when(every(19), F.to_json(F.array(text))).when(every(7), said(limit=F.lit(3)))
                 .when(every(3), said(limit=F.lit("3"), query=text)).when(every(3, 1), said(expression=text))
                 .otherwise(said(limit=F.col("h") % 100, query=text)))
    quoted = lambda c: F.to_json(F.array(c))
    inside = lambda c: F.substring(quoted(c), F.lit(2), F.length(quoted(c)) - 2)
    call = F.concat(F.lit('{"arguments":'), arguments, F.coalesce(F.concat(F.lit(',"id":'), inside(call_id)), F.lit("")),
                    F.lit(',"name":'), inside(tool), F.lit("}"))
    calls = asked.select("conv_id", (F.col("turn") * 10 + 1).alias("turn"), F.lit("assistant").alias("role"), call.alias("text"))
    answer = said(content=F.col("h").cast("string"), tool_call_id=F.when(every(31), name("lost")).otherwise(call_id))
    at = F.col("turn") * 10
    turns = F.array_compact(F.array(F.when(every(23), at - 5).otherwise(at + 2), F.when(every(29), at + 3)))
    results = asked.where(~every(5)).select("conv_id", F.explode(turns).alias("turn"), F.lit("tool").alias("role"), answer.alias("text"))
    return own.unionByName(calls).unionByName(results)


def canonical(text: Column) -> Column:
    """Canonical form of a JSON text, null if it is none."""
    return F.to_json(F.try_parse_json(text))


def calls_in(text: Column) -> Column:
    """The tool calls of a text as an array of variants; empty if it holds none."""
    whole = F.try_parse_json(text)
    listed = F.try_variant_get(whole, "$.tool_calls", "array<variant>")
    several = F.try_variant_get(whole, "$", "array<variant>")
    single = F.when(F.try_variant_get(whole, "$.name", "string").isNotNull()
                    & F.try_variant_get(whole, "$.arguments", "variant").isNotNull(), F.array(whole))
    found = F.filter(F.coalesce(listed, single, several, F.array().cast("array<variant>")), lambda c: _name(c).isNotNull())
    return F.when(F.ltrim(text).rlike(r"^[\{\[]"), found).otherwise(F.array().cast("array<variant>"))


def _name(call: Column) -> Column:
    return F.coalesce(F.try_variant_get(call, "$.function.name", "string"), F.try_variant_get(call, "$.name", "string"))


def _arguments(call: Column) -> Column:
    """A call's arguments as a variant; given as a string of JSON, they are parsed."""
    value = F.coalesce(F.try_variant_get(call, "$.function.arguments", "variant"), F.try_variant_get(call, "$.arguments", "variant"))
    written = F.try_variant_get(value, "$", "string")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_parse_json(written)).otherwise(value)


def messages(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, part, kind, role, text, call_id, tool, arguments): messages, with a row for every call."""
    own = conversations.select("conv_id", "turn", F.coalesce(F.lower("role"), F.lit("user")).alias("role"),
                               F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("calls", F.when(F.col("role") == "assistant", calls_in(F.col("text")))
                         .otherwise(F.array().cast("array<variant>")))
    none = F.lit(None).cast("variant")
    row = lambda part, kind, call_id, call: F.struct(
        part.cast("int").alias("part"), F.lit(kind).alias("kind"), call_id.alias("call_id"), call.alias("call"))
    result_id = F.try_variant_get(F.try_parse_json("text"), "$.tool_call_id", "string")
    calls = F.transform("calls", lambda c, i: row(i, "call", F.try_variant_get(c, "$.id", "string"), c))
    plain = F.array(row(F.lit(0), "message", F.lit(None).cast("string"), none))
    result = F.array(row(F.lit(0), "result", result_id, none))
    kinds = F.when(F.col("role") == "tool", result).when(F.size("calls") > 0, calls).otherwise(plain)
    return (own.select("conv_id", "turn", "role", "text", F.explode(kinds).alias("m"))
            .select("conv_id", "turn", "m.part", "m.kind", "role", "text", "m.call_id", _name(F.col("m.call")).alias("tool"),
                    _arguments(F.col("m.call")).alias("arguments")))


def _first(rows: DataFrame, name: str) -> DataFrame:
    """The first row of every conversation and identifier: (conv_id, call_id, <name>, n_<name>)."""
    able = rows.where("conv_id is not null and turn is not null and call_id is not null")
    return able.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "part")).alias(name), F.count("*").alias(f"n_{name}"))


def linked(conversations: DataFrame) -> DataFrame:
    """messages() with ``link`` (ok, open, orphan, repeated, unnamed) of calls and results, and ``place`` and ``rank``."""
    rows = messages(conversations)
    # Two slim aggregates by identifier; a hot identifier is one row after them.
    calls = _first(rows.where("kind = 'call'"), "call")
    results = _first(rows.where("kind = 'result'"), "result")
    pairs = calls.hint("shuffle_hash").join(results, ["conv_id", "call_id"], "full").select("conv_id", "call_id", "call", "result")
    plain = rows.where("kind = 'message'").withColumn("call", F.lit(None).cast("struct<turn:bigint,part:int>")).withColumn(
        "result", F.lit(None).cast("struct<turn:bigint,part:int>"))
    found = rows.where("kind <> 'message'").join(pairs, ["conv_id", "call_id"], "left").select(*plain.columns)
    own = F.struct(F.col("turn").cast("bigint").alias("turn"), F.col("part").alias("part"))
    mine = F.when(F.col("kind") == "call", F.col("call")).otherwise(F.col("result"))
    link = (F.when(F.col("kind") == "message", F.lit(None).cast("string"))
            .when(F.col("call_id").isNull() | F.col("turn").isNull() | F.col("conv_id").isNull(), "unnamed")
            .when(own != mine, "repeated")
            .when(F.col("call").isNull(), "orphan").when(F.col("result").isNull(), "open").otherwise("ok"))
    both = plain.unionByName(found).withColumn("link", link)
    after = (F.col("kind") == "result") & F.col("call").isNotNull()
    return (both.withColumn("place", F.when(after, F.greatest(F.col("turn"), F.col("call.turn"))).otherwise(F.col("turn")))
            .withColumn("rank", F.when(F.col("kind") == "result", 1).otherwise(0)).drop("call", "result"))


def _status(tools: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Adds ``status``: how a call's arguments meet the schema of its tool."""
    call = F.col("kind") == "call"
    if tools is None:
        return rows.withColumn("status", F.lit(None).cast("string"))
    # Only calls have a tool to look up: the others' null key would gather them in one place.
    others = rows.where(~call).withColumn("status", F.lit(None).cast("string"))
    found = rows.where(call).join(tools, "tool", "left")
    types = F.transform_values(F.try_variant_get("arguments", "$", "map<string,variant>"),
                               lambda _, v: F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1))
    found = found.withColumn("types", F.when(F.schema_of_variant("arguments").startswith("OBJECT"), types))
    missing = F.filter("required", lambda n: ~F.coalesce(F.map_contains_key("types", n), F.lit(False)))
    allowed = F.create_map(*[x for k, v in TYPES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    wrong = F.filter(F.array_sort(F.map_keys("names")), lambda n: F.coalesce(
        ~F.array_contains(F.element_at(allowed, F.element_at("names", n)), F.element_at("types", n)), F.lit(False)))
    status = (F.when(F.col("names").isNull(), "unknown tool")
              .when(F.col("types").isNull(), "no object")
              .when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ",")))
              .when(F.size(wrong) > 0, F.concat(F.lit("type:"), F.array_join(wrong, ","))).otherwise("ok"))
    return found.withColumn("status", status).select(*rows.columns, "status").unionByName(others)


def formatted(conversations: DataFrame, tools: DataFrame | None = None) -> DataFrame:
    """(conv_id, turn, part, kind, place, rank, link, status, json): every message, call and result in canonical JSON."""
    rows = _status(tools, linked(conversations))
    # Object keys written in code point order, so the JSON is canonical as it stands.
    message = F.to_json(F.struct(F.col("text").alias("content"), "role"))
    call = F.to_json(F.struct(
        F.struct(F.struct(F.col("arguments"), F.col("tool").alias("name")).alias("function"), F.col("call_id").alias("id"),
                 F.lit("function").alias("type")).alias("call"), F.col("role")))
    content = F.coalesce(F.get_json_object(canonical(F.col("text")), "$.content"), F.col("text"))
    result = F.to_json(F.struct(content.alias("content"), F.col("role"), F.col("call_id").alias("tool_call_id")))
    json = F.when(F.col("kind") == "call", call).when(F.col("kind") == "result", result).otherwise(message)
    return rows.select("conv_id", "turn", "part", "kind", "place", "rank", "link", "status", json.alias("json"))


def documents(conversations: DataFrame, tools: DataFrame | None = None) -> DataFrame:
    """The formatted lines, range-partitioned and sorted into topological order: written out, they are the transcripts."""
    order = ["conv_id", "place", "rank", "turn", "part"]
    return formatted(conversations, tools).repartitionByRange(*order).sortWithinPartitions(*order)
