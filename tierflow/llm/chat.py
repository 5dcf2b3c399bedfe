"""Chat formatting with tool-call linking, in DataFrame functions only.

Events are rows of one table: calls, results and plain messages. Calls and
results are hash-joined by (conversation, identifier): counts of both sides are
pre-aggregated and joined back to the events, so a hot identifier never forms a
group. A call may name the call it follows (``parent``); its topological level
is the length of that chain, found by doubling jumps: each round is one
equi-join, and the rounds grow with the logarithm of the longest chain.
Arguments are checked against the tool's parameters and serialised as canonical
JSON (keys sorted at every level, no spaces, strings escaped only where JSON
demands).

Result columns besides the event's own: ``link`` (``linked``, ``no result``,
``no call``, ``repeated`` when several calls or results share the identifier,
``no id``; NULL for messages), ``level`` (0, 2, 4, ... for calls, one more for
their results; NULL without a call or within a cycle), ``errors`` (of a call's
arguments, sorted) and ``json``.

Cases: NULL identifiers or conversations link with nothing; NULL texts and
arguments are JSON ``null``; a parent that is not a call of the conversation
counts as none; calls in a cycle, and those after it, have no level; repeated
rows stay rows; arguments that are no JSON object, that repeat a key, or that
exceed the size of Spark's variant have the error ``arguments``; an unknown
tool has the error ``tool``; further columns are dropped by ``events``; an
empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import staged

KEY = ["conversation", "id"]


def quoted(text: Column) -> Column:
    """A JSON string, or ``null``."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def canonical(text: Column) -> Column:
    """JSON text in canonical form; NULL if it is not JSON."""
    return F.to_json(F.try_parse_json(text))


def _kind(value: Column) -> Column:
    """The JSON type of a variant."""
    name = F.schema_of_variant(value)
    return (
        F.when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name == "VOID", "null")
        .when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array")
        .when(name.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | name.rlike(r"^DECIMAL\(\d+,0\)$"), "integer")
        .otherwise("number")
    )


def argument_errors(arguments: Column, parameters: Column) -> Column:
    """Sorted errors of a call's arguments: array of ``missing:x``, ``type:x``, ``unknown:x``, ``arguments``, ``tool``.

    ``parameters`` is an array of structs (name, type, required); ``type`` is a
    JSON type, with ``number`` allowing integers.
    """
    given = F.try_variant_get(F.try_parse_json(arguments), "$", "map<string,variant>")
    missing = F.transform(F.filter(parameters, lambda p: p["required"] & ~F.map_contains_key(given, p["name"])), lambda p: F.concat(F.lit("missing:"), p["name"]))

    def wrong(p: Column) -> Column:
        kind = _kind(F.element_at(given, p["name"]))
        return F.map_contains_key(given, p["name"]) & ~((kind == p["type"]) | ((p["type"] == "number") & (kind == "integer")))

    badly = F.transform(F.filter(parameters, wrong), lambda p: F.concat(F.lit("type:"), p["name"]))
    extra = F.transform(F.array_except(F.map_keys(given), F.transform(parameters, lambda p: p["name"])), lambda k: F.concat(F.lit("unknown:"), k))
    return F.when(parameters.isNull(), F.array(F.lit("tool"))).when(given.isNull(), F.array(F.lit("arguments"))).otherwise(F.array_sort(F.concat(missing, badly, extra)))


def levels(calls: DataFrame) -> DataFrame:
    """(conversation, id, depth) of distinct calls with their ``parent``; calls that never reach a root are absent."""
    ids = staged(calls.groupBy(*KEY).agg(F.min("parent").alias("parent")))
    known = ids.select("conversation", F.col("id").alias("parent"), F.lit(True).alias("known"))
    jumps = ids.join(known, ["conversation", "parent"], "left").select("conversation", "id", F.when(F.col("known"), F.col("parent")).alias("to"))
    jumps = staged(jumps.withColumn("depth", F.col("to").isNotNull().cast("long")))
    left = jumps.filter(F.col("to").isNotNull()).count()
    for _ in range(math.ceil(math.log2(left + 1)) + 1):
        if not left:
            break
        ahead = jumps.select("conversation", F.col("id").alias("to"), F.col("to").alias("next"), F.col("depth").alias("more"))
        jumps = jumps.join(ahead, ["conversation", "to"], "left").select("conversation", "id", F.col("next").alias("to"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        jumps = staged(jumps)
        left = jumps.filter(F.col("to").isNotNull()).count()
    return jumps.filter(F.col("to").isNull()).select("conversation", "id", "depth")


def link(events: DataFrame, tools: DataFrame) -> DataFrame:
    """Link and serialise ``events``: conversation, place, role, kind (call, result, message), id, parent, name, content.

    ``content`` is a call's arguments as JSON text, else plain text; ``tools``
    has ``name`` and ``parameters`` (see ``argument_errors``), a row a tool.
    """
    named = events.filter(F.col("conversation").isNotNull() & F.col("id").isNotNull() & F.col("kind").isin("call", "result"))
    sides = named.groupBy(*KEY).agg(F.count_if(F.col("kind") == "call").alias("calls"), F.count_if(F.col("kind") == "result").alias("results"))
    depth = levels(named.filter(F.col("kind") == "call").select(*KEY, "parent"))
    linked = events.join(sides.join(depth, KEY, "left"), KEY, "left").join(tools.select("name", "parameters"), "name", "left")
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    how = F.when(F.col("calls").isNull(), "no id").when((F.col("calls") > 1) | (F.col("results") > 1), "repeated").when(F.col("results") == 0, "no result").when(F.col("calls") == 0, "no call").otherwise("linked")
    call = F.concat(F.lit('{"arguments":'), F.coalesce(canonical(F.col("content")), quoted(F.col("content"))), F.lit(',"call_id":'), quoted(F.col("id")), F.lit(',"name":'), quoted(F.col("name")), F.lit(',"type":"call"}'))
    result = F.concat(F.lit('{"call_id":'), quoted(F.col("id")), F.lit(',"content":'), quoted(F.col("content")), F.lit(',"type":"result"}'))
    message = F.concat(F.lit('{"content":'), quoted(F.col("content")), F.lit(',"role":'), quoted(F.col("role")), F.lit(',"type":"message"}'))
    return linked.select(
        "conversation",
        "place",
        "role",
        "kind",
        "id",
        F.when(is_call | is_result, how).alias("link"),
        (2 * F.col("depth") + is_result.cast("long")).alias("level"),
        F.when(is_call, argument_errors(F.col("content"), F.col("parameters"))).alias("errors"),
        F.when(is_call, call).when(is_result, result).otherwise(message).alias("json"),
    )


def events_of_turns(turns: DataFrame) -> DataFrame:
    """Conversation turns as events: a user's turn calls ``reply``, the next assistant's turn is its result.

    A call follows the call two turns before; other roles are messages. Turns
    without a number have no identifier.
    """
    turn = F.col("turn").cast("long")
    is_user, is_reply = F.col("role") == "user", F.col("role") == "assistant"

    def number(at: Column) -> Column:
        return F.concat(F.col("conv_id").cast("string"), F.lit("-"), at.cast("string"))

    return turns.select(
        F.col("conv_id").alias("conversation"),
        turn.alias("place"),
        "role",
        F.when(is_user, "call").when(is_reply, "result").otherwise("message").alias("kind"),
        F.when(is_user, number(turn)).when(is_reply, number(turn - 1)).alias("id"),
        F.when(is_user, number(turn - 2)).alias("parent"),
        F.when(is_user, "reply").alias("name"),
        F.when(is_user, F.to_json(F.struct(turn.alias("turn"), F.col("text").alias("prompt")))).otherwise(F.col("text")).alias("content"),
    )


def reply_tool(spark: SparkSession) -> DataFrame:
    """The parameters of ``reply``."""
    return spark.sql("SELECT 'reply' AS name, array(named_struct('name', 'prompt', 'type', 'string', 'required', true), named_struct('name', 'turn', 'type', 'integer', 'required', true)) AS parameters")


ORACLE_SQL = """
WITH RECURSIVE e AS (
  SELECT conv_id, turn, role, text, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
         CASE role WHEN 'user' THEN turn WHEN 'assistant' THEN turn - 1 END AS place
  FROM conversations),
n AS (SELECT conv_id, place, count(*) FILTER (kind = 'call') AS calls, count(*) FILTER (kind = 'result') AS results FROM e WHERE place IS NOT NULL GROUP BY ALL),
d(conv_id, place, depth) AS (
  SELECT conv_id, place, 0 FROM n WHERE calls > 0 AND (conv_id, place - 2) NOT IN (SELECT (conv_id, place) FROM n WHERE calls > 0)
  UNION ALL SELECT n.conv_id, n.place, d.depth + 1 FROM d JOIN n ON n.conv_id = d.conv_id AND n.place = d.place + 2 WHERE n.calls > 0)
SELECT e.conv_id, e.turn, e.role, e.kind, e.conv_id || '-' || e.place AS call_id,
  CASE WHEN e.place IS NULL THEN NULL WHEN calls > 1 OR results > 1 THEN 'repeated' WHEN results = 0 THEN 'no result' WHEN calls = 0 THEN 'no call' ELSE 'linked' END AS link,
  CAST(2 * depth + (e.kind = 'result')::INT AS BIGINT) AS level,
  CASE WHEN e.kind = 'call' THEN CASE WHEN text IS NULL THEN 'missing:prompt' ELSE '' END END AS errors,
  CASE e.kind WHEN 'call' THEN '{"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE '"prompt":' || to_json(text)::VARCHAR || ',' END || '"turn":' || turn || '},"call_id":"' || e.conv_id || '-' || e.place || '","name":"reply","type":"call"}'
    WHEN 'result' THEN '{"call_id":"' || e.conv_id || '-' || e.place || '","content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"type":"result"}'
    ELSE '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":' || to_json(role)::VARCHAR || ',"type":"message"}' END AS json
FROM e LEFT JOIN n ON n.conv_id = e.conv_id AND n.place = e.place LEFT JOIN d ON d.conv_id = e.conv_id AND d.place = e.place
"""
