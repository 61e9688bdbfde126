"""Chat formatting with linked tool calls, DataFrame functions only.

Messages become events: a plain message, each call of a message with ``tool_calls``, or the
result in a message of role ``tool``. Results are joined to calls by conversation and
identifier (hash join on a table with one row per identifier). Arguments are checked
against the tool's JSON schema. Events are put in a topological order: a result comes after
its call, a call after the calls named in its ``after`` list; apart from that the order of
the turns stays. Each event is written as canonical JSON (keys sorted, no blanks).

The order key of an event is the greatest of (its turn, 0) and (turn key, hops + 1) of each
event it must follow. A dependency on an earlier turn holds already; only dependencies on
the same or a later turn start rounds of relaxation, one join each, so the rounds are the
length of the longest such chain and not of the conversation. Positions come from one
global range sort, so a conversation of any size is spread over many tasks.

Message format (JSON in ``text``): ``{"tool_calls": [{"id", "name", "arguments", "after"}]}``
for any role, ``{"tool_call_id", "content"}`` for role ``tool``. Everything else is plain.

Defined results: null role or text → plain message with null fields left out; text that is
no such JSON → plain; a result without a known call → ``orphan``; a second call or result
with an identifier of the conversation → ``duplicate`` (the first in turn order is the one
that links); a call without result → ``unanswered``; calls that wait for themselves →
``cycle`` and keep their own turn; a dependency on an unknown identifier is ignored;
repeated rows are events of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxiscope.llm.common import drop_stored, spread_rows, stored
from toxiscope.operators.ranking import global_index

ENVELOPE = (
    "struct<tool_calls:array<struct<id:string,name:string,arguments:string,after:array<string>>>,"
    "tool_call_id:string,content:string>"
)
#: JSON types by the head of Spark's variant type names.
TYPES = {
    "string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"),
    "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",), "null": ("VOID",),
}


def problems(name: Column, arguments: Column, tools: dict[str, dict]) -> Column:
    """Comma-separated faults of a call's arguments; empty when they fit their schema.

    Schemas: ``required``, ``properties`` with ``type``, ``enum`` and ``minLength``, and
    ``additionalProperties``.
    """
    value = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)

    def of(schema: dict) -> Column:
        found = []
        for key in schema.get("required", []):
            found.append(F.when(~F.array_contains(keys, key), F.lit(f"missing:{key}")))
        for key, rule in schema.get("properties", {}).items():
            at = F.try_variant_get(value, f"$['{key}']", "variant")
            have = F.array_contains(keys, key)
            if "type" in rule:
                kind = F.regexp_extract(F.schema_of_variant(at), "^[A-Z]+", 0)
                found.append(F.when(have & ~kind.isin(*TYPES[rule["type"]]), F.lit(f"type:{key}")))
            text = F.try_variant_get(value, f"$['{key}']", "string")
            if "enum" in rule:
                found.append(F.when(have & ~text.isin(*rule["enum"]), F.lit(f"enum:{key}")))
            if "minLength" in rule:
                found.append(F.when(have & (F.length(text) < rule["minLength"]), F.lit(f"short:{key}")))
        if not schema.get("additionalProperties", True):
            extra = F.array_except(keys, F.array(*[F.lit(k) for k in schema.get("properties", {})]))
            found.append(F.when(F.size(extra) > 0, F.lit("extra")))
        return F.concat_ws(",", *found) if found else F.lit("")

    checked = functools.reduce(lambda c, t: c.when(name == t[0], of(t[1])), tools.items(), F.when(F.lit(False), ""))
    return (
        F.when(value.isNull() | keys.isNull(), F.lit("json"))
        .when(name.isNull() | ~name.isin(*tools), F.lit("unknown_tool"))
        .otherwise(checked)
    )


def events_of(messages: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per event: plain message, call, or result."""
    rows = spread_rows(messages.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    ))
    rows = rows.withColumn("m", F.when(F.ltrim("text").startswith("{"), F.from_json("text", ENVELOPE)))
    calls = F.col("m.tool_calls")
    is_call = F.coalesce(F.size(calls) > 0, F.lit(False))
    is_result = F.coalesce((F.col("role") == "tool") & F.col("m.tool_call_id").isNotNull(), F.lit(False))
    kind = F.when(is_call, "call").when(is_result, "result").otherwise("message")
    one = F.struct(
        F.col("m.tool_call_id").alias("id"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("array<string>").alias("after"),
    )
    each = F.when(is_call, calls).otherwise(F.array(one))
    out = rows.select("conv", "turn", "role", "text", F.col("m.content").alias("content"), kind.alias("kind"),
                      F.posexplode(each).alias("slot", "c"))
    return out.select(
        "conv", F.col("turn").cast("long").alias("turn"), "role", "slot", "kind", F.col("c.id").alias("call_id"),
        F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"), F.col("c.after").alias("after"),
        F.when(F.col("kind") == "message", F.col("text")).otherwise(F.col("content")).alias("content"),
        F.monotonically_increasing_id().alias("event"),
    )


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _relax(calls: DataFrame, waits: DataFrame) -> DataFrame:
    """``(event, at, hops, cycle)`` of calls that wait for a call of the same or a later turn,
    or for such a call in turn. ``calls``: first calls; ``waits``: (event, on). A round moves
    one step, so there are as many rounds as the longest chain has calls."""
    key = lambda t, h: F.struct(t.alias("at"), h.alias("hops"))
    own = calls.select("event", "n_calls", key(F.coalesce("turn", F.lit(-1)), F.lit(0)).alias("key"))
    now = stored(own, "calls-order")
    while True:  # ends: a round that changes nothing, and hops have a bound
        on = now.select(F.col("event").alias("on"), F.col("key").alias("dep"), F.col("n_calls").alias("most"))
        # a chain of waiting calls has fewer hops than the conversation has calls
        need = (
            waits.join(on, "on").where(F.col("dep.hops") <= F.col("most"))
            .groupBy("event").agg(F.max(key(F.col("dep.at"), F.col("dep.hops") + 1)).alias("need"))
        )
        moved = now.join(need, "event", "left").withColumn("grew", F.coalesce(F.col("need") > F.col("key"), F.lit(False)))
        new = stored(moved.select("event", "n_calls", F.when(F.col("grew"), F.col("need")).otherwise(F.col("key")).alias("key"),
                                  "grew"), "calls-order")
        drop_stored(now)
        now = new.drop("grew")
        if new.where("grew").isEmpty():
            return now.select("event", "key.at", "key.hops", (F.col("key.hops") > F.col("n_calls")).alias("cycle"))


def link_tool_calls(
    messages: DataFrame, tools: dict[str, dict], conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``(conv, position, turn, kind, call_id, status, problems, linked_turn, json)`` per event."""
    events = stored(events_of(messages, conv, turn, role, text), "calls-events")
    when = F.struct(F.col("turn"), F.col("slot"), F.col("event"))
    named = events.where(F.col("call_id").isNotNull())
    first_call = named.where("kind = 'call'").groupBy("conv", "call_id").agg(F.min(when).alias("call"))
    first_result = named.where("kind = 'result'").groupBy("conv", "call_id").agg(F.min(when).alias("result"))
    pairs = stored(
        first_call.join(first_result.withColumnsRenamed({"conv": "c", "call_id": "i"}),
                        _same(F.col("conv"), F.col("c")) & (F.col("call_id") == F.col("i")), "full")
        .select(F.coalesce("conv", "c").alias("p_conv"), F.coalesce("call_id", "i").alias("p_id"), "call", "result"),
        "calls-pairs",
    )
    known = events.join(
        pairs, _same(F.col("conv"), F.col("p_conv")) & (F.col("call_id") == F.col("p_id")), "left"
    ).drop("p_conv", "p_id")

    # waits between first calls; only those on the same or a later turn can move anything
    per_conv = events.where("kind = 'call'").groupBy(F.col("conv").alias("n_conv")).agg(F.count(F.lit(1)).alias("n_calls"))
    waits = (
        events.where("kind = 'call'").select("event", "conv", "turn", F.explode(F.array_distinct("after")).alias("dep"))
        .join(pairs.where("call is not null").select("p_conv", "p_id", F.col("call.event").alias("on"), F.col("call.turn").alias("on_turn")),
              _same(F.col("conv"), F.col("p_conv")) & (F.col("dep") == F.col("p_id")))
        .select("event", "turn", "on", "on_turn")
    )
    moving = waits.where((F.col("on_turn") >= F.col("turn")) | F.col("turn").isNull() | F.col("on_turn").isNull())
    if moving.isEmpty():
        order = None
    else:
        calls = events.where("kind = 'call'").select("event", "conv", "turn").join(
            per_conv, _same(F.col("conv"), F.col("n_conv"))
        )
        order = _relax(calls, waits.select("event", "on"))
    turn_key = F.coalesce("turn", F.lit(-1))
    if order is None:
        keyed = known.select("*", turn_key.alias("at"), F.lit(0).alias("hops"), F.lit(False).alias("cycle"))
        call_at, call_hops = F.coalesce(F.col("call.turn"), F.lit(-1)), F.lit(0)
    else:
        of_call = order.select(F.col("event").alias("o"), F.col("at").alias("c_at"), F.col("hops").alias("c_hops"), F.col("cycle").alias("c_cycle"))
        keyed = (
            known.join(order, "event", "left").join(of_call, F.col("call.event") == F.col("o"), "left")
            .withColumns({"at": F.coalesce("at", turn_key), "hops": F.coalesce("hops", F.lit(0)), "cycle": F.coalesce("cycle", F.lit(False))})
            .withColumns({"at": F.when(F.col("cycle"), turn_key).otherwise(F.col("at")), "hops": F.when(F.col("cycle"), 0).otherwise(F.col("hops"))})
        )
        stuck = F.coalesce("c_cycle", F.lit(False))
        call_at = F.when(stuck, F.coalesce(F.col("call.turn"), F.lit(-1))).otherwise(F.col("c_at"))
        call_hops = F.when(stuck, 0).otherwise(F.col("c_hops"))
    follows = (F.col("kind") == "result") & F.col("call").isNotNull()
    least = F.greatest(
        F.struct(F.col("at"), F.col("hops")), F.struct(call_at.alias("at"), (call_hops + 1).alias("hops"))
    )
    keyed = keyed.withColumn("key", F.when(follows, least).otherwise(F.struct("at", "hops")))

    first = F.when(F.col("kind") == "call", F.col("call.event")).otherwise(F.col("result.event")) == F.col("event")
    status = (
        F.when(F.col("kind") == "message", "message")
        .when(F.col("call_id").isNull() | ~F.coalesce(first, F.lit(False)), F.when(F.col("call_id").isNull(), "nameless").otherwise("duplicate"))
        .when(F.col("cycle"), "cycle")
        .when((F.col("kind") == "call") & F.col("result").isNull(), "unanswered")
        .when((F.col("kind") == "result") & F.col("call").isNull(), "orphan")
        .otherwise("linked")
    )
    fault = F.when(F.col("kind") == "call", problems(F.col("name"), F.col("arguments"), tools))
    linked_turn = F.when(status == "linked", F.when(F.col("kind") == "call", F.col("result.turn")).otherwise(F.col("call.turn")))
    done = keyed.select(
        "event", "conv", "turn", "slot", "role", "kind", "call_id", "content", "name", "arguments", "after",
        "key", status.alias("status"), fault.alias("problems"), linked_turn.alias("linked_turn"),
    )
    done = stored(done.withColumn("json", canonical(done)).drop("content", "name", "arguments", "after", "role"), "calls-done")
    ranked = global_index(
        done.select("event", "conv", "key", "turn", "slot"),
        [F.col("conv"), F.col("key"), F.col("turn"), F.col("slot"), F.col("event")], "place",
    )
    begin = ranked.groupBy(F.col("conv").alias("b_conv")).agg(F.min("place").alias("begin"))
    placed = ranked.join(begin, _same(F.col("conv"), F.col("b_conv"))).select(
        "event", (F.col("place") - F.col("begin")).alias("position")
    )
    return done.join(placed, "event").select(
        F.col("conv").alias(conv), "position", F.col("turn"), "kind", "call_id", "status", "problems", "linked_turn", "json"
    )


def canonical(events: DataFrame) -> Column:
    """The event as JSON with sorted keys and no blanks; null fields are left out.

    Arguments that are no JSON object stay a string.
    """
    text = lambda c: F.to_json(F.array(F.col(c)))  # noqa: E731  a quoted string in brackets
    quoted = lambda c: F.regexp_replace(text(c), r"^\[|\]$", "")
    field = lambda k, v: F.concat(F.lit(f'"{k}":'), v)
    args = F.coalesce(F.to_json(F.try_parse_json("arguments")), quoted("arguments"))
    after = F.when(F.size("after") > 0, F.to_json(F.sort_array(F.array_distinct("after"))))
    wrap = lambda *parts: F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    opt = lambda k, c: F.when(F.col(c).isNotNull(), field(k, quoted(c)))
    call = wrap(
        field("after", after), F.when(F.col("arguments").isNotNull(), field("arguments", args)),
        opt("id", "call_id"), opt("name", "name"),
    )
    return (
        F.when(F.col("kind") == "call", wrap(opt("role", "role"), F.concat(F.lit('"tool_calls":['), call, F.lit("]"))))
        .when(F.col("kind") == "result", wrap(opt("content", "content"), opt("role", "role"), opt("tool_call_id", "call_id")))
        .otherwise(wrap(opt("content", "content"), opt("role", "role")))
    )


#: Schemas of the registered query's two tools.
TOOLS = {
    "ask": {
        "required": ["query", "turn"], "additionalProperties": False,
        "properties": {"query": {"type": "string", "minLength": 20}, "turn": {"type": "integer"}},
    },
    "configure": {"required": ["prompt"], "properties": {"prompt": {"type": "string", "minLength": 1}}},
}


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as tool use: a user turn calls ``ask``, a system turn ``configure``, an
    assistant turn is the result of the call of the turn before; a question waits for the
    call two turns before it. Rows that hold tool messages already stay as they are."""
    ident = lambda t: F.concat(F.lit("call_"), t.cast("string"))
    ask = F.to_json(F.struct(F.array(F.struct(
        ident(F.col("turn")).alias("id"), F.lit("ask").alias("name"),
        F.struct(F.col("text").alias("query"), "turn").alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(ident(F.col("turn") - 2))).alias("after"),
    )).alias("tool_calls")))
    configure = F.to_json(F.struct(F.array(F.struct(
        ident(F.col("turn")).alias("id"), F.lit("configure").alias("name"),
        F.struct(F.col("text").alias("prompt")).alias("arguments"),
    )).alias("tool_calls")))
    answer = F.to_json(F.struct(ident(F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content")))
    plain = F.coalesce(~F.ltrim("text").startswith("{"), F.lit(True)) & F.col("turn").isNotNull()
    role = F.col("role")
    return conversations.select(
        "conv_id", "turn",
        F.when(plain & role.isin("user", "system"), "assistant").when(plain & (role == "assistant"), "tool").otherwise(role).alias("role"),
        F.when(plain & (role == "user"), ask).when(plain & (role == "system"), configure)
        .when(plain & (role == "assistant"), answer).otherwise(F.col("text")).alias("text"),
    )
