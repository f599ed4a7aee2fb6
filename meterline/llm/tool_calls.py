"""Tool calls and their results: linked by identifier, ordered, validated, and written as canonical JSON.

Calls and results meet in equi-joins on conversation and identifier. A call
whose arguments name another call ("$ref:<id>") follows that call's result;
depths are found by joins, a round for each link of the longest chain. All
steps are DataFrame operations, and a conversation is never gathered into one
row: events carry the keys that order them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin

# Arguments by tool: type, and whether they must be there.
SCHEMAS: dict[str, dict[str, tuple[str, bool]]] = {
    "search": {"query": ("string", True), "limit": ("integer", True), "after": ("string", False)},
    "lookup": {"query": ("string", True), "limit": ("number", False), "after": ("string", False)},
    "count": {"query": ("string", False), "limit": ("integer", True), "after": ("string", False)},
}
# Names that schema_of_variant gives to the values of a type.
_TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL)", "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT"}
REFERENCE = r'"\$ref:([^"\\]+)"'
_NO_TURN, _MAX_LENGTH = -(1 << 63), (1 << 31) - 1
CALL = ["conv_id", "turn", "pos", "call_id", "name", "arguments"]


def call_rows(messages: DataFrame) -> DataFrame:
    """One row for each entry of ``tool_calls(id, name, arguments)``; equal rows are one, with ``copies``."""
    entry = messages.select("conv_id", "turn", F.posexplode("tool_calls").alias("pos", "c"))
    return entry.select("conv_id", "turn", "pos", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments")).groupBy(*CALL).agg(F.count("*").alias("copies"))


def result_rows(messages: DataFrame) -> DataFrame:
    """One row for each message that answers ``tool_call_id``; equal rows are one, with ``copies``."""
    answers = messages.where("role = 'tool'").select("conv_id", "turn", F.col("tool_call_id").alias("call_id"), F.col("text").alias("content"))
    return answers.groupBy("conv_id", "turn", "call_id", "content").agg(F.count("*").alias("copies"))


def _quoted(value: Column) -> Column:
    """A string as JSON; null as null."""
    whole = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNull(), F.lit("null")).otherwise(F.substring(whole, F.lit(6), F.length(whole) - 6))


def _object(**members: Column) -> Column:
    parts = []
    for i, key in enumerate(sorted(members)):
        parts += [F.lit(f'{"," if i else "{"}"{key}":'), members[key]]
    return F.concat(*parts, F.lit("}"))


def errors_of(name: Column, arguments: Column, schemas: dict | None = None) -> Column:
    """Sorted error codes of a call's arguments; a reference stands for a value of any type."""
    schemas = SCHEMAS if schemas is None else schemas
    value = F.try_parse_json(arguments)
    keys = F.json_object_keys(F.to_json(value))
    none = F.array().cast("array<string>")
    by_tool = F.array(F.lit("unknown_tool"))
    for tool, fields in schemas.items():
        found = [F.transform(F.array_except(keys, F.array(*map(F.lit, fields))), lambda k: F.concat(F.lit("extra:"), k))]
        for field, (kind, needed) in fields.items():
            there = F.array_contains(keys, field)
            of = F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))
            reference = F.coalesce(F.try_variant_get(value, f"$.{field}", "string").startswith("$ref:"), F.lit(False))
            fits = F.coalesce(of.rlike(_TYPES[kind]), F.lit(False)) | reference
            found.append(F.when(there & ~fits, F.array(F.lit(f"type:{field}"))).when(~there & F.lit(needed), F.array(F.lit(f"missing:{field}"))).otherwise(none))
        by_tool = F.when(name == tool, F.array_sort(F.concat(*found))).otherwise(by_tool)
    is_object = F.schema_of_variant(value).startswith("OBJECT")
    return F.when(value.isNull(), F.array(F.lit("not_json"))).when(~is_object, F.array(F.lit("not_object"))).otherwise(by_tool)


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of the ``calls(conv_id, call_id, refs)`` that no cycle holds up; 0 without references.

    References to ids that no call of the conversation has are left out.
    """
    edges = pin(calls.select("conv_id", "call_id", F.explode(F.array_distinct("refs")).alias("ref")).join(calls.select("conv_id", F.col("call_id").alias("ref")), ["conv_id", "ref"]))
    known = pin(calls.select("conv_id", "call_id").join(edges.select("conv_id", "call_id").distinct(), ["conv_id", "call_id"], "left_anti").withColumn("depth", F.lit(0)))
    waiting = edges
    while not waiting.isEmpty():
        at = waiting.join(known.select("conv_id", F.col("call_id").alias("ref"), F.col("depth").alias("below")), ["conv_id", "ref"], "left")
        ready = at.groupBy("conv_id", "call_id").agg(F.max("below").alias("below"), F.count("*").alias("n"), F.count("below").alias("met")).where("n = met")
        ready = pin(ready.select("conv_id", "call_id", (F.col("below") + 1).alias("depth")))
        if ready.isEmpty():
            break
        known = pin(known.unionByName(ready))
        waiting = pin(waiting.join(ready, ["conv_id", "call_id"], "left_anti"))
    return known


def link(messages: DataFrame, schemas: dict | None = None) -> DataFrame:
    """An event for each call and result of ``messages(conv_id, turn, role, text, tool_calls, tool_call_id)``.

    Columns: conv_id, stage (the topological order within a conversation; ties
    by turn, pos), turn, pos, kind (call or result), call_id, name, status,
    errors, copies, canonical.

    The first call of an id (by turn, pos, name, arguments) holds it; later
    ones are ``duplicate``. Its first result of a later turn (then by content)
    answers it; further ones are ``extra``, those of its turn or before are
    ``early``, those without a call are ``orphan``. Calls are ``answered``,
    ``unanswered``, in a ``cycle`` or behind one, or without an id (``no_id``).
    Copies of an event are counted, and the first copy holds the status. Conversations without
    an id are one; ids come back as they came, numbers or text. A null turn
    comes before all others and comes back as null. Arguments that repeat a
    key are no JSON here. In canonical JSON keys are sorted and
    no space is left; arguments that are not JSON are given as a string. Stages
    of events outside the order are null.
    """
    plain = messages.select(
        # Keys that are never null and lose nothing: the id behind a mark, and the least turn for none.
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(_NO_TURN)).alias("turn"), "role", F.col("text").cast("string").alias("text"), "tool_calls", "tool_call_id",
    )
    calls = pin(call_rows(plain))
    results = pin(result_rows(plain))
    order = F.struct("turn", "pos", F.coalesce("name", F.lit("")).alias("n"), F.coalesce("arguments", F.lit("")).alias("a"))
    named = calls.where("call_id is not null")
    holders = pin(named.groupBy("conv_id", "call_id").agg(F.min(order).alias("at")))
    refs = F.regexp_extract_all(F.coalesce("at.a", F.lit("")), F.lit(REFERENCE), F.lit(1))
    depth = depths(holders.select("conv_id", "call_id", refs.alias("refs")))
    holders = pin(holders.join(depth, ["conv_id", "call_id"], "left"))
    answer = F.struct("turn", F.coalesce("content", F.lit("")).alias("c"))
    met = results.join(holders.select("conv_id", "call_id", F.col("at.turn").alias("asked"), "depth"), ["conv_id", "call_id"], "left")
    firsts = pin(met.where("turn > asked").groupBy("conv_id", "call_id").agg(F.min(answer).alias("first")))

    asked = calls.join(holders, ["conv_id", "call_id"], "left").join(firsts, ["conv_id", "call_id"], "left")
    holds = F.col("at").isNotNull() & (order == F.col("at"))
    status = (
        F.when(F.col("call_id").isNull(), "no_id").when(~holds, "duplicate").when(F.col("depth").isNull(), "cycle")
        .when(F.col("first").isNull(), "unanswered").otherwise("answered")
    )
    value = F.coalesce(F.to_json(F.try_parse_json("arguments")), _quoted(F.col("arguments")))
    call_events = asked.select(
        "conv_id", F.when(holds, 2 * F.col("depth")).alias("stage"), "turn", "pos", F.lit("call").alias("kind"), "call_id", "name", status.alias("status"),
        errors_of(F.col("name"), F.col("arguments"), schemas).alias("errors"), "copies",
        _object(arguments=value, id=_quoted(F.col("call_id")), name=_quoted(F.col("name")), type=F.lit('"call"')).alias("canonical"),
    )
    met = met.join(firsts, ["conv_id", "call_id"], "left")
    linked = F.coalesce(answer == F.col("first"), F.lit(False))
    state = F.when(F.col("asked").isNull(), "orphan").when(F.col("turn") <= F.col("asked"), "early").when(linked, "linked").otherwise("extra")
    result_events = met.select(
        "conv_id", F.when(linked, 2 * F.col("depth") + 1).alias("stage"), "turn", F.lit(0).alias("pos"), F.lit("result").alias("kind"), "call_id", F.lit(None).cast("string").alias("name"),
        state.alias("status"), F.array().cast("array<string>").alias("errors"), "copies",
        _object(content=_quoted(F.col("content")), id=_quoted(F.col("call_id")), type=F.lit('"result"')).alias("canonical"),
    )
    events = call_events.unionByName(result_events)
    kind = messages.schema["conv_id"].dataType
    conversation = F.when(F.col("conv_id") != "", F.substring("conv_id", 2, _MAX_LENGTH).cast(kind))
    return events.withColumns({"conv_id": conversation, "turn": F.when(F.col("turn") != _NO_TURN, F.col("turn"))})


def table_messages(conversations: DataFrame) -> DataFrame:
    """Messages with calls, derived from conversations without any.

    Each assistant turn t calls a tool as c<t>, with a word and the length of
    its text as arguments, after the call two turns before. Some calls have a
    fault, by conversation and turn. A user turn answers the turn before it.
    """
    word = F.regexp_extract(F.coalesce("text", F.lit("")), "[A-Za-z]+", 0)
    fault = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(11))
    size = (F.length(F.coalesce("text", F.lit(""))) % 50).cast("string")
    after = F.when(fault == 5, F.col("turn")).when(F.col("turn") >= 3, F.col("turn") - 2)
    arguments = F.concat(
        F.lit("{ "), F.when(fault == 2, F.lit("")).otherwise(F.concat(F.lit('"query": "'), word, F.lit('", '))),
        F.lit('"limit": '), F.when(fault == 1, F.concat(F.lit('"'), size, F.lit('"'))).otherwise(size),
        F.when(fault == 3, F.lit(', "zone": [1, {"b": 2, "a": null}]')).otherwise(F.lit("")),
        F.coalesce(F.concat(F.lit(', "after": "$ref:c'), after.cast("string"), F.lit('"')), F.lit("")),
        F.when(fault == 0, F.lit("")).otherwise(F.lit(" }")),
    )
    name = F.when(fault == 4, "guess").otherwise(F.element_at(F.array(*map(F.lit, SCHEMAS)), (F.pmod("conv_id", F.lit(3)) + 1).cast("int")))
    calls = F.when(F.col("role") == "assistant", F.array(F.struct(F.concat(F.lit("c"), F.col("turn").cast("string")).alias("id"), name.alias("name"), arguments.alias("arguments"))))
    answers = (F.col("role") == "user") & (F.col("turn") >= 1)
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(answers, "tool").otherwise(F.col("role")).alias("role"), "text",
        F.coalesce(calls, F.array().cast("array<struct<id:string,name:string,arguments:string>>")).alias("tool_calls"),
        F.when(answers, F.concat(F.lit("c"), (F.col("turn") - 1).cast("string"))).alias("tool_call_id"),
    )


def check_sql() -> str:
    """DuckDB SQL for the events of ``table_messages`` over conversations; ``errors`` are joined and texts left out of results."""
    return """
with recursive base as (select conv_id, turn, role, coalesce(text, '') as text, (conv_id + turn) % 11 as fault from conversations),
calls as (select conv_id, turn, 'c' || turn as call_id, fault,
    case when fault = 4 then 'guess' else (['search', 'lookup', 'count'])[cast(conv_id % 3 + 1 as int)] end as name,
    regexp_extract(text, '[A-Za-z]+') as word, cast(length(text) % 50 as varchar) as size,
    case when fault = 5 then turn when turn >= 3 then turn - 2 end as after, count(*) as copies
  from base where role = 'assistant' group by all),
answers as (select conv_id, turn, 'c' || (turn - 1) as call_id, count(*) as copies from base where role = 'user' and turn >= 1 group by conv_id, turn, text),
depth as (
  select c.conv_id, c.turn, 0 as depth from calls c where after is null or not exists (select 1 from calls d where d.conv_id = c.conv_id and d.turn = c.after)
  union all select c.conv_id, c.turn, depth.depth + 1 from calls c join depth on c.conv_id = depth.conv_id and c.after = depth.turn),
raw as (select *, case when fault = 0 then
    json_quote('{ "query": "' || word || '", "limit": ' || size || coalesce(', "after": "$ref:c' || after || '"', ''))
  else '{' || concat_ws(',', '"after":"$ref:c' || after || '"', '"limit":' || case when fault = 1 then '"' || size || '"' else size end,
    case when fault <> 2 then '"query":"' || word || '"' end, case when fault = 3 then '"zone":[1,{"a":null,"b":2}]' end) || '}' end as value from calls)
select r.conv_id, cast(2 * d.depth as int) as stage, r.turn, 'call' as kind, r.call_id, r.name,
  case when d.depth is null then 'cycle' when exists (select 1 from answers a where a.conv_id = r.conv_id and a.call_id = r.call_id) then 'answered' else 'unanswered' end as status,
  case when fault = 0 then 'not_json' when fault = 4 then 'unknown_tool' when fault = 1 then 'type:limit'
    when fault = 2 and name <> 'count' then 'missing:query' when fault = 3 then 'extra:zone' else '' end as errors, r.copies,
  '{"arguments":' || value || ',"id":"' || r.call_id || '","name":"' || name || '","type":"call"}' as canonical
from raw r left join depth d on r.conv_id = d.conv_id and r.turn = d.turn
union all
select a.conv_id, cast(case when c.turn is not null then 2 * d.depth + 1 end as int), a.turn, 'result', a.call_id, null,
  case when c.turn is null then 'orphan' else 'linked' end, '', a.copies, null
from answers a left join calls c on a.conv_id = c.conv_id and a.call_id = c.call_id left join depth d on c.conv_id = d.conv_id and c.turn = d.turn"""
