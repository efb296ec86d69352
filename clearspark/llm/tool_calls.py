"""Tool calls and results of conversations: linked, ordered, validated, as canonical JSON.

A message's text is JSON: an assistant's `tool_calls` each have an id, a name, arguments and
the ids that they wait for (`after`); a tool's message has `tool_call_id` and `content`.
Calls and results meet in a hash join on (conversation, id). The order is by level: a call
stands one level above the highest call it waits for. Calls that wait for one call alone form
chains, whose ends are found by doubling; levels of the others are then found in rounds over
their waiting pairs. So a conversation is never gathered, however long it is; rounds are as
many as the calls with several waits on one path, and the logarithm of the longest chain. What
is left when a round resolves nothing waits in a circle or for something in one.
"""

import json
import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearspark.session import landed

CALLS = (
    "struct<tool_calls: array<struct<id: string, name: string, arguments: string, after: array<string>>>, "
    "tool_call_id: string, content: string>"
)
_TYPES: dict[str, Callable] = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and math.isfinite(v) and v == int(v),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}


def faults(value, schema: dict, at: str = "") -> list[str]:
    """What of a JSON schema a value breaks: type, enum, bounds, required and unknown members, items."""
    where = at or "."
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[k](value) for k in kinds):
        return [f"{where}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{where}: not listed")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if "minimum" in schema and value < schema["minimum"]:
            found.append(f"{where}: below {schema['minimum']}")
        if "maximum" in schema and value > schema["maximum"]:
            found.append(f"{where}: above {schema['maximum']}")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        found.append(f"{where}: too short")
    if isinstance(value, dict):
        found += [f"{at}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        known = schema.get("properties", {})
        for name in sorted(value):
            if name in known:
                found += faults(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{name}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += faults(x, schema["items"], f"{at}[{i}]")
    return found


def canonical(value) -> str:
    """JSON with sorted names, no spaces, plain characters, and whole numbers without a fraction."""
    return json.dumps(_plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def _plain(value):
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    if isinstance(value, float):
        return int(value) if math.isfinite(value) and value == int(value) and abs(value) < 2**53 else value if math.isfinite(value) else None
    return value


def parsed(messages: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row for each message with its calls or result; text that is no such JSON has neither."""
    body = F.from_json(F.col(text), CALLS)
    return messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), body.alias("m"))


def _chains(single: DataFrame) -> DataFrame:
    """(conv, id, end, steps) of calls that wait for one call: the first on their way that does not.

    Each round doubles the calls that are passed over. A chain has no more calls than its
    conversation, so what has not ended by then runs in a circle; its `end` is a call of it.
    """
    longest = single.groupBy("conv").count().agg(F.max("count")).first()[0] or 1
    chains = landed(single.select("conv", "id", F.col("dep").alias("end"), F.lit(1).cast("bigint").alias("steps")), "chains")
    for _ in range((longest - 1).bit_length()):
        on = chains.select(F.col("conv").alias("_c"), F.col("id").alias("_i"), F.col("end").alias("_e"), F.col("steps").alias("_s"))
        met = chains.join(on, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("end") == F.col("_i")), "left")
        ahead = F.col("_i").isNotNull()
        moved = landed(
            met.select("conv", "id", F.coalesce("_e", "end").alias("end"), (F.col("steps") + F.coalesce("_s", F.lit(0))).alias("steps"), ahead.alias("ahead")),
            "chains",
        )
        chains = moved.drop("ahead")
        if moved.filter("ahead").isEmpty():
            break
    return chains


def levels(calls: DataFrame) -> DataFrame:
    """(conv, id, level) of the first call of each id; no row for those that wait in a circle.

    A call that waits for an id without a call does not wait for it. Rows of a repeated
    message are one call here; calls of one place that differ in `after` alone wait for all of it.
    """
    nodes = calls.filter("copy = 0").select("conv", "id", "after").distinct()
    waits = nodes.select("conv", "id", F.explode("after").alias("dep")).distinct()
    known = nodes.select(F.col("conv").alias("_c"), F.col("id").alias("dep")).distinct()
    waits = waits.join(known, F.col("conv").eqNullSafe(F.col("_c")) & (waits["dep"] == known["dep"])).select("conv", "id", waits["dep"])
    waits = landed(waits, "waits")
    same = lambda a, b: a["conv"].eqNullSafe(b["conv"]) & (a["id"] == b["id"])
    waiting = waits.groupBy("conv", "id").agg(F.count("*").alias("n"), F.collect_set("dep").alias("deps"))
    waiting = landed(waiting, "waiting")
    chains = _chains(waiting.filter("n = 1").select("conv", "id", F.col("deps")[0].alias("dep")))
    free = nodes.select("conv", "id").distinct()
    done = landed(free.join(waiting, same(free, waiting), "left_anti").withColumn("level", F.lit(0).cast("bigint")), "levels")
    passed = chains.select(F.col("conv").alias("_c"), F.col("id").alias("_d"), "end", "steps")
    left = waiting.filter("n > 1").select("conv", "id", F.explode("deps").alias("dep"))
    left = left.join(passed, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("dep") == F.col("_d")), "left")
    steps = F.coalesce("steps", F.lit(0)).cast("bigint").alias("steps")
    left = left.select("conv", "id", F.lit(0).cast("bigint").alias("floor"), F.coalesce("end", "dep").alias("dep"), steps)
    out = done
    while True:
        deps = done.select(F.col("conv").alias("_c"), F.col("id").alias("_d"), F.col("level").alias("_l"))
        seen = left.join(deps, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("dep") == F.col("_d")), "left")
        floor = F.greatest(F.max(F.col("_l") + F.col("steps") + 1), F.max("floor"))
        open_ = F.collect_set(F.when(F.col("_l").isNull(), F.struct("dep", "steps")))
        state = landed(seen.groupBy("conv", "id").agg(floor.alias("floor"), open_.alias("open")), "waiting")
        ready = state.filter(F.size("open") == 0).select("conv", "id", F.col("floor").alias("level"))
        if ready.isEmpty():
            break
        done = ready
        out = out.unionByName(ready)
        left = state.filter(F.size("open") > 0).select("conv", "id", "floor", F.inline("open"))
    ends = out.select(F.col("conv").alias("_c"), F.col("id").alias("_d"), "level")
    above = chains.join(ends, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("end") == F.col("_d")))
    above = above.select("conv", "id", (F.col("level") + F.col("steps")).alias("level"))
    return out.unionByName(above).withColumn("level", F.col("level").cast("int"))


def link(
    messages: DataFrame, schemas: dict[str, dict], conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each call, and for each result that no call waits for.

    (conv, turn, position, id, name, level, status, faults, result_turn, results, message).
    Of several results the first by turn is the call's, `results` counts all. `copy` calls
    (a second one of an id in a conversation, by turn and position) and results before the
    call stay apart. status: ok, invalid (unknown tool, arguments that are no JSON or break
    the schema), unanswered, repeated, circular, orphan; the first that holds of repeated,
    circular, invalid, unanswered. `message` is the canonical JSON of call and result.
    Ordered by (conv, level, turn, position) calls come after what they wait for. Null ids
    make orphans or unlinked calls; null conversations are one conversation; messages
    without calls and results give no row; repeated messages give repeated calls. Arguments
    with half a surrogate pair or nested deeper than DEPTH make a call invalid.
    """
    rows = landed(parsed(messages, conv, turn, role, text), "messages")
    calls = rows.filter("role = 'assistant'").select("conv", "turn", F.posexplode("m.tool_calls").alias("position", "c"))
    calls = calls.select("conv", "turn", "position", "c.id", "c.name", "c.arguments", F.coalesce("c.after", F.array()).alias("after"))
    at = F.struct("turn", "position", "name", "arguments")
    first = calls.groupBy("conv", "id").agg(F.min(at).alias("first"))
    calls = calls.join(first.select(F.col("conv").alias("_c"), F.col("id").alias("_i"), "first"), F.col("conv").eqNullSafe(F.col("_c")) & F.col("id").eqNullSafe(F.col("_i")), "left")
    calls = landed(calls.withColumn("copy", F.when(at == F.col("first"), 0).otherwise(1)).drop("_c", "_i", "first"), "calls")
    results = rows.filter("role = 'tool' AND m.tool_call_id IS NOT NULL").select("conv", "turn", F.col("m.tool_call_id").alias("rid"), F.col("m.content").alias("content"))
    asked = calls.filter("copy = 0 AND id IS NOT NULL").select(F.col("conv").alias("_c"), F.col("id").alias("_i"), F.col("turn").alias("_t")).distinct()
    matched = results.join(asked, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("rid") == F.col("_i")) & (F.col("turn") > F.col("_t")), "left")
    matched = landed(matched, "results")
    answers = matched.filter("_i IS NOT NULL").groupBy("conv", "rid").agg(F.min(F.struct("turn", "content")).alias("answer"), F.count("*").alias("results"))
    answers = answers.select(F.col("conv").alias("_c"), F.col("rid").alias("_i"), "answer", "results")
    placed = levels(calls).select(F.col("conv").alias("_lc"), F.col("id").alias("_li"), "level")
    joined = calls.join(answers, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("id") == F.col("_i")) & (F.col("copy") == 0), "left")
    joined = joined.join(placed, F.col("conv").eqNullSafe(F.col("_lc")) & (F.col("id") == F.col("_li")) & (F.col("copy") == 0), "left")
    ready = joined.select(
        "conv", "turn", "position", "id", "name", "arguments", "after", "copy", F.coalesce("level", F.when(F.col("id").isNull(), 0)).alias("level"),
        F.col("answer.turn").alias("result_turn"), F.coalesce("results", F.lit(0)).cast("bigint").alias("results"), F.col("answer.content").alias("content"),
    )

    def checked(batches):
        for batch in batches:
            out = [_checked(r, schemas) for r in batch.to_pylist()]
            yield pa.Table.from_pylist(out, schema=shape).to_batches()[0] if out else pa.RecordBatch.from_pylist([], schema=shape)

    kind = messages.schema[conv].dataType.simpleString()
    when = messages.schema[turn].dataType.simpleString()
    schema = (
        f"conv {kind}, turn {when}, position int, id string, name string, level int, status string, "
        f"faults array<string>, result_turn {when}, results bigint, message string"
    )
    shape = _arrow(messages, schema)
    linked = ready.mapInArrow(checked, schema)
    orphans = matched.filter("_i IS NULL").select(
        "conv", "turn", F.lit(0).alias("position"), F.col("rid").alias("id"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("int").alias("level"), F.lit("orphan").alias("status"), F.array().cast("array<string>").alias("faults"),
        F.col("turn").alias("result_turn"), F.lit(1).cast("bigint").alias("results"), "content",
    )
    orphans = orphans.select("*", F.to_json(F.struct(F.col("id").alias("id"), F.col("content").alias("result")), {"ignoreNullFields": "false"}).alias("message"))
    return linked.unionByName(orphans.drop("content"))


def _arrow(messages: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(messages.sparkSession.createDataFrame([], ddl).schema)


#: Arguments with more levels of arrays and objects than these are not read.
DEPTH = 200


def _depth(value) -> int:
    deepest, rest = 0, [(value, 1)]
    while rest:
        at, depth = rest.pop()
        if isinstance(at, (dict, list)):
            deepest = max(deepest, depth)
            rest += [(x, depth + 1) for x in (at.values() if isinstance(at, dict) else at)]
    return deepest


def _arguments(text: str | None) -> tuple[object, str, list[str]]:
    """The value, its canonical JSON and what is wrong with a call's arguments.

    Text that is no JSON, that escapes half a surrogate pair, which no Unicode text can hold,
    or that is nested deeper than DEPTH stays text.
    """
    if text is None:
        return None, "null", [".: missing"]
    try:
        value = json.loads(text)
        if _depth(value) > DEPTH:
            return text, canonical(text), [".: too deep"]
        shown = canonical(value)
        shown.encode()
        return value, shown, []
    except RecursionError:
        return text, canonical(text), [".: too deep"]
    except ValueError:
        return text, canonical(text), [".: no JSON"]


def _checked(row: dict, schemas: dict[str, dict]) -> dict:
    arguments, shown, found = _arguments(row["arguments"])
    if row["name"] not in schemas:
        found = ["unknown tool", *found]
    elif not found:
        found = faults(arguments, schemas[row["name"]])
    status = (
        "repeated" if row["copy"]
        else "circular" if row["level"] is None
        else "invalid" if found
        else "unanswered" if row["result_turn"] is None
        else "ok"
    )
    after = canonical(sorted({x for x in row["after"] if x is not None}))
    rest = canonical({"id": row["id"], "name": row["name"], "result": row["content"]})
    message = f'{{"after":{after},"arguments":{shown},{rest[1:]}'
    return {k: row[k] for k in ("conv", "turn", "position", "id", "name", "level", "result_turn", "results")} | {
        "status": status, "faults": found, "message": message,
    }
