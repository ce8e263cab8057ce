"""Tool-call linking: calls and results joined by identifier, ordered by dependency, validated, and written as canonical JSON.

Every step works on call rows; no conversation is gathered in one place. Joins on a conversation alone, or on a call that
others depend on, cut keys with very many rows. A conversation whose calls depend on earlier ones only is in order as it is. The others are ordered
level by level: a call gets its level when all it depends on have one.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.operators.stages import discard, materialize, skew_join

_TYPES = {
    "string": str,
    "integer": int,
    "number": (int, float),
    "boolean": bool,
    "object": dict,
    "array": list,
    "null": type(None),
}


_CHECKED = {"type", "enum", "required", "properties", "additionalProperties", "items", "minimum"}
# Keywords that describe and refuse nothing.
_NOTES = {"title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "$schema", "$comment"}


def check_schema(schema, at: str = "$") -> None:
    """ValueError for a schema that ``violations`` does not check in full."""
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: a schema must be an object")
    if unknown := sorted(set(schema) - _CHECKED - _NOTES):
        raise ValueError(f"{at}: keywords not supported: {', '.join(unknown)}")
    if unknown := [k for k in _kinds(schema) if k not in _TYPES]:
        raise ValueError(f"{at}: types not supported: {unknown}")
    for name, inner in schema.get("properties", {}).items():
        check_schema(inner, f"{at}.{name}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        check_schema(schema["additionalProperties"], f"{at}.*")
    if "items" in schema:
        check_schema(schema["items"], f"{at}[]")


def _kinds(schema: dict) -> list[str]:
    kind = schema.get("type", [])
    return kind if isinstance(kind, list) else [kind]


def _fits(value, kind: str) -> bool:
    return isinstance(value, _TYPES[kind]) and (kind == "boolean" or not isinstance(value, bool))


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Where a value breaks a JSON schema of type, enum, required, properties, additionalProperties, items and minimum.

    Values come from ``parse``: 1.0 and 1e0 are the integer 1, and true is no number.
    """
    if "type" in schema:
        kinds = _kinds(schema)
        if not any(_fits(value, kind) for kind in kinds):
            return [f"{at}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and canonical(value) not in {canonical(parse(json.dumps(item))) for item in schema["enum"]}:
        found.append(f"{at}: not in enum")
    if "minimum" in schema and _fits(value, "number") and value < schema["minimum"]:
        found.append(f"{at}: below minimum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{name}: missing" for name in sorted(schema.get("required", [])) if name not in value]
        for name in sorted(value):
            if name in known:
                found += violations(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{name}: unknown")
            elif isinstance(schema.get("additionalProperties"), dict):
                found += violations(value[name], schema["additionalProperties"], f"{at}.{name}")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += violations(item, schema["items"], f"{at}[{i}]")
    return found


_LONE = re.compile("[\ud800-\udfff]")


def _writable(text: str) -> str:
    """Halves of surrogate pairs, which no UTF-8 text can hold, as JSON escapes."""
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    """JSON with sorted keys, no spaces, and characters as they are, but for lone surrogates, which are escaped."""
    return _writable(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def _number(text: str) -> int | float:
    """A number with a fraction or an exponent: equal numbers get one form. What exceeds a double is refused."""
    value = float(text)
    if math.isinf(value):
        raise ValueError("number out of range")
    return int(value) if value.is_integer() and abs(value) < 1 << 53 else value


def _whole(text: str) -> int:
    """An integer of any length as written, -0 as 0; thousands of digits are refused."""
    if len(text) > 1_000:
        raise ValueError("number out of range")
    return int(text)


def parse(text: str):
    """The value of a JSON text. ValueError for NaN, infinities and numbers out of range, RecursionError for deep nesting."""
    return json.loads(text, parse_constant=_no_constant, parse_float=_number, parse_int=_whole)


def _no_constant(name: str):
    raise ValueError(name)


def _serialise(batches: Iterator[pa.RecordBatch], schemas: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        errors, texts = [], []
        columns = {name: batch.column(name).to_pylist() for name in ("call_id", "name", "arguments", "result")}
        for call_id, name, arguments, result in zip(*columns.values()):
            call = {"id": call_id, "name": name, "result": result}
            text = canonical(call)
            try:
                value = parse(arguments or "")
                broken = violations(value, schemas[name]) if name in schemas else ["$: unknown tool"]
                text = canonical(call | {"arguments": value})
            except (ValueError, RecursionError):
                # The call is written without its arguments.
                broken = ["$: not JSON"]
            errors.append(_writable(";".join(broken)))
            texts.append(text)
        kept = [n for n in batch.schema.names if n not in ("name", "arguments", "result")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), pa.array(errors, pa.string()), pa.array(texts, pa.string())],
            [*kept, "errors", "json"],
        )


def dependency_levels(calls: DataFrame, depends: DataFrame) -> DataFrame:
    """(conv, call_id, level) of (conv, call_id, position) calls under (conv, call_id, on) dependencies.

    Level 0 is for conversations that are in order as they stand: order by (level, position) is topological in each
    conversation. Calls on a cycle, or behind one, have a null level. Dependencies on absent calls do not count. The rounds are
    as many as the longest chain among conversations that are out of order.
    """
    places = calls.select("conv", F.col("call_id").alias("on"), F.col("position").alias("_at"))
    placed = depends.join(calls.select("conv", "call_id", "position"), ["conv", "call_id"])
    edges = materialize(
        skew_join(placed, places, ["conv", "on"], "inner", spread_by="call_id")
        .select("conv", "call_id", "on", (F.col("_at") >= F.col("position")).alias("_late"))
        .distinct()
    )
    tangled = edges.filter("_late").select("conv").distinct()
    tangled = materialize(tangled)
    todo = materialize(skew_join(calls, tangled, ["conv"], "left_semi", spread_by="call_id").select("conv", "call_id"))
    edges_todo = skew_join(edges, tangled, ["conv"], "left_semi", spread_by="call_id").select("conv", "call_id", "on")
    level, done = 0, []
    while not todo.isEmpty():
        open_calls = todo.select("conv", F.col("call_id").alias("on"))
        waiting = skew_join(edges_todo, open_calls, ["conv", "on"], "left_semi", spread_by="call_id")
        blocked = waiting.select("conv", "call_id").distinct()
        free = materialize(todo.join(blocked, ["conv", "call_id"], "left_anti").withColumn("level", F.lit(level)))
        if free.isEmpty():
            done.append(todo.withColumn("level", F.lit(None).cast("int")))
            break
        done.append(free)
        left = materialize(todo.join(free.select("conv", "call_id"), ["conv", "call_id"], "left_anti"))
        discard(todo)
        todo, level = left, level + 1
    plain = skew_join(calls, tangled, ["conv"], "left_anti", spread_by="call_id")
    plain = plain.select("conv", "call_id", F.lit(0).alias("level"))
    for levels in done:
        plain = plain.unionByName(levels)
    return plain


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], *, orphans: bool = False) -> DataFrame:
    """(conv, call_id, position, level, copies, status, errors, json): one row per distinct call identifier of a conversation.

    ``calls``: conv, call_id, position, name, arguments (JSON text), depends_on (array of call ids). ``results``: conv, call_id,
    content. Of calls that share an identifier the first by position counts, ``copies`` says how many there are; of several
    results the least text counts. Calls without conversation or identifier are kept, never linked and have status
    "unlinked". With ``orphans``, so have results without them, and a result whose call is absent is a row with status "no_call"
    and no copies (of several under one identifier the least text counts); else such results are dropped. Schemas with keywords that are not checked are refused. The first status that applies: "cycle", "invalid" (not JSON, unknown tool or
    schema broken, listed in ``errors``; ``json`` then lacks what is not JSON), "no_result", "ambiguous" (several results), "ok". Extra columns are ignored.
    """
    for schema in schemas.values():
        check_schema(schema)
    named = F.col("conv").isNotNull() & F.col("call_id").isNotNull()
    fields = ["position", "name", "arguments", "depends_on"]
    keyed = calls.filter(named).groupBy("conv", "call_id").agg(
        F.min(F.struct(F.col("position").isNull().alias("_n"), *fields)).alias("_c"), F.count(F.lit(1)).alias("copies")
    )
    keyed = materialize(keyed.select("conv", "call_id", "copies", *[F.col(f"_c.{f}").alias(f) for f in fields]))
    found = results.filter(named).groupBy("conv", "call_id").agg(
        F.min("content").alias("result"), F.count(F.lit(1)).alias("_results")
    )
    depends = keyed.select("conv", "call_id", F.explode("depends_on").alias("on")).filter(F.col("on").isNotNull())
    levels = dependency_levels(keyed.select("conv", "call_id", "position"), depends)
    linked = keyed.join(found, ["conv", "call_id"], "full_outer").join(levels, ["conv", "call_id"], "left")
    absent = F.col("copies").isNull()
    linked = linked.withColumns(
        {"_results": F.when(absent, -2).otherwise(F.col("_results")).cast("long"), "copies": F.coalesce("copies", F.lit(0).cast("long"))}
    )
    columns = ["conv", "call_id", "position", "level", "copies", "_results", "name", "arguments", "result"]
    lost = calls.filter(~named).select(
        "conv", "call_id", "position", F.lit(None).cast("int").alias("level"), F.lit(1).cast("long").alias("copies"),
        F.lit(-1).cast("long").alias("_results"), "name", "arguments", F.lit(None).cast("string").alias("result"),
    )
    stray = results.filter(~named).select("conv", "call_id", F.lit(0).cast("long").alias("copies"), F.lit(-3).cast("long").alias("_results"), F.col("content").alias("result"))
    missing = {c: F.lit(None).cast(linked.schema[c].dataType) for c in ("position", "level", "name", "arguments")}
    rows = linked.select(*columns).unionByName(lost).unionByName(stray.withColumns(missing).select(*columns))
    if not orphans:
        rows = rows.filter(F.col("_results").isNull() | (F.col("_results") >= -1))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-3]) + ", errors string, json string"
    written = rows.mapInArrow(partial(_serialise, schemas=schemas), schema)
    status = (
        F.when(F.col("_results").isin(-1, -3), "unlinked")
        .when(F.col("_results") == -2, "no_call")
        .when(F.col("level").isNull(), "cycle")
        .when(F.col("errors") != "", "invalid")
        .when(F.col("_results").isNull(), "no_result")
        .when(F.col("_results") > 1, "ambiguous")
        .otherwise("ok")
    )
    # Results without a call have no arguments to check.
    errors = F.when(F.col("_results") < -1, "").otherwise(F.col("errors"))
    return written.select("conv", "call_id", "position", "level", "copies", status.alias("status"), errors.alias("errors"), "json")
