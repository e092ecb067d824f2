"""Tool calls linked to their results, ordered, validated and written as canonical JSON.

Calls and results are joined on (conversation, call id). A call's place is the
length of the longest chain of calls it depends on. Calls with one need are
skipped over by pointers that double their reach each round, so a chain of n
calls takes log n joins; calls with several needs are placed round by round, each
a join and an aggregate. A conversation may be of any size. As many rounds are
needed as the longest chain has calls with several needs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarind.llm.workspace import Workspace

_KINDS = {"string": str, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}
#: Keywords of JSON Schema that are checked, and those that only describe.
CHECKED = {
    "type", "enum", "const", "minimum", "maximum", "minLength", "maxLength", "minItems", "maxItems", "required", "properties", "additionalProperties", "items",
}
DESCRIBING = {"title", "description", "default", "examples", "$schema", "$comment"}


def check_schema(schema: dict, at: str = "$") -> None:
    """Raises on keywords and types that :func:`errors_of` would pass over."""
    unknown = set(schema) - CHECKED - DESCRIBING
    if unknown:
        raise ValueError(f"{at}: keywords not supported: {', '.join(sorted(unknown))}")
    kinds = schema.get("type", [])
    for kind in [kinds] if isinstance(kinds, str) else kinds:
        if kind != "integer" and kind not in _KINDS:
            raise ValueError(f"{at}: no type {kind}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"{at}: additionalProperties must be true or false")
    for name, below in schema.get("properties", {}).items():
        check_schema(below, f"{at}.{name}")
    if "items" in schema:
        check_schema(schema["items"], f"{at}[]")


def _is(value, kind: str) -> bool:
    """Whether a value is of a type of JSON Schema; 1.0 is an integer, true is no number."""
    if isinstance(value, bool):
        return kind == "boolean"
    if kind == "integer":
        return isinstance(value, int) or isinstance(value, float) and value.is_integer()
    return isinstance(value, _KINDS[kind])


def _equal(a, b) -> bool:
    """Equality of JSON values: numbers by value, true and 1 apart."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_equal, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_equal(a[k], b[k]) for k in a)
    return a == b


def errors_of(value, schema: dict, at: str = "$") -> list[str]:
    """What in ``value`` breaks ``schema``, by the keywords in ``CHECKED``."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, kind) for kind in kinds):
        return [f"{at}: not of type {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and not any(_equal(value, x) for x in schema["enum"]):
        out.append(f"{at}: not one of the allowed values")
    if "const" in schema and not _equal(value, schema["const"]):
        out.append(f"{at}: not the allowed value")
    if _is(value, "number"):
        if value < schema.get("minimum", value):
            out.append(f"{at}: below {schema['minimum']}")
        if value > schema.get("maximum", value):
            out.append(f"{at}: above {schema['maximum']}")
    for kind, least, most in ((str, "minLength", "maxLength"), (list, "minItems", "maxItems")):
        if isinstance(value, kind) and not schema.get(least, 0) <= len(value) <= schema.get(most, len(value)):
            out.append(f"{at}: length {len(value)} not allowed")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in sorted(schema.get("required", [])) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: not allowed" for k in sorted(value) if k not in known]
        for k in sorted(known):
            if k in value:
                out += errors_of(value[k], known[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += errors_of(x, schema["items"], f"{at}[{i}]")
    return out


def canonical(value) -> str:
    """JSON with sorted keys, without spaces, in plain Unicode."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _no_number(name: str):
    raise ValueError(f"{name} is not JSON")


def parsed(text: str):
    """The value of a JSON text. ValueError for what isn't JSON, for half surrogate
    pairs (no Unicode text can hold them), for numbers beyond the range of doubles
    and for nesting that is too deep to be followed."""
    try:
        value = json.loads(text, parse_constant=_no_number)
        canonical(value).encode()
    except RecursionError as error:
        raise ValueError("nested too deeply") from error
    return value


def _finisher(schemas: dict[str, dict]):
    def none(x):
        return None if x is None or x != x else x

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for call_id, name, arguments, result in zip(f.call_id, f.name, f.arguments, f.result):
                name, found, value = none(name), [], None
                try:
                    value = parsed(none(arguments) or "")
                except ValueError:
                    found = ["$: not JSON"]
                if name not in schemas:
                    found.append(f"no tool {name}")
                elif value is not None or not found:
                    found += errors_of(value, schemas[name])
                shown = value if value is not None else none(arguments)
                out.append((not found, "; ".join(found), canonical({"id": none(call_id), "name": name, "arguments": shown, "result": none(result)})))
            f["valid"], f["errors"], f["json"] = zip(*out) if out else ([], [], [])
            yield f[["conv_id", "call_id", "status", "level", "valid", "errors", "json"]]

    return run


def _meet(left: DataFrame, at: str, right: DataFrame, how: str) -> DataFrame:
    """``left`` with the columns of ``right`` (conv_id, call_id, others) for the call that ``at`` names."""
    right = right.withColumnRenamed("conv_id", "r_conv").withColumnRenamed("call_id", "r_call")
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col(at) == F.col("r_call")), how).drop("r_conv", "r_call")


def _skipped(one: DataFrame, work: Workspace) -> DataFrame:
    """(conv_id, call_id, to, steps, open) of calls (conv_id, call_id, to) with one need:
    the first call down the chain that hasn't one need, and how far it is. Each round
    doubles the distance; ``open`` are calls whose chain has no end, as it holds a cycle."""
    jump = work.keep(one.withColumn("steps", F.lit(1).cast("long")), "jump")
    longest = jump.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    reach = 1
    while True:
        on = jump.select("conv_id", "call_id", F.col("to").alias("on"), F.col("steps").alias("more"))
        both = _meet(jump.select("conv_id", "call_id", "to", "steps"), "to", on, "left")
        jump = work.keep(
            both.select("conv_id", "call_id", F.coalesce("on", "to").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("on").isNotNull().alias("open")), "jump"
        )
        if reach > longest or jump.where("open").isEmpty():
            return jump
        reach *= 2


def levels(calls: DataFrame, work: Workspace) -> DataFrame:
    """(conv_id, call_id, level): 0 for a call that depends on no other (``after``,
    an array of call ids of its conversation), else one more than the highest level
    it depends on. Unknown ids count as done; calls on a cycle, or after one, have no row."""
    ids = calls.select("conv_id", "call_id").distinct()
    needs = calls.select("conv_id", "call_id", F.explode("after").alias("needed")).distinct()
    needs = work.keep(_meet(needs, "needed", ids, "inner"), "needs")
    count = needs.groupBy("conv_id", "call_id").agg(F.count("*").alias("n"), F.min("needed").alias("to"))
    jump = _skipped(count.where("n = 1").select("conv_id", "call_id", "to"), work)
    # The needs of calls with several, each by the end of its chain; a chain without end has none.
    hops = _meet(needs, "call_id", count.where("n > 1").select("conv_id", "call_id"), "left_semi")
    hops = _meet(hops, "needed", jump, "left")
    at = F.when(F.col("to").isNull(), F.col("needed")).when(~F.col("open"), F.col("to"))
    hops = work.keep(hops.select("conv_id", "call_id", at.alias("at"), F.coalesce("steps", F.lit(0).cast("long")).alias("steps")), "hops")
    free = _meet(ids, "call_id", count.select("conv_id", "call_id"), "left_anti")
    done = placed = work.keep(free.withColumn("level", F.lit(0).cast("long")), "level")
    while not placed.isEmpty():
        # Of a call that still waits: how many of its needs are placed, and how high.
        both = _meet(hops, "at", done, "left")
        ready = both.groupBy("conv_id", "call_id").agg(F.count("*").alias("all"), F.count("level").alias("have"), F.max(F.col("level") + F.col("steps")).alias("top")).where("all = have")
        fresh = _meet(ready, "call_id", done.select("conv_id", "call_id"), "left_anti")
        placed = work.keep(fresh.select("conv_id", "call_id", (F.col("top") + 1).alias("level")), "level")
        done = done.unionAll(placed)
    ends = _meet(jump.where("NOT open"), "to", done, "inner")
    return done.unionAll(ends.select("conv_id", "call_id", (F.col("level") + F.col("steps")).alias("level")))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """(conv_id, call_id, status, level, valid, errors, json), a row for each call or result id.

    ``calls``: conv_id, call_id, name, arguments (JSON text), after (ids).
    ``results``: conv_id, call_id, content. ``status`` is ``linked``, ``unanswered``
    (no result) or ``orphan`` (a result without call, not valid, no level). Of
    repeated calls with an id the least (name, arguments) counts, of repeated
    results the least content. Order calls by (level, call_id). Rows without call
    id are left out; a null conversation is one of its own. Empty tables give no rows;
    other columns play no part. Arguments that :func:`parsed` refuses are shown as text
    and not valid; a schema with keywords that aren't checked is refused (ValueError).
    """
    for name, schema in schemas.items():
        check_schema(schema, name)
    work = Workspace(calls.sparkSession, "calls")
    calls = calls.where("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min(F.struct("name", "arguments", "after")).alias("call")).select("conv_id", "call_id", "call.*")
    calls = work.keep(calls, "calls")
    results = results.where("call_id IS NOT NULL").groupBy(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_id")).agg(F.min("content").alias("result"))
    both = calls.join(results, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("call_id") == F.col("r_id")), "full")
    status = F.when(F.col("call_id").isNull(), "orphan").when(F.col("r_id").isNull(), "unanswered").otherwise("linked")
    both = both.select(
        F.when(F.col("call_id").isNull(), F.col("r_conv")).otherwise(F.col("conv_id")).alias("conv_id"), F.coalesce("call_id", "r_id").alias("call_id"),
        status.alias("status"), "name", "arguments", "result",
    )
    level = levels(calls, work).select(F.col("conv_id").alias("l_conv"), F.col("call_id").alias("l_id"), "level")
    both = both.join(level, F.col("conv_id").eqNullSafe(F.col("l_conv")) & (F.col("call_id") == F.col("l_id")), "left").drop("l_conv", "l_id")
    kind = calls.schema["conv_id"].dataType.simpleString()
    both = both.mapInPandas(_finisher(schemas), f"conv_id {kind}, call_id string, status string, level long, valid boolean, errors string, json string")
    return work.only(both, "linked")


SCHEMAS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False,
               "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 9}}},
    "translate": {"type": "object", "required": ["query", "to"], "additionalProperties": False,
                  "properties": {"query": {"type": "string"}, "to": {"type": "string", "enum": ["de", "en", "es", "fr"]}}},
}


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results made of plain turns: a user's turn is a call with the whole
    text as its query, the assistant's next turn its result, and each call depends
    on the one two turns before. ``limit`` follows the length of the text, so some
    calls break their schema."""
    name = lambda turn: F.substring(F.md5(F.concat_ws(":", F.col("conv_id"), turn)), 1, 12)
    n = F.length("text")
    calls = conversations.where("role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id", name(F.col("turn")).alias("call_id"), F.when(n % 3 == 0, "translate").otherwise("search").alias("name"),
        F.when(n % 3 == 0, F.to_json(F.struct(F.col("text").alias("query"), F.lit("en").alias("to")))).otherwise(
            F.to_json(F.struct((n % 11).alias("limit"), F.col("text").alias("query")))).alias("arguments"),
        F.array(name(F.col("turn") - 2)).alias("after"),
    )
    results = conversations.where("role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results
