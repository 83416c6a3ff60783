"""Chat formatting: tool calls joined with their results, in order, as JSON.

Calls and results are hash-joined by conversation and identifier. A call may
name one earlier call that it follows; these links are ordered topologically
by pointer doubling, so a conversation of any length takes a logarithmic
number of joins on call identifiers and never has to meet in one task.
Arguments are validated against the tool's schema, and each linked call is
serialised as canonical JSON (sorted keys, no spaces).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from outletlab.session import cut_lineage

KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def schema_errors(value: object, schema: dict, at: str = "$") -> list[str]:
    """Violations of the schema: type, enum, minLength, minimum, required,
    properties, additionalProperties and items, depth first."""
    kinds = schema.get("type")
    if kinds:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        ok = any(isinstance(value, KINDS[k]) and not (isinstance(value, bool) and k in ("integer", "number")) for k in kinds)
        if not ok:
            return [f"{at}: not of type {'/'.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not one of the allowed values")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        out.append(f"{at}: shorter than {schema['minLength']}")
    if isinstance(value, (int, float)) and not isinstance(value, bool) and value < schema.get("minimum", value):
        out.append(f"{at}: less than {schema['minimum']}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}: lacks {k}" for k in sorted(schema.get("required", [])) if k not in value]
        for k in sorted(value):
            if k in known:
                out += schema_errors(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}: unknown {k}")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += schema_errors(x, schema["items"], f"{at}[{i}]")
    return out


def call_positions(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, position) of calls (conv_id, call_id, parent_id):
    the number of calls on the way to the first; null on or behind a cycle.

    A parent that isn't a call counts as none. Each round joins every call
    with the one its pointer has reached, which doubles the distance covered;
    after as many rounds as the count of calls has bits, only cycles are left.
    """
    known = calls.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("found"))
    state = (calls.join(known, ["conv_id", "parent_id"], "left")
             .select("conv_id", "call_id", F.when(F.col("found"), F.col("parent_id")).alias("up"),
                     F.when(F.col("found"), 1).otherwise(0).cast("long").alias("position")))
    state = cut_lineage(state, "call_links")
    for _ in range(state.count().bit_length() + 1):
        if state.filter("up IS NOT NULL").isEmpty():
            break
        over = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("position").alias("more"))
        # a call may be the parent of any number of others: only the pointing side repeats
        state = cut_lineage(state.join(over, ["conv_id", "up"], "left").select(
            "conv_id", "call_id", F.col("up2").alias("up"),
            (F.col("position") + F.coalesce("more", F.lit(0))).alias("position")), "call_links")
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("position")).alias("position"))


def format_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Linked tool calls, one row a call, and one row an orphaned result's id.

    ``calls`` has conv_id, call_id, parent_id, name, arguments (JSON text);
    ``results`` has conv_id, call_id, content. The result has conv_id,
    call_id, position (topological; null on a cycle), name, n_calls, n_results,
    valid, errors (text, empty if valid) and json.

    Rows repeating an identifier are one call or result: the smallest by
    (name, arguments, parent_id), or by content, is used, n_calls and n_results
    count the rows, and rows that differ are an error. A result without a call gives a row with a null name that isn't
    valid; a call without a result is serialised with a null result. Rows
    with a null identifier or conversation are linked with nothing and left
    out, being addressable by nothing. An unknown tool, arguments that aren't
    JSON, and a cycle are errors. Empty tables give no rows; other columns
    are not read.
    """
    keyed = "conv_id IS NOT NULL AND call_id IS NOT NULL"
    one = (calls.filter(keyed).groupBy("conv_id", "call_id")
           .agg(F.min(F.struct("name", "arguments", "parent_id")).alias("c"), F.max(F.struct("name", "arguments", "parent_id")).alias("c2"),
                F.count(F.lit(1)).alias("n_calls"))
           .select("conv_id", "call_id", "c.*", "n_calls", (F.col("c") != F.col("c2")).alias("calls_differ")))
    one = cut_lineage(one, "calls")
    answers = (results.filter(keyed).groupBy("conv_id", "call_id")
               .agg(F.min(F.struct("content")).alias("r"), F.max(F.struct("content")).alias("r2"), F.count(F.lit(1)).alias("n_results"))
               .select("conv_id", "call_id", "r.content", "n_results", (F.col("r") != F.col("r2")).alias("results_differ")))
    linked = (one.withColumn("called", F.lit(True)).join(call_positions(one), ["conv_id", "call_id"], "left")
              .join(answers, ["conv_id", "call_id"], "full"))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = []
            for r in batch.to_pylist():
                errors, arguments = [], None
                if not r["called"]:
                    errors.append("result without a call")
                else:
                    try:
                        arguments = json.loads(r["arguments"] or "")
                    except ValueError:
                        errors.append("arguments are not JSON")
                    else:
                        if r["name"] in schemas:
                            errors += schema_errors(arguments, schemas[r["name"]])
                        else:
                            errors.append("unknown tool")
                    if r["position"] is None:
                        errors.append("cycle of calls")
                errors += [f"{what} of this id differ" for what in ("calls", "results") if r[f"{what}_differ"]]
                record = {"id": r["call_id"], "name": r["name"], "arguments": arguments, "after": r["parent_id"],
                          "position": r["position"], "result": r["content"], "errors": errors}
                out.append({"conv_id": r["conv_id"], "call_id": r["call_id"], "position": r["position"], "name": r["name"],
                            "n_calls": r["n_calls"] or 0, "n_results": r["n_results"] or 0, "valid": not errors, "errors": "; ".join(errors), "json": canonical(record)})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                    batch.schema.field("conv_id"), batch.schema.field("call_id"), ("position", pa.int64()), ("name", pa.string()),
                    ("n_calls", pa.int64()), ("n_results", pa.int64()), ("valid", pa.bool_()), ("errors", pa.string()), ("json", pa.string())]))

    schema = StructType([StructField("conv_id", calls.schema["conv_id"].dataType), StructField("call_id", calls.schema["call_id"].dataType),
                         StructField("position", LongType()), StructField("name", StringType()), StructField("n_calls", LongType()), StructField("n_results", LongType()),
                         StructField("valid", BooleanType()), StructField("errors", StringType()), StructField("json", StringType())])
    return linked.select("conv_id", "call_id", "parent_id", "name", "arguments", "position", "content", "n_calls", "n_results",
                         "calls_differ", "results_differ", F.coalesce("called", F.lit(False)).alias("called")).mapInArrow(batches, schema)


# The schemas of the calls read from plain conversations.
TURN_SCHEMAS = {
    "ask": {"type": "object", "required": ["text", "turn"], "additionalProperties": False,
            "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}},
    "configure": {"type": "object", "required": ["text", "turn"], "additionalProperties": False,
                  "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}},
}


def turn_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain conversations as calls and results: a user's or system's turn is
    a call named after its role, following the call two turns before; an
    assistant's turn is the result of the call one turn before. Other roles
    keep their name and so are reported as unknown tools."""
    ident = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    turn = F.col("turn")
    name = F.when(F.col("role") == "user", "ask").when(F.col("role") == "system", "configure").otherwise(F.col("role"))
    said = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("text"), turn.alias("turn")))
    is_result = F.col("role").eqNullSafe(F.lit("assistant"))
    calls = conversations.filter(~is_result).select("conv_id", ident(turn).alias("call_id"), ident(turn - 2).alias("parent_id"),
                                                    name.alias("name"), said.alias("arguments"))
    results = conversations.filter(is_result).select("conv_id", ident(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results
