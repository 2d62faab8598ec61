"""Chat formatting: tool calls linked to their results, ordered, validated and serialised.

Calls and results meet in a hash join on conversation and call identifier.
Calls may refer to results of other calls; levels of the reference graph are
peeled off in rounds over its edges only, and ``(level, call_turn, call_id)``
is a topological order within a conversation.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.llm.common import keep

REPLY = "reply"  # the tool that an assistant's plain answer to a user's turn stands for
SCHEMAS = {
    REPLY: {
        "type": "object",
        "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
        "required": ["text", "turn"],
        "additionalProperties": False,
    }
}

KEY = ["conv_id", "call_id"]


def calls_and_results(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls ``conv_id, call_id, turn, name, arguments`` and results ``conv_id, call_id, turn, content``.

    An assistant's text that is a JSON object with ``tool_calls`` (``id``,
    ``name``, ``arguments``) holds calls; a tool's text with ``tool_call_id``
    and ``content`` is a result. Every user turn is also a call of ``reply``,
    and an assistant's plain text one turn later its result. Rows without
    conversation or turn have no place in a conversation and are left out.
    """
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    call = "struct<tool_calls:array<struct<id:string,name:string,arguments:string>>>"
    looks = F.ltrim("text").startswith("{")
    made = F.when(looks & (F.col("role") == "assistant"), F.from_json("text", call)["tool_calls"])
    answer = F.when(looks & (F.col("role") == "tool"), F.from_json("text", "struct<tool_call_id:string,content:string>"))
    rows = rows.withColumn("_made", made).withColumn("_answer", answer)
    explicit = rows.select("conv_id", "turn", F.explode("_made").alias("c")).select(
        "conv_id", F.coalesce("c.id", F.lit("")).alias("call_id"), "turn", F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments")
    )
    asked = rows.where(F.col("role") == "user").select(
        "conv_id", F.concat(F.lit("turn-"), "turn").alias("call_id"), "turn", F.lit(REPLY).alias("name"),
        F.to_json(F.struct("text", "turn")).alias("arguments"),
    )
    given = rows.where(F.col("_answer").isNotNull()).select(
        "conv_id", F.coalesce("_answer.tool_call_id", F.lit("")).alias("call_id"), "turn", F.coalesce("_answer.content", F.lit("")).alias("content")
    )
    plain = rows.where((F.col("role") == "assistant") & F.col("_made").isNull()).select(
        "conv_id", F.concat(F.lit("turn-"), F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return explicit.unionAll(asked), given.unionAll(plain)


def _levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of calls that refer to other calls; level null on or behind a cycle."""
    refs = F.regexp_extract_all("arguments", F.lit('"\\$result"\\s*:\\s*"([^"]*)"'))
    edges = calls.where(F.col("arguments").contains("$result")).select("conv_id", F.explode(refs).alias("src"), F.col("call_id").alias("dst"))
    known = calls.select("conv_id", F.col("call_id").alias("src"))
    left = keep(edges.join(known, ["conv_id", "src"], "left_semi").distinct(), "refs")
    done, level = None, 0
    every = left.select("conv_id", F.col("dst").alias("call_id")).distinct()
    while not left.isEmpty():
        targets = left.select("conv_id", F.col("dst").alias("src")).distinct()
        level += 1
        rest = keep(left.join(targets, ["conv_id", "src"], "left_semi"), "refs")
        freed = left.select("conv_id", "dst").distinct().join(rest.select("conv_id", "dst").distinct(), ["conv_id", "dst"], "left_anti")
        freed = keep(freed.select("conv_id", F.col("dst").alias("call_id"), F.lit(level).alias("level")), "levels")
        if freed.isEmpty():
            break
        done, left = freed if done is None else done.unionAll(freed), rest
    if done is None:
        return every.withColumn("level", F.lit(None).cast("int"))
    return every.join(done, KEY, "left")


def canonical(value) -> str:
    """JSON with keys in UTF-16 order, no spaces, shortest numbers; not-a-number and infinities are errors."""
    if isinstance(value, Mapping):
        items = sorted(value.items(), key=lambda kv: kv[0].encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(v)}" for k, v in items) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("no JSON number")
        text = repr(value)
        if value == 0:
            return "0"
        if 1e-6 <= abs(value) < 1e21:
            return format(Decimal(text), "f").removesuffix(".0")
        head, exponent = text.split("e")
        return f"{head.removesuffix('.0')}e{int(exponent):+d}"
    return json.dumps(value, ensure_ascii=False)


_TYPES = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool) and math.isfinite(v) and v == int(v),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
}


def violations(value, schema: Mapping, path: str = "$") -> list[str]:
    """Where a value breaks a JSON schema: type, enum, ranges, lengths, required and further properties, items.

    A reference to another call's result stands for any value.
    """
    if isinstance(value, dict) and set(value) == {"$result"}:
        return []
    out = []
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[k](value) for k in kinds):
        return [f"{path}: type"]
    if "enum" in schema and not any(canonical(value) == canonical(e) for e in schema["enum"]):
        out.append(f"{path}: enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            out.append(f"{path}: range")
    if isinstance(value, (str, list)):
        low, high = ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
        if not schema.get(low, 0) <= len(value) <= schema.get(high, math.inf):
            out.append(f"{path}: length")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            out += violations(item, schema["items"], f"{path}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{path}.{k}: unknown")
            elif isinstance(schema.get("additionalProperties"), Mapping):
                out += violations(value[k], schema["additionalProperties"], f"{path}.{k}")
    return out


def _value(text: str | None):
    """A JSON value; text that is none is a string."""
    try:
        found = json.loads(text if text is not None else "null")
        canonical(found)
        return found
    except (ValueError, RecursionError):
        return text


def format_call(row: Mapping, schemas: Mapping[str, Mapping]) -> tuple[str, list[str], str]:
    """Status, violations and canonical JSON of a linked row."""
    arguments, errors = _value(row["arguments"]), []
    if row["n_calls"]:
        schema = schemas.get(row["name"])
        errors = ["$: no such tool"] if schema is None else violations(arguments, schema)
    if not row["n_calls"]:
        status = "no_call"
    elif row["cyclic"]:
        status = "cycle"
    elif errors:
        status = "invalid"
    elif not row["n_results"]:
        status = "no_result"
    elif row["result_turn"] < row["call_turn"]:
        status = "early_result"
    else:
        status = "ok"
    out = {"call_id": row["call_id"], "status": status}
    if row["n_calls"]:
        out |= {"name": row["name"], "arguments": arguments}
    if row["n_results"]:
        out["result"] = _value(row["content"])
    return status, errors, canonical(out)


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping] = SCHEMAS) -> DataFrame:
    """One row per call identifier: ``name, call_turn, result_turn, level, n_calls, n_results, status, errors, json``.

    Where an identifier repeats, the first call and the first result (by turn,
    then content) count, and ``n_calls`` and ``n_results`` tell how many there were: repeated
    rows are added up before the join and never paired. A result without a call has status ``no_call``; otherwise, in this
    order: ``cycle``, ``invalid``, ``no_result``, ``early_result``, ``ok``. Null arguments are JSON null. Empty tables give
    an empty result; other columns are not looked at.
    """
    text = F.coalesce("arguments", F.lit("null"))
    first = F.struct("turn", F.coalesce("name", F.lit("")).alias("name"), text.alias("arguments"))
    one_call = calls.groupBy(*KEY).agg(F.min(first).alias("c"), F.count("*").alias("n_calls"))
    one_call = one_call.select(*KEY, F.col("c.turn").alias("call_turn"), "c.name", "c.arguments", "n_calls")
    one_result = results.groupBy(*KEY).agg(F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results"))
    one_result = one_result.select(*KEY, F.col("r.turn").alias("result_turn"), "r.content", "n_results")
    levels = _levels(one_call).withColumn("_ref", F.lit(True))
    joined = one_call.join(one_result, KEY, "full_outer").join(levels, KEY, "left")
    joined = joined.withColumn("cyclic", F.coalesce(F.col("_ref") & F.col("level").isNull(), F.lit(False))).drop("_ref")
    joined = joined.withColumn("level", F.when(~F.col("cyclic"), F.coalesce("level", F.lit(0))))
    joined = joined.fillna(0, ["n_calls", "n_results"])
    kept = [*KEY, "name", "call_turn", "result_turn", "level", "n_calls", "n_results"]
    rows = joined.select(*kept, "arguments", "content", "cyclic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [format_call(r, schemas) for r in batch.to_pylist()]
            added = [pa.array([d[0] for d in done], pa.string()), pa.array(["; ".join(d[1]) for d in done], pa.string()), pa.array([d[2] for d in done], pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in kept), *added], names=[*kept, "status", "errors", "json"])

    fields = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept)
    return rows.mapInArrow(run, f"{fields}, status string, errors string, json string")
