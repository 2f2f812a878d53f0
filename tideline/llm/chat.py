"""Chat formatting with linked tool calls.

Calls and results of a conversation are linked by a hash join on their
identifier, ordered so that a result never comes before its call, checked
against the schema of the called function, and written as canonical JSON: keys
in code point order, no white space, numbers and texts in their shortest form.

Everything is a DataFrame operation.  No step gathers a conversation: the order
is a sort key, so a conversation of any length is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical(json: Column) -> Column:
    """The canonical form of a JSON text; null if it is not JSON or repeats a key."""
    return F.to_json(F.try_parse_json(json))


def quoted(text: Column) -> Column:
    """A text as a JSON string; null stays null."""
    wrapped = F.to_json(F.struct(text.alias("t")))
    return F.when(text.isNotNull(), F.substring(wrapped, F.lit(6), F.length(wrapped) - 6))


def json_object(fields: Mapping[str, Column]) -> Column:
    """A canonical object of already serialised values; null values are left out."""
    parts = [F.concat(F.lit(f'"{name}":'), fields[name]) for name in sorted(fields)]
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts)), ","), F.lit("}"))


#: JSON type names, and the patterns of the types a parsed value shows.
TYPES = {
    "string": "^STRING$",
    "integer": "^BIGINT$",
    "number": "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$",
    "boolean": "^BOOLEAN$",
    "object": "^OBJECT<.*",
    "array": "^ARRAY<.*",
    "null": "^VOID$",
}


def violations(arguments: Column, schema: Mapping[str, Any]) -> Column:
    """What a JSON text of arguments violates of a schema, in a fixed order; an empty array if nothing.

    The schema has ``properties`` (type, enum, minLength, maxLength, minimum,
    maximum), ``required`` and ``additionalProperties`` (true unless given).
    """
    value = F.try_parse_json(arguments)
    found = [F.when(value.isNull() | ~F.coalesce(F.schema_of_variant(value), F.lit("")).startswith("OBJECT"), F.lit("not an object"))]
    for name, rule in sorted(schema.get("properties", {}).items()):
        path = f"$['{name}']"
        part = F.try_variant_get(value, path, "variant")
        kind = F.schema_of_variant(part)
        if name in schema.get("required", ()):
            found.append(F.when(part.isNull(), F.lit(f"{name}: missing")))
        if "type" in rule:
            found.append(F.when(~kind.rlike(TYPES[rule["type"]]), F.lit(f"{name}: not {rule['type']}")))
        text, number = F.try_variant_get(value, path, "string"), F.try_variant_get(value, path, "double")
        if "enum" in rule:
            found.append(F.when(~text.isin([str(v) for v in rule["enum"]]), F.lit(f"{name}: not listed")))
        is_text = kind == "STRING"
        if "minLength" in rule:
            found.append(F.when(is_text & (F.length(text) < rule["minLength"]), F.lit(f"{name}: too short")))
        if "maxLength" in rule:
            found.append(F.when(is_text & (F.length(text) > rule["maxLength"]), F.lit(f"{name}: too long")))
        if "minimum" in rule:
            found.append(F.when(~is_text & (number < rule["minimum"]), F.lit(f"{name}: too small")))
        if "maximum" in rule:
            found.append(F.when(~is_text & (number > rule["maximum"]), F.lit(f"{name}: too large")))
    if not schema.get("additionalProperties", True):
        extra = F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(n) for n in schema.get("properties", {})]))
        found.append(F.when(F.size(extra) > 0, F.concat(F.lit("unknown: "), F.array_join(F.array_sort(extra), ","))))
    return F.array_compact(F.array(*found))


def check(calls: DataFrame, schemas: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Add ``violations`` to calls (name, arguments); an unknown function is a violation."""
    out = F.array(F.lit("unknown function"))
    for name, schema in schemas.items():
        out = F.when(F.col("name") == name, violations(F.col("arguments"), schema)).otherwise(out)
    return calls.withColumn("violations", out)


def link(calls: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Link calls and results, both with conv_id, call_id and turn, by conversation and identifier.

    A call is ``linked``, ``unanswered``, or ``repeated`` if its identifier
    belongs to several calls.  A result is ``linked``, ``orphan`` (no call), or
    ``repeated`` if several results share its identifier.  Null identifiers
    link to nothing.  ``place`` orders a conversation topologically: a call
    keeps its turn, a result comes after its turn and after its call's.
    """
    key = ["conv_id", "call_id"]
    # One row per identifier on the other side, so a repeated identifier multiplies nothing.
    called = calls.groupBy(*key).agg(F.count(F.lit(1)).alias("__calls"), F.max("turn").alias("__call_turn"))
    answered = results.groupBy(*key).agg(F.count(F.lit(1)).alias("__results"))
    ids = called.join(answered, key, "left")
    calls_out = calls.join(ids, key, "left").withColumns(
        {
            "status": F.when(F.col("__calls") > 1, "repeated").when(F.col("__results") > 0, "linked").otherwise("unanswered"),
            "place": F.col("turn") * 2,
        }
    )
    both = answered.join(called, key, "left")
    results_out = results.join(both, key, "left").withColumns(
        {
            "status": F.when(F.col("__call_turn").isNull(), "orphan").when(F.col("__results") > 1, "repeated").otherwise("linked"),
            "place": F.greatest(F.col("turn"), F.coalesce("__call_turn", "turn")) * 2 + 1,
        }
    )
    spare = ["__calls", "__results", "__call_turn"]
    return calls_out.drop(*spare), results_out.drop(*spare)


def turns_as_calls(messages: DataFrame, function: str = "respond") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split (conv_id, turn, role, text) into calls, results and other messages.

    Every user turn calls ``function`` with its text and turn; an assistant
    turn is the result of the call made one turn before it.  The identifier is
    made of the conversation and the calling turn.
    """
    rows = messages.select("conv_id", "turn", "role", "text")

    def identifier(turn: Column) -> Column:
        return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), turn.cast("string"))

    calls = rows.where(F.col("role") == "user").select(
        "conv_id", "turn", "role", identifier(F.col("turn")).alias("call_id"), F.lit(function).alias("name"),
        F.to_json(F.struct("text", "turn")).alias("arguments"),
    )
    results = rows.where(F.col("role") == "assistant").select(
        "conv_id", "turn", "role", identifier(F.col("turn") - 1).alias("call_id"), "text"
    )
    others = rows.where(~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False)))
    return calls, results, others


def format_chat(messages: DataFrame, schemas: Mapping[str, Mapping[str, Any]], function: str = "respond") -> DataFrame:
    """One canonical JSON line per message, with its place in the conversation.

    Every row is kept, repeated rows too.  Returns conv_id, turn, kind (call,
    result, message), call_id, status, violations (joined by ``; ``), place and
    json.  A null role is a message of no role; a null text is left out of the
    JSON; a result without its call is formatted as a plain message.  Rows
    without a conversation or turn have no identifier and no link.  Other
    columns of the input are ignored.
    """
    calls, results, others = turns_as_calls(messages, function)
    linked, answers = link(check(calls, schemas), results)
    turn = F.col("turn").cast("string")
    call_json = json_object(
        {
            "role": quoted(F.col("role")),
            "tool_call": json_object(
                {"arguments": canonical(F.col("arguments")), "id": quoted(F.col("call_id")), "name": quoted(F.col("name"))}
            ),
            "turn": turn,
        }
    )
    plain = {"content": quoted(F.col("text")), "role": quoted(F.col("role")), "turn": turn}
    answer_json = json_object(plain | {"tool_call_id": F.when(F.col("status") != "orphan", quoted(F.col("call_id")))})

    def shaped(df: DataFrame, kind: str, call_id: Column, status: Column, faults: Column, place: Column, json: Column) -> DataFrame:
        return df.select(
            "conv_id", "turn", F.lit(kind).alias("kind"), call_id.alias("call_id"), status.alias("status"),
            faults.alias("violations"), place.alias("place"), json.alias("json"),
        )

    none = F.lit(None).cast("string")
    return (
        shaped(linked, "call", F.col("call_id"), F.col("status"), F.array_join("violations", "; "), F.col("place"), call_json)
        .unionByName(shaped(answers, "result", F.col("call_id"), F.col("status"), none, F.col("place"), answer_json))
        .unionByName(shaped(others, "message", none, none, none, F.col("turn") * 2, json_object(plain)))
    )
