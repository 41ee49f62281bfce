"""JSON schemas of tools as column expressions (PRD-13, DM-6, HP-13).

A schema is compiled once, on the driver, to a condition over a VARIANT; a row
costs one expression whatever the schema's size, and no join with a table of
tools.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .canon import json_string

#: Types of schema_of_variant for a schema's type.  Whole numbers beyond 64 bits are decimals of 19 and more digits without a fraction.
TYPES = {
    "string": "STRING", "integer": r"BIGINT|DECIMAL\((19|[23]\d),0\)", "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL\(.*", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*",
}


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def keys(value: Column) -> Column:
    """The names of an object's fields; null for anything else."""
    return F.when(F.schema_of_variant(value).startswith("OBJECT"), F.map_keys(value.cast("map<string,variant>")))


def matches(value: Column, schema: Any, deep: bool = False) -> Column:
    """Whether ``value`` (a variant) is of the schema's type and among a string's choices; truth values aren't numbers, and what no type is known for matches nothing.

    ``deep`` looks into the items and properties that an array's or an object's
    schema declares as well.
    """
    kind = schema.get("type") if isinstance(schema, dict) else None
    if kind not in TYPES:
        return F.lit(False)
    conditions = [F.schema_of_variant(value).rlike(f"^({TYPES[kind]})\\z")]
    if kind == "string" and isinstance(schema.get("enum"), list):
        conditions.append(F.try_variant_get(value, "$", "string").isin([x for x in schema["enum"] if isinstance(x, str)]))
    if deep and kind == "array" and "items" in schema:
        conditions.append(F.forall(F.try_variant_get(value, "$", "array<variant>"), lambda v: matches(v, schema["items"], deep)))
    if deep and kind == "object" and "properties" in schema:
        conditions.append(valid_arguments(value, schema, deep))
    return F.coalesce(_all(conditions), F.lit(False))


def valid_arguments(value: Column, schema: Any, deep: bool = False) -> Column:
    """PRD-13: whether ``value`` is an object with the required fields, declared ones alone, each of its type; a schema that isn't one of an object with properties fits nothing."""
    properties, required = schema.get("properties"), schema.get("required", [])
    if schema.get("type") != "object" or not isinstance(properties, dict) or not isinstance(required, list) or not all(isinstance(r, str) for r in required):
        return F.lit(False)

    def sound(held: Column) -> Column:
        has = lambda name: F.map_contains_key(held, name)
        known = F.forall(F.map_keys(held), lambda k: k.isin(list(properties))) if properties else F.size(held) == 0
        fits = [~has(name) | matches(F.try_element_at(held, F.lit(name)), s, deep) for name, s in properties.items()]
        return F.coalesce(_all([held.isNotNull(), *[has(r) for r in required], known, *fits]), F.lit(False))

    return F.transform(F.array(F.try_variant_get(value, "$", "map<string,variant>")), sound)[0]


def call_error(tool: Column, arguments: Column, tools: dict[str, dict], deep: bool = False) -> Column:
    """The error of a call with ``arguments`` (a variant): unknown_tool, invalid_tool_arguments, or null; ``tools``: name to input schema."""
    if not tools:
        return F.lit("unknown_tool")
    wrong = F.lit("unknown_tool")
    for name, schema in tools.items():
        wrong = F.when(tool == name, F.when(~valid_arguments(arguments, schema, deep), "invalid_tool_arguments")).otherwise(wrong)
    return wrong


def definition(name: str, description: str, inputs: dict[str, Any], outputs: dict[str, Any]) -> dict[str, Any]:
    """DM-6: a public tool; all inputs are required."""
    given = {"type": "object", "properties": inputs} | ({"required": list(inputs)} if inputs else {})
    return {"name": name, "description": description, "input_schema": given, "output_schema": {"type": "object", "properties": outputs}}


def tools_json(names: Column, tools: dict[str, str]) -> Column:
    """The JSON array of the tools in ``names`` (an array), in that order; ``tools``: name to JSON text."""
    table = F.create_map(*[F.lit(x) for pair in tools.items() for x in pair])
    return F.concat(F.lit("["), F.array_join(F.transform(names, lambda n: F.coalesce(table[n], F.concat(F.lit('{"name":'), json_string(n), F.lit("}")))), ","), F.lit("]"))
