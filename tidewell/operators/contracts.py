"""A JSON-Schema subset compiled once into Column expressions over a VARIANT: the first violation's path, or null.

Keywords, in order: $ref and oneOf (siblings ignored), type, const, enum, minLength, minimum, format date-time, required,
properties, additionalProperties false beside properties, minItems, uniqueItems, items, allOf, if/then, anyOf.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .mapping import OFFSET_TIME

_KINDS = {"object": "OBJECT", "array": "ARRAY", "string": "STRING", "boolean": "BOOLEAN", "integer": r"BIGINT|DECIMAL\(\d+,0\)", "number": "BIGINT|DECIMAL.*|DOUBLE|FLOAT", "null": "VOID"}
#: How often a document may go through one reference that leads back to itself: Spark's time to analyse nested lambdas more than doubles with each.
MOST_DEPTH = 4


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value computed once however often f uses it: a lambda's variable, unlike a column's expression, is never copied to its places of use."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _get(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _equals(v: Column, value) -> Column:
    """Whether v is the given JSON value: numbers by value, objects whatever the order of their keys."""
    if isinstance(value, int | float) and not isinstance(value, bool):
        same = F.coalesce(_get(v, "decimal(38,10)") == F.lit(str(value)).try_cast("decimal(38,10)"), _get(v, "double") == float(value))
        return F.coalesce(F.schema_of_variant(v).rlike(f"^({_KINDS['number']})$") & same, F.lit(False))
    return F.coalesce(F.to_json(v) == F.to_json(F.parse_json(F.lit(json.dumps(value, ensure_ascii=False)))), F.lit(False))


def _joined(at: str | Column, more: str) -> str | Column:
    return at + more if isinstance(at, str) else F.concat(at, F.lit(more))


def _resolved(reference: str, root: dict) -> dict | None:
    target = root
    for part in reference.removeprefix("#/").split("/"):
        part = part.replace("~1", "/").replace("~0", "~")
        if not isinstance(target, dict) or part not in target:
            return None
        target = target[part]
    return target


def violation(v: Column, schema: dict, root: dict | None = None, at: str | Column = "$", through: tuple[str, ...] = ()) -> Column:
    """The path of the first violation of a present value v, in the order of the keywords above; null if it is valid.

    Each value is bound once, with its fields, its items or its kind, so that the expression grows with the schema and
    not with its depth. A reference that leads back to itself is followed MOST_DEPTH times; a document that goes deeper
    is no valid one there (ING_CONTRACT_DEPTH_EXCEEDED).
    """
    root = schema if root is None else root
    if "$ref" in schema:
        target = _resolved(schema["$ref"], root)
        if target is None:
            return F.lit("ING_CONTRACT_REF_UNAVAILABLE")
        if through.count(schema["$ref"]) >= MOST_DEPTH:
            return F.lit("ING_CONTRACT_DEPTH_EXCEEDED")
        return violation(v, target, root, at, (*through, schema["$ref"]))
    if "oneOf" in schema:
        hits = lambda x: reduce(lambda a, b: a + b, [violation(x, s, root, at, through).isNull().cast("int") for s in schema["oneOf"]])
        return bound(v, lambda x: F.when(hits(x) != 1, at))
    # an object has fields, an array has items; only of what is neither the kind is asked, which costs a walk through it
    parts = F.struct(v.alias("v"), _get(v, "map<string,variant>").alias("fields"), _get(v, "array<variant>").alias("items"))

    def told(x: Column) -> Column:
        kind = F.when(x["fields"].isNotNull(), "OBJECT").when(x["items"].isNotNull(), "ARRAY").otherwise(F.schema_of_variant(x["v"]))
        return bound(kind, lambda k: _first(x["v"], x["fields"], x["items"], k, schema, root, at, through))

    return bound(parts, told)


def _first(v: Column, fields: Column, items: Column, kind: Column, schema: dict, root: dict, at: str | Column, through: tuple[str, ...]) -> Column:
    here = lambda bad: F.when(bad, at)
    sub = lambda x, s, where=at: violation(x, s, root, where, through)
    number = lambda: kind.rlike(f"^({_KINDS['number']})$")
    found: list[Column] = []
    if "type" in schema:
        names = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        found.append(here(~kind.rlike("^(" + "|".join(_KINDS.get(n, "(?!)") for n in names) + ")$")))
    if "const" in schema:
        found.append(here(~_equals(v, schema["const"])))
    if "enum" in schema:
        found.append(here(~reduce(lambda a, b: a | b, [_equals(v, x) for x in schema["enum"]], F.lit(False))))
    if "minLength" in schema:
        found.append(here((kind == "STRING") & (F.length(_get(v, "string")) < schema["minLength"])))
    if "minimum" in schema:
        found.append(here(number() & (_get(v, "decimal(38,10)") < schema["minimum"])))
    if schema.get("format") == "date-time":
        late = lambda s: ~s.rlike(OFFSET_TIME) | F.try_to_timestamp(s).isNull()
        found.append(here((kind == "STRING") & bound(_get(v, "string"), late)))
    for name in schema.get("required", []):
        found.append(F.when(~F.map_contains_key(fields, F.lit(name)), _joined(at, f".{name}")))
    for name, part in schema.get("properties", {}).items():
        found.append(F.when(F.map_contains_key(fields, F.lit(name)), sub(F.try_element_at(fields, F.lit(name)), part, _joined(at, f".{name}"))))
    if schema.get("additionalProperties") is False and "properties" in schema:
        extra = F.array_except(F.map_keys(fields), F.array(*map(F.lit, schema["properties"])) if schema["properties"] else F.array().cast("array<string>"))
        found.append(F.concat(F.lit(at) if isinstance(at, str) else at, F.lit("."), F.array_min(extra)))
    if "minItems" in schema:
        found.append(here(F.size(items) < schema["minItems"]))
    if schema.get("uniqueItems"):
        found.append(here(F.size(F.array_distinct(F.transform(items, lambda x: F.to_json(x)))) < F.size(items)))
    if "items" in schema:
        each = lambda x, i: sub(x, schema["items"], F.concat(F.lit(at) if isinstance(at, str) else at, F.lit("["), i.cast("string"), F.lit("]")))
        found.append(F.get(F.filter(F.transform(items, each), lambda p: p.isNotNull()), F.lit(0)))
    for part in schema.get("allOf", []):
        found.append(sub(v, part))
    if "if" in schema and "then" in schema:
        found.append(F.when(sub(v, schema["if"]).isNull(), sub(v, schema["then"])))
    if "anyOf" in schema:
        found.append(here(reduce(lambda a, b: a & b, [sub(v, s).isNotNull() for s in schema["anyOf"]])))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def validate_contract(document: Column, schema: dict | None) -> tuple[Column, Column, Column]:
    """(valid, code, first_path) of a JSON text."""
    if schema is None:
        return F.lit(False), F.lit("ING_CONTRACT_SCHEMA_UNAVAILABLE"), F.lit(None).cast("string")
    path = bound(F.try_parse_json(document), lambda v: F.when(v.isNull(), "$").otherwise(violation(v, schema)))
    codes = ("ING_CONTRACT_REF_UNAVAILABLE", "ING_CONTRACT_DEPTH_EXCEEDED")
    return path.isNull(), bound(path, lambda p: F.when(p.isin(*codes), p).when(p.isNotNull(), "ING_CONTRACT_INVALID")), bound(path, lambda p: F.when(~p.isin(*codes), p))
