"""JSON Schema as an expression, against a validator that walks the parsed document."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from pulseframe.functions import jsonschema


def kind_is(v, name):
    number = isinstance(v, (int, float)) and not isinstance(v, bool)
    return {"object": isinstance(v, dict), "array": isinstance(v, list), "string": isinstance(v, str), "boolean": isinstance(v, bool), "null": v is None, "number": number, "integer": number and float(v).is_integer()}[name]


def same(a, b):
    return type(a) is type(b) and a == b or kind_is(a, "number") and kind_is(b, "number") and a == b


def slow(schema, v, root, at="#"):
    """The first violation, or None."""
    if schema is True or schema == {}:
        return None
    if schema is False:
        return f"{at}: not allowed"
    if "$ref" in schema:
        target = root
        for part in schema["$ref"][1:].split("/")[1:]:
            target = target[part.replace("~1", "/")]
        return slow(target, v, root, at)
    sub = lambda s, x, name: slow(s, x, root, name)
    if "type" in schema and not any(kind_is(v, t) for t in ([schema["type"]] if isinstance(schema["type"], str) else schema["type"])):
        return f"{at}: type"
    for key, values in (("enum", schema.get("enum")), ("const", [schema["const"]] if "const" in schema else None)):
        if values is not None and not any(same(v, x) for x in values):
            return f"{at}: {key}"
    rules = [("minimum", "number", lambda x: v < x), ("maximum", "number", lambda x: v > x), ("exclusiveMinimum", "number", lambda x: v <= x), ("exclusiveMaximum", "number", lambda x: v >= x), ("multipleOf", "number", lambda x: abs(v / x - round(v / x)) > 1e-9),
             ("minLength", "string", lambda x: len(v) < x), ("maxLength", "string", lambda x: len(v) > x), ("pattern", "string", lambda x: not re.search(x, v)), ("minItems", "array", lambda x: len(v) < x), ("maxItems", "array", lambda x: len(v) > x),
             ("minProperties", "object", lambda x: len(v) < x), ("maxProperties", "object", lambda x: len(v) > x), ("uniqueItems", "array", lambda x: x and len({json.dumps(i, sort_keys=True) for i in v}) < len(v))]
    for key, kind, bad in rules:
        if key in schema and kind_is(v, kind) and bad(schema[key]):
            return f"{at}: {key}"
    found = []
    if isinstance(v, dict):
        found += [f"{at}: required {k}" for k in schema.get("required", []) if k not in v]
        found += [sub(s, v[k], f"{at}/{k}") for k, s in schema.get("properties", {}).items() if k in v]
        for p, s in schema.get("patternProperties", {}).items():
            found += [sub(s, v[k], f"{at}/{k}") for k in sorted(v) if re.search(p, k)]
        known = lambda k: k in schema.get("properties", {}) or any(re.search(p, k) for p in schema.get("patternProperties", {}))
        found += [sub(schema.get("additionalProperties", True), v[k], f"{at}/{k}") for k in sorted(v) if not known(k)]
    if isinstance(v, list):
        items = schema.get("items", True)
        found += [sub(s, x, f"{at}/{k}") for k, (s, x) in enumerate(zip(items, v))] if isinstance(items, list) else [sub(items, x, f"{at}/{k}") for k, x in enumerate(v)]  # noqa: B905
    found += [sub(s, v, at) for s in schema.get("allOf", [])]
    for key, bad in (("anyOf", lambda n: n == 0), ("oneOf", lambda n: n != 1)):
        if key in schema and bad(sum(sub(s, v, at) is None for s in schema[key])):
            found.append(f"{at}: {key}")
    if "not" in schema and sub(schema["not"], v, at) is None:
        found.append(f"{at}: not")
    return next((x for x in found if x), None)


PING = {
    "type": "object",
    "required": ["clientId", "application"],
    "definitions": {"version": {"type": "string", "pattern": r"^\d+\.\d+$", "maxLength": 6}, "odd/name": {"type": ["integer", "null"]}},
    "properties": {
        "clientId": {"type": "string", "minLength": 1},
        "application": {"type": "object", "properties": {"version": {"$ref": "#/definitions/version"}, "channel": {"enum": ["release", "beta", None, 3]}}, "required": ["version"], "additionalProperties": False},
        "counts": {"type": "array", "items": {"type": "number", "minimum": 0, "exclusiveMaximum": 10}, "maxItems": 3, "uniqueItems": True},
        "pair": {"items": [{"type": "string"}, {"type": "boolean"}]},
        "extra": {"additionalProperties": {"$ref": "#/definitions/odd~1name"}, "patternProperties": {"^s_": {"type": "string"}}, "maxProperties": 3},
        "choice": {"oneOf": [{"type": "integer"}, {"minimum": 5}], "not": {"const": 99}},
        "any.of": {"anyOf": [{"type": "string"}, {"type": "array", "minItems": 2}], "allOf": [{"not": {"const": "no"}}]},
    },
}
VALUES = [None, True, False, 0, 3, 7.5, -1, 10, 99, 3.0, "", "a", "no", "beta", "1.2", "12.x", "100.2000", [], [1], [1, 2], [1, 1], [0, 3, 2, 5], [11], ["a", 1], ["a", True], [None], {}, {"version": "1.2"}, {"version": "1.2", "channel": "beta"}, {"version": "1.2", "channel": "x"}, {"version": "1.2", "z": 1}, {"version": 1}, {"s_a": "x", "n": 3}, {"s_a": 1}, {"q": "x"}, {"q": None, "r": 1, "s_": "", "t": 2}]


def documents(n):
    rng = random.Random(1)
    out = [*VALUES]
    for _ in range(n):
        doc = {"clientId": "c", "application": {"version": "1.2"}}
        for key in rng.sample([*PING["properties"], "other"], rng.randint(0, 3)):
            doc[key] = rng.choice(VALUES)
        if rng.random() < 0.1:
            del doc["clientId"]
        out.append(doc)
    return out


def found(spark, schema, docs):
    df = spark.createDataFrame([(k, json.dumps(d)) for k, d in enumerate(docs)], "k long, t string").withColumn("d", F.parse_json("t"))
    return {r.k: r.v for r in df.select("k", jsonschema.violation(schema, F.col("d")).alias("v")).collect()}


def test_ping_schema(spark):
    docs = documents(600)
    got = found(spark, PING, docs)
    for k, d in enumerate(docs):
        assert got[k] == slow(PING, d, PING), d
    assert len({v and v.split(": ")[1] for v in got.values()}) > 9


@pytest.mark.parametrize("schema", [True, False, {}, {"type": "integer"}, {"type": ["string", "null"]}, {"const": {"version": "1.2"}}, {"enum": [[1, 2], 3, "a", False]}, {"multipleOf": 2.5}, {"minLength": 1}, {"pattern": "b.t"}, {"minItems": 2}, {"minProperties": 2}, {"not": {}}, {"items": False}, {"additionalProperties": False}])
def test_each_keyword(spark, schema):
    got = found(spark, json.dumps(schema), VALUES)
    assert got == {k: slow(schema, v, schema) for k, v in enumerate(VALUES)}


def test_bad_schemas_and_documents(spark):
    doc = F.col("d")
    for bad in ({"$ref": "other.json"}, {"$ref": "#"}, {"properties": {"a": {"$ref": "#/properties/a"}}}, {"type": "text"}):
        with pytest.raises(ValueError):
            jsonschema.violation(bad, doc)
    df = spark.createDataFrame([(None,), ("{nope",)], "t string").select(F.try_parse_json("t").alias("d"))
    assert [r.v for r in df.select(jsonschema.violation({"type": "object"}, doc).alias("v")).collect()] == [None, None]
