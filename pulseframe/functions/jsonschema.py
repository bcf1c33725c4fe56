"""JSON Schema compiled to one column expression over a variant: the first violation, or null."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Schema = dict[str, Any] | bool
#: Kinds of number as the variant names them.
_NUMBERS = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def _step(key: str) -> str:
    """A key as a step of a variant's path."""
    if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", key):
        return f".{key}"
    if "'" not in key:
        return f"['{key}']"
    if '"' not in key:
        return f'["{key}"]'
    raise ValueError(f"no path can name the key {key}")


class _Value:
    """A place in a document: a path below a variant column, and how it is called in messages.

    As a variant, alone or in a map or an array, a value is copied with all its parts. So what a value is, its keys and its size are asked of
    structs without fields, which are objects or null, and copy nothing.
    """

    def __init__(self, base: Column, path: str, name: Column):
        self.base, self.path, self.name = base, path, name

    def child(self, key: str) -> _Value:
        return _Value(self.base, self.path + _step(key), F.concat(self.name, F.lit(f"/{key}")))

    def as_(self, kind: str) -> Column:
        return F.try_variant_get(self.base, self.path, kind)

    @property
    def here(self) -> Column:
        return self.base if self.path == "$" else self.as_("variant")

    @property
    def there(self) -> Column:
        return self.as_("struct<>").isNotNull() | self.here.isNotNull()

    @property
    def kind(self) -> Column:
        return F.schema_of_variant(self.here)

    @property
    def entries(self) -> Column:
        return self.as_("map<string,variant>")

    @property
    def keys(self) -> Column:
        return F.map_keys(self.as_("map<string,struct<>>"))

    @property
    def items(self) -> Column:
        return self.as_("array<variant>")

    @property
    def n_items(self) -> Column:
        return F.size(self.as_("array<struct<>>"))

    def is_a(self, name: str) -> Column:
        number = self.kind.rlike(_NUMBERS)
        tests = {
            "object": lambda: self.as_("struct<>").isNotNull(),
            "array": lambda: self.as_("array<struct<>>").isNotNull(),
            "string": lambda: self.kind == "STRING",
            "boolean": lambda: self.kind == "BOOLEAN",
            "null": lambda: F.is_variant_null(self.here),
            "number": lambda: number,
            "integer": lambda: number & (self.as_("double") == F.floor(self.as_("double"))),
        }
        if name not in tests:
            raise ValueError(f"no such type: {name}")
        return F.coalesce(tests[name](), F.lit(False))

    def equals(self, value: Any) -> Column:
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return F.coalesce(self.kind.rlike(_NUMBERS) & (self.as_("double") == float(value)), F.lit(False))
        if isinstance(value, str):
            return F.coalesce((self.kind == "STRING") & (self.as_("string") == value), F.lit(False))
        # The variant's text has its keys in order.
        return F.coalesce(F.to_json(self.here) == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False), F.lit(False))


def _first(found: Column) -> Column:
    """The first of an array that is not null."""
    return F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0))


class _Compiler:
    def __init__(self, root: Schema):
        self.root = root

    def target(self, ref: str) -> Schema:
        if not ref.startswith("#"):
            raise ValueError(f"a reference to another document: {ref}")
        at: Any = self.root
        for part in ref[1:].split("/")[1:]:
            key = part.replace("~1", "/").replace("~0", "~")
            at = at[int(key)] if isinstance(at, list) else at[key]
        return at

    def checks(self, schema: Schema, value: _Value, open_refs: tuple[str, ...] = ()) -> list[Column]:
        """Violations of a value that is there, in the order in which they are looked for; each null or a text."""
        says = lambda bad, what: F.when(bad, F.concat(value.name, F.lit(f": {what}")))
        if schema is True or schema == {}:
            return []
        if schema is False:
            return [says(F.lit(True), "not allowed")]
        assert isinstance(schema, dict)
        if "$ref" in schema:
            ref = schema["$ref"]
            if ref in open_refs:
                raise ValueError(f"a reference within itself: {ref}")
            return self.checks(self.target(ref), value, (*open_refs, ref))
        sub = lambda s, v: self.one(s, v, open_refs)
        out: list[Column] = []
        if "type" in schema:
            names = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
            fits = value.is_a(names[0])
            for n in names[1:]:
                fits = fits | value.is_a(n)
            out.append(says(~fits, "type"))
        for key, values in (("enum", schema.get("enum")), ("const", [schema["const"]] if "const" in schema else None)):
            if values is not None:
                fits = F.lit(False)
                for x in values:
                    fits = fits | value.equals(x)
                out.append(says(~fits, key))
        number, text = value.as_("double"), value.as_("string")
        limits = {
            "minimum": ("number", lambda x: number < x),
            "maximum": ("number", lambda x: number > x),
            "exclusiveMinimum": ("number", lambda x: number <= x),
            "exclusiveMaximum": ("number", lambda x: number >= x),
            "multipleOf": ("number", lambda x: F.abs(number / x - F.round(number / x)) > 1e-9),
            "minLength": ("string", lambda x: F.char_length(text) < x),
            "maxLength": ("string", lambda x: F.char_length(text) > x),
            "pattern": ("string", lambda x: ~text.rlike(x)),
            "minItems": ("array", lambda x: value.n_items < x),
            "maxItems": ("array", lambda x: value.n_items > x),
            "minProperties": ("object", lambda x: F.size(value.keys) < x),
            "maxProperties": ("object", lambda x: F.size(value.keys) > x),
        }
        for key, (kind, bad) in limits.items():
            if key in schema:
                out.append(says(value.is_a(kind) & bad(schema[key]), key))
        if schema.get("uniqueItems"):
            texts = F.transform(value.items, lambda x: F.to_json(x))
            out.append(says(value.is_a("array") & (F.size(F.array_distinct(texts)) < F.size(texts)), "uniqueItems"))
        for key in schema.get("required", []):
            out.append(says(value.is_a("object") & ~value.child(key).there, f"required {key}"))
        named, patterns = schema.get("properties", {}), schema.get("patternProperties", {})
        for key, s in named.items():
            child = value.child(key)
            out.append(F.when(child.there, sub(s, child)))  # only objects have one
        each = lambda keep, s: _first(F.transform(F.filter(F.map_entries(value.entries), lambda e: keep(e["key"])), lambda e: sub(s, _Value(e["value"], "$", F.concat(value.name, F.lit("/"), e["key"])))))
        for pattern, s in patterns.items():
            out.append(each(lambda k, p=pattern: k.rlike(p), s))
        more = schema.get("additionalProperties", True)
        if more is not True and more != {}:
            other = lambda k: ~k.isin(*named) if named else F.lit(True)

            def rest(k: Column) -> Column:
                keep = other(k)
                for p in patterns:
                    keep = keep & ~k.rlike(p)
                return keep

            if more is False:
                out.append(F.concat(value.name, F.lit("/"), F.get(F.filter(value.keys, rest), F.lit(0)), F.lit(": not allowed")))
            else:
                out.append(each(rest, more))
        items = schema.get("items", True)
        if isinstance(items, list):
            for k, s in enumerate(items):
                place = _Value(value.base, f"{value.path}[{k}]", F.concat(value.name, F.lit(f"/{k}")))
                out.append(F.when(place.there, sub(s, place)))  # only arrays have one
        elif items is not True and items != {}:
            out.append(_first(F.transform(value.items, lambda x, k: sub(items, _Value(x, "$", F.concat(value.name, F.lit("/"), k.cast("string")))))))
        out += [sub(s, value) for s in schema.get("allOf", [])]
        fits = lambda s: F.when(sub(s, value).isNull(), 1).otherwise(0)
        for key, bad in (("anyOf", lambda n: n == 0), ("oneOf", lambda n: n != 1)):
            if key in schema:
                n = F.lit(0)
                for s in schema[key]:
                    n = n + fits(s)
                out.append(says(bad(n), key))
        if "not" in schema:
            out.append(says(sub(schema["not"], value).isNull(), "not"))
        return out

    def one(self, schema: Schema, value: _Value, open_refs: tuple[str, ...] = ()) -> Column:
        return F.coalesce(*self.checks(schema, value, open_refs), F.lit(None).cast("string"))


def violation(schema: Schema | str, document: Column) -> Column:
    """The first violation of a JSON Schema (a dict or its text) by a variant, as `#/path/to/value: keyword`; null where there is none, and for a
    null document.

    Known are type, enum, const, bounds of numbers, lengths, items and properties, multipleOf, pattern, uniqueItems, required, properties,
    patternProperties, additionalProperties, items (one schema or a list), allOf, anyOf, oneOf, not, and $ref within the schema; what else a schema has is
    ignored, as is the rest of a schema with a $ref. A value's own keywords come in that order, then its parts. A reference within itself, or to
    another document, is an error: an expression has a fixed depth. Patterns are Java's and search anywhere in a text.
    """
    parsed = json.loads(schema) if isinstance(schema, str) else schema
    return F.when(document.isNotNull(), _Compiler(parsed).one(parsed, _Value(document, "$", F.lit("#"))))
