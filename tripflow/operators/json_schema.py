"""JSON Schema as a Column: a document's first broken path, or ``Success``.

A schema is compiled once, on the driver, to one expression over ``variant``; rows are judged by built-in
functions, in one pass and without a shuffle.  Supported: type (one or several), enum and const of plain values,
minimum, maximum, exclusiveMinimum, exclusiveMaximum, minLength, maxLength, pattern, required, properties,
additionalProperties (true or false), items (one schema), minItems, maxItems; title, description, default,
examples, ``$schema``, ``$id`` and ``$comment`` say nothing.  Any other keyword is an error when compiling.

As in the standard a keyword speaks only of values of its own kind (``minimum`` of numbers), 1.0 is an integer,
a pattern may match anywhere, lengths are code points, and a property that holds null is there.  Numbers are
compared as doubles.  The order of the checks is fixed: a value's own keywords, its required names in their order,
names that are not allowed (the smallest), properties in the schema's order, items by index.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUCCESS = "Success"
SILENT = {"title", "description", "default", "examples", "$schema", "$id", "$comment"}
TYPES = {"object", "array", "string", "number", "integer", "boolean", "null"}


def _double(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _members(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _member(v: Column, name: str) -> Column:
    """A property's value; NULL if there is none (a JSON null is a value)."""
    if name and not re.search(r"['?\\]", name):
        return F.try_variant_get(v, f"$['{name}']", "variant")
    return F.try_element_at(_members(v), F.lit(name))


def _is(v: Column, kind: Column, name: str) -> Column:
    if name == "integer":
        return kind.startswith("BIGINT") | (_is(v, kind, "number") & (_double(v) == F.floor(_double(v))))
    if name == "number":
        return kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return kind.startswith({"object": "OBJECT", "array": "ARRAY", "string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}[name])


def _equals(v: Column, kind: Column, value: object) -> Column:
    if value is None:
        return _is(v, kind, "null")
    if isinstance(value, bool):
        return _is(v, kind, "boolean") & (F.try_variant_get(v, "$", "boolean") == F.lit(value))
    if isinstance(value, (int, float)):
        return _is(v, kind, "number") & (_double(v) == F.lit(float(value)))
    if isinstance(value, str):
        return _is(v, kind, "string") & (_text(v) == F.lit(value))
    raise ValueError(f"enum and const take plain values, not {value!r}")


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _rules(v: Column, kind: Column) -> dict[str, Callable[[object], Column]]:
    """Keyword -> what of its argument breaks it, for the keywords that look at one value alone."""
    number, text, array = (_is(v, kind, t) for t in ("number", "string", "array"))
    items = F.size(F.try_variant_get(v, "$", "array<variant>"))
    return {
        "enum": lambda a: ~_any([_equals(v, kind, x) for x in a]),
        "const": lambda a: ~_equals(v, kind, a),
        "minimum": lambda a: number & (_double(v) < F.lit(float(a))),
        "maximum": lambda a: number & (_double(v) > F.lit(float(a))),
        "exclusiveMinimum": lambda a: number & (_double(v) <= F.lit(float(a))),
        "exclusiveMaximum": lambda a: number & (_double(v) >= F.lit(float(a))),
        "minLength": lambda a: text & (F.char_length(_text(v)) < F.lit(int(a))),
        "maxLength": lambda a: text & (F.char_length(_text(v)) > F.lit(int(a))),
        "pattern": lambda a: text & ~F.rlike(_text(v), F.lit(a)),
        "minItems": lambda a: array & (items < F.lit(int(a))),
        "maxItems": lambda a: array & (items > F.lit(int(a))),
    }


def _broken(v: Column, schema: Mapping | bool, at: Column) -> Column:
    """The first broken path under ``v`` as ``path: keyword``, else NULL."""
    def say(keyword: str, where: Column = at) -> Column:
        return F.concat(where, F.lit(f": {keyword}"))

    if isinstance(schema, bool):
        return F.lit(None).cast("string") if schema else say("not allowed")
    kind = F.schema_of_variant(v)
    rules = _rules(v, kind)
    unknown = set(schema) - set(rules) - SILENT - {"type", "required", "properties", "additionalProperties", "items"}
    if unknown:
        raise ValueError(f"unsupported keywords: {', '.join(sorted(unknown))}")
    found: list[Column] = []
    if "type" in schema:
        names = [schema["type"]] if isinstance(schema["type"], str) else list(schema["type"])
        if not set(names) <= TYPES:
            raise ValueError(f"unknown type: {schema['type']!r}")
        found.append(F.when(~_any([_is(v, kind, t) for t in names]), say("type")))
    found += [F.when(broken(schema[k]), say(k)) for k, broken in rules.items() if k in schema]
    is_object, is_array = _is(v, kind, "object"), _is(v, kind, "array")
    for name in schema.get("required", ()):
        found.append(F.when(is_object & _member(v, name).isNull(), say("required", F.concat(at, F.lit(f".{name}")))))
    properties = schema.get("properties", {})
    more = schema.get("additionalProperties", True)
    if not isinstance(more, bool):
        raise ValueError("additionalProperties takes true or false")
    if not more:
        known = F.array(*[F.lit(p) for p in properties]).cast("array<string>")
        extra = F.array_min(F.array_except(F.map_keys(_members(v)), known))
        found.append(F.when(is_object & extra.isNotNull(), say("not allowed", F.concat(at, F.lit("."), extra))))
    for name, inner in properties.items():
        value = _member(v, name)
        found.append(F.when(is_object & value.isNotNull(), _broken(value, inner, F.concat(at, F.lit(f".{name}")))))
    if "items" in schema:
        each = F.transform(F.try_variant_get(v, "$", "array<variant>"),
                           lambda x, i: _broken(x, schema["items"], F.concat(at, F.lit("["), i.cast("string"), F.lit("]"))))
        found.append(F.when(is_array, F.get(F.array_compact(each), F.lit(0))))
    return F.coalesce(*found, F.lit(None).cast("string"))


def validate(doc: Column | str, schema: Mapping | bool) -> Column:
    """``Success``, or the first broken path and keyword of a JSON text (``$.a.b[2]: type``).

    NULL is ``$: no document``; text that is no JSON, holds more than one value or names a property twice is
    ``$: not JSON``."""
    text = F.col(doc) if isinstance(doc, str) else doc
    v = F.try_parse_json(text)
    # The parser stops after the first value: alone, a document is also the one element of an array and of an object.
    alone = [F.try_parse_json(F.concat(F.lit(a), text, F.lit(b))).isNotNull() for a, b in (("[", "]"), ('{"a":', "}"))]
    return (F.when(text.isNull(), F.lit("$: no document")).when(v.isNull() | ~(alone[0] & alone[1]), F.lit("$: not JSON"))
            .otherwise(F.coalesce(_broken(v, schema, F.lit("$")), F.lit(SUCCESS))))


def validation_report(df: DataFrame, col: str, schema: Mapping | bool) -> DataFrame:
    """Documents by verdict, array indices left out: (verdict, rows)."""
    verdict = F.regexp_replace(validate(col, schema), r"\[[0-9]+\]", "[]")
    return df.select(verdict.alias("verdict")).groupBy("verdict").agg(F.count(F.lit(1)).alias("rows"))
