"""JSON values against the usual keywords of JSON Schema, and canonical JSON text."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable

KINDS: dict[str, Callable] = {
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "integer": lambda v: not isinstance(v, bool)
    and (isinstance(v, int) or isinstance(v, float) and v.is_integer()),
    "number": lambda v: not isinstance(v, bool) and isinstance(v, (int, float)),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}
# Keywords that say nothing about whether a value is valid.
NOTES = {
    "$comment", "$defs", "$id", "$schema", "default", "definitions", "deprecated", "description",
    "examples", "format", "readOnly", "title", "writeOnly",
}
# What a limit is about, and whether a value is within it.
LIMITS: dict[str, tuple[str, Callable]] = {
    "minimum": ("number", lambda v, m: v >= m),
    "maximum": ("number", lambda v, m: v <= m),
    "exclusiveMinimum": ("number", lambda v, m: v > m),
    "exclusiveMaximum": ("number", lambda v, m: v < m),
    "multipleOf": ("number", lambda v, m: (v / m) == int(v / m) if math.isfinite(v / m) else False),
    "minLength": ("string", lambda v, m: len(v) >= m),
    "maxLength": ("string", lambda v, m: len(v) <= m),
    "pattern": ("string", lambda v, m: re.search(m, v) is not None),
    "minItems": ("array", lambda v, m: len(v) >= m),
    "maxItems": ("array", lambda v, m: len(v) <= m),
    "uniqueItems": ("array", lambda v, m: not m or len({canonical(x) for x in v}) == len(v)),
    "minProperties": ("object", lambda v, m: len(v) >= m),
    "maxProperties": ("object", lambda v, m: len(v) <= m),
}
CHOICES = ("anyOf", "oneOf", "allOf")
OTHERS = {
    "type", "enum", "const", "required", "properties", "additionalProperties", "items", "not", "$ref",
}


def _constant(name: str):
    raise ValueError(f"{name} is no JSON")


def read_json(text: str | None):
    """A JSON value; ``ValueError`` for anything else, null included."""
    if text is None:
        raise ValueError("no text")
    try:
        return json.loads(text, parse_constant=_constant)
    except RecursionError as error:
        raise ValueError("nested too deep") from error


def _plain(value):
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("number out of range")
        return int(value) if value.is_integer() and abs(value) < 2**53 else value
    if isinstance(value, list):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return value


def canonical(value) -> str:
    """Keys sorted, no spaces, numbers without a trailing fraction of zero."""
    try:
        return json.dumps(
            _plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False
        )
    except RecursionError as error:
        raise ValueError("nested too deep") from error


def check_schema(schema: dict | bool, at: str = "$") -> None:
    """Raise on keywords and types that ``problems`` does not know, so none passes unseen."""
    if isinstance(schema, bool):
        return
    unknown = set(schema) - NOTES - set(LIMITS) - set(CHOICES) - OTHERS
    if unknown:
        raise ValueError(f"{at}: unknown keywords {sorted(unknown)}")
    kinds = schema.get("type", [])
    for kind in [kinds] if isinstance(kinds, str) else kinds:
        if kind not in KINDS:
            raise ValueError(f"{at}: unknown type {kind}")
    if "pattern" in schema:
        re.compile(schema["pattern"])
    if not schema.get("$ref", "#/").startswith("#/"):
        raise ValueError(f"{at}: only references into the schema itself are known")
    inner = [*schema.get("properties", {}).items(), *schema.get("$defs", {}).items()]
    inner += schema.get("definitions", {}).items()
    inner += [(k, schema[k]) for k in ("items", "additionalProperties", "not") if k in schema]
    inner += [(f"{k}[{i}]", s) for k in CHOICES for i, s in enumerate(schema.get(k, []))]
    for name, part in inner:
        check_schema(part, f"{at}.{name}")


def same(one, other) -> bool:
    """Equality of JSON: true is not 1, but 1 is 1.0."""
    return canonical(one) == canonical(other)


def _found(root: dict, reference: str) -> dict | bool:
    part = root
    for name in reference[2:].split("/"):
        part = part[name.replace("~1", "/").replace("~0", "~")]
    return part


def problems(value, schema: dict | bool, at: str = "$", root: dict | None = None) -> list[str]:
    """What a value has against a schema that ``check_schema`` accepts."""
    if isinstance(schema, bool):
        return [] if schema else [f"{at}: not allowed"]
    root = schema if root is None else root
    if "$ref" in schema:
        return problems(value, _found(root, schema["$ref"]), at, root)
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(KINDS[k](value) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and not any(same(value, v) for v in schema["enum"]):
        found.append(f"{at}: not among the values")
    if "const" in schema and not same(value, schema["const"]):
        found.append(f"{at}: not the value")
    for key, (kind, holds) in LIMITS.items():
        if key in schema and KINDS[kind](value) and not holds(value, schema[key]):
            found.append(f"{at}: beyond {key}")
    if isinstance(value, dict):
        inner, more = schema.get("properties", {}), schema.get("additionalProperties", True)
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for key, item in value.items():
            if key in inner:
                found += problems(item, inner[key], f"{at}.{key}", root)
            elif more is False:
                found.append(f"{at}.{key}: unknown")
            else:
                found += problems(item, more, f"{at}.{key}", root)
    if isinstance(value, list) and "items" in schema:
        for number, item in enumerate(value):
            found += problems(item, schema["items"], f"{at}[{number}]", root)
    for key, count in ((k, len(schema[k])) for k in CHOICES if k in schema):
        passed = sum(not problems(value, part, at, root) for part in schema[key])
        if not (passed == count if key == "allOf" else passed == 1 if key == "oneOf" else passed):
            found.append(f"{at}: fails {key}")
    if "not" in schema and not problems(value, schema["not"], at, root):
        found.append(f"{at}: fails not")
    return found
