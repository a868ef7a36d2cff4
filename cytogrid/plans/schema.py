"""Checking a configuration against a schema before any job runs: every fault is named by its key path, and defaults are filled in.

A schema is a mapping: ``type`` (one or several of string, integer, number, boolean, array, object, null), ``enum``, ``pattern``, ``minimum``, ``maximum``, ``above`` (exclusive), ``least`` (items at
least), ``unique``, ``items``, ``keys`` (of an object; ``open`` lets others through; ``others`` is the schema of these), ``required``, ``default``, ``needs`` (key: keys that must come with it) and ``when``
(pairs of {key: value} and a schema that then holds too).
"""

from __future__ import annotations

import copy
import json
import re
from typing import Any

from pyspark.sql import SparkSession

KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def _is(value: Any, kind: str) -> bool:
    return isinstance(value, KINDS[kind]) and (kind == "boolean" or not isinstance(value, bool))


def faults(value: Any, schema: dict, at: str = "") -> list[str]:
    """What is wrong with ``value``, as "key.path: reason"; none where it fits."""
    here = at or "configuration"
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{here}: {value!r} is not {' or '.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{here}: {value!r} is none of {', '.join(map(str, schema['enum']))}")
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        out.append(f"{here}: {value!r} does not match {schema['pattern']}")
    if _is(value, "number"):
        for rule, wrong, says in (("minimum", lambda a, b: a < b, "below"), ("maximum", lambda a, b: a > b, "above"), ("above", lambda a, b: a <= b, "not above")):
            if rule in schema and wrong(value, schema[rule]):
                out.append(f"{here}: {value} is {says} {schema[rule]}")
    if isinstance(value, list):
        if len(value) < schema.get("least", 0):
            out.append(f"{here}: {len(value)} items, at least {schema['least']} are needed")
        if schema.get("unique") and any(x in value[:i] for i, x in enumerate(value)):
            out.append(f"{here}: an item is there twice")
        for i, x in enumerate(value):
            out += faults(x, schema.get("items", {}), f"{at}[{i}]")
    if isinstance(value, dict):
        known, name = schema.get("keys", {}), lambda k: f"{at}.{k}" if at else str(k)
        out += [f"{name(k)}: is required" for k in schema.get("required", ()) if value.get(k) in (None, "")]
        unknown = sorted(str(k) for k in value if k not in known)
        if unknown and "keys" in schema and not schema.get("open") and "others" not in schema:
            out.append(f"{here}: unknown keys: {', '.join(unknown)}")
        for k, x in value.items():
            out += faults(x, known[k] if k in known else schema.get("others", {}), name(k))
        for k, others in schema.get("needs", {}).items():
            if value.get(k) is not None:
                out += [f"{name(k)}: goes together with {o}" for o in others if value.get(o) is None]
        for given, then in schema.get("when", ()):
            if all(value.get(k, known.get(k, {}).get("default")) == x for k, x in given.items()):
                out += [f for f in faults(value, {"open": True, **then}, at) if f not in out]
    return out


def filled(value: Any, schema: dict) -> Any:
    """``value`` with the defaults of keys that are not there, at every depth."""
    if not isinstance(value, dict):
        return value
    out = {k: filled(x, schema.get("keys", {}).get(k, schema.get("others", {}))) for k, x in value.items()}
    for k, s in schema.get("keys", {}).items():
        if k not in out and "default" in s:
            out[k] = filled(copy.deepcopy(s["default"]), s)
    return out


def checked(value: Any, schema: dict) -> Any:
    """``value`` with defaults; raises with all faults."""
    if found := faults(value, schema):
        raise ValueError("; ".join(found))
    return filled(value, schema)


def read(spark: SparkSession, path: str) -> Any:
    """A YAML or JSON file, from wherever Spark reads."""
    text = spark.read.text(path, wholetext=True).first()[0]
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError:
        raise RuntimeError(f"{path}: reading YAML needs a YAML module; write the configuration as JSON") from None
    return yaml.safe_load(text)
