"""Strict JSON at the boundary: one Arrow call per array of texts.

Spark's own JSON readers accept text after a value and differ on repeated
keys, so calls are parsed by Python's reader. It returns facts (kinds, strings
and keys by path) that native expressions evaluate further.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys that a call must have.
CALL_KEYS = ("jsonrpc", "method", "params", "id")
#: Objects nested deeper than this are no JSON for the engine.
MAX_DEPTH = 1000

CALL = "struct<ok:boolean,is_object:boolean,missing:string,version_ok:boolean,method_kind:string,method:string,facts:map<string,string>>"
CALL_ARROW = pa.struct([("ok", pa.bool_()), ("is_object", pa.bool_()), ("missing", pa.string()), ("version_ok", pa.bool_()), ("method_kind", pa.string()), ("method", pa.string()), ("facts", pa.map_(pa.string(), pa.string()))])


def kind(value) -> str:
    """One letter for a JSON value: object, array, string, integer, number, boolean, null."""
    if value is None:
        return "z"
    if isinstance(value, bool):
        return "b"
    if isinstance(value, int) or (isinstance(value, float) and value.is_integer()):
        return "i"
    return {float: "n", str: "s", list: "a", dict: "o"}[type(value)]


def loads(text: str | None):
    """(True, value), or (False, None) for what is no strict JSON text."""
    try:
        return (False, None) if text is None else (True, json.loads(text))
    except (ValueError, RecursionError):
        return False, None


def facts(value) -> dict[str, str]:
    """Kind, and text for strings, of a value and of what objects in it hold, by path."""
    out, stack = {}, [("", value, 0)]
    while stack:
        path, v, depth = stack.pop()
        k = kind(v)
        out[path] = f"s:{v}" if k == "s" else k
        if k == "o" and depth < MAX_DEPTH:
            stack += [(f"{path}/{key.replace('~', '~0').replace('/', '~1')}", x, depth + 1) for key, x in v.items()]
    return out


def read_call(text: str | None) -> dict:
    """What the checks need to know of one call text."""
    ok, value = loads(text)
    out = {"ok": ok, "is_object": isinstance(value, dict), "missing": None, "version_ok": False, "method_kind": None, "method": None, "facts": None}
    if out["is_object"]:
        missing = [k for k in CALL_KEYS if k not in value]
        method = value.get("method")
        out |= {"missing": ",".join(missing) or None, "version_ok": value.get("jsonrpc") == "2.0", "method_kind": kind(method), "method": method if isinstance(method, str) else None, "facts": list(facts(value.get("params", {})).items())}
    return out


def clean(text: str | None) -> str | None:
    """Lone surrogates, which JSON escapes can name, as question marks: Arrow strings are UTF-8."""
    return text if text is None else text.encode("utf-8", "replace").decode()


def _cleaned(row: dict) -> dict:
    row["method"] = clean(row["method"])
    if row["facts"] is not None:
        row["facts"] = [(clean(a), clean(b)) for a, b in row["facts"]]
    return row


def read_calls(texts: Column) -> Column:
    """Facts of every text of an array, in its order; null for null.

    The call is marked as not deterministic: filters on what was found then
    stay above it, instead of taking a copy of it, and of all below, along.
    Filters on other columns belong before it.
    """

    @F.arrow_udf(f"array<{CALL}>")
    def read(arrays: pa.Array) -> pa.Array:
        rows = [None if a is None else [_cleaned(read_call(t)) for t in a] for a in arrays.to_pylist()]
        return pa.array(rows, pa.list_(CALL_ARROW))

    return read.asNondeterministic()(texts)


def canonical(text: Column, drop: tuple[str, ...] = ()) -> Column:
    """An object as text with sorted keys, without some of its top keys; null for what is no JSON."""

    @F.arrow_udf("string")
    def dump(values: pa.Array) -> pa.Array:
        out = []
        for v in values.to_pylist():
            ok, x = loads(v)
            if ok and isinstance(x, dict):
                x = {k: y for k, y in x.items() if k not in drop}
            out.append(json.dumps(x, sort_keys=True) if ok else None)
        return pa.array(out, pa.string())

    return dump(text)


def minify(text: Column) -> Column:
    """JSON without white space between tokens, keys in their order; null for what is no JSON."""

    @F.arrow_udf("string")
    def shrink(values: pa.Array) -> pa.Array:
        out = []
        for v in values.to_pylist():
            ok, x = loads(v)
            out.append(clean(json.dumps(x, separators=(",", ":"), ensure_ascii=False)) if ok else None)
        return pa.array(out, pa.string())

    return shrink(text)


def valid(text: Column) -> Column:
    """Whether a text is one strict JSON value."""

    @F.arrow_udf(T.BooleanType())
    def check(values: pa.Array) -> pa.Array:
        return pa.array([loads(v)[0] for v in values.to_pylist()], pa.bool_())

    return check(text)
