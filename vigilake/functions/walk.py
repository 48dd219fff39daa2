"""The per-document helpers Spark has no expression for, as Arrow UDFs.

`unfold` rewrites keys and lists where wanted keys occur, `merge` merges, `split_json_blocks` cuts JSON
objects apart. Everything decided from their output is done with Spark expressions.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("key", T.StringType()),
            T.StructField("value", T.StringType()),
            T.StructField("kind", T.StringType()),  # string, number, bool, null, object, array
            T.StructField("pos", T.IntegerType()),  # position of the key in the document
        ]
    )
)
UNFOLDED = T.StructType(
    [
        T.StructField("doc", T.StringType()),
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("found", FOUND),
    ]
)
_ARROW = pa.struct(
    [
        ("doc", pa.string()),
        ("keys", pa.list_(pa.string())),
        (
            "found",
            pa.list_(pa.struct([("key", pa.string()), ("value", pa.string()), ("kind", pa.string()), ("pos", pa.int32())])),
        ),
    ]
)
_KINDS = {str: "string", bool: "bool", int: "number", float: "number", dict: "object", list: "array", type(None): "null"}


def lower_keys(node):
    """Every object key in lower case at any depth; of keys that become equal the later one wins."""
    if isinstance(node, dict):
        return {k.lower(): lower_keys(v) for k, v in node.items()}
    if isinstance(node, list):
        return [lower_keys(v) for v in node]
    return node


def walk(node, wanted: frozenset, keys: set, found: list) -> None:
    """Collect all keys, and the values of wanted keys with an object's own keys before deeper ones."""
    counter = 0
    objects = []  # (order of the object, position of the key, key, value)

    def visit(n):
        nonlocal counter
        if isinstance(n, dict):
            mine = len(objects)
            objects.append([])
            for k, v in n.items():
                keys.add(k)
                counter += 1
                if k in wanted:
                    objects[mine].append((k, v, counter))
                visit(v)
        elif isinstance(n, list):
            for v in n:
                visit(v)

    visit(node)
    for group in objects:
        for k, v, pos in group:
            kind = _KINDS[type(v)]
            text = v if kind == "string" else json.dumps(v) if kind in ("number", "bool") else None
            found.append({"key": k, "value": text, "kind": kind, "pos": pos})


def _no_number(name: str):
    raise ValueError(f"{name} is no JSON number")


def read_object(value: str | None) -> dict | None:
    """The JSON object of a text; None for anything else. Numbers that are none in JSON raise ValueError."""
    node = json.loads(value, parse_constant=_no_number) if value is not None else None
    return node if isinstance(node, dict) else None


def written(node) -> str:
    """`node` as JSON that every reader takes back: ValueError for infinite numbers and half surrogates."""
    text = json.dumps(node, ensure_ascii=False, allow_nan=False)
    text.encode()  # UnicodeEncodeError is a ValueError
    return text


def unfold(text: Column, wanted: Iterable[str], tokens: Iterable[str] | None = None) -> Column:
    """JSON text -> lower-cased document, its distinct keys, and all occurrences of wanted keys.

    `tokens` limits the listed keys to those anybody asks for. Anything but a JSON object gives NULL, and so
    does an object that cannot be written back as JSON (half surrogates, numbers beyond a double) or nests
    deeper than can be followed.
    """
    names = frozenset(wanted)
    asked = None if tokens is None else frozenset(tokens)

    @F.arrow_udf(UNFOLDED)
    def run(batch: pa.Array) -> pa.Array:
        out = []
        for value in batch.to_pylist():
            try:
                node = read_object(value)
                if node is None:
                    out.append(None)
                    continue
                node = lower_keys(node)
                keys: set = set()
                found: list = []
                walk(node, names, keys, found)
                shown = sorted(keys if asked is None else keys & asked)
                out.append({"doc": written(node), "keys": shown, "found": found})
            except (ValueError, RecursionError):
                out.append(None)
        return pa.array(out, type=_ARROW)

    return run(text)


def merged(left, right):
    """Objects merged at every depth, the right side winning."""
    if not (isinstance(left, dict) and isinstance(right, dict)):
        return right
    return {**left, **{k: merged(left[k], v) if k in left else v for k, v in right.items()}}


def merge(left: Column, right: Column) -> Column:
    """Deep merge of two JSON object texts; the values of `right` win. NULL or unreadable text counts as {}."""

    def read(value):
        try:
            return read_object(value) or {}
        except (ValueError, RecursionError):
            return {}

    def both(x, y):
        x, y = read(x), read(y)
        for attempt in (lambda: merged(x, y), lambda: x, dict):  # what cannot be written counts as unreadable
            try:
                return written(attempt())
            except (ValueError, RecursionError):
                continue

    @F.arrow_udf(T.StringType())
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([both(x, y) for x, y in zip(a.to_pylist(), b.to_pylist())], type=pa.string())

    return run(left, right)


def split_json_blocks(df: DataFrame, col: str, out: str = "block") -> DataFrame:
    """One row per JSON object of a text that holds several, found by counting braces."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(batch: pa.Array) -> pa.Array:
        rows = []
        for value in batch.to_pylist():
            depth, start, blocks = 0, 0, []
            for i, ch in enumerate(value or ""):
                depth += (ch == "{") - (ch == "}")
                if depth == 0:
                    block = value[start : i + 1].strip()
                    start = i + 1
                    if block:
                        blocks.append(block)
            rows.append(blocks)
        return pa.array(rows, type=pa.list_(pa.string()))

    return df.withColumn("_blocks", run(F.col(col))).withColumn(out, F.explode("_blocks")).drop("_blocks")
