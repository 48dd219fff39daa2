"""JSON access on a VARIANT column: scalar extraction, dotted paths, templates.

A VARIANT cannot be grouped, joined or sorted, so everything here ends in a string (or an array of
strings); callers cast from there with `try_cast`, which keeps ANSI mode from failing a whole query
on one odd value.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.schema import LIFTED, LIFTED_ARRAYS, SHELL_FIELDS

Path = Sequence["str | int"]

_SEGMENT = re.compile(r"([^.\[\]]+)|\[(\d+)\]")
_TAG = re.compile(r"\{\{\s*([\w@.\-]+)\s*\}\}")


def parse_field_path(text: str) -> list[str | int] | None:
    """`details._ips[0]` -> ['details', '_ips', 0]; None when nothing is left."""
    path: list[str | int] = [
        int(m.group(2)) if m.group(1) is None else m.group(1) for m in _SEGMENT.finditer(text.strip())
    ]
    return path or None


def path_to_string(path: Path) -> str:
    """The inverse of `parse_field_path`."""
    text = ""
    for i, seg in enumerate(path):
        text += f"[{seg}]" if isinstance(seg, int) else (str(seg) if i == 0 else f".{seg}")
    return text


def variant_path(path: Path) -> str:
    """A VARIANT path with every key quoted, so `c-ip`, `@type` and the like are safe."""
    out = "$"
    for seg in path:
        out += f"[{seg}]" if isinstance(seg, int) else '["' + str(seg).replace('"', '\\"') + '"]'
    return out


def jv(doc: Column, path: Path | str) -> Column:
    """The scalar at `path` as string; NULL when missing, JSON null, object or array.

    Casting an object or array to string gives its JSON text, so only values that look like one are
    checked a second time; ordinary scalars cost a single extraction.
    """
    segs = parse_field_path(path) if isinstance(path, str) else list(path)
    where = variant_path(segs or [])
    text = F.try_variant_get(doc, where, "string")
    kind = F.schema_of_variant(F.try_variant_get(doc, where, "variant"))
    nested = F.substring(text, 1, 1).isin("{", "[") & kind.rlike("^(OBJECT|ARRAY)")
    return F.when(nested, F.lit(None)).otherwise(text)


def jtext(doc: Column, path: Path | str) -> Column:
    """Like `jv`, but objects and arrays come back as JSON text."""
    segs = parse_field_path(path) if isinstance(path, str) else list(path)
    return F.try_variant_get(doc, variant_path(segs or []), "string")


def jv_array(doc: Column, path: Path | str) -> Column:
    """The array of scalars at `path` as `array<string>`; NULL when it is not an array."""
    segs = parse_field_path(path) if isinstance(path, str) else list(path)
    return F.try_variant_get(doc, variant_path(segs or []), "array<string>")


def to_json_string(doc: Column) -> Column:
    return F.to_json(doc)


def has_path(doc: Column, path: Path | str) -> Column:
    """True when the path exists with a value other than JSON null."""
    segs = parse_field_path(path) if isinstance(path, str) else list(path)
    return F.try_variant_get(doc, variant_path(segs or []), "variant").isNotNull()


def field(df: DataFrame, path: str, nested_text: bool = False) -> Column:
    """A dotted path on an event table as string, NULL on any miss.

    Shell columns and lifted columns are used as they are; the rest is taken from `details`. Detection
    rules may leave out the `details.` prefix only for shell columns. With `nested_text` a list or
    object counts under its JSON text (grouping keys); otherwise it is NULL.
    """
    segs = parse_field_path(path)
    if not segs:
        return F.lit(None).cast("string")
    root = segs[0]
    if len(segs) == 1 and root in df.columns and root != "details":
        kind = df.schema[str(root)].dataType.simpleString()
        col = F.col(str(root))
        return F.to_json(col) if kind.startswith(("array", "struct", "map")) else col.cast("string")
    if len(segs) == 2 and isinstance(segs[1], int) and root in ("tags", "plugins"):
        return F.try_element_at(F.col(str(root)), F.lit(segs[1] + 1))
    if root == "details" and len(segs) > 1:
        lifted = LIFTED.get(path_to_string(segs[1:]))
        if lifted and lifted in df.columns:
            return F.col(lifted)
        return (jtext if nested_text else jv)(F.col("details"), segs[1:])
    return F.lit(None).cast("string")


def detail(df: DataFrame, key: str) -> Column:
    """`details.<key>` from its lifted column if the table has one, else from the VARIANT."""
    return field(df, f"details.{key}")


def detail_array(df: DataFrame, key: str) -> Column:
    """`details.<key>` as `array<string>`, lifted or from the VARIANT."""
    lifted = LIFTED_ARRAYS.get(key)
    return F.col(lifted) if lifted in df.columns else jv_array(F.col("details"), key)


def lift(df: DataFrame) -> DataFrame:
    """Add the lifted columns a table does not have yet."""
    d = F.col("details")
    cols = {name: jv(d, key) for key, name in LIFTED.items()}
    cols.update({name: jv_array(d, key) for key, name in LIFTED_ARRAYS.items()})
    return df.withColumns({name: c for name, c in cols.items() if name not in df.columns})


def record_json(df: DataFrame) -> Column:
    """The whole event as JSON text, shell plus details, for samples and templates."""
    names = [c for c in SHELL_FIELDS if c in df.columns]
    return F.to_json(F.struct(*[F.col(c) for c in names]))


def template_fields(template: str) -> list[str]:
    return [m.group(1) for m in _TAG.finditer(template or "")]


def render(template: str | None, lookup) -> Column:
    """`{{a.b.0.c}}` substitution as one `concat`, split at plan time.

    `lookup(path)` returns the Column for a dotted path; missing values render as ''.
    """
    if not template:
        return F.lit("")
    parts: list[Column] = []
    pos = 0
    for m in _TAG.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos : m.start()]))
        parts.append(F.coalesce(lookup(m.group(1)).cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def dotted(path: str) -> list[str | int]:
    """Template path `slots.0.events.0.x`: all-digit segments are array positions."""
    return [int(p) if p.isdigit() else p for p in path.split(".")]


def record_lookup(record: Column):
    """Lookup for `render` over a record kept as JSON text."""
    doc = F.try_parse_json(record)
    return lambda path: jtext(doc, dotted(path))


def row_lookup(df: DataFrame):
    """Lookup for `render` over the columns of an event table."""
    return lambda path: field(df, re.sub(r"\.(\d+)(?=\.|$)", r"[\1]", path), nested_text=True)


def render_payload(template, lookup) -> Column:
    """A JSON template with each string leaf rendered; keys, numbers and flags stay as they are."""

    def build(node) -> Column:
        if isinstance(node, str):
            # {"s":"<escaped>"} is the JSON escaping Spark offers; keep the quoted text only
            wrapped = F.to_json(F.struct(render(node, lookup).alias("s")))
            return wrapped.substr(F.lit(6), F.length(wrapped) - 6)
        if isinstance(node, list):
            return F.concat(F.lit("["), F.concat_ws(",", *[build(x) for x in node]), F.lit("]"))
        if isinstance(node, dict):
            inner = [F.concat(F.lit(json.dumps(k, ensure_ascii=False) + ":"), build(v)) for k, v in node.items()]
            return F.concat(F.lit("{"), F.concat_ws(",", *inner), F.lit("}"))
        return F.lit(json.dumps(node))

    return build(template)


def dict_match(doc: Column, wanted: dict[str, object]) -> Column:
    """True when the object holds every given key with the given value."""
    cond = F.lit(True)
    for key, value in wanted.items():
        text = json.dumps(value) if isinstance(value, (bool, int, float)) else value
        got = jv(doc, [key])
        cond = cond & (got.eqNullSafe(F.lit(None if value is None else str(text))))
    return cond


def register_sql_functions(spark: SparkSession) -> None:
    """SQL functions rule and query criteria may use on `details`.

    `json_value(details, '$.a.b')` and its spelling variants give scalars, `json_value_array` arrays.
    Only temporary SQL functions are made; they are inlined into the plan, no Python runs.
    """
    body = (
        "CASE WHEN substring(try_variant_get(d, p, 'string'), 1, 1) IN ('{{', '[') "
        "AND schema_of_variant(try_variant_get(d, p, 'variant')) RLIKE '^(OBJECT|ARRAY)' "
        "THEN NULL ELSE try_variant_get(d, p, 'string') END"
    ).replace("{{", "{")
    for name in ("json_value", "json_extract_scalar", "string_of"):
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(d VARIANT, p STRING) RETURNS STRING RETURN {body}"
        )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION json_value_array(d VARIANT, p STRING) RETURNS ARRAY<STRING> "
        "RETURN try_variant_get(d, p, 'array<string>')"
    )
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION strpos(s STRING, t STRING) RETURNS INT RETURN instr(s, t)")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION regexp_contains(s STRING, r STRING) RETURNS BOOLEAN RETURN s RLIKE r"
    )
