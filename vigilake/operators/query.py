"""Ad-hoc queries over events and record filters over result tables."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilake.functions.jsonfn import field, jv, parse_field_path, path_to_string, variant_path
from vigilake.schema import (
    DEFAULT_QUERY_LIMIT, DEFAULT_QUERY_MINUTES, LIFTED, MAX_LOOKBACK_MINUTES, MAX_QUERY_LIMIT,
    TOP_LEVEL_STRING_FIELDS,
)
from vigilake.sources.tables import clamp_minutes, scan_events, within

# --- criteria ----------------------------------------------------------------

# Words a criteria text may not contain.
FORBIDDEN_WORDS = (
    "insert", "update", "delete", "merge", "drop", "create", "alter", "truncate", "grant", "revoke",
    "call", "begin", "commit", "rollback", "export", "load", "copy", "information_schema", "session_user",
)
MAX_CRITERIA_CHARS = 4000
_FORBIDDEN = re.compile(r"\b(" + "|".join(FORBIDDEN_WORDS) + r")\b", re.IGNORECASE)
_COMMENT_MARKS = ("--", "/*", "*/", "#")


class InvalidCriteria(ValueError):
    pass


def validate_criteria(criteria: str | None) -> str:
    """The stripped text, or InvalidCriteria. Empty means everything in the window."""
    text = (criteria or "").strip()
    if len(text) > MAX_CRITERIA_CHARS:
        raise InvalidCriteria(f"criteria have {len(text)} characters, {MAX_CRITERIA_CHARS} are accepted")
    if ";" in text:
        raise InvalidCriteria("one expression is accepted, a semicolon would end it")
    if any(mark in text for mark in _COMMENT_MARKS):
        raise InvalidCriteria("leave comments out of the criteria")
    word = _FORBIDDEN.search(text)
    if word:
        raise InvalidCriteria(f"{word.group(0)} has no place in a condition")
    return text


_LITERAL = r"'(?:[^'\\]|\\.)*'"
_PATH = r"(?:\.\w+|\.\"[^\"]+\"|\[\d+\]|\[\"[^\"]+\"\])+"
_SPELLING = re.compile(
    rf"\b(?:json_value|json_extract_scalar|string_of)\s*\(\s*details\s*,\s*'\$(?P<given>{_PATH})'\s*\)"
    rf"|\b(?:json_value|string)\s*\(\s*details(?P<scalar>{_PATH})\s*\)"
    rf"|\bjson_value_array\s*\(\s*details(?P<array>{_PATH})\s*\)"
    rf"|(?P<item>{_LITERAL})\s+(?P<no>not\s+)?in\s+unnest\s*\(\s*(?P<list>\w+)\s*\)"
    rf"|{_LITERAL}|\bcast\s*(?=\()|\bint64\b|\bfloat64\b|\bstrpos\s*(?=\()|\bregexp_contains\s*(?=\()",
    re.IGNORECASE,
)


_WORDS = {
    "cast": "try_cast", "int64": "BIGINT", "float64": "DOUBLE", "strpos": "instr", "regexp_contains": "regexp_like",
}


def adapt_spelling(criteria: str, columns: Sequence[str] = ()) -> str:
    """Accept the warehouse spellings existing rules use.

    `JSON_VALUE(details.a.b)`, `STRING(details.a.b)` and `json_value(details, '$.a.b')` become the
    lifted column if there is one, else a scalar extraction; `'x' IN UNNEST(tags)` becomes
    `array_contains`; casts become `try_cast`, so one odd value yields NULL instead of failing the
    query. Text inside quotes is left alone.
    """

    def swap(m: re.Match) -> str:
        text = m.group(0)
        if m["item"]:
            return f"{m['no'] or ''}array_contains({m['list']}, {m['item']})"
        path = m["given"] or m["scalar"] or m["array"]
        if path:
            segs = parse_field_path(path.replace('"', "")) or []
            where = variant_path(segs)
            if m["array"]:
                return f"try_variant_get(details, '{where}', 'array<string>')"
            lifted = LIFTED.get(path_to_string(segs))
            if lifted in columns:
                return lifted
            got, raw = f"try_variant_get(details, '{where}', 'string')", f"try_variant_get(details, '{where}', 'variant')"
            return (
                f"(CASE WHEN substring({got}, 1, 1) IN ('{{', '[') "
                f"AND schema_of_variant({raw}) RLIKE '^(OBJECT|ARRAY)' THEN NULL ELSE {got} END)"
            )
        return _WORDS.get(text.lower().strip(), text)

    return _SPELLING.sub(swap, criteria)


def criteria_expr(columns: Sequence[str], criteria: str) -> Column:
    """The criteria in parentheses, so an OR cannot escape the window; not yet checked against a table."""
    text = criteria_text(columns, criteria)
    return F.expr(f"({text})") if text else F.lit(True)


def criteria_text(columns: Sequence[str], criteria: str) -> str:
    """The criteria as Spark reads them, or InvalidCriteria; needs no session."""
    text = validate_criteria(criteria)
    if re.search(r"\(\s*(select|with)\b", text, re.IGNORECASE):
        raise InvalidCriteria("criteria must not contain a query")
    return adapt_spelling(text, columns)


def criteria_column(events: DataFrame, criteria: str) -> Column:
    """`criteria_expr` checked to be a boolean over this table. Analysis only: no job runs."""
    cond = criteria_expr(events.columns, criteria)
    kind = events.select(cond.alias("c")).schema["c"].dataType
    if not isinstance(kind, T.BooleanType):
        raise InvalidCriteria(f"criteria must be true or false, not {kind.simpleString()}")
    return cond


def query_events(
    events: DataFrame,
    criteria: str = "",
    minutes: object = DEFAULT_QUERY_MINUTES,
    limit: object = DEFAULT_QUERY_LIMIT,
    *,
    as_of: datetime | str,
    most: int = MAX_QUERY_LIMIT,
) -> DataFrame:
    """Matching events of the trailing window, newest first. Empty criteria browses the window.

    At most `most` rows and the retention's length are served; a request beyond that is warned about.
    """
    window = _bounded("minutes", minutes, DEFAULT_QUERY_MINUTES, MAX_LOOKBACK_MINUTES)
    rows = _bounded("rows", limit, DEFAULT_QUERY_LIMIT, most)
    recent = scan_events(events, as_of, window)
    return newest_first(recent.filter(criteria_column(events, criteria)), rows)


def _bounded(what: str, asked: object, default: int, top: int) -> int:
    got = clamp_minutes(asked, default, top)
    if isinstance(asked, int) and asked > got:
        warnings.warn(f"{asked} {what} asked for, {got} served; raise the limit to get more", stacklevel=3)
    return got


def browse(
    events: DataFrame, minutes: object = DEFAULT_QUERY_MINUTES, limit: object = DEFAULT_QUERY_LIMIT, *, as_of, most: int = MAX_QUERY_LIMIT
) -> DataFrame:
    return query_events(events, "", minutes, limit, as_of=as_of, most=most)


def newest_first(df: DataFrame, limit: int, ts: str = "utctimestamp", tie: str = "eventid") -> DataFrame:
    """Top-n by time; the id decides between equal times, so repeated runs agree."""
    return df.orderBy(F.desc(ts), F.asc(tie)).limit(limit)


def log_search(events: DataFrame, since, until, source: str | None = None, text: str | None = None) -> DataFrame:
    """Time range, source and free text over summary and details."""
    out = within(events, since, until)
    if source:
        out = out.filter(F.col("source") == source)
    if text:
        needle = F.lit(text.lower())
        out = out.filter(
            F.lower("summary").contains(needle) | F.lower(F.to_json("details")).contains(needle)
        )
    return out


# --- condition rows ----------------------------------------------------------

ORDER_OPERATORS = (">", "<", ">=", "<=")


@dataclass(frozen=True)
class Condition:
    """One builder row. Fields: a shell column, `tags`, `plugins` or a path below `details`."""

    field: str
    operator: str
    value: str

    @property
    def incomplete(self) -> bool:
        return not self.field.strip() or self.value.strip() == ""


def _number(text: str) -> float | None:
    try:
        return float(text.strip())
    except ValueError:
        return None


def _compare(left: Column, op: str, right: Column) -> Column:
    return {
        "=": lambda: left == right, "!=": lambda: left != right,
        ">": lambda: left > right, "<": lambda: left < right,
        ">=": lambda: left >= right, "<=": lambda: left <= right,
    }[op]()


def row_predicate(events: DataFrame, row: Condition) -> Column | None:
    """SQL-style predicate of one row; None when the row is incomplete.

    A missing path compares to NULL, so it is excluded under every operator, `!=` included. `tags` and
    `plugins` know only member and not member. `contains` looks for the literal text.
    """
    if row.incomplete:
        return None
    name, op, value = row.field.strip(), row.operator, row.value
    if name in ("tags", "plugins"):
        member = F.array_contains(name, value)
        return ~member if op == "!=" else member
    if name in TOP_LEVEL_STRING_FIELDS:
        return F.col(name).contains(value) if op == "contains" else _compare(F.col(name), op, F.lit(value))
    path = name if name.startswith("details.") else f"details.{name}"
    got = field(events, path)
    if op == "contains":
        return got.contains(value)
    number = _number(value)
    if op in ORDER_OPERATORS and number is not None:
        return _compare(got.try_cast("double"), op, F.lit(number))
    return _compare(got, op, F.lit(value))


def all_rows(events: DataFrame, rows: Sequence[Condition]) -> Column:
    """All complete rows together."""
    preds = [p for p in (row_predicate(events, r) for r in rows) if p is not None]
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def row_for_path(path: Sequence[str | int], value: object) -> Condition | None:
    """Click-to-filter: a path into an event and its scalar value as a condition."""
    if not path or value is None or isinstance(value, (list, dict, tuple)):
        return None
    text = str(value).lower() if isinstance(value, bool) else str(value)
    root = path[0]
    if root in ("tags", "plugins") and len(path) == 2:
        return Condition(str(root), "=", text)
    if root in TOP_LEVEL_STRING_FIELDS and len(path) == 1:
        return Condition(str(root), "=", text)
    if root == "details" and len(path) > 1:
        return Condition(path_to_string(path), "=", text)
    return None


# --- record filters ----------------------------------------------------------


def _value_at(df: DataFrame, path: Sequence[str | int]) -> tuple[Column, T.DataType] | None:
    """The Column and type at a path of a nested result table; None when the schema has no such path.

    Below a VARIANT the type is not known beforehand, so its values count as text.
    """
    if not path or path[0] not in df.columns:
        return None
    col, kind = F.col(str(path[0])), df.schema[str(path[0])].dataType
    for i, seg in enumerate(path[1:], start=1):
        if isinstance(kind, T.VariantType):
            return jv(col, path[i:]), T.StringType()
        if isinstance(seg, int) and isinstance(kind, T.ArrayType):
            col, kind = F.get(col, F.lit(seg)), kind.elementType
        elif isinstance(seg, str) and isinstance(kind, T.StructType) and seg in kind.names:
            col, kind = col.getField(seg), kind[seg].dataType
        elif isinstance(seg, str) and isinstance(kind, T.MapType):
            col, kind = F.try_element_at(col, F.lit(seg)), kind.valueType
        else:
            return None
    return col, kind


def _as_text(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    if isinstance(kind, (T.StructType, T.MapType, T.VariantType)):
        return F.to_json(col)
    return col.cast("string")


def matches_row(df: DataFrame, row: Condition) -> Column:
    """Record-style match of one row, ignoring case. Incomplete rows match everything.

    A missing value matches only `!=`. Lists: `=` member, `!=` not a member, `contains` part of any
    element, order operators never. Order operators compare numbers when both sides are, else text.
    """
    path = parse_field_path(row.field)
    target = row.value.strip()
    if not row.field.strip() or target == "" or path is None:
        return F.lit(True)
    op, needle = row.operator, F.lit(target.lower())
    found = _value_at(df, path)
    if found is None:
        return F.lit(op == "!=")
    col, kind = found
    if isinstance(kind, T.ArrayType):
        items = F.transform(col, lambda x: F.lower(_as_text(x, kind.elementType)))
        hit = {
            "=": F.exists(items, lambda x: x == needle),
            "!=": ~F.exists(items, lambda x: x == needle),
            "contains": F.exists(items, lambda x: x.contains(needle)),
        }.get(op, F.lit(False))
        return F.coalesce(hit, F.lit(op == "!="))
    text = _as_text(col, kind)
    if op == "contains":
        hit = F.lower(text).contains(needle)
    elif op in ORDER_OPERATORS:
        number = _number(target)
        lexical = _compare(text, op, F.lit(target))
        if number is None:
            hit = lexical
        else:
            mine = text.try_cast("double")
            hit = F.when(mine.isNull(), lexical).otherwise(_compare(mine, op, F.lit(number)))
    else:
        hit = _compare(F.lower(text), op, needle)
    return F.coalesce(hit, F.lit(op == "!="))


def matches_all_rows(df: DataFrame, rows: Sequence[Condition]) -> Column:
    return reduce(lambda a, b: a & b, [matches_row(df, r) for r in rows], F.lit(True))


def deep_search(df: DataFrame, term: str, fields: Sequence[str] = (), whole_record: bool = True) -> DataFrame:
    """Case-insensitive text search in some fields and, unless switched off, the whole record."""
    if not term:
        return df
    needle = F.lit(term.lower())
    hits = [F.lower(F.col(f).cast("string")).contains(needle) for f in fields]
    if whole_record:
        hits.append(F.lower(F.to_json(F.struct("*"))).contains(needle))
    return df.filter(F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False)))


# --- result tables -----------------------------------------------------------


def select_columns(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """User-chosen columns from any path, each under its path string as name."""
    out = []
    for text in paths:
        found = _value_at(df, parse_field_path(text) or [])
        out.append((found[0] if found else F.lit(None).cast("string")).alias(text))
    return df.select(*out)


def column_label(path: str) -> str:
    """The last name in a path: the short header of a chosen column."""
    names = [s for s in parse_field_path(path) or [] if isinstance(s, str)]
    return names[-1] if names else path


def sort_any(df: DataFrame, path: str, descending: bool = False, tie: str | None = None) -> DataFrame:
    """Sort by any path: numbers by value, times by instant, the rest as text; missing values last."""
    found = _value_at(df, parse_field_path(path) or [])
    if found is None:
        return df
    col, kind = found
    if isinstance(kind, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType)):
        keys = [col]
    elif isinstance(kind, (T.StringType, T.BooleanType)):
        keys = [col.cast("string")]
    else:
        keys = [F.to_json(col)]
    order = [k.desc_nulls_last() if descending else k.asc_nulls_last() for k in keys]
    return df.orderBy(*order, *([F.asc(tie)] if tie else []))


def page(df: DataFrame, size: int, pages: int = 1, status: str | None = None, ts: str = "created_at", tie: str = "alert_id") -> DataFrame:
    """The newest `size * pages` records, optionally of one status."""
    kept = df.filter(F.col("status") == status) if status else df
    return kept.orderBy(F.desc(ts), F.asc(tie)).limit(size * pages)


def has_more(paged: DataFrame, size: int, pages: int = 1) -> bool:
    """True when the page came back full."""
    return paged.count() >= size * pages


def bounded_result(df: DataFrame, n: int = 500) -> dict:
    """At most `n` rows with their number and whether there were more; fetches n + 1 rows only."""
    rows = df.limit(n + 1).collect()
    return {"rows": rows[:n], "row_count": min(len(rows), n), "truncated": len(rows) > n}


def latest_row(df: DataFrame, ts: str = "utctimestamp", tie: str = "eventid") -> DataFrame:
    return df.orderBy(F.desc(ts), F.desc(tie)).limit(1)
