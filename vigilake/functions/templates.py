"""Templates with sections, compiled to nested array expressions over a document.

`{{a.b}}` is the value at a path, `{{{a.b}}}` and `{{&a.b}}` the same (nothing is escaped for HTML: alerts are text),
`{{.}}` the item itself. `{{#a}}..{{/a}}` repeats for each item of a list, shows once inside an object, once for
any other value that is not false, empty or missing; `{{^a}}..{{/a}}` shows where `{{#a}}` would not.
`{{! }}` is a remark. A name is looked up in the innermost section first and then outward. The text is parsed
once when the plan is made; a section over a list becomes a `transform` of the list, joined up.

Defined cases: missing values and nulls are empty; objects and lists give their JSON text; an unclosed or
wrongly closed section is refused; a standalone section line keeps its line end.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigilake.functions.jsonfn import dotted, variant_path

TAG = re.compile(r"\{\{\{\s*(?P<bare>[^}]*?)\s*\}\}\}|\{\{\s*(?P<kind>[#^/&!]?)\s*(?P<name>[^}]*?)\s*\}\}", re.S)


class BadTemplate(ValueError):
    pass


@dataclass
class Node:
    """A text, a value (`path`), or a section (`path`, `inner`, `inverted`)."""

    text: str | None = None
    path: str | None = None
    inner: list["Node"] | None = None
    inverted: bool = False


@dataclass
class _Level:
    path: str | None
    inverted: bool = False
    nodes: list[Node] = field(default_factory=list)


def parse(template: str | None) -> list[Node]:
    """The template as a tree."""
    text, at, levels = template or "", 0, [_Level(None)]
    for m in TAG.finditer(text):
        if m.start() > at:
            levels[-1].nodes.append(Node(text=text[at : m.start()]))
        at = m.end()
        kind, name = ("", m["bare"]) if m["bare"] is not None else (m["kind"], m["name"])
        if kind in ("#", "^"):
            levels.append(_Level(name, kind == "^"))
        elif kind == "/":
            done = levels.pop()
            if done.path != name or not levels:
                raise BadTemplate(f"{{{{/{name}}}}} closes no section")
            levels[-1].nodes.append(Node(path=name, inner=done.nodes, inverted=done.inverted))
        elif kind != "!" and name:
            levels[-1].nodes.append(Node(path=name))
    if len(levels) > 1:
        raise BadTemplate(f"{{{{#{levels[-1].path}}}}} is not closed")
    if at < len(text):
        levels[-1].nodes.append(Node(text=text[at:]))
    return levels[0].nodes


def has_sections(template: str | None) -> bool:
    return bool(re.search(r"\{\{\s*[#^/&!]|\{\{\{", template or ""))


def paths_of(nodes: list[Node]) -> list[str]:
    """All paths a template names."""
    return [p for n in nodes for p in ([n.path] if n.path else []) + paths_of(n.inner or [])]


def _part(context: Column, path: str, kind: str) -> Column:
    if path == ".":
        return F.try_variant_get(context, "$", kind)
    return F.try_variant_get(context, variant_path(dotted(path)), kind)


def _first(contexts: list[Column], path: str, kind: str) -> Column:
    """The value at a path in the innermost context that has it."""
    if path == ".":
        return _part(contexts[-1], path, kind)
    found = [_part(c, path, kind) for c in reversed(contexts)]
    return F.coalesce(*found) if len(found) > 1 else found[0]


def _render(nodes: list[Node], contexts: list[Column]) -> Column:
    parts = []
    for node in nodes:
        if node.text is not None:
            parts.append(F.lit(node.text))
        elif node.inner is None:
            parts.append(F.coalesce(_first(contexts, node.path, "string"), F.lit("")))
        else:
            text = _first(contexts, node.path, "string")
            items = F.when(text.startswith("["), _first(contexts, node.path, "array<variant>"))
            shown = text.isNotNull() & ~text.isin("", "false", "[]", "{}")
            if node.inverted:
                parts.append(F.when(F.coalesce(shown, F.lit(False)), F.lit("")).otherwise(_render(node.inner, contexts)))
                continue
            each = F.array_join(F.transform(items, lambda item: _render(node.inner, [*contexts, item])), "")
            once = _render(node.inner, [*contexts, _first(contexts, node.path, "variant")])
            parts.append(F.when(~F.coalesce(shown, F.lit(False)), F.lit("")).when(items.isNotNull(), each).otherwise(once))
    return F.concat(*parts) if parts else F.lit("")


def render_document(template: str | None, document: Column) -> Column:
    """The template filled from a VARIANT document."""
    return _render(parse(template), [document])
