"""Many rules at once: a predicate index instead of one condition per rule.

Of a rule's criteria the parts `column = 'text'`, `column IN (...)` (also spelled with OR) and
`array_contains(column, 'text')` that must all hold become data. One of them, the one whose texts the fewest
rules share, is the rule's way in: a hash table per column leads from an event's own texts to the rules that
may match. Only for those the other parts are checked, and only for what is no such part the criteria
themselves are evaluated, one CASE over the rule's number. So an event costs what its candidates cost, and the plan has
one lookup per column, one expression per distinct key and one per criteria with a rest.

More than FEW rules of a table never come together in one plan. They are read where they are (`TableRules`): of each
document the parts `column = 'text'` that must all hold become a join key, and what is left (the rest of the criteria, the
grouping path) makes a family. An event offers its own texts once per family and is joined with the rules by them;
constants and templates are joined by the rule's number. Rules that are no such data (deadman, sequences, templates with
sections, no such part, families beyond FAMILIES) are evaluated as before beside them; claims are settled over all.

Everything else a rule brings (threshold, names, tags, templates) is a constant table looked up by its number. Templates
are lists of parts; the values they name are taken once per distinct path (templates with sections are
expressions of their own). The alerts are those of
`detect.threshold` and `detect.deadman`.

Claims are settled on ids alone; whole events are read for the few that an alert shows. What is used more
than once (matches as ids and times, groups that fired, claims, samples) is written to the shared folder, so
evaluating runs jobs.

Defined cases: criteria without such a part belong to rules that are candidates for every event; an empty
rule list gives no rows; a null never equals a text; tags that repeat in one event count once.
"""

from __future__ import annotations

import json
import logging
import re
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field as dc_field
from datetime import datetime, timedelta
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from vigilake.functions.jsonfn import dotted, jtext, record_json, template_fields
from vigilake.functions.scalars import stable_id
from vigilake.operators import detect as d
from vigilake.operators.query import adapt_spelling, criteria_text, validate_criteria
from vigilake.plans.blocked import first_n
from vigilake.schema import ALERT_SCHEMA, SHELL_FIELDS
from vigilake.session import materialise
from vigilake.sources.rules import Documents, Rule, read_rule
from vigilake.sources.tables import as_datetime, clamp_minutes, scan_events, ts_lit

log = logging.getLogger(__name__)

FEW = 1_000  # rules of a table that are still put into the plan
FAMILIES = 100  # kinds of rules an event is offered to, each an expression of the plan

# --- what of a condition is data ---------------------------------------------


@dataclass(frozen=True)
class Part:
    """`column` equals one of `texts`, or holds it where the column is a list."""

    column: str
    texts: tuple[str, ...]


@dataclass
class Split:
    parts: list[Part] = dc_field(default_factory=list)
    rest: bool = False  # something is left that only the criteria themselves can say


def _tree(nodes: list[dict]) -> dict:
    """Spark's expression tree, from its nodes listed parents first."""
    node = nodes.pop(0)
    return {**node, "name": node["class"].rsplit(".", 1)[1], "children": [_tree(nodes) for _ in range(node["num-children"])]}


def _column(node: dict) -> str | None:
    """The name of a plain column, as parsed: `[a]`."""
    m = re.fullmatch(r"\[(\w+)\]", node.get("nameParts", "")) if node["name"] == "UnresolvedAttribute" else None
    return m.group(1).lower() if m else None


def _text(node: dict) -> str | None:
    return node["value"] if node["name"] == "Literal" and node.get("dataType") == "string" else None


def _part(node: dict, kinds: dict[str, str]) -> Part | None:
    kids = node["children"]
    if node["name"] == "EqualTo":
        for a, b in (kids, kids[::-1]):
            if kinds.get(_column(a)) == "string" and _text(b) is not None:
                return Part(_column(a), (_text(b),))
    if node["name"] == "In" and kinds.get(_column(kids[0])) == "string" and all(_text(k) is not None for k in kids[1:]):
        return Part(_column(kids[0]), tuple(dict.fromkeys(_text(k) for k in kids[1:])))
    if node["name"] == "Or":
        one, two = (_part(k, kinds) for k in kids)
        if one and two and one.column == two.column and kinds[one.column] == "string":
            return Part(one.column, tuple(dict.fromkeys(one.texts + two.texts)))
    if node["name"] == "UnresolvedFunction" and node["nameParts"].lower() == "[array_contains]" and len(kids) == 2:
        if kinds.get(_column(kids[0])) == "array<string>" and _text(kids[1]) is not None:
            return Part(_column(kids[0]), (_text(kids[1]),))
    return None


def split_criteria(events: DataFrame, criteria: Sequence[str]) -> list[Split]:
    """The indexable parts of each criteria text. Spark's own parser reads all of them in one call."""
    if not criteria:
        return []
    kinds = {f.name.lower(): f.dataType.simpleString() for f in events.schema.fields}
    texts = [adapt_spelling(validate_criteria(c), events.columns) or "true" for c in criteria]
    parser = events.sparkSession._jsparkSession.sessionState().sqlParser()
    whole = _tree(json.loads(parser.parseExpression("array(" + ", ".join(f"({t})" for t in texts) + ")").toJSON()))

    def gather(node: dict, into: Split) -> Split:
        if node["name"] == "And":
            for k in node["children"]:
                gather(k, into)
            return into
        part = _part(node, kinds)
        if part:
            into.parts.append(part)
        elif not (node["name"] == "Literal" and node.get("dataType") == "boolean" and node["value"] == "true"):
            into.rest = True
        return into

    return [gather(node, Split()) for node in whole["children"]]


# --- the index ---------------------------------------------------------------


def constant(rows: list, kind: str) -> Column:
    """A literal of any nested type in one step; Spark folds it once per plan."""
    return F.from_json(F.lit(json.dumps(rows)), kind)


def _lookup(table: dict[str, list[int]], text: Column) -> Column:
    """The numbers listed under a text: a hash table of short maps, so a lookup does not grow with the table."""
    buckets: list[dict] = [{} for _ in range(max(1, len(table)))]
    for key, numbers in table.items():
        buckets[zlib.crc32(key.encode()) % len(buckets)][key] = numbers
    held = constant(buckets, "array<map<string, array<int>>>")
    bucket = F.element_at(held, (F.crc32(text.cast("binary")) % len(buckets) + 1).cast("int"))
    return F.coalesce(F.try_element_at(bucket, text), F.array().cast("array<int>"))


@dataclass
class RuleIndex:
    """Watches with their way in. `ways` maps a column to {text: numbers}; `always` are candidates for every event."""

    watches: list[d.Watch]
    splits: list[Split]
    ways: dict[str, dict[str, list[int]]]
    always: list[int]

    @classmethod
    def build(cls, events: DataFrame, watches: Sequence[d.Watch]) -> "RuleIndex":
        splits = split_criteria(events, [w.spec.criteria for w in watches])
        load = Counter((p.column, t) for s in splits for p in s.parts for t in p.texts)
        ways: dict[str, dict[str, list[int]]] = {}
        always = []
        for w, s in zip(watches, splits):
            if not s.parts:
                always.append(w.no)
                continue
            way = min(s.parts, key=lambda p: sum(load[p.column, t] for t in p.texts))
            for t in way.texts:
                ways.setdefault(way.column, {}).setdefault(t, []).append(w.no)
        return cls(list(watches), splits, ways, always)

    def candidates(self, events: DataFrame) -> Column:
        """The numbers of the watches an event may match."""
        kinds = {f.name.lower(): f.dataType.simpleString() for f in events.schema.fields}
        found = [constant(self.always, "array<int>")] if self.always else []
        for column, table in self.ways.items():
            if kinds[column] == "string":
                found.append(_lookup(table, F.col(column)))
            else:
                found.append(F.coalesce(F.flatten(F.transform(F.array_distinct(column), lambda t: _lookup(table, t))), F.array().cast("array<int>")))
        return F.concat(*found) if found else F.array().cast("array<int>")

    def reaches(self, events: DataFrame) -> Column | None:
        """Whether an event has any of the ways' texts: a filter the scan can take; None when some rule has no way."""
        if self.always or not self.ways:
            return None
        kinds = {f.name.lower(): f.dataType.simpleString() for f in events.schema.fields}
        conds = []
        for column, table in self.ways.items():
            texts = list(table)
            conds.append(F.col(column).isin(texts) if kinds[column] == "string" else F.arrays_overlap(F.col(column), constant(texts, "array<string>")))
        return reduce(lambda a, b: a | b, conds)


def _blank() -> Column:
    return F.coalesce(F.col("eventid"), F.lit("")) == ""


def hits(events: DataFrame, index: RuleIndex, as_of: datetime | str, closed: bool = False, whole: bool = True) -> DataFrame:
    """One row per (event, watch) match with the grouping value, as `detect.hits`; not `whole`: ids and times only."""
    watches = index.watches
    # without an id an event is told by its time and summary
    slim = ["utctimestamp", "eventid", F.when(_blank(), F.col("summary")).alias("summary")]
    keep = [c for c in SHELL_FIELDS if c in events.columns] if whole else slim
    if not watches:
        return events.limit(0).select(*keep, F.lit(0).alias("watch_no"), F.lit("").alias("value"))
    end = as_datetime(as_of)
    minutes = [clamp_minutes(w.spec.lookback_minutes) for w in watches]
    recent = scan_events(events, as_of, max(minutes), closed)
    near = index.reaches(events)
    recent = recent if near is None else recent.filter(near)

    columns = sorted({p.column for s in index.splits for p in s.parts})
    keys = list(dict.fromkeys(w.spec.aggregation_key if w.spec.keyed else "" for w in watches))
    rest = [w.no for w, s in zip(watches, index.splits) if s.rest]
    epoch = datetime(1970, 1, 1)
    table = constant(
        [
            {
                "since": round((end - timedelta(minutes=m) - epoch) / timedelta(microseconds=1)), "key": keys.index(w.spec.aggregation_key if w.spec.keyed else ""),
                "rest": s.rest, "checks": [{"c": columns.index(p.column) + 1, "t": list(p.texts)} for p in s.parts],
            }
            for w, s, m in zip(watches, index.splits, minutes)
        ],
        "array<struct<since: bigint, key: int, rest: boolean, checks: array<struct<c: int, t: array<string>>>>>",
    )
    kinds = {f.name.lower(): f.dataType.simpleString() for f in events.schema.fields}
    own = [F.array(F.col(c)) if kinds[c] == "string" else F.col(c) for c in columns]
    # explode_outer: a plain explode makes the optimizer infer a filter that looks everything up a second time
    offered = recent.withColumn("watch_no", F.explode_outer(index.candidates(events))).filter(F.col("watch_no").isNotNull())
    offered = offered.withColumn("_rule", F.element_at(table, F.col("watch_no") + 1)).filter(F.unix_micros("utctimestamp") >= F.col("_rule.since"))
    if columns:
        held = F.array(*own)
        has = lambda k: F.exists(k["t"], lambda t: F.coalesce(F.array_contains(F.element_at(held, k["c"]), t), F.lit(False)))
        offered = offered.filter(F.forall("_rule.checks", has))
    if rest:
        texts = {w.no: adapt_spelling(validate_criteria(w.spec.criteria), events.columns) or "true" for w in watches}
        case = "CASE watch_no " + " ".join(f"WHEN {n} THEN ({texts[n]})" for n in rest) + " END"
        offered = offered.filter(~F.col("_rule.rest") | F.expr(case))
    value = reduce(lambda a, i: F.when(F.col("_rule.key") == i, d.key_value(events, Rule("key", aggregation_key=keys[i]))).otherwise(a), range(len(keys)), F.lit(None).cast("string"))
    matched = offered.select(*keep, "watch_no", value.alias("value"))
    return matched.filter(F.col("value").isNotNull())


# --- constants and templates by number ---------------------------------------

_PART = "array<struct<text: string, ref: int>>"
_ROW = (
    "array<struct<alert_name: string, alert_type: string, severity: string, category: string, tags: array<string>, kind: string, "
    f"bound: bigint, samples: int, needed: int, silent: string, summary: {_PART}, snippet: {_PART}>>"
)


def pieces(template: str, ref) -> list[dict]:
    """A template as texts and what `ref` says to the paths it names."""
    out, at = [], 0
    for m in re.finditer(r"\{\{\s*([\w@.\-]+)\s*\}\}", template or ""):
        out += [{"text": template[at : m.start()]}, ref(m.group(1))]
        at = m.end()
    return [p for p in [*out, {"text": (template or "")[at:]}] if p != {"text": ""}]


def own_text(spec: Rule, path: str) -> str:
    own = getattr(spec, path, None)
    return "" if own is None or isinstance(own, tuple) else str(own)


class RuleTable:
    """The constants of the watches, looked up by `watch_no`, and their templates."""

    def __init__(self, watches: Sequence[d.Watch]):
        self.events: list[tuple[int, str]] = []  # (event, path) the summaries name
        self.paths: list[str] = []  # paths the snippets name
        self.sections = [w for w in watches if d.sectioned(w.spec)]  # rendered each by an expression of its own
        rows = []
        for w in watches:
            rule, spec = w.rule, w.spec
            rows.append({
                "alert_name": rule.alert_name, "alert_type": rule.alert_type, "severity": rule.severity, "category": rule.category,
                "tags": list(rule.tags), "kind": spec.alert_type, "bound": spec.limit, "samples": spec.samples, "needed": d._samples_needed(w),
                "silent": spec.aggregation_key if spec.keyed else d.ALL,
                "summary": self._summary(spec) if w not in self.sections else [],
                "snippet": self._snippet(spec) if spec.event_snippet and spec.samples and w not in self.sections else None,
            })
        self.needed = max([r["needed"] for r in rows], default=0)
        self.table = constant(rows, _ROW)

    def on(self, df: DataFrame) -> DataFrame:
        """`df` (watch_no) with what `of` reads."""
        return df

    def of(self, name: str) -> Column:
        return F.element_at(self.table, F.col("watch_no") + 1)[name]

    def _place(self, items: list, item) -> int:
        if item not in items:
            items.append(item)
        return items.index(item)

    def _summary(self, spec: Rule) -> list[dict]:
        def ref(path: str) -> dict:
            if path in ("metadata.value", "metadata.count"):
                return {"ref": 0 if path == "metadata.value" else 1}
            m = re.match(r"events\.(\d+)\.(.+)", path)
            if m:
                return {"ref": 2 + self._place(self.events, (int(m.group(1)), m.group(2)))}
            return {"text": own_text(spec, path)}

        return pieces(spec.summary, ref)

    def _snippet(self, spec: Rule) -> list[dict]:
        return pieces(spec.event_snippet, lambda path: {"ref": self._place(self.paths, path)})

    def rendered(self) -> Column:
        """Summary and snippets from the columns watch_no, value, event_count and events."""

        def put(parts: Column, values: Column) -> Column:
            return F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.get(values, p["ref"]), F.lit(""))), "")

        def doc(event: Column) -> Column:
            return F.try_parse_json(event["record"])

        values = [F.col("value"), F.col("event_count").cast("string")]
        values += [jtext(doc(F.get(F.col("events"), F.lit(n))), dotted(p)) for n, p in self.events]
        text = put(self.of("summary"), F.array(*values))
        if not self.paths:
            bare = self.of("snippet")
            shots = F.transform(F.slice("events", 1, self.of("samples")), lambda _: put(bare, F.array().cast("array<string>")))
        else:
            shots = F.transform(F.slice("events", 1, self.of("samples")), lambda e: put(self.of("snippet"), F.array(*[jtext(doc(e), dotted(p)) for p in self.paths])))
        out = F.when(self.of("snippet").isNull() | (F.size(shots) == 0), text).otherwise(F.concat_ws(" ", text, F.concat_ws(" ", shots)))
        for w in self.sections:
            out = F.when(F.col("watch_no") == w.no, d.render_sections(w.spec)).otherwise(out)
        return out

    def alert_rows(self, triggers: DataFrame, as_of: datetime | str) -> DataFrame:
        """Triggers (watch_no, value, event_count, new_count, summary, events) as alert records with `watch_no`."""
        cols = {c: self.of(c) for c in ("alert_name", "alert_type", "severity", "category", "tags")}
        cols |= {c: F.col(c) for c in ("summary", "value", "event_count", "new_count", "events")}
        cols |= {
            "alert_id": stable_id(self.of("alert_name"), F.col("value"), F.lit(as_datetime(as_of).isoformat())), "status": F.lit("OPEN"),
            "created_at": ts_lit(as_of), "deadman_hits": F.lit(None).cast("long"), "last_triggered_at": F.lit(None).cast("timestamp"),
        }
        return triggers.select("watch_no", *[cols[f.name].cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA])


def samples(found: DataFrame, rules: RuleTable, least: int = 0) -> DataFrame:
    """(watch_no, value, events): the first events of each group by (time, id), as many as the rule needs."""
    n = F.greatest(rules.of("needed"), F.lit(least))
    kept = first_n(rules.on(found), ["watch_no", "value"], [F.col("utctimestamp"), F.col("eventid")], n, max(least, rules.needed, 1))
    one = F.struct("rn", "utctimestamp", "eventid", record_json(found).alias("record"))
    shots = F.transform("_s", lambda s: F.struct(s["utctimestamp"].alias("utctimestamp"), s["eventid"].alias("eventid"), s["record"].alias("record")))
    return kept.groupBy("watch_no", "value").agg(F.sort_array(F.collect_list(one)).alias("_s")).select("watch_no", "value", shots.alias("events"))


# --- evaluation --------------------------------------------------------------


def threshold(
    events: DataFrame, watches: Sequence[d.Watch], as_of: datetime | str, processed: DataFrame | None = None, scope: str = "global", closed: bool = False
) -> d.Evaluation:
    """All threshold watches, as `detect.threshold`: alerts (with `watch_no`), claims, and the watches as numbered."""
    ws = [d.Watch(i, w.rule, w.spec, w.slot_no) for i, w in enumerate(w for w in watches if w.spec.alert_type != "deadman")]
    index = RuleIndex.build(events, ws)
    out = settled(events, RuleTable(ws), lambda e, picks, whole: hits(e, index, as_of, closed, whole=whole), as_of, processed, scope)
    out.watches = ws
    return out


def settled(events: DataFrame, rules: RuleTable, search, as_of: datetime | str, processed: DataFrame | None, scope: str) -> d.Evaluation:
    """Alerts and claims of the threshold rules whose matches `search(events, picks, whole)` finds, where there are picks at least theirs."""
    group = ["watch_no", "value"]
    # the window is searched once; counts, claims and samples are settled on ids and times
    found = materialise(search(events, None, False), "hits")
    counts = d.count_hits(found)
    fired = materialise(rules.on(counts).filter(F.col("event_count") >= rules.of("bound")).select(*counts.columns), "fired")
    members = found.join(fired.select(*group), group)
    mine = materialise(d.claim_events(d.new_events(members, processed), scope), "claims")
    fresh = mine.groupBy(*group).agg(F.count(F.lit(1)).alias("new_count"))

    # the summary shows the first events of the window, the alert embeds its first new ones; both are read together
    order, needed = [F.col("utctimestamp"), F.col("eventid")], max(1, rules.needed)
    # a group without a new event makes no alert: nothing is read for it, and where none has any the events are not searched again
    telling = members.join(fresh.select(*group), group, "left_semi")
    one = first_n(rules.on(telling), group, order, rules.of("needed"), needed).select(*members.columns, F.lit(1).alias("use"))
    two = first_n(rules.on(mine), group, order, F.greatest(rules.of("needed"), F.lit(1)), needed).select(*members.columns, F.lit(2).alias("use"))
    same = {"_id": F.coalesce("eventid", F.lit("")), "_of": F.when(_blank(), F.coalesce("summary", F.lit(""))).otherwise("")}
    picks = one.unionByName(two).withColumns(same).groupBy(*group, "utctimestamp", *same).agg(F.collect_set("use").alias("uses"))
    whole = search(events if not mine.isEmpty() else events.filter(F.lit(False)), picks, True)
    read = materialise(whole.withColumns(same).join(picks, [*group, "utctimestamp", *same]).select(*whole.columns, "uses"), "samples")
    shown = samples(read.filter(F.array_contains("uses", 1)), rules)
    embedded = samples(read.filter(F.array_contains("uses", 2)), rules, least=1)

    told = rules.on(fired.join(shown, group)).withColumn("summary", rules.rendered()).drop("events")
    alerts = rules.alert_rows(told.join(fresh, group).join(embedded, group), as_of)
    claimed = mine.join(alerts.select("alert_id", *group), group).select("alert_id", "watch_no", "eventid", "utctimestamp")
    return d.Evaluation(alerts, claimed)


def deadman(events: DataFrame, watches: Sequence[d.Watch], as_of: datetime | str, closed: bool = False) -> DataFrame:
    """Alert rows (with `watch_no`) of all deadman watches, as `detect.deadman`, and of expected groups that are absent."""
    ws = [d.Watch(i, w.rule, w.spec, w.slot_no) for i, w in enumerate(w for w in watches if w.spec.alert_type == "deadman")]
    index, rules = RuleIndex.build(events, ws), RuleTable(ws)
    group = ["watch_no", "value"]
    counts = materialise(d.count_hits(hits(events, index, as_of, closed, whole=False)), "counts")
    every = events.sparkSession.range(len(ws)).select(F.col("id").cast("int").alias("watch_no"))
    silent = every.join(counts.select("watch_no").distinct(), "watch_no", "left_anti").select("watch_no", rules.of("silent").alias("value"), F.lit(0).cast("long").alias("event_count"))
    named = [(w.no, v) for w in ws if w.spec.keyed for v in dict.fromkeys(w.spec.expected_values)]
    if named:
        # an expected group that is absent counts 0, whatever the others do; it stands in for the rule as a whole
        expected = events.sparkSession.createDataFrame(named, "watch_no int, value string")
        absent = expected.join(counts.select(*group), group, "left_anti").withColumn("event_count", F.lit(0).cast("long"))
        silent = silent.join(expected.select("watch_no").distinct(), "watch_no", "left_anti").unionByName(absent)
    fired = counts.filter(F.col("event_count") <= rules.of("bound")).unionByName(silent)
    # every event of a firing group is kept: there are at most `bound` of them
    seen = samples(hits(events, index, as_of, closed).join(fired.select(*group), group), rules, least=max([w.spec.limit for w in ws], default=1) or 1)
    full = fired.join(seen, group, "left").withColumn("events", F.coalesce("events", d.synthetic_event(as_of)))
    return rules.alert_rows(full.withColumn("summary", rules.rendered()).withColumn("new_count", F.col("event_count")), as_of)


def evaluate(
    events: DataFrame, rules: Sequence[Rule], as_of: datetime | str, processed: DataFrame | None = None, scope: str = "global", closed: bool = False
) -> d.Evaluation:
    """Threshold and deadman rules together, as `detect.evaluate_rules`, however many there are."""
    if isinstance(rules, Documents) and rules.table is not None and rules.table.limit(FEW + 1).count() > FEW:
        return evaluate_table(events, rules, as_of, processed, scope, closed)
    good, failed = d.check_rules(events, rules)
    watches = d.watches_of([r for r in good if r.alert_type != "sequence"])
    out = d.Evaluation(events.sparkSession.createDataFrame([], ALERT_SCHEMA), None, failed)
    if any(w.spec.alert_type != "deadman" for w in watches):
        part = threshold(events, watches, as_of, processed, scope, closed)
        out.alerts, out.claimed, out.watches = part.alerts.drop("watch_no"), part.claimed, part.watches
    if any(w.spec.alert_type == "deadman" for w in watches):
        out.alerts = out.alerts.unionByName(deadman(events, watches, as_of, closed).drop("watch_no"))
    return out


# --- rules that stay a table -------------------------------------------------

_LEX = re.compile(r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|[()\[\]]|->|\b(?:and|or|xor|between|case)\b", re.IGNORECASE)
_EQUAL = re.compile(r"(?P<c1>[a-z_]\w*)\s*={1,2}\s*'(?P<t1>[^'\\]*)'|'(?P<t2>[^'\\]*)'\s*={1,2}\s*(?P<c2>[a-z_]\w*)", re.IGNORECASE)


def equal_parts(text: str, strings: set[str]) -> tuple[list[str], list[str], str] | None:
    """(columns, texts, rest) of a condition as Spark reads it: its parts `column = 'text'` that must all hold, and the others.

    None where there is no such part or the condition is not plainly one AND after the other.
    """
    parts, depth, at = [], 0, 0
    for m in _LEX.finditer(text):
        token = m.group().lower()
        depth += (token in ("(", "[")) - (token in (")", "]"))
        if depth == 0 and token == "and":
            parts.append(text[at : m.start()])
            at = m.end()
        elif depth == 0 and token in ("or", "xor", "between", "case", "->"):
            return None
    found, rest = [], []
    for part in [*parts, text[at:]]:
        m = _EQUAL.fullmatch(part.strip())
        column = m and (m["c1"] or m["c2"]).lower()
        if column in strings:
            found.append((column, m["t1"] if m["c1"] else m["t2"]))
        else:
            rest.append(part.strip())
    found.sort(key=lambda x: x[0])
    return ([c for c, _ in found], [t for _, t in found], " AND ".join(f"({r})" for r in rest)) if found else None


_TEXTS, _PIECES = pa.list_(pa.string()), pa.list_(pa.struct([("text", pa.string()), ("path", pa.string())]))
_DATA = pa.schema([
    ("name", pa.string()), ("yaml", pa.string()), ("error", pa.string()), ("data", pa.bool_()), ("columns", _TEXTS), ("texts", _TEXTS), ("rest", pa.string()), ("key", pa.string()),
    ("minutes", pa.int32()), ("alert_name", pa.string()), ("alert_type", pa.string()), ("severity", pa.string()), ("category", pa.string()), ("tags", _TEXTS),
    ("bound", pa.int64()), ("samples", pa.int32()), ("needed", pa.int32()), ("summary", _PIECES), ("snippet", _PIECES),
])


def data_of(name: str, text: str, columns: list[str], strings: set[str]) -> dict:
    """One document as a row of _DATA: `error` where it is none, not `data` where only a plan of its own can say what it means."""
    row = {"name": name, "yaml": text, "data": False}
    try:
        rule = read_rule(text)
    except Exception as e:  # noqa: BLE001 - any defect of one document stays with that document
        log.error("rule %s refused: %s", name, e)
        return row | {"error": str(e)}
    try:
        found = equal_parts(criteria_text(columns, rule.criteria), strings)
    except ValueError:  # it is refused where it is evaluated
        return row
    watch = d.Watch(0, rule, rule)
    if rule.alert_type in ("deadman", "sequence") or found is None or template_fields(rule.criteria) or d.sectioned(rule):
        return row

    def ref(path: str) -> dict:
        return {"path": path} if path in ("metadata.value", "metadata.count") or re.match(r"events\.(\d+)\.(.+)", path) else {"text": own_text(rule, path)}

    return row | {
        "data": True, "columns": found[0], "texts": found[1], "rest": found[2], "key": rule.aggregation_key if rule.keyed else "", "minutes": clamp_minutes(rule.lookback_minutes),
        "alert_name": rule.alert_name, "alert_type": rule.alert_type, "severity": rule.severity, "category": rule.category, "tags": list(rule.tags), "bound": rule.limit,
        "samples": rule.samples, "needed": d._samples_needed(watch), "summary": pieces(rule.summary, ref),
        "snippet": pieces(rule.event_snippet, lambda path: {"path": path}) if rule.event_snippet and rule.samples else None,
    }


def rule_rows(table: DataFrame, events: DataFrame) -> DataFrame:
    """The documents of a rules table (name, yaml) in the order of names, as rows of _DATA with `watch_no`, which grows in that order."""
    columns, strings = events.columns, {f.name.lower() for f in events.schema.fields if f.dataType.simpleString() == "string"}
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pylist([data_of(n, t or "", columns, strings) for n, t in zip(*(b[c].to_pylist() for c in ("name", "yaml")))], schema=_DATA)

    named = table.select(F.coalesce(F.col("name").cast("string"), F.lit("None")).alias("name"), "yaml")
    rows = named.mapInArrow(run, from_arrow_schema(_DATA)).orderBy("name")
    return materialise(rows.withColumn("watch_no", F.monotonically_increasing_id()), "rules")


class TableRules(RuleTable):
    """Many rules with their constants as a table, and few that are evaluated as `watches` beside it, numbered as `numbers` says."""

    def __init__(self, rows: DataFrame, watches: Sequence[d.Watch], numbers: Sequence[int]):
        super().__init__(watches)
        own, numbered = self.table, F.array(*map(F.lit, numbers)).cast("array<long>")
        self.sections = [d.Watch(numbers[w.no], w.rule, w.spec, w.slot_no) for w in self.sections]
        used = rows.select(F.explode("summary").alias("p")).select("p.path").distinct().filter("path LIKE 'events.%'")
        for path in sorted(r["path"] for r in used.collect()):
            m = re.match(r"events\.(\d+)\.(.+)", path)
            self._place(self.events, (int(m.group(1)), m.group(2)))
        for r in sorted(r["path"] for r in rows.select(F.explode("snippet").alias("p")).select("p.path").distinct().filter("path IS NOT NULL").collect()):
            self._place(self.paths, r)
        summary = {"metadata.value": 0, "metadata.count": 1} | {f"events.{n}.{p}": 2 + i for i, (n, p) in enumerate(self.events)}
        parts = {"summary": summary, "snippet": {p: i for i, p in enumerate(self.paths)}}

        def placed(name: str) -> Column:
            places = F.from_json(F.lit(json.dumps(parts[name])), "map<string, int>")
            return F.transform(name, lambda p: F.struct(p["text"].alias("text"), F.when(p["path"].isNotNull(), F.try_element_at(places, p["path"])).alias("ref")))

        cols = {"kind": F.col("alert_type"), "silent": F.lit(d.ALL)} | {n: placed(n) for n in parts}
        kind = T.DataType.fromDDL(_ROW).elementType
        whole = rows.select("watch_no", F.struct(*[cols.get(n, F.col(n)).alias(n) for n in kind.names]).cast(kind).alias("_rule"))
        if watches:
            few = rows.sparkSession.range(len(watches)).select(F.element_at(numbered, (F.col("id") + 1).cast("int")).alias("watch_no"), F.element_at(own, (F.col("id") + 1).cast("int")).alias("_rule"))
            whole = whole.unionByName(few)
        self.rules = materialise(whole, "constants")
        self.needed = max(self.needed, rows.agg(F.max("needed")).first()[0] or 0)

    def on(self, df: DataFrame) -> DataFrame:
        return df.join(self.rules, "watch_no")

    def of(self, name: str) -> Column:
        return F.col("_rule")[name]


def families_of(rows: DataFrame, events: DataFrame) -> list[dict]:
    """The kinds of rules an event is offered to, the most frequent ones; what Spark does not accept is left out."""
    out = []
    kinds = rows.filter("data").groupBy("columns", "rest", "key").agg(F.count(F.lit(1)).alias("n"))
    for r in kinds.orderBy(F.desc("n"), "columns", "rest", "key").limit(FAMILIES).collect():
        cond = F.expr(r["rest"]) if r["rest"] else F.lit(True)
        try:
            if events.select(cond.alias("c"), d.key_value(events, Rule("key", aggregation_key=r["key"])).alias("v")).schema["c"].dataType.simpleString() == "boolean":
                out.append(r.asDict() | {"cond": cond})
        except Exception:  # noqa: BLE001 - its rules are refused one by one
            continue
    return out


def table_hits(events: DataFrame, rows: DataFrame, families: list[dict], as_of: datetime | str, closed: bool, minutes: int, whole: bool) -> DataFrame:
    """As `hits`, of rules that stay a table: an event offers its texts to each family and meets the rules that ask for them."""
    slim = ["utctimestamp", "eventid", F.when(_blank(), F.col("summary")).alias("summary")]
    keep = [c for c in SHELL_FIELDS if c in events.columns] if whole else slim
    offers = []
    for i, f in enumerate(families):
        texts, value = [F.col(c) for c in f["columns"]], d.key_value(events, Rule("key", aggregation_key=f["key"]))
        ready = reduce(lambda a, b: a & b, [*[t.isNotNull() for t in texts], value.isNotNull()])
        offers.append(F.when(ready, F.struct(F.lit(i).alias("family"), F.array(*texts).alias("texts"), value.alias("value"))))
    recent = scan_events(events, as_of, minutes, closed)
    offered = recent.withColumn("_o", F.explode_outer(F.array_compact(F.array(*offers)))).filter(F.col("_o").isNotNull())
    end = round((as_datetime(as_of) - datetime(1970, 1, 1)) / timedelta(microseconds=1))
    asked = rows.select(F.struct("family", "texts").alias("_k"), F.col("family").alias("_f"), "watch_no", (F.lit(end) - F.col("minutes").cast("long") * 60_000_000).alias("_since"))
    met = offered.withColumn("_k", F.struct("_o.family", "_o.texts")).join(asked, "_k").filter(F.unix_micros("utctimestamp") >= F.col("_since"))
    if any(f["rest"] for f in families):
        # by the rule's family, so that it is asked of events with the rule's texts only: what guards it stands among these
        met = met.filter(reduce(lambda a, i: F.when(F.col("_f") == i, families[i]["cond"]).otherwise(a), range(len(families)), F.lit(False)))
    return met.select(*keep, "watch_no", F.col("_o.value").alias("value"))


def evaluate_table(events: DataFrame, rules: Documents, as_of: datetime | str, processed: DataFrame | None, scope: str, closed: bool) -> d.Evaluation:
    """`evaluate` for more rules than a plan can hold; `watches` of the outcome is empty, as `watch_no` numbers rows of a table."""
    rows = rule_rows(rules.table, events)
    families = families_of(rows, events)
    known = [{"family": i, **{c: f[c] for c in ("columns", "rest", "key")}} for i, f in enumerate(families)]
    held = events.sparkSession.createDataFrame(known, "family int, columns array<string>, rest string, key string")
    named = rows.join(held, ["columns", "rest", "key"], "left")
    data = named.filter("data AND family IS NOT NULL")
    lone = named.filter("error IS NULL AND NOT (data AND family IS NOT NULL)").select("watch_no", "yaml").orderBy("watch_no").collect()
    # files come first
    from_files = rules.parsed(rules.texts)
    numbered = [(i - len(from_files), r) for i, r in enumerate(from_files)] + [(r["watch_no"], read_rule(r["yaml"])) for r in lone]
    good, failed = d.check_rules(events, [r for _, r in numbered])
    number = {id(r): n for n, r in numbered}
    watches = d.watches_of([r for r in good if r.alert_type != "sequence"])
    ws = [d.Watch(i, w.rule, w.spec, w.slot_no) for i, w in enumerate(w for w in watches if w.spec.alert_type != "deadman")]
    numbers = [number[id(w.rule)] for w in ws]
    index, table = RuleIndex.build(events, ws), TableRules(data, ws, numbers)
    minutes = data.agg(F.max("minutes")).first()[0] or 1

    def search(e: DataFrame, picks: DataFrame | None, whole: bool) -> DataFrame:
        if picks is not None:
            # what is shown is read whole: only events that may be among it meet the rules again
            near = picks.select(F.col("utctimestamp").alias("_at"), "_id").distinct()
            e = e.join(near, (F.col("utctimestamp") == F.col("_at")) & (F.coalesce("eventid", F.lit("")) == F.col("_id")), "left_semi")
        found = [table_hits(e, data, families, as_of, closed, minutes, whole)] if families else []
        if ws or not families:
            each = F.array(*map(F.lit, numbers)).cast("array<long>")
            found.append(hits(e, index, as_of, closed, whole=whole).withColumn("watch_no", F.element_at(each, F.col("watch_no") + 1)))
        return reduce(DataFrame.unionByName, found)

    out = settled(events, table, search, as_of, processed, scope)
    out.alerts, out.failed = out.alerts.drop("watch_no"), failed
    if any(w.spec.alert_type == "deadman" for w in watches):
        out.alerts = out.alerts.unionByName(deadman(events, watches, as_of, closed).drop("watch_no"))
    return out


__all__ = ["Part", "RuleIndex", "RuleTable", "TableRules", "deadman", "evaluate", "hits", "split_criteria", "template_fields", "threshold"]
