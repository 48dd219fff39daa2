"""The rule engine: threshold and deadman rules over one scan, claims, folding, alert rows."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass, field as dc_field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.functions.jsonfn import field, record_json, record_lookup, render, template_fields
from vigilake.functions.scalars import stable_id
from vigilake.functions.templates import has_sections, render_document
from vigilake.operators.query import InvalidCriteria, criteria_column, criteria_expr
from vigilake.plans.blocked import first_n
from vigilake.schema import ALERT_SCHEMA, SHELL_FIELDS
from vigilake.sources.rules import Rule
from vigilake.sources.tables import as_datetime, clamp_minutes, scan_events, ts_lit

log = logging.getLogger(__name__)

ALL = "all"


@dataclass(frozen=True)
class Watch:
    """One condition to evaluate: a rule, or one slot of a sequence rule."""

    no: int
    rule: Rule
    spec: Rule
    slot_no: int | None = None


@dataclass
class Evaluation:
    """What one tick produced. All parts are lazy DataFrames over the same scan."""

    alerts: DataFrame
    claimed: DataFrame  # (alert_id, watch_no, eventid, utctimestamp): every event of every alert
    failed: list[tuple[str, str]] = dc_field(default_factory=list)
    watches: list[Watch] = dc_field(default_factory=list)  # what `watch_no` refers to


TAG_END = "\u001f"  # no tag holds it, a comma may


def watches_of(rules: Sequence[Rule], first_slots: bool = True) -> list[Watch]:
    """Plain rules and the first slot of sequences, in rule order."""
    out: list[Watch] = []
    for rule in rules:
        if rule.alert_type == "sequence":
            if first_slots and rule.slots:
                out.append(Watch(len(out), rule, rule.slots[0], 0))
        else:
            out.append(Watch(len(out), rule, rule))
    return out


def check_rules(events: DataFrame, rules: Sequence[Rule]) -> tuple[list[Rule], list[tuple[str, str]]]:
    """Split rules into usable ones and (name, reason). Only analyses expressions; no job runs.

    All criteria are analysed together; one by one only when that fails, to find the bad ones.
    """
    columns = events.columns

    def conditions(rule: Rule) -> list[Column]:
        specs = rule.slots if rule.alert_type == "sequence" else (rule,)
        if not specs:
            raise InvalidCriteria("no slots in sequence")
        if any(not s.criteria.strip() for s in specs):
            raise InvalidCriteria("empty criteria")
        return [criteria_expr(columns, s.criteria) for s in specs if not template_fields(s.criteria)]

    def analyse(conds: list[Column]) -> None:
        for f in events.select(*[c.alias(f"c{i}") for i, c in enumerate(conds)]).schema.fields:
            if f.dataType.simpleString() != "boolean":
                raise InvalidCriteria(f"criteria must be true or false, not {f.dataType.simpleString()}")

    ready, failed = [], []
    for rule in rules:
        try:
            ready.append((rule, conditions(rule)))
        except Exception as e:  # noqa: BLE001 - a bad rule must not stop the others
            failed.append((rule, e))
    try:
        analyse([c for _, conds in ready for c in conds])
        good = [rule for rule, _ in ready]
    except Exception:  # noqa: BLE001
        good = []
        for rule, conds in ready:
            try:
                analyse(conds)
                good.append(rule)
            except Exception as e:  # noqa: BLE001
                failed.append((rule, e))
    order = {id(r): i for i, r in enumerate(rules)}
    failed.sort(key=lambda pair: order[id(pair[0])])
    for rule, e in failed:
        log.error("rule %s failed: %s", rule.alert_name, str(e).splitlines()[0])
    return good, [(rule.alert_name, str(e).splitlines()[0]) for rule, e in failed]


def lookback(events: DataFrame, minutes: object, as_of: datetime | str, closed: bool = False) -> DataFrame:
    return scan_events(events, as_of, minutes, closed)


def key_value(events: DataFrame, spec: Rule) -> Column:
    """The grouping value of a rule; lists and objects group under their JSON text."""
    return field(events, spec.aggregation_key, nested_text=True) if spec.keyed else F.lit(ALL)


def of_watch(watches: Sequence[Watch], pick) -> Column:
    """A per-watch constant looked up by `watch_no` from a literal array."""
    return F.element_at(F.array(*[F.lit(pick(w)) for w in watches]), F.col("watch_no") + 1)


def hits(events: DataFrame, watches: Sequence[Watch], as_of: datetime | str, closed: bool = False) -> DataFrame:
    """One row per (event, watch) match with the grouping value: all watches in a single scan.

    The scan reaches back as far as the longest watch; shorter ones add their own time bound.
    """
    end = as_datetime(as_of)
    longest = max(clamp_minutes(w.spec.lookback_minutes) for w in watches)
    recent = scan_events(events, as_of, longest, closed)
    columns, found = events.columns, []
    for w in watches:
        minutes = clamp_minutes(w.spec.lookback_minutes)
        cond = criteria_expr(columns, w.spec.criteria)
        if minutes < longest:
            cond = (F.col("utctimestamp") >= ts_lit(end - timedelta(minutes=minutes))) & cond
        value = key_value(events, w.spec)
        if w.spec.keyed:
            cond = cond & value.isNotNull()
        found.append(F.when(cond, F.struct(F.lit(w.no).alias("watch_no"), value.alias("value"))))
    keep = [c for c in SHELL_FIELDS if c in events.columns]
    # explode_outer: a plain explode makes the optimizer infer a filter that repeats all conditions
    matched = recent.select(*keep, F.explode_outer(F.array_compact(F.array(*found))).alias("_hit"))
    return matched.filter(F.col("_hit").isNotNull()).select(*keep, "_hit.watch_no", "_hit.value")


def count_hits(found: DataFrame) -> DataFrame:
    """Matches per (watch, value); combined in the map tasks, so hot values cost nothing extra."""
    return found.groupBy("watch_no", "value").agg(F.count(F.lit(1)).alias("event_count"))


def count_by_key(events: DataFrame, path: str = "") -> DataFrame:
    """Counts by the value at a path, most frequent first; without a path one group named `all`."""
    rule = Rule("count", aggregation_key=path)
    if not rule.keyed:
        return events.agg(F.count(F.lit(1)).alias("event_count")).select(F.lit(ALL).alias("value"), "event_count")
    value = key_value(events, rule)
    return (
        events.filter(value.isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), "value")
    )


def threshold_triggers(counts: DataFrame, watches: Sequence[Watch]) -> DataFrame:
    """(watch, value) groups of threshold watches that reached their threshold."""
    kind = of_watch(watches, lambda w: w.spec.alert_type)
    return counts.filter((kind != "deadman") & (F.col("event_count") >= of_watch(watches, lambda w: w.spec.limit)))


def deadman_triggers(counts: DataFrame, watches: Sequence[Watch]) -> DataFrame:
    """(watch, value) groups of deadman watches at or below their threshold.

    A watch nothing matched fires once with count 0, under the name of its key.
    """
    spark = counts.sparkSession
    rows = [(w.no, w.spec.aggregation_key if w.spec.keyed else ALL) for w in watches if w.spec.alert_type == "deadman"]
    kind = of_watch(watches, lambda w: w.spec.alert_type)
    seen = counts.filter(kind == "deadman")
    # ceilings are looked up in a literal; only the numbers of the watches that saw something meet the rules
    low = seen.filter(F.col("event_count") <= of_watch(watches, lambda w: w.spec.limit))
    silent = spark.createDataFrame(rows, "watch_no int, value string").join(seen.select("watch_no").distinct(), "watch_no", "left_anti")
    silent = silent.select("watch_no", "value", F.lit(0).cast("long").alias("event_count"))
    return low.select("watch_no", "value", "event_count").unionByName(silent)


def synthetic_event(as_of: datetime | str) -> Column:
    """The stand-in event of a deadman that saw nothing."""
    rec = {
        "utctimestamp": ts_lit(as_of), "eventid": F.lit(None).cast("string"), "severity": F.lit("INFO"),
        "summary": F.lit("Expected event not found"), "category": F.lit("deadman"), "source": F.lit("deadman"),
        "tags": F.array(F.lit("deadman")), "plugins": F.array().cast("array<string>"),
        "details": F.parse_json(F.lit("{}")),
    }
    record = F.to_json(F.struct(*[c.alias(n) for n, c in rec.items()]))
    return F.array(
        F.struct(rec["utctimestamp"].alias("utctimestamp"), rec["eventid"].alias("eventid"), record.alias("record"))
    )


# --- claims ------------------------------------------------------------------


def _id_key() -> Column:
    """Join key for event ids. Rows without an id never match and are spread instead of piling up."""
    blank = F.coalesce(F.col("eventid"), F.lit("")) == ""
    return F.when(blank, F.concat(F.lit("\u0001"), F.xxhash64("utctimestamp", "summary"))).otherwise(F.col("eventid"))


def new_events(found: DataFrame, processed: DataFrame | None) -> DataFrame:
    """Rows whose event no alert has used yet; rows without an id always stay."""
    if processed is None:
        return found
    done = processed.select(F.col("eventid").alias("_key")).filter(F.col("_key") != "")
    return found.withColumn("_key", _id_key()).join(done, "_key", "left_anti").drop("_key")


def claim_events(found: DataFrame, scope: str = "global", order: Sequence[str] = ("watch_no", "value")) -> DataFrame:
    """Give every event to the first watch in order that wants it.

    With `scope='rule'` each watch keeps its own claims. Events without an id are not claimed by anyone.
    """
    if scope == "rule":
        return found
    blank = F.coalesce(F.col("eventid"), F.lit("")) == ""
    first = F.row_number().over(Window.partitionBy("_key").orderBy(*order))
    return found.withColumn("_key", _id_key()).withColumn("_rn", first).filter(blank | (F.col("_rn") == 1)).drop("_key", "_rn")


# --- alert rows --------------------------------------------------------------


def sample_events(found: DataFrame, watches: Sequence[Watch], least: int = 0, most: int | None = None) -> DataFrame:
    """(watch_no, value, events): the first events of each group by (time, id), as many as the watch asks.

    Only that many rows per group and map task reach the shuffle.
    """
    wanted = {w.no: _samples_needed(w) for w in watches}
    ceiling = max([least, *wanted.values(), 1])
    n = F.greatest(of_watch(watches, lambda w: wanted[w.no]), F.lit(least))
    kept = first_n(found, ["watch_no", "value"], [F.col("utctimestamp"), F.col("eventid")], n, ceiling)
    one = F.struct("rn", "utctimestamp", "eventid", record_json(found).alias("record"))
    return kept.groupBy("watch_no", "value").agg(F.sort_array(F.collect_list(one)).alias("_s")).select(
        "watch_no", "value",
        F.transform("_s", lambda s: F.struct(
            s["utctimestamp"].alias("utctimestamp"), s["eventid"].alias("eventid"), s["record"].alias("record")
        )).alias("events"),
    )


def _samples_needed(w: Watch) -> int:
    """Samples a watch embeds, or reaches into from its own or its sequence's summary."""
    deepest = 0
    for path in template_fields(w.spec.summary):
        m = re.match(r"events\.(\d+)\.", path)
        if m:
            deepest = max(deepest, int(m.group(1)) + 1)
    return max(w.spec.samples, deepest)


def alert_lookup(spec: Rule):
    """Template lookup inside a trigger: metadata, sampled events, then the rule's own fields."""

    def look(path: str) -> Column:
        if path == "metadata.value":
            return F.col("value")
        if path == "metadata.count":
            return F.col("event_count")
        m = re.match(r"events\.(\d+)\.(.+)", path)
        if m:
            record = F.get(F.col("events"), F.lit(int(m.group(1))))["record"]
            return record_lookup(record)(m.group(2))
        own = getattr(spec, path, None)
        return F.lit(None if own is None or isinstance(own, tuple) else str(own)).cast("string")

    return look


def _snippet(template: str):
    return lambda event: render(template, record_lookup(event["record"]))


def sectioned(spec: Rule) -> bool:
    return has_sections(spec.summary) or has_sections(spec.event_snippet)


def render_sections(spec: Rule) -> Column:
    """Summary and snippets of one rule by the full template syntax; lists are of the events an alert shows."""
    own = {k: v for k, v in vars(spec).items() if isinstance(v, (str, int))}
    parts = F.to_json(F.struct(F.col("value"), F.col("event_count").alias("count")))
    records = F.array_join(F.transform("events", lambda e: e["record"]), ",")
    document = F.concat(F.lit(json.dumps(own)[:-1] + ', "metadata": '), parts, F.lit(', "events": ['), records, F.lit("]}"))
    text = render_document(spec.summary, F.try_parse_json(document))
    if not (spec.event_snippet and spec.samples):
        return text
    shots = F.transform(F.slice("events", 1, spec.samples), lambda e: render_document(spec.event_snippet, F.try_parse_json(e["record"])))
    return F.concat_ws(" ", text, F.when(F.size(shots) > 0, F.concat_ws(" ", shots)))


def render_summary(watches: Sequence[Watch]) -> Column:
    """Summary plus one rendered snippet per sampled event, each watch with its own templates."""
    out = F.lit("")
    for w in watches:
        if sectioned(w.spec):
            out = F.when(F.col("watch_no") == w.no, render_sections(w.spec)).otherwise(out)
            continue
        text = render(w.spec.summary, alert_lookup(w.spec))
        if w.spec.event_snippet and w.spec.samples:
            shots = F.transform(F.slice("events", 1, w.spec.samples), _snippet(w.spec.event_snippet))
            text = F.concat_ws(" ", text, F.when(F.size(shots) > 0, F.concat_ws(" ", shots)))
        out = F.when(F.col("watch_no") == w.no, text).otherwise(out)
    return out


def alert_rows(triggers: DataFrame, watches: Sequence[Watch], as_of: datetime | str) -> DataFrame:
    """Triggers (watch_no, value, event_count, new_count, summary, events) as alert records."""
    name = of_watch(watches, lambda w: w.rule.alert_name)
    tags = of_watch(watches, lambda w: TAG_END.join(w.rule.tags))
    cols = {
        "alert_id": stable_id(name, F.col("value"), F.lit(as_datetime(as_of).isoformat())),
        "alert_name": name,
        "alert_type": of_watch(watches, lambda w: w.rule.alert_type),
        "severity": of_watch(watches, lambda w: w.rule.severity),
        "category": of_watch(watches, lambda w: w.rule.category),
        "tags": F.when(tags == "", F.array().cast("array<string>")).otherwise(F.split(tags, TAG_END)),
        "status": F.lit("OPEN"),
        "created_at": ts_lit(as_of),
        "deadman_hits": F.lit(None).cast("long"),
        "last_triggered_at": F.lit(None).cast("timestamp"),
    }
    cols.update({c: F.col(c) for c in ("summary", "value", "event_count", "new_count", "events")})
    return triggers.select("watch_no", *[cols[f.name].cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA])


def threshold(
    events: DataFrame,
    watches: Sequence[Watch],
    as_of: datetime | str,
    processed: DataFrame | None = None,
    scope: str = "global",
    closed: bool = False,
) -> Evaluation:
    """All threshold watches on one scan: counts, claims, alert rows, and each alert's events.

    Counting and claiming read the window twice instead of shuffling every matching event for the count.
    """
    ws = [w for w in watches if w.spec.alert_type != "deadman"]
    renumbered = [Watch(i, w.rule, w.spec, w.slot_no) for i, w in enumerate(ws)]
    found = hits(events, renumbered, as_of, closed)
    fired = threshold_triggers(count_hits(found), renumbered)
    members = found.join(fired, ["watch_no", "value"])
    mine = claim_events(new_events(members, processed), scope)
    fresh = mine.groupBy("watch_no", "value").agg(F.count(F.lit(1)).alias("new_count"))
    # the summary shows the first events of the window, the alert embeds the first new ones
    shown = sample_events(members, renumbered)
    summaries = (
        fired.join(shown, ["watch_no", "value"]).withColumn("summary", render_summary(renumbered)).drop("events")
    )
    embedded = sample_events(mine, renumbered, least=1)
    full = summaries.join(fresh, ["watch_no", "value"]).join(embedded, ["watch_no", "value"])
    alerts = alert_rows(full, renumbered, as_of)
    claimed = mine.join(alerts.select("alert_id", "watch_no", "value"), ["watch_no", "value"]).select(
        "alert_id", "watch_no", "eventid", "utctimestamp"
    )
    return Evaluation(alerts, claimed, watches=renumbered)


def deadman(
    events: DataFrame, watches: Sequence[Watch], as_of: datetime | str, closed: bool = False
) -> DataFrame:
    """Alert rows of all deadman watches. Groups that fire hold at most `threshold` events each."""
    ws = [w for w in watches if w.spec.alert_type == "deadman"]
    renumbered = [Watch(i, w.rule, w.spec, w.slot_no) for i, w in enumerate(ws)]
    found = hits(events, renumbered, as_of, closed)
    fired = deadman_triggers(count_hits(found), renumbered)
    # every event of a firing group is kept: there are at most `threshold` of them
    seen = sample_events(
        found.join(fired.select("watch_no", "value"), ["watch_no", "value"]),
        renumbered,
        least=max(w.spec.limit for w in renumbered) or 1,
    )
    full = fired.join(seen, ["watch_no", "value"], "left").withColumn(
        "events", F.coalesce("events", synthetic_event(as_of))
    )
    full = full.withColumn("summary", render_summary(renumbered)).withColumn("new_count", F.col("event_count"))
    return alert_rows(full, renumbered, as_of)


def fold_deadman(open_alerts: DataFrame, fired: DataFrame, caps: dict[str, int], as_of: datetime | str) -> DataFrame:
    """Fold deadman triggers of one tick into the open alert of the same name, or open one.

    Returns the changed or new alert rows: hits grow by the number of triggers, the newest `cap` events
    stay. Several triggers of one name count one after the other, as if they came one by one.
    """
    order = [F.col("event_count").desc(), F.col("value").asc()]
    position = F.row_number().over(Window.partitionBy("alert_name").orderBy(*order))
    # only the first trigger (it may open the alert) and the last `cap` ones (their events may stay) matter
    ceiling = max([*caps.values(), 3, 1])
    tail = F.row_number().over(Window.partitionBy("alert_name").orderBy(F.col("event_count"), F.col("value").desc()))
    n = fired.groupBy("alert_name").agg(F.count(F.lit(1)).alias("_hits"))
    head = fired.withColumn("_p", position).filter(F.col("_p") == 1).drop("_p")
    last = (
        fired.withColumn("_t", tail)
        .filter(F.col("_t") <= ceiling)
        .groupBy("alert_name")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("_t")).alias("o"), "events"))).alias("_tail"))
        .select("alert_name", F.flatten(F.transform("_tail", lambda t: t["events"])).alias("_new"))
    )
    current = (
        open_alerts.filter((F.col("status") == "OPEN") & (F.col("alert_type") == "deadman"))
        .groupBy("alert_name")
        .agg(F.min_by(F.struct("*"), F.struct("created_at", "alert_id")).alias("_open"))
    )
    cap = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in caps.items() for x in kv]), F.col("alert_name"))
        if caps else F.lit(None).cast("int"),
        F.lit(3),
    )
    cap = F.greatest(cap, F.lit(1))
    joined = head.join(n, "alert_name").join(last, "alert_name").join(current, "alert_name", "left")
    known = F.col("_open").isNotNull()
    both = F.concat(F.col("_open.events"), F.col("_new"))
    kept = lambda a: F.slice(a, F.greatest(F.size(a) - cap + 1, F.lit(1)), cap)
    # a fresh alert starts with all events of its first trigger; folding starts at the second
    fresh_events = F.when(F.col("_hits") == 1, F.col("events")).otherwise(kept(F.col("_new")))
    cols = {f.name: F.when(known, F.col(f"_open.{f.name}")).otherwise(F.col(f.name)) for f in ALERT_SCHEMA}
    cols["deadman_hits"] = F.when(
        known, F.coalesce(F.col("_open.deadman_hits"), F.lit(1)) + F.col("_hits")
    ).otherwise(F.col("_hits"))
    cols["last_triggered_at"] = ts_lit(as_of)
    cols["events"] = F.when(known, kept(both)).otherwise(fresh_events)
    return joined.select(
        *[cols[f.name].cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA],
        (~known).alias("first_hit"),
    )


def evaluate_rules(
    events: DataFrame,
    rules: Sequence[Rule],
    as_of: datetime | str,
    processed: DataFrame | None = None,
    scope: str = "global",
    closed: bool = False,
) -> Evaluation:
    """Threshold and deadman rules together; sequences are in `operators.sequence`."""
    good, failed = check_rules(events, rules)
    watches = watches_of([r for r in good if r.alert_type != "sequence"])
    empty = events.sparkSession.createDataFrame([], ALERT_SCHEMA)
    out = Evaluation(empty, None, failed)
    if any(w.spec.alert_type != "deadman" for w in watches):
        part = threshold(events, watches, as_of, processed, scope, closed)
        out.alerts, out.claimed = part.alerts.drop("watch_no"), part.claimed
    if any(w.spec.alert_type == "deadman" for w in watches):
        out.alerts = out.alerts.unionByName(deadman(events, watches, as_of, closed).drop("watch_no"))
    return out


def rolling_rule_counts(events: DataFrame, watch: Watch, path: str = "") -> DataFrame:
    """Trailing count per value at every matching event: a rule's lookback slid over the data."""
    from vigilake.plans.ranges import rolling_count

    value = key_value(events, watch.spec)
    rows = events.filter(criteria_column(events, watch.spec.criteria) & value.isNotNull()).select(
        "eventid", "utctimestamp", value.alias("value")
    )
    return rolling_count(rows, ["value"], "utctimestamp", clamp_minutes(watch.spec.lookback_minutes) * 60, "n")


def fanout_metrics(evaluated: int, failed: int) -> dict:
    return {"status": "degraded" if failed else "ok", "published": evaluated, "failed": failed}
