"""Sequence rules on state tables: start, advance, complete, expire."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions.jsonfn import record_json, record_lookup, render
from vigilake.functions.scalars import is_expired, lifespan_seconds, stable_id
from vigilake.operators import detect as d
from vigilake.operators.query import InvalidCriteria, adapt_spelling, validate_criteria
from vigilake.plans.blocked import first_n, ranked
from vigilake.schema import ALERT_SCHEMA, INFLIGHT_SCHEMA, SHELL_FIELDS, SLOT_STATE
from vigilake.sources.rules import Rule
from vigilake.sources.tables import scan_events, ts_lit

_QUOTED_TAG = re.compile(r"'\{\{\s*([\w@.\-]+)\s*\}\}'")
_BARE_TAG = re.compile(r"\{\{\s*([\w@.\-]+)\s*\}\}")


@dataclass
class SequenceTick:
    inflight: DataFrame  # the state after the tick
    alerts: DataFrame  # completed sequences
    claimed: DataFrame  # (owner, eventid, utctimestamp)


def expire_inflight(inflight: DataFrame, as_of: datetime | str) -> DataFrame:
    """State that is still alive. Expired rows go before anything is evaluated."""
    return inflight.filter(~is_expired(F.col("expiration"), as_of))


def slot_state(slot_no: int | Column, name: Column, as_of: datetime | str) -> Column:
    """State of a slot that was just filled, from columns value, event_count, summary, first_event."""
    no = F.lit(slot_no) if isinstance(slot_no, int) else slot_no
    cols = {"slot_no": no, "alert_name": name, "filled_at": ts_lit(as_of)}
    cols.update({c: F.col(c) for c in ("value", "event_count", "summary", "first_event")})
    return F.struct(*[cols[f.name].cast(f.dataType).alias(f.name) for f in SLOT_STATE])


def start(triggered: DataFrame, watches: Sequence[d.Watch], as_of: datetime | str) -> DataFrame:
    """Alert rows of first slots (with `watch_no`) as new in-flight sequences."""
    life = lifespan_seconds(d.of_watch(watches, lambda w: w.rule.lifespan or ""))
    first = triggered.withColumn("first_event", F.get("events", F.lit(0))["record"])
    cols = {
        "inflight_id": stable_id(F.lit("inflight"), F.col("alert_id")),
        "expiration": F.timestamp_seconds(F.unix_seconds(ts_lit(as_of)) + life),
        "summary": d.of_watch(watches, lambda w: w.rule.summary),
        "created_at": ts_lit(as_of),
        "slots": F.array(slot_state(0, d.of_watch(watches, lambda w: w.spec.alert_name), as_of)),
    }
    cols.update({c: F.col(c) for c in ("alert_name", "severity", "category", "tags")})
    return first.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in INFLIGHT_SCHEMA])


def sequence_start(events, rules: Sequence[Rule], as_of, processed=None, scope="global", closed=False) -> SequenceTick:
    """Evaluate first slots only; `tick.run_tick` evaluates them together with the plain rules."""
    watches = d.watches_of([r for r in rules if r.alert_type == "sequence"])
    spark = events.sparkSession
    born = spark.createDataFrame([], INFLIGHT_SCHEMA)
    claimed = spark.createDataFrame([], "owner string, eventid string, utctimestamp timestamp")
    if any(w.spec.alert_type != "deadman" for w in watches):
        ev = d.threshold(events, watches, as_of, processed, scope, closed)
        born = born.unionByName(start(ev.alerts, ev.watches, as_of))
        claimed = ev.claimed.select(F.col("alert_id").alias("owner"), "eventid", "utctimestamp")
    dead = [w for w in watches if w.spec.alert_type == "deadman"]
    if dead:
        again = [d.Watch(i, w.rule, w.spec, w.slot_no) for i, w in enumerate(dead)]
        born = born.unionByName(start(d.deadman(events, dead, as_of, closed), again, as_of))
    return SequenceTick(born, spark.createDataFrame([], ALERT_SCHEMA), claimed)


# --- references to earlier slots ---------------------------------------------


def inflight_lookup(path: str) -> Column:
    """`slots.<i>.events.0.<path>`, `slots.<i>.metadata.value|count`, `slots.<i>.summary`, own fields."""
    m = re.match(r"slots\.(\d+)\.(.+)", path)
    if not m:
        if path == "metadata.count":
            return F.aggregate("slots", F.lit(0).cast("long"), lambda a, s: a + s["event_count"])
        if path == "metadata.value":
            return F.get("slots", F.lit(0))["value"]
        return F.col(path) if path in INFLIGHT_SCHEMA.names else F.lit(None).cast("string")
    slot, rest = F.get("slots", F.lit(int(m.group(1)))), m.group(2)
    inner = re.match(r"events\.0\.(.+)", rest)
    if inner:
        return record_lookup(slot["first_event"])(inner.group(1))
    if rest == "metadata.value":
        return slot["value"]
    if rest == "metadata.count":
        return slot["event_count"].cast("string")
    return slot[rest].cast("string") if rest in SLOT_STATE.names else F.lit(None).cast("string")


def bind_references(criteria: str, columns: Sequence[str]) -> tuple[str, dict[str, str]]:
    """Replace tags by columns `ref_0`, `ref_1`, ...; returns the text and {column: path}.

    A slot that refers to earlier slots must compare at least one reference with `=`, so that events and
    running sequences meet in a hash join and never as a product.
    """
    refs: dict[str, str] = {}

    def name(path: str) -> str:
        for col, known in refs.items():
            if known == path:
                return col
        refs[f"ref_{len(refs)}"] = path
        return f"ref_{len(refs) - 1}"

    text = _QUOTED_TAG.sub(lambda m: name(m.group(1)), criteria)
    text = _BARE_TAG.sub(lambda m: f"try_cast({name(m.group(1))} AS DOUBLE)", text)
    if refs and not re.search(r"(?<![<>!])=\s*ref_\d+\b|\bref_\d+\s*=(?!=)", text):
        raise InvalidCriteria("a slot that refers to earlier slots must compare a reference with =")
    return adapt_spelling(validate_criteria(text), columns), refs


def hash_joined(found: DataFrame) -> DataFrame:
    """`found`, if Spark joins it by equal keys: a criteria text can hide from `bind_references` that no key is compared."""
    plan = found._jdf.queryExecution().sparkPlan().toString()
    if re.search(r"\b(BroadcastNestedLoopJoin|CartesianProduct)\b", plan):
        raise InvalidCriteria("a slot that refers to earlier slots must compare an event's column with a reference by =, for all of its matches")
    return found


# --- advancing ---------------------------------------------------------------


def _advance_slot(events, pending, rule: Rule, k: int, rule_no: int, as_of, processed, closed):
    """Fills of slot `k` of one rule: (filled threshold rows, their candidate events) or deadman rows."""
    spec = rule.slots[k]
    text, refs = bind_references(spec.criteria, events.columns)
    names = list(refs)
    waiting = pending.select("inflight_id", "created_at", *[inflight_lookup(p).alias(c) for c, p in refs.items()])
    window = scan_events(events, as_of, spec.lookback_minutes, closed)
    if refs:
        groups = waiting.select(*names).distinct()
        found = hash_joined(window.join(groups, F.expr(f"({text})")))
    else:
        found = window.filter(F.expr(f"({text})"))
    value = d.key_value(events, spec)
    keep = [c for c in SHELL_FIELDS if c in events.columns]
    found = found.select(*keep, *names, value.alias("value")).filter(F.col("value").isNotNull())

    if spec.alert_type == "deadman":
        counts = found.groupBy(*names).agg(F.count(F.lit(1)).alias("event_count"))
        joined = waiting.join(counts, names, "left") if refs else waiting.withColumn("event_count", counts.scalar())
        quiet = joined.filter(F.coalesce("event_count", F.lit(0)) <= spec.limit)
        out = quiet.select(
            "inflight_id", F.lit(rule_no).alias("rule_no"), F.lit(spec.aggregation_key if spec.keyed else d.ALL).alias("value"),
            F.coalesce("event_count", F.lit(0).cast("long")).alias("event_count"),
            d.synthetic_event(as_of).alias("events"),
        )
        return out, None

    keys = [*names, "value"]
    fresh = d.new_events(found, processed)
    totals = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("event_count")).filter(F.col("event_count") >= spec.limit)
    triggers = totals.join(fresh.select(*keys).distinct(), keys)
    # the i-th waiting sequence of a group takes the i-th trigger, biggest first
    triggers = triggers.withColumns({"_rule": F.lit(rule_no), "_neg": -F.col("event_count"), "_pre": F.substring(F.md5("value"), 1, 2)})
    group = ["_rule", *names]
    t = ranked(triggers, group, ["_neg", "_pre"], [F.col("value")]).drop("_neg", "_pre")
    waiting = waiting.withColumns({"_rule": F.lit(rule_no), "_pre": F.substring("inflight_id", 1, 2)})
    w = ranked(waiting, group, ["created_at", "_pre"], [F.col("inflight_id")])
    chosen = w.join(t, [*group, "rank"]).select("inflight_id", *keys, "event_count")
    candidates = fresh.join(chosen, keys).select(
        *keep, "inflight_id", F.lit(rule_no).alias("rule_no"), "value", "event_count"
    )
    return None, candidates


def sequence_advance(
    events: DataFrame,
    inflight: DataFrame,
    rules: Sequence[Rule],
    as_of: datetime | str,
    processed: DataFrame | None = None,
    scope: str = "global",
    closed: bool = False,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> SequenceTick:
    """Try to fill the first open slot of every running sequence, one slot per tick.

    `keep` may write an intermediate result and return it read back: the claimed events and the fills
    feed the state, the alerts and the claims alike.
    """
    spark = events.sparkSession
    steps = [(r, k) for r in rules if r.alert_type == "sequence" for k in range(1, len(r.slots))]
    empty = SequenceTick(
        inflight, spark.createDataFrame([], ALERT_SCHEMA), spark.createDataFrame([], "owner string, eventid string, utctimestamp timestamp")
    )
    if not steps:
        return empty
    at = (F.col("alert_name"), F.size("slots"))
    quiet, wanted, watches = [], [], []
    for no, (rule, k) in enumerate(steps):
        pending = inflight.filter((at[0] == rule.alert_name) & (at[1] == k))
        dead, candidates = _advance_slot(events, pending, rule, k, no, as_of, processed, closed)
        (quiet if dead is not None else wanted).append(dead if dead is not None else candidates)
        watches.append(d.Watch(no, rule, rule.slots[k], k))

    filled = []
    claimed = empty.claimed
    if wanted:
        pool = reduce(lambda a, b: a.unionByName(b), wanted)
        mine = d.claim_events(pool, scope, order=("rule_no", "inflight_id"))
        mine = keep(mine, "_advance_events")
        most = max(max(d._samples_needed(w), 1) for w in watches)
        one = F.struct("rn", "utctimestamp", "eventid", record_json(mine).alias("record"))
        shown = first_n(mine, ["inflight_id"], [F.col("utctimestamp"), F.col("eventid")], most, most)
        grouped = shown.groupBy("inflight_id", "rule_no", "value", "event_count").agg(F.sort_array(F.collect_list(one)).alias("_s"))
        filled.append(grouped.select(
            "inflight_id", "rule_no", "value", "event_count",
            F.transform("_s", lambda s: F.struct(
                s["utctimestamp"].alias("utctimestamp"), s["eventid"].alias("eventid"), s["record"].alias("record"))).alias("events"),
        ))
        claimed = mine.select(F.col("inflight_id").alias("owner"), "eventid", "utctimestamp")
    filled += quiet
    fills = reduce(lambda a, b: a.unionByName(b), filled).withColumnRenamed("rule_no", "watch_no")
    slot_name = d.of_watch(watches, lambda w: w.spec.alert_name)
    fills = fills.withColumn("summary", d.render_summary(watches)).withColumn("first_event", F.get("events", F.lit(0))["record"])
    fills = fills.select(
        "inflight_id", slot_state(d.of_watch(watches, lambda w: w.slot_no), slot_name, as_of).alias("_slot"), F.col("events").alias("_events"),
        d.of_watch(watches, lambda w: len(w.rule.slots)).alias("_total"),
    )
    fills = keep(fills, "_fills")
    moved = inflight.join(fills, "inflight_id").withColumn("slots", F.concat("slots", F.array("_slot")))
    done = F.size("slots") >= F.col("_total")
    complete = moved.filter(done)
    still = moved.filter(~done).select(*INFLIGHT_SCHEMA.names)
    rest = inflight.join(fills.select("inflight_id"), "inflight_id", "left_anti")
    return SequenceTick(rest.unionByName(still), final_alerts(complete, rules, as_of), claimed)


def final_alerts(complete: DataFrame, rules: Sequence[Rule], as_of: datetime | str) -> DataFrame:
    """Completed sequences as alerts; the first event of every slot stays with the alert."""
    summary = F.col("summary")
    for rule in rules:
        if rule.alert_type == "sequence":
            summary = F.when(F.col("alert_name") == rule.alert_name, render(rule.summary, inflight_lookup)).otherwise(summary)
    doc = lambda s: F.try_parse_json(s["first_event"])
    kept = F.transform("slots", lambda s: F.struct(
        F.try_variant_get(doc(s), "$.utctimestamp", "timestamp").alias("utctimestamp"),
        F.try_variant_get(doc(s), "$.eventid", "string").alias("eventid"), s["first_event"].alias("record"),
    ))
    total = inflight_lookup("metadata.count")
    cols = {
        "alert_id": stable_id(F.lit("sequence"), F.col("inflight_id")), "alert_type": F.lit("sequence"), "summary": summary,
        "status": F.lit("OPEN"), "created_at": ts_lit(as_of), "value": F.get("slots", F.lit(0))["value"],
        "event_count": total, "new_count": total, "events": kept,
        "deadman_hits": F.lit(None), "last_triggered_at": F.lit(None),
    }
    cols.update({c: F.col(c) for c in ("alert_name", "severity", "category", "tags")})
    return complete.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA])


def check_sequences(events: DataFrame, rules: Sequence[Rule]) -> tuple[list[Rule], list[tuple[str, str]]]:
    """Sequence rules whose later slots cannot be bound are set aside with the reason."""
    good, failed = [], []
    for rule in rules:
        try:
            for spec in rule.slots:
                text, refs = bind_references(spec.criteria, events.columns)
                cols = [F.lit(None).cast("string").alias(c) for c in refs]
                events.limit(0).select("*", *cols).select(F.expr(f"({text})").alias("c")).schema  # noqa: B018
            good.append(rule)
        except Exception as e:  # noqa: BLE001 - one bad rule must not stop the others
            failed.append((rule.alert_name, str(e).splitlines()[0]))
    return good, failed




__all__ = ["expire_inflight", "sequence_start", "sequence_advance", "start", "SequenceTick", "check_sequences"]
