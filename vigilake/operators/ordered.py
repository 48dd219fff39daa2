"""Sequence rules whose slots must follow each other in time (`strict_order`).

Per key the slots are the states of an automaton. Of all partial matches that have reached a state only the
one with the latest beginning matters, since it outlives the others; so a key's memory is one beginning per
state. An event of a slot moves the beginning of the state before it, as it stood before the event, into the
slot's own state. A slot with a threshold of n is n states that take the same events.

A match ends with an event of the last slot. A beginning counts once, with the first event that ends it, and
only if the rule's lifespan has not passed since. Beginnings never go backwards in time, so a state is a running
maximum: over a table each state is one pass of `plans.ranges`, whatever the share of the hottest key.
`streaming.sequences` holds the same automaton as state of a stream.

Defined cases: events of equal time follow each other by id; an event that fits several slots serves all of
them, but no two steps of one match; events without a key or an id take no part; slots that refer to earlier
slots, or wait for absence, are refused.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions.jsonfn import render, template_fields
from vigilake.functions.scalars import stable_id
from vigilake.operators import detect as d
from vigilake.operators.query import InvalidCriteria, criteria_expr
from vigilake.plans.ranges import carried, laid_out
from vigilake.schema import ALERT_SCHEMA
from vigilake.session import materialise
from vigilake.sources.rules import Rule
from vigilake.sources.tables import scan_events

def states_of(rule: Rule) -> list[int]:
    """For each state the slot whose events lead into it."""
    if len(rule.slots) < 2:
        raise InvalidCriteria("an ordered sequence has two slots or more")
    out = []
    for k, slot in enumerate(rule.slots):
        if slot.alert_type == "deadman":
            raise InvalidCriteria("a slot that waits for absence has no place in an ordered sequence")
        if template_fields(slot.criteria):
            raise InvalidCriteria("slots of an ordered sequence share a key instead of referring to each other")
        out += [k] * max(1, slot.limit)
    return out


def steps(events: DataFrame, rule: Rule) -> DataFrame:
    """value, ts, eventid, slots: the events that fit any slot, with the slots they fit."""
    fits = []
    for k, slot in enumerate(rule.slots):
        keyed = Rule("key", aggregation_key=slot.aggregation_key or rule.slots[0].aggregation_key)
        value = d.key_value(events, keyed)
        fits.append(F.when(criteria_expr(events.columns, slot.criteria) & value.isNotNull(), F.struct(value.alias("value"), F.lit(k).alias("slot"))))
    found = events.select("utctimestamp", "eventid", F.explode(F.array_compact(F.array(*fits))).alias("f")).filter(F.coalesce("eventid", F.lit("")) != "")
    return found.groupBy(F.col("f.value").alias("value"), F.col("utctimestamp").alias("ts"), "eventid").agg(F.collect_set("f.slot").alias("slots"))


def life_seconds(rule: Rule) -> int:
    """The rule's lifespan, read as `functions.scalars.lifespan_seconds` does."""
    m = re.match(r"\s*(\d+)\s*(day|hour|min)", (rule.lifespan or "").lower())
    return int(m.group(1)) * {"day": 86_400, "hour": 3_600, "min": 60}[m.group(2)] if m else 3 * 86_400


def life_minutes(rule: Rule) -> int:
    return max(1, -(-life_seconds(rule) // 60))


def matches(events: DataFrame, rule: Rule, ranges: int | None = None) -> DataFrame:
    """value, started_at, ended_at, steps (ts and id of the event of each state) of one rule."""
    states = states_of(rule)
    laid = laid_out(materialise(steps(events, rule), "steps"), ["value"], ["ts", "eventid"], ranges)
    step = F.array(F.struct(F.col("ts"), F.col("eventid")))
    # a state: the beginning first, so that the greater one is the later one
    begun = F.struct(F.col("ts").alias("started_at"), F.col("eventid").alias("first"), step.alias("steps"))
    rows = laid.withColumn("state", F.when(F.array_contains("slots", states[0]), begun))
    for slot in states[1:]:
        run = carried(rows, ["value"], {"past": ("max", F.col("state"))}, before=True)
        moved = F.struct(F.col("past.started_at").alias("started_at"), F.col("past.first").alias("first"), F.concat("past.steps", step).alias("steps"))
        rows = run.withColumn("state", F.when(F.array_contains("slots", slot) & F.col("past").isNotNull(), moved)).drop("past")
        rows = materialise(rows, "states")
    ended = rows.filter("state IS NOT NULL").select("value", "ts", "eventid", "state.*")
    first = F.min_by(F.struct(F.col("ts").alias("ended_at"), "steps"), F.struct("ts", "eventid"))
    out = ended.groupBy("value", "started_at", "first").agg(first.alias("e")).select("value", "started_at", "e.ended_at", "e.steps")
    return out.filter(F.unix_micros("ended_at") - F.unix_micros("started_at") <= life_seconds(rule) * 1_000_000)


def alerts_of(found: DataFrame, rule: Rule) -> DataFrame:
    """Matches (value, started_at, ended_at, steps) as alert rows; an alert's id derives from its rule, key and steps."""

    def look(path: str) -> Column:
        own = {"metadata.value": F.col("value"), "metadata.count": F.size("steps").cast("string")}
        if path in own:
            return own[path]
        parts = path.split(".")
        if len(parts) == 3 and parts[0] == "steps" and parts[1].isdigit() and parts[2] in ("eventid", "ts"):
            return F.get("steps", F.lit(int(parts[1])))[parts[2]].cast("string")
        text = getattr(rule, path, None)
        return F.lit(None if text is None or isinstance(text, tuple) else str(text)).cast("string")

    size = F.size("steps").cast("long")
    event = lambda s: F.struct(s["ts"].alias("utctimestamp"), s["eventid"].alias("eventid"), F.lit(None).cast("string").alias("record"))
    cols = {
        "alert_id": stable_id(F.lit(rule.alert_name), F.col("value"), F.array_join(F.transform("steps", lambda s: s["eventid"]), ",")),
        "alert_name": F.lit(rule.alert_name), "alert_type": F.lit("sequence"), "severity": F.lit(rule.severity), "category": F.lit(rule.category),
        "summary": render(rule.summary, look), "tags": F.array(*[F.lit(t) for t in rule.tags]).cast("array<string>"), "status": F.lit("OPEN"),
        "created_at": F.col("ended_at"), "value": F.col("value"), "event_count": size, "new_count": size, "events": F.transform("steps", event),
        "deadman_hits": F.lit(None), "last_triggered_at": F.lit(None),
    }
    return found.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in ALERT_SCHEMA])


def ordered_sequences(events: DataFrame, rules: Sequence[Rule], as_of: datetime | str, minutes: int, closed: bool = True) -> DataFrame:
    """Alert rows of all rules over the trailing window."""
    window = scan_events(events, as_of, minutes, closed)
    out = events.sparkSession.createDataFrame([], ALERT_SCHEMA)
    for rule in rules:
        out = out.unionByName(alerts_of(matches(window, rule), rule))
    return out


__all__ = ["alerts_of", "life_minutes", "life_seconds", "matches", "ordered_sequences", "states_of", "steps"]
