"""Ordered sequences on a stream: the automaton of `operators.ordered` as keyed state with event-time timers.

Events wait in the state of their key until the watermark has passed them and are then taken in order of time,
so late ones find their place. The state is what waits, one beginning per state of the automaton, and the last
beginning that was reported. Timers at a beginning's end of life clear it; a key whose state is empty keeps
nothing. The matches are those of `ordered.matches` over the same events up to the watermark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from vigilake.operators import detect as d
from vigilake.operators.ordered import life_seconds, states_of
from vigilake.operators.query import criteria_expr
from vigilake.sources.rules import Rule

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FOUND = "value string, started_at long, ended_at long, steps string"


class Automaton(StatefulProcessor):
    """One key. Times are microseconds; `memory` holds {"states": [[begun, steps] or null], "told": last reported beginning}."""

    def __init__(self, states: list[int], life: int):
        self.states, self.life = states, life

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "ts long, eventid string", "slots string")
        self.memory = handle.getValueState("memory", "doc string")
        self.until = handle.getValueState("until", "ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        times = set()
        for r in rows:
            place = (r.at, r.eventid)
            slots = {r.slot}
            if self.waiting.containsKey(place):
                slots |= set(json.loads(self.waiting.getValue(place)[0]))
            self.waiting.updateValue(place, (json.dumps(sorted(slots)),))
            times.add(-(-r.at // 1000))
        for ms in times:
            self.handle.registerTimer(ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        if self.until.exists() and self.until.get()[0] >= now:
            return iter([])  # an earlier timer of this batch has taken all that is due
        self.until.update((now,))
        return iter(self.advance(key[0], now * 1000))

    def advance(self, value: str, now: int) -> list[Row]:
        due = sorted((k[0], k[1], json.loads(v[0])) for k, v in self.waiting.iterator() if k[0] <= now)
        memory = json.loads(self.memory.get()[0]) if self.memory.exists() else {"states": [None] * len(self.states), "told": None}
        states, told, out = memory["states"], memory["told"], []
        for ts, eventid, slots in due:
            self.waiting.removeKey((ts, eventid))
            for i in reversed(range(len(states))):  # the last state first: each moves what was there before this event
                if self.states[i] not in slots:
                    continue
                if i == 0:
                    states[0] = [[ts, eventid], [[ts, eventid]]]
                elif states[i - 1] is not None:
                    begun, steps = states[i - 1]
                    states[i] = [begun, [*steps, [ts, eventid]]]
                    if i == len(states) - 1 and begun != told and ts - begun[0] <= self.life:
                        told = begun
                        out.append(Row(value=value, started_at=begun[0], ended_at=ts, steps=json.dumps(states[i][1])))
        states = [s if s is not None and now - s[0][0] <= self.life else None for s in states]
        if any(states):
            self.memory.update((json.dumps({"states": states, "told": told}),))
            self.handle.registerTimer((max(s[0][0] for s in states if s) + self.life) // 1000 + 1)
        elif self.memory.exists():
            self.memory.clear()
        return out

    def close(self) -> None:
        pass


def _fits(events: DataFrame, rule: Rule) -> Column:
    fits = []
    for k, slot in enumerate(rule.slots):
        value = d.key_value(events, Rule("key", aggregation_key=slot.aggregation_key or rule.slots[0].aggregation_key))
        fits.append(F.when(criteria_expr(events.columns, slot.criteria) & value.isNotNull(), F.struct(value.alias("value"), F.lit(k).alias("slot"))))
    return F.explode(F.array_compact(F.array(*fits)))


def ordered_stream(events: DataFrame, rule: Rule, delay: str = "5 minutes") -> DataFrame:
    """value, started_at, ended_at, steps of one rule on a stream of events; an event may come `delay` late."""
    states = states_of(rule)
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    found = events.select("utctimestamp", "eventid", _fits(events, rule).alias("f")).filter(F.coalesce("eventid", F.lit("")) != "")
    rows = found.select(F.col("f.value").alias("value"), "utctimestamp", F.unix_micros("utctimestamp").alias("at"), "eventid", F.col("f.slot").alias("slot"))
    keyed = rows.withWatermark("utctimestamp", delay).groupBy("value")
    out = keyed.transformWithState(statefulProcessor=Automaton(states, life_seconds(rule) * 1_000_000), outputStructType=FOUND, outputMode="Append", timeMode="EventTime")
    pairs = F.from_json("steps", "array<array<string>>")
    return out.select(
        "value", F.timestamp_micros("started_at").alias("started_at"), F.timestamp_micros("ended_at").alias("ended_at"),
        F.transform(pairs, lambda p: F.struct(F.timestamp_micros(p[0].cast("long")).alias("ts"), p[1].alias("eventid"))).alias("steps"),
    )
