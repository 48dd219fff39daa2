"""Silent groups on a stream: a deadline per group as event-time timer, expected groups as initial state."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from vigilake.operators.absence import expected_of, heard
from vigilake.sources.rules import Rule
from vigilake.sources.tables import clamp_minutes, ts_lit
from vigilake.streaming.sequences import ROCKSDB

FOUND = "value string, last_heard long, absent_at long, expected boolean"


class Silence(StatefulProcessor):
    """One group. Times are microseconds; calls wait until the watermark has passed them, so late ones still count."""

    def __init__(self, lookback: int):
        self.lookback = lookback

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at long", "one int")
        # when it was last heard, whether its present silence is told, whether it is expected
        self.group = handle.getValueState("heard", "at long, told boolean, expected boolean")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.group.update((initialState.since, False, True))
        self.handle.registerTimer(self.due(initialState.since))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        times = {r.at for r in rows}
        for at in times:
            self.waiting.updateValue((at,), (1,))
        for ms in {-(-at // 1000) for at in times}:
            self.handle.registerTimer(ms)
        return iter([])

    def due(self, at: int) -> int:
        """The first millisecond after the deadline."""
        return (at + self.lookback) // 1000 + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        at, told, expected = self.group.get() if self.group.exists() else (None, False, False)
        out = []

        def tell() -> None:
            out.append(Row(value=key[0], last_heard=at, absent_at=at + self.lookback, expected=expected))

        for call in sorted(k[0] for k, _ in self.waiting.iterator() if k[0] <= now):
            self.waiting.removeKey((call,))
            if at is not None and call <= at:
                continue
            if at is not None and not told and at + self.lookback < call:
                tell()
            at, told = call, False
        if at is not None and not told:
            if at + self.lookback < now:
                tell()
                told = True
            else:
                self.handle.registerTimer(self.due(at))
        if at is not None:
            self.group.update((at, told, expected))
        return iter(out)

    def close(self) -> None:
        pass


def absence_stream(events: DataFrame, rule: Rule, since: datetime | str, expected: DataFrame | None = None, delay: str = "5 minutes") -> DataFrame:
    """value, last_heard, absent_at, expected of a keyed deadman rule on a stream; `expected(value)` is a batch table."""
    session = events.sparkSession
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    names = (expected_of(events, rule) if expected is None else expected.select("value")).distinct()
    begun = names.filter("value IS NOT NULL").withColumn("since", F.unix_micros(ts_lit(since))).groupBy("value")
    calls = heard(events, rule).filter(F.col("utctimestamp") >= ts_lit(since)).withColumn("at", F.unix_micros("utctimestamp"))
    out = calls.withWatermark("utctimestamp", delay).groupBy("value").transformWithState(
        statefulProcessor=Silence(clamp_minutes(rule.lookback_minutes) * 60_000_000), outputStructType=FOUND, outputMode="Append", timeMode="EventTime", initialState=begun
    )
    return out.select("value", F.timestamp_micros("last_heard").alias("last_heard"), F.timestamp_micros("absent_at").alias("absent_at"), "expected")
