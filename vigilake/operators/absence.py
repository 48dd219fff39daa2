"""Groups that fall silent: every expected group, and every one that was heard, has its own deadline.

A group is absent from `lookback` after it was last heard. It is told once per silence, whatever the other
groups do; being heard again arms it anew. Expected groups are heard at `since`, so one that never sends
anything is told too. `streaming.absence` holds the same deadlines as timers of a stream.

Defined cases: events before `since` or after `until` do not count; a group heard exactly at its deadline is
not absent; a silence counts once its deadline has passed at `until`; null groups are left out.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.operators import detect as d
from vigilake.operators.query import criteria_expr
from vigilake.plans.ranges import carried, laid_out
from vigilake.sources.rules import Rule
from vigilake.sources.tables import clamp_minutes, ts_lit, within


def heard(events: DataFrame, rule: Rule) -> DataFrame:
    """value, utctimestamp of the events a keyed deadman rule listens for."""
    value = d.key_value(events, rule)
    return events.filter(criteria_expr(events.columns, rule.criteria)).select(value.alias("value"), "utctimestamp").filter("value IS NOT NULL")


def expected_of(events: DataFrame, rule: Rule) -> DataFrame:
    rows = [(v,) for v in dict.fromkeys(rule.expected_values)]
    return events.sparkSession.createDataFrame(rows, "value string")


def absences(events: DataFrame, rule: Rule, since: datetime | str, until: datetime | str, expected: DataFrame | None = None, ranges: int | None = None) -> DataFrame:
    """value, last_heard, absent_at, expected: one row per silence of a group; `expected(value)` may be a table of any size."""
    names = (expected_of(events, rule) if expected is None else expected.select("value")).distinct()
    calls = heard(within(events, since, until, closed=True), rule).select("value", F.col("utctimestamp").alias("at")).distinct()
    first = names.select("value", ts_lit(since).alias("at"))
    # the end of the time looked at closes the last silence of each group
    marks = calls.unionByName(first).distinct().withColumn("end", F.lit(0))
    ends = marks.select("value").distinct().select("value", ts_lit(until).alias("at"), F.lit(1).alias("end"))
    run = carried(laid_out(marks.unionByName(ends), ["value"], ["at", "end"], ranges), ["value"], {"last_heard": ("max", F.when(F.col("end") == 0, F.col("at")))}, before=True)
    deadline = F.timestamp_micros(F.unix_micros("last_heard") + clamp_minutes(rule.lookback_minutes) * 60_000_000)
    # at the end the deadline must have passed; before a call it must lie before the call
    silent = run.filter(F.col("last_heard").isNotNull()).withColumn("absent_at", deadline).filter(F.col("absent_at") < F.col("at"))
    known = names.withColumn("expected", F.lit(True))
    return silent.select("value", "last_heard", "absent_at").join(known, "value", "left").withColumn("expected", F.coalesce("expected", F.lit(False)))
