"""Views that are kept as partials and follow the event table by its log of commits.

A view has partials, grouped so that those of any rows can be added up, and a `merged` that turns them into
the view. For each folder that counts in the event table the view's own log names one folder of partials, so
what a commit takes out of the table (a replaced batch, an expired day) goes out of the view in its next
refresh, and only folders that are new are read. A folder that was joined from others gets its partials by
adding up theirs; no event is read again. Reading the view reads partials only, of the days asked for.

Defined cases: an empty table gives an empty view; a refresh that dies leaves the view as it was; two refreshes
at once name each folder once; a folder without rows for the view is named without partials.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.operators import views as v
from vigilake.schema import EVENT_SCHEMA
from vigilake.sources.manifest import Change, Entry, Manifest
from vigilake.sources.tables import prepare_write

FOLDER = ["event_date", "ingest_batch"]
#: of a sketch's registers: 2 ** 12 of them are off by about 1.6 per cent at one standard deviation
SKETCH_BITS = 12


@dataclass(frozen=True)
class ViewKind:
    """How a view is summed up: the rows to group, the keys, the aggregates of rows and those of partials.

    Without `again` partials cannot be added up: joined folders are read like new ones.
    """

    rows: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    first: Callable[[], dict[str, Column]]
    again: Callable[[], dict[str, Column]] | None
    merged: Callable[["ViewKind", DataFrame], DataFrame] = lambda kind, partials: kind.added(partials)

    def partial(self, events: DataFrame) -> DataFrame:
        return self.rows(events).groupBy(*self.keys, *FOLDER).agg(*[c.alias(n) for n, c in self.first().items()])

    def added(self, partials: DataFrame, by: Iterable[str] = ()) -> DataFrame:
        return partials.groupBy(*self.keys, *by).agg(*[c.alias(n) for n, c in self.again().items()])


def _attributed(events: DataFrame) -> DataFrame:
    return v._attributed(events, FOLDER[1:]).withColumn("day", F.col("event_date"))


def _seen(events: DataFrame) -> DataFrame:
    rows = v._attributed(events, FOLDER[1:]).select("identity", "utctimestamp", *v.FIRST_SEEN_DIMENSIONS, *FOLDER)
    long = rows.unpivot(["identity", "utctimestamp", *FOLDER], list(v.FIRST_SEEN_DIMENSIONS), "dimension", "value")
    return long.filter(F.col("value").isNotNull())


FIRST_SEENS = ViewKind(
    rows=_seen,
    keys=("identity", "dimension", "value"),
    first=lambda: {"first_seen_at": F.min("utctimestamp"), "last_seen_at": F.max("utctimestamp"), "event_count": F.count(F.lit(1))},
    again=lambda: {"first_seen_at": F.min("first_seen_at"), "last_seen_at": F.max("last_seen_at"), "event_count": F.sum("event_count")},
)

DAILY_ACTIVITY = ViewKind(
    rows=_attributed,
    keys=("identity", "day", "source", "category", "source_ip", "user_agent"),
    first=v.combination_counts,
    again=lambda: {"n": F.sum("n"), "warn": F.sum("warn"), "lo": F.min("lo"), "hi": F.max("hi")},
    merged=lambda kind, partials: v.activity_of_combinations(kind.added(partials)),
)

IDENTITY_SKETCHES = ViewKind(
    rows=_attributed,
    keys=("identity", "day"),
    first=lambda: {"event_count": F.count(F.lit(1)), "ips": F.hll_sketch_agg("source_ip", SKETCH_BITS), "agents": F.hll_sketch_agg("user_agent", SKETCH_BITS)},
    again=lambda: {"event_count": F.sum("event_count"), "ips": F.hll_union_agg("ips"), "agents": F.hll_union_agg("agents")},
)


def sketched(days: DataFrame) -> DataFrame:
    """Events and approximate numbers of addresses and agents per identity, over the days of kept sketches."""
    return days.groupBy("identity").agg(
        F.sum("event_count").alias("event_count"),
        F.hll_sketch_estimate(F.hll_union_agg("ips")).alias("approx_ips"),
        F.hll_sketch_estimate(F.hll_union_agg("agents")).alias("approx_agents"),
    )


class KeptView:
    """A view of the event table at `events`, kept below `path`. An entry of its log carries the table's folder as batch."""

    def __init__(self, spark: SparkSession, events: str, path: str, kind: ViewKind):
        self.spark, self.kind = spark, kind
        self.events, self.own = Manifest(spark, events), Manifest(spark, path)

    def refresh(self) -> dict[str, int]:
        """Bring the partials in line with the event table; says how many folders were read, added up and dropped."""
        wanted, have = self.events.state().live, {e.batch: e for e in self.own.state().live.values()}
        new = [e for f, e in wanted.items() if f not in have]
        joined = [e for e in new if e.parents and all(p in have for p in e.parents)] if self.kind.again else []
        fresh = [e for e in new if e not in joined]
        parts = []
        if fresh:
            parts.append(self.kind.partial(self.events.read(e.folder for e in fresh)))
        # own folder of a parent -> batch of the folder it went into
        moved = {have[p].folder: _batch(e.folder) for e in joined for p in e.parents if have[p].tier >= 0}
        if moved:
            name = F.concat(F.lit("event_date="), F.col("event_date").cast("string"), F.lit("/ingest_batch="), F.col("ingest_batch").cast("string"))
            to = F.from_json(F.lit(json.dumps(moved)), "map<string, string>")
            parts.append(self.kind.added(self.own.read(moved).withColumn("ingest_batch", F.element_at(to, name)), FOLDER))
        attempt, made = uuid.uuid4().hex[:12], []
        if parts:
            out = reduce(lambda a, b: a.unionByName(b), parts)
            out = out.withColumn("ingest_batch", F.concat("ingest_batch", F.lit(f"-{attempt}")))
            out.hint("rebalance", *FOLDER).write.mode("append").partitionBy(*FOLDER).parquet(self.own.path)
            made = self.own.written(f"*-{attempt}")
        entries = []
        for e in new:
            folder = f"{e.folder}-{attempt}"
            entries.append(Entry(folder, e.folder, 0 if folder in made else -1))
        gone = {f for f in have if f not in wanted}

        def plan(now) -> Change | None:
            known = {e.batch for e in now.live.values()}
            add, remove = [e for e in entries if e.batch not in known], [f for f, e in now.live.items() if e.batch in gone]
            return Change(add, remove) if add or remove else None

        self.own.commit(plan)
        return {"read": len(fresh), "added": len(joined), "dropped": len(gone)}

    def partials(self, since: str | None = None, until: str | None = None) -> DataFrame:
        """The partials that count, of the days from `since` to before `until` (yyyy-mm-dd)."""
        names = []
        for e in self.own.state().live.values():
            day = e.day.split("=", 1)[1]
            if e.tier >= 0 and (since is None or day >= since) and (until is None or day < until):
                names.append(e.folder)
        found = self.own.read(names)
        if found is None:
            found = self.kind.partial(prepare_write(self.spark.createDataFrame([], EVENT_SCHEMA)).withColumn("ingest_batch", F.lit("")))
        return found

    def read(self, since: str | None = None, until: str | None = None) -> DataFrame:
        return self.kind.merged(self.kind, self.partials(since, until))


def _batch(folder: str) -> str:
    return folder.split("ingest_batch=", 1)[1]
