"""One detection cycle over the event table, with its state in plain tables.

Every `COMPACT_EVERY` cycles the logs that are read back are written together, so a cycle reads one base
folder and few small ones however long the system runs. What the base before the last one covers is deleted
then, the outbox after `KEEP_OUTBOX` cycles, so the number of folders is bounded too; readers have a whole
compaction's time to finish.

Layout below the state folder, one sub-folder per cycle number: `alerts`, `processed` (which is also the list of
every alert's events) and `outbox` are logs of what the cycle added or changed, `inflight` is the whole (small,
short-lived) state after it. A cycle counts only once its marker in `done` is written, so a cycle that died
half-way is simply run again under the same number.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.operators import detect as d
from vigilake.operators import ordered
from vigilake.operators import ruleindex as ri
from vigilake.operators import sequence as sq
from vigilake.operators.query import InvalidCriteria
from vigilake.plans.blocked import latest
from vigilake.schema import ALERT_SCHEMA, INFLIGHT_SCHEMA, RETENTION_DAYS
from vigilake.sources.messages import heartbeat_events
from vigilake.sources.outbox import notification_outbox
from vigilake.sources.rules import Rule
from vigilake.sources.tables import as_datetime, clamp_minutes, ts_lit

log = logging.getLogger(__name__)

COMPACT_EVERY = 60
KEEP_OUTBOX = 1_440  # cycles: a day of minutes
CLAIM = "alert_id string, eventid string, utctimestamp timestamp, processed_at timestamp"
CHANGE = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ALERT_SCHEMA) + ", notify boolean, cycle int"


@dataclass
class StateFolder:
    spark: SparkSession
    path: str

    def _cycles(self, table: str) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        return [int(n[1:]) for n in names if n[:1] == "c" and n[1:].isdigit()]

    def done(self) -> int:
        """Number of the last finished cycle, 0 when there is none."""
        return max(self._cycles("done"), default=0)

    def _at(self, table: str, cycle: int) -> str:
        return f"{self.path}/{table}/c{cycle:09d}"

    def write(self, df: DataFrame, table: str, cycle: int) -> DataFrame:
        path = self._at(table, cycle)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def finish(self, cycle: int) -> None:
        jvm = self.spark.sparkContext._jvm
        mark = jvm.org.apache.hadoop.fs.Path(self._at("done", cycle))
        mark.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(mark)

    def log(self, table: str, schema: str, upto: int) -> DataFrame:
        """The newest base of a log table and what cycles wrote after it, up to cycle `upto`."""
        if not upto:
            return self.spark.createDataFrame([], schema)
        base = max((c for c in self._cycles(f"base_{table}") if c <= upto), default=0)
        paths = [self._at(f"base_{table}", base)] if base else []
        paths += [self._at(table, c) for c in range(base + 1, upto + 1)]
        return self.spark.read.schema(schema).parquet(*paths)

    def compact(self, cycle: int, oldest: Column) -> None:
        """Write alerts as they stand, and claims of events that can still exist, as new bases."""
        self.write(latest(self.log("alerts", CHANGE, cycle), ["alert_id"], ["cycle"]).select(*ALERT_SCHEMA.names, "notify", "cycle"), "base_alerts", cycle)
        self.write(self.log("processed", CLAIM, cycle).filter(F.col("utctimestamp") >= oldest), "base_processed", cycle)

        self.trim(cycle)

    def trim(self, cycle: int) -> int:
        """Delete what the base before the last one covers; returns the number of folders."""
        bases = sorted(self._cycles("base_alerts"))
        if len(bases) < 2:
            return 0
        covered, jvm, gone = bases[-2], self.spark.sparkContext._jvm, 0
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.listStatus(root):
            table = status.getPath().getName()
            if not status.isDirectory() or table == "outbox" and cycle <= KEEP_OUTBOX:
                continue
            # the base itself stays, and of all others what it covers goes
            limit = covered if table.startswith("base_") else cycle - KEEP_OUTBOX + 1 if table == "outbox" else covered + 1
            for c in self._cycles(table):
                if c < limit:
                    fs.delete(jvm.org.apache.hadoop.fs.Path(self._at(table, c)), True)
                    gone += 1
        return gone

    def alert_events(self, upto: int | None = None) -> DataFrame:
        """alert_id, eventid, utctimestamp of every event an alert has claimed, within retention."""
        return self.log("processed", CLAIM, self.done() if upto is None else upto).select("alert_id", "eventid", "utctimestamp")

    def inflight(self, upto: int) -> DataFrame:
        if not upto:
            return self.spark.createDataFrame([], INFLIGHT_SCHEMA)
        return self.spark.read.schema(INFLIGHT_SCHEMA).parquet(self._at("inflight", upto))

    def alerts(self, upto: int | None = None) -> DataFrame:
        """The alerts as they stand: the newest row per id."""
        upto = self.done() if upto is None else upto
        return latest(self.log("alerts", CHANGE, upto), ["alert_id"], ["cycle"])


def run_tick(
    events: DataFrame,
    rules: Sequence[Rule],
    state: StateFolder,
    as_of: datetime | str,
    statuses: DataFrame | None = None,
    notify: Mapping | None = None,
    scope: str = "global",
    closed: bool = True,
) -> dict:
    """Expire, evaluate threshold rules and first slots, fold deadman rules, advance sequences, record.

    `statuses(alert_id, status)` are the analysts' current states; a deadman alert that is no longer OPEN
    is not folded into. Returns the metrics of the cycle and its heartbeat message as a DataFrame.
    """
    spark = events.sparkSession
    last = state.done()
    cycle = last + 1
    good, failed = d.check_rules(events, rules)
    good, unbound = _bindable(events, good)
    failed += unbound
    strict = [r for r in good if r.alert_type == "sequence" and r.strict_order]
    published, good = len(good), [r for r in good if r not in strict]
    longest = max([clamp_minutes(s.lookback_minutes) for r in good for s in (r.slots or (r,))], default=5)
    horizon = ts_lit(as_datetime(as_of) - timedelta(minutes=longest))
    # an event outside every window cannot be claimed again: older claims need not be read
    processed = state.log("processed", CLAIM, last).filter(F.col("utctimestamp") >= horizon)
    alive = sq.expire_inflight(state.inflight(last), as_of)

    changes = spark.createDataFrame([], CHANGE).drop("cycle")
    claims = spark.createDataFrame([], "alert_id string, eventid string, utctimestamp timestamp")
    born = spark.createDataFrame([], INFLIGHT_SCHEMA)
    watches = d.watches_of(good)
    if any(w.spec.alert_type != "deadman" for w in watches):
        ev = ri.threshold(events, watches, as_of, processed if last else None, scope, closed)
        rows = state.write(ev.alerts, "_threshold", cycle)
        claims = claims.unionByName(ev.claimed.select("alert_id", "eventid", "utctimestamp"))
        is_seq = d.of_watch(ev.watches, lambda w: w.rule.alert_type == "sequence")
        changes = changes.unionByName(rows.filter(~is_seq).drop("watch_no").withColumn("notify", F.lit(True)))
        born = born.unionByName(sq.start(rows.filter(is_seq), ev.watches, as_of))
    claims = state.write(claims, "_claims", cycle)
    dead = [w for w in watches if w.spec.alert_type == "deadman"]
    plain = [w for w in dead if w.rule.alert_type == "deadman"]
    if plain:
        opened = state.log("alerts", CHANGE, last).filter(F.col("alert_type") == "deadman")
        current = latest(opened, ["alert_id"], ["cycle"])
        if statuses is not None:
            current = current.drop("status").join(statuses, "alert_id", "left").withColumn("status", F.coalesce("status", F.lit("OPEN")))
        caps = {w.rule.alert_name: max(1, w.rule.event_sample_count if w.rule.event_sample_count is not None else 3) for w in plain}
        folded = d.fold_deadman(current.select(*ALERT_SCHEMA.names), ri.deadman(events, plain, as_of, closed).drop("watch_no"), caps, as_of)
        changes = changes.unionByName(folded.withColumnRenamed("first_hit", "notify"))
    slots = [w for w in dead if w.rule.alert_type == "sequence"]
    if slots:
        again = [d.Watch(i, w.rule, w.spec, w.slot_no) for i, w in enumerate(slots)]
        born = born.unionByName(sq.start(ri.deadman(events, slots, as_of, closed), again, as_of))

    used = processed.select("eventid").unionByName(claims.select("eventid"))
    step = sq.sequence_advance(events, alive, good, as_of, used, scope, closed, lambda df, name: state.write(df, name, cycle))
    changes = changes.unionByName(step.alerts.withColumn("notify", F.lit(True)))
    for rule in strict:
        # a match is known by its steps, so cycles may look at the same events again
        found = ordered.ordered_sequences(events, [rule], as_of, 2 * ordered.life_minutes(rule), closed)
        told = state.log("alerts", CHANGE, last).select("alert_id")
        changes = changes.unionByName(found.join(told, "alert_id", "left_anti").withColumn("notify", F.lit(True)))
    changes = state.write(changes.withColumn("cycle", F.lit(cycle)), "alerts", cycle)
    state.write(step.inflight.unionByName(born), "inflight", cycle)
    everything = claims.unionByName(step.claimed.withColumnRenamed("owner", "alert_id"))
    state.write(everything.withColumn("processed_at", ts_lit(as_of)), "processed", cycle)
    if notify:
        state.write(notification_outbox(changes, notify), "outbox", cycle)
    if cycle % COMPACT_EVERY == 0:
        state.compact(cycle, ts_lit(as_datetime(as_of) - timedelta(days=RETENTION_DAYS)))
    state.finish(cycle)

    metrics = d.fanout_metrics(published, len(failed))
    beat = heartbeat_events(spark, metrics["published"], metrics["failed"], len(rules))
    return {**metrics, "cycle": cycle, "reasons": failed, "heartbeat": beat}


def _bindable(events: DataFrame, rules: Sequence[Rule]) -> tuple[list[Rule], list[tuple[str, str]]]:
    sequences, failed = sq.check_sequences(events, [r for r in rules if r.alert_type == "sequence"])
    for rule in [r for r in sequences if r.strict_order]:
        try:
            ordered.states_of(rule)
        except InvalidCriteria as e:
            sequences.remove(rule)
            failed.append((rule.alert_name, str(e)))
    kept = {id(r) for r in sequences}
    return [r for r in rules if r.alert_type != "sequence" or id(r) in kept], failed
