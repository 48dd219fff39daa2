"""Ingest that neither dies nor loses rows, pruned hunts, refused products."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from vigilake.operators import hunts as h
from vigilake.operators import score, views
from vigilake.operators.detect import threshold, watches_of
from vigilake.operators.query import InvalidCriteria, browse
from vigilake.operators.sequence import hash_joined
from vigilake.session import run_dir
from vigilake.sources.messages import read_event_stream
from vigilake.sources.rules import Rule
from vigilake.sources.tables import read_events, write_events
from vigilake.streaming.ingest import ingest

ONCE = {"availableNow": True}
POISON = [
    '{"a": "\\ud800"}', '{"a": 1e400}', '{"a": NaN}', '{"a":' * 985 + "1" + "}" * 985, '{"a": ', "[1]",
]


def run(spark, drop, lake, **more):
    ingest(read_event_stream(spark, path=str(drop)), f"{lake}/t", f"{lake}/cp", quarantine=f"{lake}/bad", trigger=ONCE, **more).awaitTermination()
    return read_events(spark, f"{lake}/t"), spark.read.json(f"{lake}/bad")


@pytest.mark.parametrize("dedup", [None, "1 hour"])
def test_poison_goes_to_quarantine(spark, tmp_path, dedup):
    drop, lake = tmp_path / "in", run_dir(spark, "lake")
    drop.mkdir()
    good = json.dumps({"a": 1, "time": "2024-01-01T00:00:00Z"})
    late = json.dumps({"a": 2, "time": "2020-01-01T00:00:00Z"})
    (drop / "a.txt").write_text("\n".join([good, *POISON, "plain line", good, late]))
    events, bad = run(spark, drop, lake, dedup=dedup)
    assert bad.count() == len(POISON)
    assert events.count() == (3 if dedup else 4)
    assert events.filter("year(utctimestamp) = 2020").count() == 1


def test_replayed_batch_leaves_one_copy(spark, tmp_path):
    drop, lake = tmp_path / "in", run_dir(spark, "lake")
    drop.mkdir()
    (drop / "a.txt").write_text("\n".join([json.dumps({"a": i, "time": "2024-01-01T00:00:00Z"}) for i in range(5)] + ["{"]))
    assert run(spark, drop, lake)[0].count() == 5
    shutil.rmtree(f"{lake.removeprefix('file://')}/cp/commits")  # the batch was written, its end was not
    events, bad = run(spark, drop, lake)
    assert events.count() == 5 and bad.count() == 1


def test_hunts_prune_days(spark, events, tmp_path):
    write_events(events.select("utctimestamp", "eventid", "severity", "summary", "category", "source", "tags", "plugins", "details"), str(tmp_path / "t"))
    e = read_events(spark, str(tmp_path / "t"))
    ie, iam, daily = views.identity_events(e), views.iam_changes(e), views.entity_daily_activity(e)
    since, until = "2024-01-20 00:00:00", "2024-01-21 00:00:00"
    hunts = {
        "sweep": h.sweep(ie, since, until), "grants": h.external_grants(iam, ["example.com"], since), "breadth": h.category_breadth(daily, "2024-01-20"),
        "roles": h.privileged_roles(iam, since=since), "keys": h.key_creation(iam, since=since),
        "labels": score.label_events(ie, "user1@example.com", [], since, until),
        "checks": h.technique_checks(ie, iam, daily, "user1@example.com", since),
    }
    for name, df in hunts.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
        assert scans and all("event_date" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans), (name, scans)


def test_products_are_refused(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events, groups = spark.createDataFrame([("x", "s")], "category string, source string"), spark.createDataFrame([("s",)], "ref_0 string")
        for text in ("category = 'x' OR source = ref_0", "ref_0 = 'lit' AND category = 'x'"):
            with pytest.raises(InvalidCriteria):
                hash_joined(events.join(groups, F.expr(f"({text})")))
        assert hash_joined(events.join(groups, F.expr("category = 'x' AND source = ref_0"))).count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tags_may_hold_commas(spark, events):
    rule = Rule("r", criteria="severity = 'INFO'", aggregation_key="source", tags=("a,b", "c"), lookback_minutes=60 * 24 * 40)
    alerts = threshold(events, watches_of([rule]), "2024-01-31 00:00:00").alerts
    assert {tuple(r.tags) for r in alerts.collect()} == {("a,b", "c")}


def test_a_cut_is_reported(events):
    with pytest.warns(UserWarning, match="5000 rows asked for"):
        browse(events, 60, 5000, as_of="2024-01-31 00:00:00")
