import base64
import json

import pytest
from pyspark.sql import functions as F

from vigilake.operators import score as sc
from vigilake.operators import views as v
from vigilake.session import run_dir
from vigilake.sources import messages as m
from vigilake.sources import tables as t


def test_event_table_prunes_days_and_expires(events, spark):
    path = run_dir(spark, "table")
    t.write_events(events, path)
    table = t.read_events(spark, path)
    assert table.count() == events.count()
    plan = t.scan_events(table, "2024-01-31 00:00:00", 1440)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: [IsNotNull(utctimestamp)" in plan
    slim = v.entity_daily_activity(table)._jdf.queryExecution().executedPlan().toString()
    assert "details" not in slim.split("ReadSchema")[1]
    gone = t.expire_partitions(spark, path, "2024-01-20 00:00:00", days=10)
    assert "event_date=2024-01-09" in gone and "event_date=2024-01-10" not in gone
    assert t.read_events(spark, path).filter("event_date < '2024-01-10'").count() == 0
    assert t.live_partitions(table.limit(0), "2024-01-20 00:00:00").count() == 0


def test_defaults_on_write(spark):
    df = spark.sql("SELECT cast(null AS timestamp) utctimestamp, cast(null AS string) eventid, 'LOW' severity, cast(null AS string) summary, "
                   "cast(null AS string) category, cast(null AS string) source, cast(null AS array<string>) tags, "
                   "cast(null AS array<string>) plugins, cast(null AS variant) details")
    r = t.finalise_record(df, F.lit("2024-01-01").cast("timestamp")).withColumn("details", F.to_json("details")).first()
    assert list(r)[1:] == ["", "LOW", "UNKNOWN", "UNKNOWN", "UNKNOWN", [], [], "{}"]


def test_envelopes(spark):
    pack = lambda raw: json.dumps({"message": {"data": base64.b64encode(raw).decode()}})
    rows = [pack(b' {"a": 1} '), pack(b"plain"), pack(b"[1]"), pack(b"\xff\xfe"), '{"message": {}}', "{}", "junk", '{"message": {"data": "%%"}}']
    out = m.decode_envelope(spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, value string")).orderBy("i").collect()
    assert [r.text for r in out[:2]] == ['{"a": 1}', '{"raw_log":"plain"}'] and "No data" in out[4].text
    assert [r.problem for r in out] == [None, None, "not a JSON object", "undecodable data", None, "invalid envelope", "invalid envelope", "undecodable data"]


def test_files_and_lines(spark, tmp_path):
    names = spark.createDataFrame([("/x/1_CloudTrail_a.json.gz",), ("/x/cloudtrail.json",)], "p string")
    assert m.cloudtrail_files(names, "p").count() == 1
    (tmp_path / "e.jsonl").write_text('{"eventid": "1"}\n\n  \n{"eventid": "2"}\n')
    assert t.read_events_jsonl(spark, str(tmp_path)).count() == 2


def test_fixture_and_report(events, spark, tmp_path):
    ie = v.identity_events(events)
    args = dict(canary="svc3@proj.iam.gserviceaccount.com", operators=["user1@example.com"], since="2024-01-01 00:00:00", until="2024-02-01 00:00:00")
    got = sc.export_fixture(ie, str(tmp_path / "f"), "f", techniques=["t"], **args)
    assert got["counts"]["total"] == ie.count() == t.read_events_jsonl(spark, str(tmp_path / "f" / "events")).count()
    assert spark.read.json(str(tmp_path / "f" / "ground_truth")).filter("label = 'attack'").count() == got["counts"]["attack"]
    with pytest.raises(sc.EmptyFixture):
        sc.export_fixture(ie, str(tmp_path / "g"), "g", techniques=[], **{**args, "canary": "nobody"})
    assert sc.labelled_window_guard({"total": 5, "attack": 1, "benign": 3})
    report = {"verdict": "findings", "summary": "s", "findings": [{"title": "t", "confidence": "sure", "evidence_eventids": [], "why_not_benign": "w"}]}
    (tmp_path / "r.json").write_text(json.dumps(report))
    assert sc.read_report(spark, str(tmp_path / "r.json")).first().problems == ["confidence", "evidence"]


def test_upsert_and_delete(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "id string, n int")
    assert sorted(tuple(r) for r in t.upsert(old, new, "id").collect()) == [("a", 1), ("b", 3), ("c", 4)]
    assert [r.id for r in t.delete_keys(old, new, "id").collect()] == ["a"]
