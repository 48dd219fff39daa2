import base64
import json


from vigilake.operators.tick import StateFolder
from vigilake.session import run_dir
from vigilake.sources.messages import read_event_stream
from vigilake.sources.rules import Rule
from vigilake.streaming.detect import detection_clock
from vigilake.streaming.ingest import ingest

ONCE = {"availableNow": True}


def pack(doc):
    return json.dumps({"message": {"data": base64.b64encode(json.dumps(doc).encode()).decode()}})


def test_ingest_goes_on_where_it_stopped(spark, tmp_path):
    drop, lake = tmp_path / "in", run_dir(spark, "lake")
    drop.mkdir()
    args = dict(quarantine=f"{lake}/bad", enveloped=True, trigger=ONCE)
    (drop / "a.txt").write_text("\n".join([pack({"a": 1, "timestamp": "2024-01-01T00:00:00Z"}), pack([1]), "junk"]))
    ingest(read_event_stream(spark, path=str(drop)), f"{lake}/t", f"{lake}/cp", **args).awaitTermination()
    (drop / "b.txt").write_text(pack({"a": 2, "timestamp": "2024-01-02T00:00:00Z"}))
    ingest(read_event_stream(spark, path=str(drop)), f"{lake}/t", f"{lake}/cp", **args).awaitTermination()
    got = spark.read.parquet(f"{lake}/t").orderBy("utctimestamp")
    assert [str(r.event_date) for r in got.collect()] == ["2024-01-01", "2024-01-02"]
    assert {r.problem for r in spark.read.json(f"{lake}/bad").collect()} == {"not a JSON object", "invalid envelope"}


def test_redelivered_messages_are_stored_once(spark, tmp_path):
    drop, lake = tmp_path / "in", run_dir(spark, "lake")
    drop.mkdir()
    line = json.dumps({"a": 1, "time": "2024-01-01T00:00:00Z"})
    (drop / "a.txt").write_text("\n".join([line, line, json.dumps({"a": 2, "time": "2024-01-01T00:00:01Z"})]))
    ingest(read_event_stream(spark, path=str(drop)), f"{lake}/t", f"{lake}/cp", trigger=ONCE, dedup="10 minutes").awaitTermination()
    assert spark.read.parquet(f"{lake}/t").count() == 2


def test_clock_runs_cycles(spark, events, tmp_path):
    (tmp_path / "tick.txt").write_text("x")
    state = StateFolder(spark, run_dir(spark, "state"))
    beats = []
    rule = Rule("gone", "deadman", criteria="source = 'x'", summary="gone")
    clock = spark.readStream.text(str(tmp_path))
    q = detection_clock(clock, lambda: events, lambda: [rule], state, f"{state.path}/cp", ONCE, publish=lambda df: beats.append(df.first()[0]))
    q.awaitTermination()
    assert state.done() == 1 and state.alerts().count() == 1
    assert json.loads(beats[0])["details"]["published"] == 1
