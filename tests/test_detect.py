import pytest
from pyspark.sql import functions as F

from vigilake.operators import detect as d
from vigilake.operators import sequence as sq
from vigilake.operators.normalize import normalize
from vigilake.operators.query import InvalidCriteria
from vigilake.operators.tick import StateFolder, run_tick
from vigilake.session import run_dir
from vigilake.sources.messages import heartbeat_events
from vigilake.sources.rules import Rule, load_rules, platform_rules, rule_from_dict

AS_OF = "2024-01-31 00:00:00"
MONTH = 43200


def test_bad_rules_stay_alone(events):
    rules = [Rule("ok", criteria="source = 'x'"), Rule("typo", criteria="nope = 'x'"), Rule("none", criteria=" "),
             Rule("text", criteria="severity"), Rule("empty", alert_type="sequence")]
    good, failed = d.check_rules(events, rules)
    assert [r.alert_name for r in good] == ["ok"] and [n for n, _ in failed] == ["typo", "none", "text", "empty"]


def test_odd_values_do_not_fail_a_cast(events):
    rule = Rule("cast", criteria="CAST(JSON_VALUE(details.user) AS INT64) > 1", lookback_minutes=MONTH)
    assert d.threshold(events, d.watches_of([rule]), AS_OF).alerts.count() == 0


def test_rules_from_files(tmp_path, spark):
    (tmp_path / "a.yml").write_text('alert_name: "a"\nalert_type: "threshold"\ncriteria: "x"\nlookback_minutes: bogus\n')
    (tmp_path / "b.yml").write_text(": : not yaml [")
    (tmp_path / "c.yml").write_text("- just a list")
    table = spark.createDataFrame(
        [("t1", '{"alert_name": "t1", "slots": [{"criteria": "x"}]}', None), ("t2", "alert_name: t2", False)],
        "name string, yaml string, enabled boolean")
    rules, refused = load_rules(str(tmp_path / "*.yml"), table)
    assert [r.alert_name for r in rules] == ["a", "t1"] and len(refused) == 2
    assert rules[0].lookback_minutes == 5 and rules[1].slots[0].alert_name == "t1_slot_1"


def test_deadman_quiet_and_firing(events):
    quiet = Rule("quiet", "deadman", criteria="source = 'cloudtrail'", lookback_minutes=MONTH)
    dead = Rule("dead", "deadman", criteria="source = 'x'", summary="{{metadata.value}} {{metadata.count}}", event_snippet="s {{summary}}", event_sample_count=1)
    rows = d.deadman(events, d.watches_of([quiet, dead]), AS_OF).collect()
    assert [(r.alert_name, r.summary, len(r.events)) for r in rows] == [("dead", "all 0 s Expected event not found", 1)]


def test_heartbeat_meets_the_rules_that_watch_it(spark):
    beat = normalize(heartbeat_events(spark, 3, 1, 4), now=F.lit(AS_OF).cast("timestamp"))
    rules = {r.alert_name: r for r in platform_rules()}
    degraded = d.threshold(beat, d.watches_of([rules["cron_degraded"]]), AS_OF).alerts.collect()
    assert degraded[0].value == "detection" and "1 heartbeats" in degraded[0].summary
    assert d.deadman(beat, d.watches_of([rules["deadman_ingest_pipeline"]]), AS_OF).count() == 0
    healthy = normalize(heartbeat_events(spark, 4, 0, 4), now=F.lit(AS_OF).cast("timestamp"))
    assert d.threshold(healthy, d.watches_of([rules["cron_degraded"]]), AS_OF).alerts.count() == 0


def test_events_without_id_are_never_claimed(spark):
    df = spark.createDataFrame([("", 0), ("", 1), ("a", 0), ("a", 1)], "eventid string, watch_no int").selectExpr(
        "*", "'v' AS value", "timestamp '2024-01-01' AS utctimestamp", "'s' AS summary")
    got = sorted((r.eventid, r.watch_no) for r in d.claim_events(df).collect())
    assert got == [("", 0), ("", 1), ("a", 0)]
    assert d.claim_events(df, scope="rule").count() == 4
    done = spark.createDataFrame([("a",), ("",)], "eventid string")
    assert [r.eventid for r in d.new_events(df, done).collect()] == ["", ""]


def test_references_need_an_equality():
    text, refs = sq.bind_references("a = '{{slots.0.metadata.value}}' AND n > {{slots.0.metadata.count}}", [])
    assert text == "a = ref_0 AND n > try_cast(ref_1 AS DOUBLE)" and list(refs) == ["ref_0", "ref_1"]
    with pytest.raises(InvalidCriteria):
        sq.bind_references("a > '{{slots.0.metadata.value}}'", [])


def test_sequence_join_is_no_product(events, spark):
    rule = Rule("s", "sequence", slots=(
        Rule("one", criteria="category = 'click'", aggregation_key="details.user", lookback_minutes=MONTH),
        Rule("two", criteria="category = 'view' AND JSON_VALUE(details.user) = '{{slots.0.metadata.value}}'", lookback_minutes=MONTH)))
    begun = sq.sequence_start(events, [rule], AS_OF)
    plan = sq.sequence_advance(events, begun.inflight, [rule], AS_OF).alerts._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_cycles_fold_and_replay(events, spark):
    state = StateFolder(spark, run_dir(spark, "t"))
    rules = [Rule("dead", "deadman", severity="HIGH", criteria="source = 'x'", summary="gone"), Rule("bad", criteria="nope = 1"),
             Rule("click", criteria="category = 'click'", lookback_minutes=MONTH, severity="LOW")]
    config = {"enabled": True, "webhook_url": "u", "min_severity": "HIGH"}
    first = run_tick(events, rules, state, AS_OF, notify=config)
    assert (first["status"], first["published"], first["failed"]) == ("degraded", 2, 1)
    second = run_tick(events, rules, state, "2024-01-31 00:01:00", notify=config)
    assert second["cycle"] == 2 == state.done()
    alerts = {r.alert_name: r for r in state.alerts().collect()}
    assert alerts["dead"].deadman_hits == 2 and alerts["click"].created_at.day == 31 and len(alerts) == 2
    sent = [spark.read.parquet(f"{state.path}/outbox/c{c:09d}").count() for c in (1, 2)]
    assert sent == [1, 0]  # the first hit only
    resolved = state.alerts().select("alert_id").withColumn("status", F.lit("RESOLVED"))
    run_tick(events, rules[:1], state, "2024-01-31 00:02:00", statuses=resolved)
    assert state.alerts().filter("alert_name = 'dead'").count() == 2


def test_rule_documents():
    r = rule_from_dict({"alert_name": "x", "tags": None, "debug": True, "alert_type": "deadman"})
    assert (r.limit, r.samples, r.tags) == (0, 0, ())


def test_compacted_logs_say_the_same(events, spark, monkeypatch):
    from vigilake.operators import tick

    monkeypatch.setattr(tick, "COMPACT_EVERY", 2)
    state = StateFolder(spark, run_dir(spark, "c"))
    rules = [Rule("dead", "deadman", criteria="source = 'x'", summary="gone"),
             Rule("click", criteria="category = 'click'", lookback_minutes=MONTH)]
    for minute in range(3):
        run_tick(events, rules, state, f"2024-01-31 00:0{minute}:00")
    assert state._cycles("base_alerts") == [2]
    alerts = {r.alert_name: r for r in state.alerts().collect()}
    assert alerts["dead"].deadman_hits == 3 and len(alerts) == 2
    assert alerts["click"].new_count == state.log("processed", tick.CLAIM, 3).count()


def test_folders_of_the_state_are_bounded(events, spark, monkeypatch):
    from vigilake.operators import tick

    monkeypatch.setattr(tick, "COMPACT_EVERY", 2)
    monkeypatch.setattr(tick, "KEEP_OUTBOX", 3)
    state = StateFolder(spark, run_dir(spark, "b"))
    rules = [Rule("dead", "deadman", criteria="source = 'x'", summary="gone"), Rule("click", criteria="category = 'click'", lookback_minutes=MONTH)]
    for minute in range(8):
        run_tick(events, rules, state, f"2024-01-31 00:0{minute}:00", notify={"enabled": True, "webhook_url": "u"})
    assert state.done() == 8 and state._cycles("base_alerts") == [6, 8]
    assert sorted(state._cycles("alerts")) == sorted(state._cycles("done")) == [7, 8] and sorted(state._cycles("outbox")) == [6, 7, 8]
    alerts = {r.alert_name: r for r in state.alerts().collect()}
    assert alerts["dead"].deadman_hits == 8 and alerts["click"].new_count == state.alert_events().filter(F.col("alert_id") == alerts["click"].alert_id).count()
