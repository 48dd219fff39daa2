import json
import time

import pytest
from pyspark.sql import functions as F

from vigilake.catalog.detection import FEEDS, RULES
from vigilake.operators import detect as d
from vigilake.operators import ruleindex as ri
from vigilake.sources.rules import Rule, load_rules
from vigilake.sources.sample import AS_OF

MONTH = 43200
ODD = [
    Rule("every", criteria="severity = 'INFO' OR category = 'error'", threshold=50, lookback_minutes=MONTH, aggregation_key="source", summary="{{events.1.eventid}} {{events.0.tags.0}}", event_snippet="[x]", event_sample_count=1),
    Rule("in", criteria="category IN ('click', 'view') AND source = 'gcp_audit' AND NOT summary LIKE '%1 %'", lookback_minutes=MONTH, summary="{{severity}} {{nothing}} {{metadata.value}}", tags=("a", "b,c")),
    Rule("or", criteria="(eventname = 'ConsoleLogin' OR eventname = 'DeleteBucket') AND array_contains(tags, 'login')", lookback_minutes=9000, aggregation_key="details.user", threshold=2, summary="a {{alert_name}}", event_snippet="{{details.user}}/{{details.k}};", event_sample_count=3),
    Rule("swapped", criteria="'error' = category AND identity IS NOT NULL", lookback_minutes=MONTH, aggregation_key="tags", summary="t {{metadata.count}}"),
    Rule("two tags", criteria="'gcp' IN UNNEST(tags) AND 'gcp_audit' IN UNNEST(tags)", lookback_minutes=2000, threshold=1, summary="s"),
    Rule("never", criteria="category = NULL AND source = 'gcp_audit'", lookback_minutes=MONTH, summary="n"),
    Rule("quoted", criteria="summary = 'it''s AND source = 1'", lookback_minutes=MONTH, summary="n"),
]


def alerts(ev):
    rows = ev.select("alert_id", "alert_name", "summary", "value", "event_count", "new_count", "severity", "tags", F.to_json("events").alias("events")).collect()
    return sorted(map(tuple, rows), key=repr)


def test_parts_of_criteria(events):
    texts = ["source = 'a' AND (category = 'b' OR category IN ('c', 'b')) AND value > 1", "JSON_VALUE(details.user) = 'u'", "array_contains(tags, 'x')",
             "source = 'a' OR category = 'b'", "event_date = '2024-01-01'", "NOT source = 'a'", ""]
    found = ri.split_criteria(events, texts)
    assert [[(p.column, p.texts) for p in s.parts] for s in found] == [
        [("source", ("a",)), ("category", ("b", "c"))], [("identity", ("u",))], [("tags", ("x",))], [], [], [], []]
    assert [s.rest for s in found] == [True, False, False, True, True, True, False]


@pytest.mark.parametrize("scope", ["global", "rule"])
def test_same_alerts_as_rule_by_rule(events, scope):
    rules = [*RULES, *ODD]
    spent = events.filter(F.col("eventid").endswith("5")).select("eventid")
    one, two = (f(events, rules, AS_OF, spent, scope) for f in (d.evaluate_rules, ri.evaluate))
    assert alerts(two.alerts) == alerts(one.alerts) and len(alerts(one.alerts)) > 10
    claims = lambda ev: sorted(map(tuple, ev.claimed.select("alert_id", "eventid").collect()))
    assert claims(one) == claims(two)


def test_same_deadman_alerts(events):
    assert alerts(ri.evaluate(events, FEEDS, AS_OF).alerts) == alerts(d.evaluate_rules(events, FEEDS, AS_OF).alerts)


def test_bad_and_no_rules(events):
    out = ri.evaluate(events, [Rule("bad", criteria="nope = 'x'"), Rule("none", criteria="source = 'x'")], AS_OF)
    assert [n for n, _ in out.failed] == ["bad"] and out.alerts.count() == 0
    assert ri.evaluate(events, [], AS_OF).alerts.count() == 0


def test_events_without_ids_and_repeated_events(events):
    twice = events.withColumn("eventid", F.when(F.col("k") > 50, "").when(F.col("k") > 40, None).otherwise(F.col("eventid"))) if "k" in events.columns else events
    twice = twice.withColumn("eventid", F.when(F.col("source") == "cloudtrail", F.lit("")).when(F.col("category") == "view", None).otherwise(F.col("eventid")))
    rules = [Rule("c", criteria="source = 'cloudtrail'", lookback_minutes=MONTH, aggregation_key="category", event_sample_count=2),
             Rule("v", criteria="category = 'view'", lookback_minutes=MONTH, event_sample_count=0)]
    one, two = (f(twice, rules, AS_OF).alerts.select("alert_name", "value", "event_count", "new_count", F.size("events")).collect() for f in (d.evaluate_rules, ri.evaluate))
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_a_thousand_rules_are_planned_in_seconds(events):
    rules = [
        Rule(f"r{i}", criteria=f"source = 'cloudtrail' AND JSON_VALUE(details.user) = 'user{i}@example.com'" + (f" AND CAST(JSON_VALUE(details.k) AS INT64) > {i % 90}" if i % 10 == 0 else ""),
             lookback_minutes=MONTH, threshold=1, summary=f"{i}: {{{{metadata.count}}}} by {{{{events.0.details.user}}}}", event_snippet="{{eventid}}", event_sample_count=1)
        for i in range(1000)
    ]
    begun = time.perf_counter()
    out = ri.evaluate(events, rules, AS_OF)
    plan = out.alerts._jdf.queryExecution().executedPlan().toString()
    took = time.perf_counter() - begun
    assert took < 10 and "from_json" not in plan
    got = {r.alert_name: r.event_count for r in out.alerts.collect()}
    few = [r for r in rules if int(r.alert_name[1:]) < 15]
    assert {k: v for k, v in got.items() if int(k[1:]) < 15} == {r.alert_name: r.event_count for r in d.evaluate_rules(events, few, AS_OF, scope="rule").alerts.collect()}


def test_events_are_not_read_again_when_nothing_is_new(events, monkeypatch):
    read, plain = [], ri.hits
    monkeypatch.setattr(ri, "hits", lambda ev, *a, **k: read.append((k.get("whole", True), ev.isEmpty())) or plain(ev, *a, **k))
    watches = d.watches_of([r for r in ODD if r.alert_name == "every"])
    claimed = events.select(F.lit("a").alias("alert_id"), "eventid", "utctimestamp")
    assert ri.threshold(events, watches, AS_OF, claimed).alerts.count() == 0
    assert read == [(False, False), (True, True)]
    assert ri.threshold(events, watches, AS_OF).alerts.count() > 0


def documents(spark, rules, bad=()):
    docs = [(f"{i:05d}", json.dumps(vars(r))) for i, r in enumerate(rules)]
    return spark.createDataFrame([*docs, *bad], "name string, yaml string").withColumn("enabled", F.lit(None).cast("boolean")).repartition(3)


@pytest.mark.parametrize("scope", ["global", "rule"])
def test_rules_that_stay_a_table(spark, events, scope, monkeypatch):
    """The same alerts and claims as with all rules in the plan, rules among them that are no data."""
    plain = [*RULES, *ODD, *FEEDS, Rule("bad", criteria="nope = 'x'"), Rule("typo", criteria="category = 'click' AND nope = 1"), Rule("told", criteria="drop 'x'"),
             Rule("guarded", criteria="category = 'nothing' AND 10 / length(replace(category, 'click', '')) > 1", lookback_minutes=MONTH)]
    rules = [Rule(f"u{i}", criteria=f"category = '{'click' if i % 2 else 'view'}' AND JSON_VALUE(details.user) = 'user{i}@example.com'" + " AND severity <> 'HIGH'" * (i % 3 == 0),
                  lookback_minutes=MONTH if i % 5 else 9000, threshold=1 + i % 2, aggregation_key="source" if i % 4 == 0 else "", summary=f"{i} {{{{alert_name}}}} {{{{events.0.details.user}}}} {{{{metadata.count}}}}",
                  event_snippet="{{eventid}};" if i % 2 else "", tags=("t", f"{i}")) for i in range(15)] + [r for r in plain if r.alert_type != "sequence"]
    monkeypatch.setattr(ri, "FEW", 3)
    seen = []
    inner = ri.TableRules
    monkeypatch.setattr(ri, "TableRules", lambda rows, ws, numbers: seen.append((rows.count(), len(ws))) or inner(rows, ws, numbers))
    spent = events.filter(F.col("eventid").endswith("5")).select("eventid")
    held, refused = load_rules(table=documents(spark, rules, [("99999", "no rule"), (None, ": [")]))
    one, two = ri.evaluate(events, rules, AS_OF, spent, scope), ri.evaluate(events, held, AS_OF, spent, scope)
    assert seen[0][0] >= 15 and 0 < seen[0][1] < len(rules) - 15
    assert alerts(two.alerts) == alerts(one.alerts) and len(alerts(one.alerts)) > 20
    claims = lambda ev: sorted(map(tuple, ev.claimed.select("alert_id", "eventid").collect()))
    assert claims(one) == claims(two) and two.failed == one.failed and {"bad", "typo", "told"} <= {n for n, _ in two.failed}
    assert len(held) == len(rules) and len(refused) == 2


def test_many_rules_do_not_come_to_the_driver(spark, events, monkeypatch):
    rules = [Rule(f"r{i}", criteria=f"category = 'click' AND JSON_VALUE(details.user) = 'user{i}@example.com'", lookback_minutes=MONTH, summary="{{metadata.count}}") for i in range(3000)]
    held, _ = load_rules(table=documents(spark, rules))
    monkeypatch.setattr(ri.Documents, "read", lambda self: pytest.fail("rules were read as a list"))
    out = ri.evaluate(events, held, AS_OF)
    plan = out.alerts._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 200_000 and "user2999@" not in plan
    got = {r.alert_name: r.event_count for r in out.alerts.collect()}
    want = events.filter("category = 'click' AND identity LIKE 'user%' AND utctimestamp >= timestamp '2024-01-31 00:00:00' - INTERVAL 30 DAY").groupBy("identity").count().collect()
    assert got == {"r" + r.identity[4:].split("@")[0]: r["count"] for r in want} and got


def test_parts_of_a_condition():
    strings = {"category", "identity"}
    assert ri.equal_parts("category = 'a' AND 'u' = Identity AND (x OR y) AND n > 1", strings) == (["category", "identity"], ["a", "u"], "((x OR y)) AND (n > 1)")
    assert ri.equal_parts("category = 'a AND b'", strings) == (["category"], ["a AND b"], "")
    for text in ("category = 'a' OR x", "NOT category = 'a'", "category = 'it''s'", "category = 'a\\'b'", "n = 'a'", "category = 'a' AND n BETWEEN 1 AND 2", "category = 'a' = true", "", "(category = 'a' AND x)"):
        assert ri.equal_parts(text, strings) is None
