import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigilake.operators import absence, ordered
from vigilake.operators.query import InvalidCriteria
from vigilake.operators.tick import StateFolder, run_tick
from vigilake.session import run_dir
from vigilake.sources.rules import Rule, rule_from_dict

START = datetime(2024, 1, 1)
SLOTS = tuple(Rule(n, criteria=f"category = '{n}'", aggregation_key="details.user", threshold=2 if n == "b" else None) for n in "abc")
RULE = Rule("abc", "sequence", lifespan="2 hours", slots=SLOTS, severity="HIGH", summary="{{metadata.value}} {{steps.0.eventid}}", strict_order=True)


def table(spark, rows):
    """rows: (minute, id, category, user)"""
    df = spark.createDataFrame([(START + timedelta(minutes=m), i, c, u) for m, i, c, u in rows], "utctimestamp timestamp, eventid string, category string, user string")
    details = F.parse_json(F.to_json(F.struct("user")))
    return df.select("utctimestamp", "eventid", F.lit("INFO").alias("severity"), F.lit("s").alias("summary"), "category", F.lit("x").alias("source"),
                     F.array(F.lit("t")).alias("tags"), F.array(F.lit("p")).alias("plugins"), details.alias("details"))


def brute(rows, states="abbc", life=120):
    """The automaton, event by event."""
    out = []
    for user in {r[3] for r in rows if r[3] and r[1]}:
        held, told = [None] * len(states), None
        for m, i, c, _ in sorted({(m, i, c, u) for m, i, c, u in rows if u == user and i}):
            for k in reversed(range(len(states))):
                if states[k] != c:
                    continue
                if k == 0:
                    held[0] = [(m, i)]
                elif held[k - 1]:
                    held[k] = [*held[k - 1], (m, i)]
                    if k == len(states) - 1 and held[k][0] != told and m - held[k][0][0] <= life:
                        told = held[k][0]
                        out.append((user, [x for _, x in held[k]]))
    return sorted(out)


@pytest.mark.parametrize("ranges", [None, 6])
def test_matches(spark, ranges):
    rnd = random.Random(11)
    rows = [(rnd.randrange(3000), f"e{i}", rnd.choice("abcbx"), "hot" if rnd.random() < 0.6 else rnd.choice(["u", "v", None])) for i in range(900)]
    rows += [(100, "", "a", "hot"), (5, "z1", "c", "w"), (4, "z2", "b", "w"), (3, "z3", "b", "w"), (2, "z4", "a", "w")]
    got = ordered.matches(table(spark, rows), RULE, ranges).select("value", F.transform("steps", lambda s: s["eventid"]).alias("s")).collect()
    assert sorted((r.value, r.s) for r in got) == brute(rows) and len(got) > 20


def test_rules_that_have_no_order(spark):
    for bad in (Rule("x", "sequence", slots=SLOTS[:1]), Rule("x", "sequence", slots=(SLOTS[0], Rule("d", "deadman", criteria="true"))),
                Rule("x", "sequence", slots=(SLOTS[0], Rule("r", criteria="category = '{{slots.0.metadata.value}}'")))):
        with pytest.raises(InvalidCriteria):
            ordered.states_of(bad)
    assert ordered.matches(table(spark, [(1, "a", "a", "u")]).limit(0), RULE).count() == 0


def test_lifespans():
    assert [ordered.life_seconds(Rule("x", lifespan=t)) for t in ("7 days", "1 hour", "30min", "soon", None)] == [604_800, 3_600, 1_800, 259_200, 259_200]
    doc = rule_from_dict({"alert_name": "x", "strict_order": True, "expected_values": [1, "b"], "alert_type": "deadman"})
    assert doc.strict_order and doc.expected_values == ("1", "b")


def test_cycles_report_a_match_once(spark):
    rows = [(1, "e1", "a", "u"), (2, "e2", "b", "u"), (3, "e3", "b", "u"), (4, "e4", "c", "u"), (3, "f1", "c", "v"), (2, "f2", "b", "v"), (1, "f3", "a", "v")]
    state = StateFolder(spark, run_dir(spark, "s"))
    bad = Rule("bad", "sequence", strict_order=True, slots=(SLOTS[0], Rule("d", "deadman", criteria="category = 'x'")))
    first = run_tick(table(spark, rows), [RULE, bad], state, START + timedelta(minutes=10))
    assert (first["published"], first["failed"]) == (1, 1)
    run_tick(table(spark, [*rows, (11, "f4", "b", "v"), (12, "f5", "c", "v")]), [RULE], state, START + timedelta(minutes=20))
    alerts = state.alerts().orderBy("value").collect()
    assert [(r.value, r.summary, r.cycle, r.alert_type) for r in alerts] == [("u", "u e1", 1, "sequence"), ("v", "v f3", 2, "sequence")]


def test_silences(spark):
    rule = Rule("gone", "deadman", criteria="category = 'a'", aggregation_key="details.user", lookback_minutes=30, expected_values=("u", "never"))
    rows = [(m, f"u{m}", "a", "u") for m in (10, 20, 60, 90)] + [(15, "w1", "a", "w"), (50, "x", "b", "w"), (5, "y", "a", None)]
    got = absence.absences(table(spark, rows), rule, START, START + timedelta(minutes=125), ranges=3).collect()
    minutes = sorted((r.value, int((r.last_heard - START).total_seconds()) // 60, r.expected) for r in got)
    # u was heard at its deadline at 90; `never` counts from the begin
    assert minutes == [("never", 0, True), ("u", 20, True), ("u", 90, True), ("w", 15, False)]


def test_an_absent_group_fires_while_others_report(spark):
    rule = Rule("gone", "deadman", criteria="category = 'a'", aggregation_key="details.user", lookback_minutes=30, expected_values=("u", "never"), summary="{{metadata.value}}")
    state = StateFolder(spark, run_dir(spark, "s"))
    run_tick(table(spark, [(9, "e", "a", "u"), (9, "f", "a", "w")]), [rule], state, START + timedelta(minutes=10))
    assert [(r.value, r.event_count) for r in state.alerts().collect()] == [("never", 0)]
