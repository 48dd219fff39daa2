"""Rules, claims, deadman folding, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilake.catalog.base import AS_OF, duck, events, flat, ts
from vigilake.operators import detect as d
from vigilake.operators import ruleindex as ri
from vigilake.operators import sequence as sq
from vigilake.session import materialise
from vigilake.sources.rules import Rule

DAY = 1440
LOGIN = Rule(
    alert_name="console_login", criteria="source='cloudtrail' AND STRING(details.eventname) = 'ConsoleLogin'",
    severity="MEDIUM", category="authentication", aggregation_key="details.user", threshold=3,
    lookback_minutes=20 * DAY, summary="User {{metadata.value}} {{metadata.count}} console logins",
    event_snippet="{{eventid}} from IP {{details.sourceipaddress}}", event_sample_count=2, tags=("login", "aws"),
)
ERRORS = Rule(
    alert_name="error_burst", criteria="severity IN ('WARNING', 'CRITICAL')", severity="HIGH",
    aggregation_key="details.project", threshold=20, lookback_minutes=15 * DAY,
    summary="{{alert_name}}: {{metadata.count}} errors in {{metadata.value}}, first {{events.0.eventid}}",
)
KEYS = Rule(
    alert_name="key_creation", criteria="JSON_VALUE(details.methodname) LIKE '%ServiceAccountKey%' AND 'gcp' IN UNNEST(tags)",
    severity="CRITICAL", threshold=1, lookback_minutes=5 * DAY, summary="{{metadata.count}} keys created",
)
RISKY = Rule(
    alert_name="risky", criteria="CAST(JSON_VALUE(details.k) AS INT64) > 90 OR CAST(JSON_VALUE(details.risk_score) AS FLOAT64) > 100",
    severity="LOW", aggregation_key="category", threshold=10, lookback_minutes=10 * DAY,
    summary="{{metadata.count}} risky {{metadata.value}}",
)
RULES = [LOGIN, ERRORS, KEYS, RISKY]

# the same rules for DuckDB: (name, condition, value, threshold, minutes)
_SQL_RULES = [
    ("console_login", "source = 'cloudtrail' AND eventname = 'ConsoleLogin'", "identity", 3, 20 * DAY),
    ("error_burst", "severity IN ('WARNING', 'CRITICAL')", "project", 20, 15 * DAY),
    ("key_creation", "methodname LIKE '%ServiceAccountKey%' AND list_contains(tags, 'gcp')", "'all'", 1, 5 * DAY),
    ("risky", "(k > 90 OR value > 100)", "category", 10, 10 * DAY),
]
_HITS = "hit AS (\n" + "\nUNION ALL\n".join(
    f"""SELECT {i} AS rule_no, '{n}' AS alert_name, {v} AS val, {t} AS threshold, eventid, utctimestamp, source_ip
FROM ev WHERE {c} AND {v} IS NOT NULL AND utctimestamp >= {ts()} - INTERVAL {m} MINUTE"""
    for i, (n, c, v, t, m) in enumerate(_SQL_RULES)
) + """
), fired AS (
  SELECT rule_no, alert_name, val, count(*) AS n FROM hit GROUP BY rule_no, alert_name, val, threshold
  HAVING count(*) >= threshold
), member AS (
  SELECT h.*, f.n, row_number() OVER (PARTITION BY eventid ORDER BY h.rule_no, h.val) AS claim_no,
    row_number() OVER (PARTITION BY h.rule_no, h.val ORDER BY utctimestamp, eventid) AS pos
  FROM hit h JOIN fired f ON f.rule_no = h.rule_no AND f.val = h.val
)"""


def _threshold(spark, sf):
    e = events(spark, sf)
    ws = d.watches_of([LOGIN])
    return flat(d.threshold(e, ws, AS_OF).alerts.select("alert_name", "value", "event_count", "summary", "severity", "category", "tags"))


def _multi(spark, sf):
    e = events(spark, sf)
    return flat(d.threshold(e, d.watches_of(RULES), AS_OF).alerts.select("alert_name", "value", "event_count", "new_count"))


def _multi_counts(spark, sf):
    e = events(spark, sf)
    ws = d.watches_of(RULES)
    fired = d.threshold_triggers(d.count_hits(d.hits(e, ws, AS_OF)), ws)
    return fired.select(d.of_watch(ws, lambda w: w.rule.alert_name).alias("alert_name"), "value", "event_count")


def _claims(spark, sf):
    e = events(spark, sf)
    ev = d.threshold(e, d.watches_of(RULES), AS_OF)
    named = ev.alerts.select("alert_id", "alert_name", "value")
    return flat(ev.claimed.join(named, "alert_id").select("alert_name", "value", "eventid"))


def _summaries(spark, sf):
    e = events(spark, sf)
    return d.threshold(e, d.watches_of([ERRORS, KEYS]), AS_OF).alerts.select("alert_name", "summary")


def _processed(e):
    return e.filter(F.col("category") == "signup").select("eventid", F.col("utctimestamp").alias("processed_at"))


def _new_events(spark, sf):
    e = events(spark, sf)
    left = d.new_events(e, _processed(e))
    return flat(left.select("eventid", "utctimestamp", "category"))


def _second_tick(spark, sf):
    """The rules again when events of earlier alerts are spent already."""
    e = events(spark, sf)
    spent = e.filter(F.col("eventid").endswith("5"))
    ev = d.threshold(e, d.watches_of(RULES), AS_OF, spent.select("eventid"))
    return flat(ev.alerts.select("alert_name", "value", "event_count", "new_count"))


FEEDS = [
    Rule(alert_name="dead_activity", alert_type="deadman", severity="CRITICAL", lookback_minutes=3 * DAY,
         criteria="source='gcp_audit' AND JSON_VALUE(details.audit_log_type) = 'activity'", summary="no activity"),
    Rule(alert_name="dead_other", alert_type="deadman", severity="HIGH", lookback_minutes=3 * DAY,
         criteria="source='okta'", summary="no {{metadata.value}} events ({{metadata.count}})"),
    Rule(alert_name="quiet_user", alert_type="deadman", severity="LOW", lookback_minutes=30 * DAY, threshold=15,
         criteria="category='purchase'", aggregation_key="details.user", event_snippet="last {{eventid}}",
         event_sample_count=1, summary="{{metadata.value}} only {{metadata.count}}"),
    Rule(alert_name="dead_keyed", alert_type="deadman", severity="LOW", lookback_minutes=60,
         criteria="source='nothing'", aggregation_key="details.user", summary="{{metadata.value}} absent"),
]


def _deadman(spark, sf):
    e = events(spark, sf)
    return flat(d.deadman(e, d.watches_of(FEEDS), AS_OF).select("alert_name", "value", "event_count", "summary"))


def _open_deadman(e):
    """Open and closed deadman alerts made from the table: one per user number below ten."""
    kinds = e.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.min("utctimestamp").alias("created_at"))
    sample = F.array(F.struct(
        F.col("created_at").alias("utctimestamp"), F.col("category").alias("eventid"), F.lit("{}").alias("record")))
    return kinds.select(
        F.concat(F.lit("id-"), "category").alias("alert_id"),
        F.when(F.col("category") == "error", "dead_activity").when(F.col("category") == "view", "dead_other")
        .otherwise(F.concat(F.lit("dead_"), "category")).alias("alert_name"),
        F.lit("deadman").alias("alert_type"), F.lit("HIGH").alias("severity"), F.lit("old").alias("summary"),
        F.lit("deadman").alias("category"), F.array().cast("array<string>").alias("tags"),
        F.lit("OPEN").alias("status"), "created_at", F.lit("all").alias("value"),
        F.lit(0).cast("long").alias("event_count"), F.lit(0).cast("long").alias("new_count"),
        sample.alias("events"), F.col("n").alias("deadman_hits"), F.col("created_at").alias("last_triggered_at"),
    )


def _fold(spark, sf):
    e = events(spark, sf)
    caps = {r.alert_name: max(1, r.event_sample_count or 3) for r in FEEDS}
    out = d.fold_deadman(_open_deadman(e), d.deadman(e, d.watches_of(FEEDS), AS_OF), caps, AS_OF)
    return flat(out.select("alert_name", "deadman_hits", "first_hit", "created_at",
                           F.size("events").cast("long").alias("kept_events"), "last_triggered_at"))


_DEAD_SQL = f"""act AS (SELECT count(*) AS n FROM ev WHERE source = 'gcp_audit' AND audit_log_type = 'activity'
    AND utctimestamp >= {ts()} - INTERVAL {3 * DAY} MINUTE),
  quiet AS (SELECT identity, count(*) AS n, min_by(eventid, (utctimestamp, eventid)) AS first_id
    FROM ev WHERE category = 'purchase' AND identity IS NOT NULL GROUP BY identity HAVING count(*) <= 15),
  dead AS (
    SELECT 'dead_activity' AS alert_name, 'all' AS value, n AS event_count, 'no activity' AS summary FROM act WHERE n <= 0
    UNION ALL SELECT 'dead_other', 'all', 0, 'no all events (0)'
    UNION ALL SELECT 'quiet_user', identity, n, identity || ' only ' || n || ' last ' || first_id FROM quiet
    UNION ALL SELECT 'dead_keyed', 'details.user', 0, 'details.user absent')"""

ROLL = Rule(alert_name="roll", criteria="category IN ('error', 'click')", aggregation_key="details.user", lookback_minutes=DAY)

# all events, in three groups, over the whole retention
EVERY = Rule(alert_name="every", criteria="utctimestamp IS NOT NULL", aggregation_key="source", lookback_minutes=425 * DAY)


def _rolling(spark, sf):
    e = events(spark, sf)
    return flat(d.rolling_rule_counts(e, d.watches_of([ROLL])[0]).select("eventid", "utctimestamp", "value", "n"))


T1, T2 = "2024-01-20 00:00:00", "2024-01-24 00:00:00"
_SLOT0 = Rule(alert_name="key", criteria="JSON_VALUE(details.methodname) LIKE '%CreateServiceAccountKey'",
              aggregation_key="details.user", lookback_minutes=5 * DAY, summary="{{metadata.count}} keys")
KEY_THEN_ERRORS = Rule(
    alert_name="key_then_errors", alert_type="sequence", severity="HIGH", category="iam", lifespan="7 days",
    summary="{{metadata.count}} events by {{slots.0.events.0.details.user}}: {{slots.0.metadata.count}} keys",
    slots=(_SLOT0, Rule(alert_name="errors", aggregation_key="details.user", threshold=2, lookback_minutes=4 * DAY,
                        criteria="category = 'error' AND JSON_VALUE(details.user) = '{{slots.0.events.0.details.user}}'")),
)
KEY_THEN_QUIET = Rule(
    alert_name="key_then_quiet", alert_type="sequence", severity="LOW", lifespan="7 days", summary="quiet {{slots.0.metadata.value}}",
    slots=(_SLOT0, Rule(alert_name="no_purchase", alert_type="deadman", threshold=0, lookback_minutes=4 * DAY,
                        criteria="category = 'purchase' AND JSON_VALUE(details.user) = '{{slots.0.events.0.details.user}}'")),
)
KEY_THEN_ANY = Rule(
    alert_name="key_then_any", alert_type="sequence", severity="LOW", lifespan="2 hours", summary="x",
    slots=(_SLOT0, Rule(alert_name="clicks", aggregation_key="source", threshold=1, lookback_minutes=4 * DAY, criteria="category = 'click'")),
)


def _sequence(spark, sf, rule):
    e = events(spark, sf)
    begun = sq.sequence_start(e, [rule], T1, closed=True)
    # state lives in tables between ticks
    begun.inflight, begun.claimed = materialise(begun.inflight, "inflight"), materialise(begun.claimed, "claimed")
    return sq.sequence_advance(e, sq.expire_inflight(begun.inflight, T2), [rule], T2, begun.claimed, closed=True)


def _started(spark, sf):
    e = events(spark, sf)
    begun = sq.sequence_start(e, [KEY_THEN_ERRORS], T1, closed=True).inflight
    slot = F.get("slots", F.lit(0))
    return flat(begun.select("alert_name", slot["value"].alias("value"), slot["event_count"].alias("n"),
                             slot["summary"].alias("slot_summary"), "expiration", F.size("slots").cast("long").alias("filled")))


def _finished(rule):
    return lambda s, p: flat(_sequence(s, p, rule).alerts.select("alert_name", "value", "event_count", "summary", "created_at"))


def _rank_matched(spark, sf):
    """Slot without references: the i-th sequence takes the i-th trigger; the others keep waiting."""
    e = events(spark, sf)
    rule = KEY_THEN_ANY
    begun = sq.sequence_start(e, [rule], T1, closed=True)
    begun.inflight, begun.claimed = materialise(begun.inflight, "inflight"), materialise(begun.claimed, "claimed")
    out = sq.sequence_advance(e, begun.inflight, [rule], T2, begun.claimed, closed=True)
    first = F.get("events", F.lit(0))["record"]
    return out.alerts.agg(F.count(F.lit(1)).alias("done"), F.count(first).alias("with_first")).select(
        "done", "with_first", out.inflight.agg(F.count(F.lit(1)).alias("c")).scalar().alias("waiting"))


def _all_expired(spark, sf):
    e = events(spark, sf)
    begun = sq.sequence_start(e, [KEY_THEN_ANY, KEY_THEN_ERRORS], T1, scope="rule", closed=True).inflight
    return sq.expire_inflight(begun, T2).groupBy("alert_name").agg(F.count(F.lit(1)).alias("alive"))


_SEQ = f"""s0 AS (SELECT identity, count(*) AS n0 FROM ev WHERE methodname LIKE '%CreateServiceAccountKey' AND identity IS NOT NULL
    AND utctimestamp BETWEEN {ts(T1)} - INTERVAL {5 * DAY} MINUTE AND {ts(T1)} GROUP BY identity),
  win AS (SELECT * FROM ev WHERE utctimestamp BETWEEN {ts(T2)} - INTERVAL {4 * DAY} MINUTE AND {ts(T2)})"""

# a thousand rules, two for each of 500 users, of four kinds
_KINDS = (
    "source = 'cloudtrail' AND JSON_VALUE(details.user) = '{who}'",
    "category IN ('click', 'view', 'error') AND STRING(details.user) = '{who}' AND CAST(JSON_VALUE(details.k) AS INT64) > {k}",
    "'gcp' IN UNNEST(tags) AND JSON_VALUE(details.user) = '{who}'",
    "(severity = 'WARNING' OR severity = 'CRITICAL') AND JSON_VALUE(details.user) = '{who}'",
)
MANY = [
    Rule(alert_name=f"many_{i}", criteria=_KINDS[i % 4].format(who=f"user{i % 500}@example.com", k=i % 90), severity="LOW",
         aggregation_key=("category", "", "details.project")[i % 3], threshold=1 + i % 2, lookback_minutes=(20 + i % 10) * DAY,
         summary=f"{i}: {{{{metadata.value}}}} {{{{metadata.count}}}} {{{{events.0.eventid}}}}", event_snippet="{{category}}", event_sample_count=i % 2)
    for i in range(1000)
]
_MANY_SQL = f"""rule AS (SELECT i, 'user' || (i % 500) || '@example.com' AS who, i % 90 AS least_k, 1 + i % 2 AS threshold, 20 + i % 10 AS days FROM range(1000) t(i)),
hit AS (SELECT i AS rule_no, threshold, eventid, utctimestamp, category, CASE i % 3 WHEN 0 THEN category WHEN 1 THEN 'all' ELSE project END AS val
  FROM ev JOIN rule ON identity = who AND CASE i % 4 WHEN 0 THEN source = 'cloudtrail' WHEN 1 THEN category IN ('click', 'view', 'error') AND k > least_k
    WHEN 2 THEN list_contains(tags, 'gcp') ELSE severity IN ('WARNING', 'CRITICAL') END AND utctimestamp >= {ts()} - days * INTERVAL 1 DAY),
fired AS (SELECT rule_no, val, count(*) AS n FROM hit WHERE val IS NOT NULL GROUP BY rule_no, val, threshold HAVING count(*) >= threshold),
member AS (SELECT h.*, f.n, row_number() OVER (PARTITION BY eventid ORDER BY h.rule_no, h.val) AS claim_no,
  row_number() OVER (PARTITION BY h.rule_no, h.val ORDER BY utctimestamp, eventid) AS pos FROM hit h JOIN fired f ON f.rule_no = h.rule_no AND f.val = h.val)"""


def _many(spark, sf):
    """A thousand rules through the predicate index."""
    return flat(ri.evaluate(events(spark, sf), MANY, AS_OF).alerts.select("alert_name", "value", "event_count", "new_count", "summary"))


def _many_claims(spark, sf):
    """The events each of a thousand rules' alerts has claimed."""
    ev = ri.evaluate(events(spark, sf), MANY, AS_OF)
    return flat(ev.claimed.join(ev.alerts.select("alert_id", "alert_name", "value"), "alert_id").select("alert_name", "value", "eventid"))


def _indexed_deadman(spark, sf):
    return flat(ri.evaluate(events(spark, sf), FEEDS, AS_OF).alerts.select("alert_name", "value", "event_count", "summary"))


QUERIES = {
    "rule_index": (
        _many,
        duck(_MANY_SQL + """
---
SELECT 'many_' || rule_no AS alert_name, val AS value, n AS event_count, count(*) FILTER (claim_no = 1) AS new_count,
  rule_no || ': ' || val || ' ' || n || ' ' || min(eventid) FILTER (pos = 1) || CASE WHEN rule_no % 2 = 1 THEN ' ' || min(category) FILTER (pos = 1) ELSE '' END AS summary
FROM member GROUP BY rule_no, val, n HAVING count(*) FILTER (claim_no = 1) > 0"""),
    ),
    "rule_index_claims": (
        _many_claims,
        duck(_MANY_SQL + "\n---\nSELECT 'many_' || rule_no AS alert_name, val AS value, eventid FROM member WHERE claim_no = 1"),
    ),
    "rule_index_deadman": (_indexed_deadman, duck(_DEAD_SQL + "---\nSELECT * FROM dead")),
    "sequence_start": (
        _started,
        duck(_SEQ + f"""
---
SELECT 'key_then_errors' AS alert_name, identity AS value, n0 AS n, n0 || ' keys' AS slot_summary,
  {ts(T1)} + INTERVAL 7 DAY AS expiration, CAST(1 AS BIGINT) AS filled FROM s0"""),
    ),
    "sequence_two_slot": (
        _finished(KEY_THEN_ERRORS),
        duck(_SEQ + f""", s1 AS (SELECT identity, count(*) AS n1 FROM win WHERE category = 'error' GROUP BY identity HAVING count(*) >= 2)
---
SELECT 'key_then_errors' AS alert_name, identity AS value, n0 + n1 AS event_count,
  (n0 + n1) || ' events by ' || identity || ': ' || n0 || ' keys' AS summary, {ts(T2)} AS created_at FROM s0 JOIN s1 USING (identity)"""),
    ),
    "sequence_deadman_slot": (
        _finished(KEY_THEN_QUIET),
        duck(_SEQ + f"""
---
SELECT 'key_then_quiet' AS alert_name, identity AS value, n0 AS event_count, 'quiet ' || identity AS summary, {ts(T2)} AS created_at
FROM s0 WHERE identity NOT IN (SELECT identity FROM win WHERE category = 'purchase' AND identity IS NOT NULL)"""),
    ),
    "sequence_rank_matched": (
        _rank_matched,
        duck(_SEQ + f""", t AS (SELECT source, count(*) AS c, row_number() OVER (ORDER BY count(*) DESC) AS rn FROM win
    WHERE category = 'click' GROUP BY source)
---
SELECT least((SELECT count(*) FROM t), (SELECT count(*) FROM s0)) AS done,
  least((SELECT count(*) FROM t), (SELECT count(*) FROM s0)) AS with_first,
  (SELECT count(*) FROM s0) - (SELECT count(*) FROM t) AS waiting"""),
    ),
    "expire_inflight": (
        _all_expired,
        duck(_SEQ + "\n---\nSELECT 'key_then_errors' AS alert_name, count(*) AS alive FROM s0"),
    ),
    "count_by_key": (
        lambda s, p: d.count_by_key(events(s, p), "details.user"),
        duck("SELECT identity AS value, count(*) AS event_count FROM ev WHERE identity IS NOT NULL GROUP BY identity"),
    ),
    "count_by_list_key": (
        lambda s, p: d.count_by_key(events(s, p), "tags"),
        duck("""SELECT '["' || array_to_string(tags, '","') || '"]' AS value, count(*) AS event_count FROM ev GROUP BY 1"""),
    ),
    "count_all": (
        lambda s, p: d.count_by_key(events(s, p), "none"),
        duck("SELECT 'all' AS value, count(*) AS event_count FROM ev"),
    ),
    "threshold_alerts": (
        _threshold,
        duck(_HITS + """---
SELECT alert_name, val AS value, n AS event_count, 'MEDIUM' AS severity, 'authentication' AS category, 'login,aws' AS tags,
  'User ' || val || ' ' || n || ' console logins ' ||
  string_agg(eventid || ' from IP ' || coalesce(source_ip, ''), ' ' ORDER BY pos) AS summary
FROM member WHERE rule_no = 0 AND pos <= 2 GROUP BY alert_name, val, n"""),
    ),
    "alert_summaries": (
        _summaries,
        duck(_HITS + """---
SELECT alert_name, 'error_burst: ' || n || ' errors in ' || val || ', first ' || eventid AS summary
FROM member WHERE rule_no = 1 AND pos = 1
UNION ALL SELECT alert_name, n || ' keys created' FROM fired WHERE rule_no = 2"""),
    ),
    "multi_rule_one_scan": (
        _multi_counts,
        duck(_HITS + "---\nSELECT alert_name, val AS value, n AS event_count FROM fired"),
    ),
    "claimed_alerts": (
        _multi,
        duck(_HITS + """---
SELECT alert_name, val AS value, n AS event_count, count(*) AS new_count FROM member
WHERE claim_no = 1 GROUP BY alert_name, val, n"""),
    ),
    "claim_events": (
        _claims,
        duck(_HITS + "---\nSELECT alert_name, val AS value, eventid FROM member WHERE claim_no = 1"),
    ),
    "second_tick": (
        _second_tick,
        duck(_HITS + """, left_over AS (
  SELECT *, row_number() OVER (PARTITION BY eventid ORDER BY rule_no, val) AS c FROM member WHERE NOT eventid LIKE '%5')
---
SELECT alert_name, val AS value, n AS event_count, count(*) AS new_count FROM left_over
WHERE c = 1 GROUP BY alert_name, val, n"""),
    ),
    "new_events_anti": (
        _new_events,
        duck("SELECT eventid, utctimestamp, category FROM ev WHERE category <> 'signup'"),
    ),
    "deadman_alerts": (_deadman, duck(_DEAD_SQL + "---\nSELECT * FROM dead")),
    "deadman_fold": (
        _fold,
        duck(_DEAD_SQL + f""", old AS (
  SELECT CASE category WHEN 'error' THEN 'dead_activity' WHEN 'view' THEN 'dead_other' ELSE 'dead_' || category END AS alert_name,
    count(*) AS hits, min(utctimestamp) AS created_at FROM ev GROUP BY category)
---
SELECT d.alert_name, coalesce(o.hits, 0) + count(*) AS deadman_hits, o.hits IS NULL AS first_hit,
  coalesce(o.created_at, {ts()}) AS created_at,
  CAST(CASE d.alert_name WHEN 'dead_other' THEN 2 ELSE 1 END AS BIGINT) AS kept_events,
  {ts()} AS last_triggered_at
FROM dead d LEFT JOIN old o ON o.alert_name = d.alert_name GROUP BY d.alert_name, o.hits, o.created_at"""),
    ),
    "rolling_count_long": (
        lambda s, p: flat(d.rolling_rule_counts(events(s, p), d.watches_of([EVERY])[0]).select("eventid", "utctimestamp", "value", "n")),
        duck("""SELECT eventid, utctimestamp, source AS value, count(*) OVER (
  PARTITION BY source ORDER BY utctimestamp RANGE BETWEEN INTERVAL 425 DAY PRECEDING AND CURRENT ROW) AS n FROM ev"""),
    ),
    "rolling_count": (
        _rolling,
        duck(f"""SELECT eventid, utctimestamp, identity AS value, count(*) OVER (
  PARTITION BY identity ORDER BY utctimestamp RANGE BETWEEN INTERVAL {DAY} MINUTE PRECEDING AND CURRENT ROW) AS n
FROM ev WHERE category IN ('error', 'click') AND identity IS NOT NULL"""),
    ),
}
