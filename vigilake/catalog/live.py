"""Streams run to their end over the test tables, and detection cycles on state tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilake.catalog import normalise as n
from vigilake.catalog.base import duck, events, flat, ts
from vigilake.catalog.detection import FEEDS, KEY_THEN_ERRORS, LOGIN
from vigilake.functions.jsonfn import jv
from vigilake.operators import ordered
from vigilake.operators import ruleindex as ri
from vigilake.operators.absence import absences
from vigilake.operators.tick import StateFolder, run_tick
from vigilake.session import run_dir
from vigilake.sources import sample
from vigilake.sources.outbox import notification_outbox
from vigilake.sources.rules import Rule
from vigilake.sources.tables import read_events
from vigilake.streaming.absence import absence_stream
from vigilake.streaming.detect import sliding_alerts
from vigilake.streaming.ingest import drop_repeats, ingest
from vigilake.streaming.sequences import ordered_stream

DAY = 1440
ONCE = {"availableNow": True}
BURST = Rule(alert_name="burst", criteria="severity = 'INFO'", aggregation_key="source", threshold=2, lookback_minutes=5)
TICKS = ("2024-01-12 00:00:00", "2024-01-17 00:00:00", "2024-01-22 00:00:00")


def _stream(spark, sf, build):
    """Run a builder over the events table as a file stream instead of a batch read."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return build(source)


def _to_table(df, spark, name):
    path = run_dir(spark, name)
    q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", path + "-cp").trigger(**ONCE).start()
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def _ingested(spark, sf):
    """Raw messages through the streaming ingest into a day-partitioned table, read back."""
    n.configure(spark)
    raw = _stream(spark, sf, lambda src: n.generic_messages(n.with_columns(src)))
    path = run_dir(spark, "ingest")
    ingest(raw, f"{path}/events", f"{path}/cp", f"{path}/bad", trigger=ONCE, now=n.now()).awaitTermination()
    back = read_events(spark, f"{path}/events")
    d = F.col("details")
    return flat(back.select(
        "eventid", "utctimestamp", "source", "category", "severity", "summary", F.col("source_ip").alias("src"),
        jv(d, "destinationipaddress").alias("dst"), F.col("event_date").cast("string").alias("event_date"),
    ))


def _messages(src):
    """Good messages, broken ones of several kinds, plain lines; every seventh comes twice, and none in order of time."""
    n_ = F.col("event_id").cast("string")
    good = F.to_json(F.struct(F.col("event_id").alias("n"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")))
    body = (
        F.when(F.col("event_id") % 20 == 0, F.concat(F.lit('{"a": 1e400, "n": '), n_, F.lit("}")))
        .when(F.col("event_id") % 20 == 1, F.concat(F.lit('{"cut": '), n_))
        .when(F.col("event_id") % 20 == 2, F.concat(F.lit("[" ), n_, F.lit("]")))
        .when(F.col("event_id") % 20 == 3, F.concat(F.lit('{"half": "\\ud800", "n": '), n_, F.lit("}")))
        .when(F.col("event_id") % 20 == 4, F.concat(F.lit("line "), n_))
        .otherwise(good)
    )
    copies = F.when(F.col("event_id") % 7 == 0, 2).otherwise(1)
    return src.withColumn("value", body).select("value", F.explode(F.sequence(F.lit(1), copies)).alias("_copy")).select("value")


def _accounted(spark, sf):
    """Every message of a troubled stream ends as an event, in quarantine, or as a repeat."""
    n.configure(spark)
    path = run_dir(spark, "account")
    ingest(_stream(spark, sf, _messages), f"{path}/events", f"{path}/cp", f"{path}/bad", trigger=ONCE, dedup="1 hour", now=n.now()).awaitTermination()
    kept = read_events(spark, f"{path}/events").groupBy(F.when(F.col("details").cast("string").contains("raw_log"), "line").otherwise("event").alias("outcome")).count()
    bad = spark.read.json(f"{path}/bad").groupBy(F.col("problem").alias("outcome")).count()
    return kept.unionByName(bad).withColumnRenamed("count", "n")


def _deduplicated(spark, sf):
    """Every message delivered twice; one event of each stays."""
    events(spark, sf)
    twice = _stream(spark, sf, lambda src: src.select(
        F.concat(F.lit("e"), "event_id").alias("eventid"), F.col("ts").cast("timestamp").alias("utctimestamp"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery")))
    return flat(_to_table(drop_repeats(twice).select("eventid", "utctimestamp"), spark, "dedup"))


def _sliding_stream(spark, sf):
    events(spark, sf)
    live = _stream(spark, sf, lambda src: sample.canonical(src))
    return flat(_to_table(sliding_alerts(live, BURST), spark, "sliding"))


_WINDOWS = """hit AS (SELECT source AS value, time_bucket(INTERVAL 1 MINUTE, utctimestamp) - i * INTERVAL 1 MINUTE AS window_start
  FROM ev, range(0, 5) t(i) WHERE severity = 'INFO')
---
SELECT 'burst' AS alert_name, window_start, window_start + INTERVAL 5 MINUTE AS window_end, value, count(*) AS event_count FROM hit
{} GROUP BY window_start, value HAVING count(*) >= 2"""


def _cycles(spark, sf):
    """Three detection cycles: claims carry over, deadman hits add up, sequences advance."""
    e = events(spark, sf)
    state = StateFolder(spark, run_dir(spark, "state"))
    rule = LOGIN.__class__(**{**LOGIN.__dict__, "lookback_minutes": 10 * DAY})
    for at in TICKS:
        run_tick(e, [rule, KEY_THEN_ERRORS, FEEDS[1]], state, at)
    return state


def _cycle_alerts(spark, sf):
    out = _cycles(spark, sf).alerts()
    return flat(out.filter(F.col("alert_type") != "sequence").select("alert_name", "value", "event_count", "new_count", F.coalesce("deadman_hits", F.lit(0)).alias("deadman_hits"), "created_at"))


_CYCLE_SQL = "login AS (SELECT identity, eventid, utctimestamp FROM ev WHERE eventname = 'ConsoleLogin' AND identity IS NOT NULL),\n" + ",\n".join(
    f"""w{i} AS (SELECT *, count(*) OVER (PARTITION BY identity) AS n FROM login
  WHERE utctimestamp BETWEEN {ts(t)} - INTERVAL 10 DAY AND {ts(t)}),
c{i} AS (SELECT identity, eventid, n FROM w{i} WHERE n >= 3{''.join(f' AND eventid NOT IN (SELECT eventid FROM c{k})' for k in range(1, i))})"""
    for i, t in enumerate(TICKS, 1)
) + "\n---\n" + "\nUNION ALL\n".join(
    f"""SELECT 'console_login' AS alert_name, identity AS value, n AS event_count, count(*) AS new_count, CAST(0 AS BIGINT) AS deadman_hits,
  {ts(t)} AS created_at FROM c{i} GROUP BY identity, n""" for i, t in enumerate(TICKS, 1)
) + f"\nUNION ALL SELECT 'dead_other', 'all', 0, 0, 3, {ts(TICKS[0])}"


def _outbox(spark, sf):
    """Alerts of the login rule as notifications."""
    from vigilake.operators import detect as d

    e = events(spark, sf)
    alerts = d.threshold(e, d.watches_of([LOGIN]), "2024-01-31 00:00:00").alerts
    sent = notification_outbox(alerts, {"enabled": True, "webhook_url": "https://hooks.invalid/x", "min_severity": "medium",
                                        "template": '{"text": "{{alert_name}} \\"{{value}}\\"", "n": 1}'})
    return sent.select("webhook_url", "payload")


# --- slots in order of time

_BY_USER = {"aggregation_key": "details.user"}
THEN = Rule(alert_name="click_then_error", alert_type="sequence", severity="HIGH", category="order", lifespan="3 days", tags=("order",),
            summary="{{metadata.value}}: {{steps.0.eventid}} then {{steps.1.eventid}}",
            slots=(Rule("click", criteria="category = 'click'", **_BY_USER), Rule("error", criteria="category = 'error'", **_BY_USER)))
TWICE = Rule(alert_name="signup_two_views_purchase", alert_type="sequence", lifespan="10 days", summary="{{metadata.count}} steps by {{metadata.value}}",
             slots=(Rule("signup", criteria="category IN ('signup', 'click')", **_BY_USER), Rule("views", criteria="category = 'view'", threshold=2, **_BY_USER),
                    Rule("purchase", criteria="category = 'purchase' OR category = 'signup'", **_BY_USER)))
_ORDER_SQL = """o AS (SELECT identity AS value, utctimestamp AS ts, eventid, category FROM ev WHERE identity IS NOT NULL),
{}
first AS (SELECT value, s, arg_min(steps, (ts, eventid)) AS steps, min(ts) AS ended FROM last WHERE s IS NOT NULL GROUP BY value, s),
done AS (SELECT value, s.ts AS started, ended, steps FROM first WHERE ended - s.ts <= INTERVAL {} DAY)"""
_LAST = "last_value({} IGNORE NULLS) OVER (PARTITION BY value ORDER BY ts, eventid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _order_sql(slots: list[str], days: int) -> str:
    """One table per state; a state is the last one before it, with this event as a further step."""
    out = [f"""t0 AS (SELECT *, CASE WHEN {slots[0]} THEN {{'ts': ts, 'id': eventid}} END AS s, CASE WHEN {slots[0]} THEN eventid END AS steps FROM o)"""]
    for i, slot in enumerate(slots[1:], 1):
        out.append(f"""p{i} AS (SELECT *, {_LAST.format('s')} AS ps, {_LAST.format('steps')} AS psteps FROM t{i - 1}),
t{i} AS (SELECT value, ts, eventid, category, CASE WHEN {slot} THEN ps END AS s, CASE WHEN {slot} THEN psteps || ',' || eventid END AS steps FROM p{i})""")
    out.append(f"last AS (SELECT * FROM t{len(slots) - 1}),")
    return _ORDER_SQL.format(",\n".join(out), days)


_THEN_SQL = _order_sql(["category = 'click'", "category = 'error'"], 3)
_TWICE_SQL = _order_sql(["category IN ('signup', 'click')", "category = 'view'", "category = 'view'", "category IN ('purchase', 'signup')"], 10)


def _ordered(rule):
    """All matches of a rule over the table as alerts."""

    def run(spark, sf):
        found = ordered.ordered_sequences(events(spark, sf), [rule], "2024-12-31 00:00:00", 425 * DAY)
        ids = F.array_join(F.transform("events", lambda x: x["eventid"]), ",")
        return flat(found.select("alert_name", "value", "summary", "created_at", "event_count", ids.alias("steps")))

    return run


def _in_turns(spark, sf):
    """The events as a stream: eight files in order of time, one a batch, each a little out of order."""
    events(spark, sf)
    raw = spark.read.parquet(f"{sf}/events.parquet")
    path = run_dir(spark, "ordered")
    lo, hi = raw.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    # an hour's jitter: events of a batch come up to an hour before or after their turn
    jitter = (F.pmod(F.xxhash64("event_id"), F.lit(7_200)) - 3_600) * 1_000_000
    turn = F.greatest(F.lit(0), F.least(F.lit(7), F.floor((F.unix_micros(F.col("ts").cast("timestamp")) + jitter - lo) * 8 / (hi - lo + 1)))).cast("int")
    for i in range(8):
        raw.filter(turn == i).coalesce(1).write.mode("append").parquet(f"{path}/in")
    return spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def _ordered_stream(spark, sf):
    """The same rule on a stream of several batches."""
    live = _in_turns(spark, sf)
    found = _to_table(ordered_stream(sample.canonical(live), THEN, "3 hours"), spark, "matches")
    alerts = ordered.alerts_of(found, THEN)
    ids = F.array_join(F.transform("events", lambda x: x["eventid"]), ",")
    return flat(alerts.select("alert_name", "value", "summary", "created_at", "event_count", ids.alias("steps")))


# --- groups that fall silent

# the proxies: some of them send errors, user1000 to user1004 never do anything
MISSED = Rule(alert_name="missed", alert_type="deadman", criteria="category = 'error'", aggregation_key="details.user", lookback_minutes=8 * DAY,
              expected_values=tuple(f"user{i}@example.com" for i in (*range(0, 40), *range(1000, 1005))))
_SINCE, _UNTIL = "2024-01-01 00:00:00", "2024-01-31 00:00:00"


def _absent(spark, sf):
    return flat(absences(events(spark, sf), MISSED, _SINCE, _UNTIL))


def _absent_stream(spark, sf):
    """The same silences on a stream of several batches, as far as its watermark comes."""
    return flat(_to_table(absence_stream(sample.canonical(_in_turns(spark, sf)), MISSED, _SINCE, delay="3 hours"), spark, "absent"))


def _absent_now(spark, sf):
    """One cycle of a deadman rule with expected groups: those absent from its window fire beside others that report."""
    e = events(spark, sf)
    return flat(ri.evaluate(e, [MISSED], "2024-01-20 00:00:00", closed=True).alerts.select("alert_name", "value", "event_count"))


_NAMES = "names AS (SELECT DISTINCT 'user' || i || '@example.com' AS value FROM (SELECT unnest(range(0, 40)) AS i UNION ALL SELECT unnest(range(1000, 1005))))"


def _absent_sql(until: str, calls: str) -> str:
    return duck(f"""{_NAMES},
heard AS (SELECT DISTINCT identity AS value, utctimestamp AS t FROM ev WHERE category = 'error' AND identity IS NOT NULL AND utctimestamp >= {ts(_SINCE)} AND utctimestamp <= {calls}
  UNION SELECT value, {ts(_SINCE)} FROM names),
step AS (SELECT value, t AS last_heard, coalesce(lead(t) OVER (PARTITION BY value ORDER BY t), {until}) AS next FROM heard)
---
SELECT value, last_heard, last_heard + INTERVAL 8 DAY AS absent_at, value IN (SELECT value FROM names) AS expected FROM step
WHERE last_heard + INTERVAL 8 DAY < next AND last_heard + INTERVAL 8 DAY < {until}""")


_MARK = "(SELECT date_trunc('millisecond', max(utctimestamp)) - INTERVAL 3 HOUR FROM ev WHERE category = 'error' AND identity IS NOT NULL)"

QUERIES = {
    "absence_per_group": (_absent, _absent_sql(ts(_UNTIL), ts(_UNTIL))),
    "absence_per_group_stream": (_absent_stream, _absent_sql(_MARK, _MARK)),
    "absence_expected_groups": (
        _absent_now,
        duck(f"""{_NAMES}, win AS (SELECT identity AS value FROM ev WHERE category = 'error' AND identity IS NOT NULL
  AND utctimestamp BETWEEN TIMESTAMP '2024-01-12 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00')
---
SELECT 'missed' AS alert_name, value, CAST(0 AS BIGINT) AS event_count FROM names WHERE value NOT IN (SELECT value FROM win)"""),
    ),
    "ordered_sequence": (
        _ordered(THEN),
        duck(_THEN_SQL + """
---
SELECT 'click_then_error' AS alert_name, value, value || ': ' || split_part(steps, ',', 1) || ' then ' || split_part(steps, ',', 2) AS summary,
  ended AS created_at, CAST(2 AS BIGINT) AS event_count, steps FROM done"""),
    ),
    "ordered_sequence_thresholds": (
        _ordered(TWICE),
        duck(_TWICE_SQL + """
---
SELECT 'signup_two_views_purchase' AS alert_name, value, '4 steps by ' || value AS summary, ended AS created_at, CAST(4 AS BIGINT) AS event_count, steps FROM done"""),
    ),
    "ordered_sequence_stream": (
        _ordered_stream,
        duck(_THEN_SQL + """
---
SELECT 'click_then_error' AS alert_name, value, value || ': ' || split_part(steps, ',', 1) || ' then ' || split_part(steps, ',', 2) AS summary,
  ended AS created_at, CAST(2 AS BIGINT) AS event_count, steps FROM done
WHERE ended <= (SELECT max(ts) FROM o WHERE category IN ('click', 'error')) - INTERVAL 3 HOUR"""),
    ),
    "stream_ingest": (
        _ingested,
        duck("""c AS (SELECT *, CASE event_id % 4 WHEN 1 THEN source_ip WHEN 3 THEN '172.16.0.' || (user_id % 200)
    ELSE '192.168.0.' || (user_id % 200) END AS src, CASE WHEN event_id % 3 = 0 THEN '2001:db8::' || (user_id % 10) END AS dst,
  CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ev.utctimestamp) ELSE date_trunc('millisecond', ev.utctimestamp) END AS t FROM ev)
---
SELECT eventid, t AS utctimestamp, 'UNKNOWN' AS source, event_type AS category, 'INFO' AS severity, 'UNKNOWN' AS summary, src, dst,
  CAST(CAST(t AS DATE) AS VARCHAR) AS event_date FROM c"""),
    ),
    "ingest_accounting": (
        _accounted,
        """SELECT CASE WHEN event_id % 20 IN (0, 3) THEN 'cannot be written back as JSON' WHEN event_id % 20 = 1 THEN 'not readable as JSON'
  WHEN event_id % 20 = 2 THEN 'not a JSON object' WHEN event_id % 20 = 4 THEN 'line' ELSE 'event' END AS outcome, count(*) AS n
FROM events GROUP BY 1""",
    ),
    "stream_dedup": (_deduplicated, duck("SELECT eventid, utctimestamp FROM ev")),
    "sliding_window_alerts": (
        lambda s, p: flat(sliding_alerts(events(s, p), BURST)),
        duck(_WINDOWS.format("")),
    ),
    "sliding_window_stream": (
        _sliding_stream,
        duck(_WINDOWS.format("WHERE window_start + INTERVAL 5 MINUTE <= (SELECT max(utctimestamp) FROM ev) - INTERVAL 5 MINUTE")),
    ),
    "detection_cycles": (_cycle_alerts, duck(_CYCLE_SQL)),
    "notification_outbox": (
        _outbox,
        duck("""SELECT 'https://hooks.invalid/x' AS webhook_url, '{"text":"console_login \\"' || identity || '\\"","n":1}' AS payload
FROM ev WHERE eventname = 'ConsoleLogin' AND identity IS NOT NULL AND utctimestamp >= TIMESTAMP '2024-01-11 00:00:00'
GROUP BY identity HAVING count(*) >= 3"""),
    ),
}
