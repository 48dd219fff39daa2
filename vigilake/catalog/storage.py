"""Tables written and read again, state kept by key, rules from documents, and the loops that close over them."""

from __future__ import annotations


from pyspark.sql import functions as F

from vigilake.catalog.base import AS_OF, duck, events, flat, ts
from vigilake.catalog.detection import LOGIN
from vigilake.catalog.live import THEN, _THEN_SQL
from vigilake.operators import query as q
from vigilake.operators import ruleindex as ri
from vigilake.operators import score as sc
from vigilake.operators import views as v
from vigilake.operators.tick import StateFolder, run_tick
from vigilake.session import run_dir
from vigilake.sources import messages as m
from vigilake.sources import tables as tb
from vigilake.sources.rules import Rule, load_rules, platform_rules
from vigilake.streaming.ingest import ingest

DAY = 1440
_PLAIN = ("utctimestamp", "eventid", "severity", "summary", "category", "source", "tags", "plugins", "details")


def _base(spark, sf):
    return events(spark, sf).select(*_PLAIN)


def _jsonl(spark, sf):
    """Events exported as JSON lines, with blank lines between them, and read back."""
    path = run_dir(spark, "jsonl")
    line = F.to_json(F.struct("eventid", "category", "details"))
    base = _base(spark, sf)
    base.select(F.explode(F.array(line, F.lit("  "))).alias("value")).write.text(path)
    doc = F.col("doc")
    back = tb.read_events_jsonl(spark, path)
    return back.select(F.try_variant_get(doc, "$.eventid", "string").alias("eventid"), F.try_variant_get(doc, "$.category", "string").alias("category"),
                       F.try_variant_get(doc, "$.details.k", "int").cast("long").alias("k"))


def _files(spark, sf):
    """Rows that come from the trail's log files, told by the name of the file."""
    e = _base(spark, sf)
    name = F.concat(F.lit("s3://x/"), F.when(F.col("source") == "cloudtrail", "1_CloudTrail_").otherwise("other_"), "eventid", F.when(F.col("category") == "view", ".txt").otherwise(".json.gz"))
    return m.cloudtrail_files(e.withColumn("path", name), "path").select("eventid")


def _expired(spark, sf):
    """A day-partitioned table after days beyond its retention went, counted per day."""
    path = run_dir(spark, "expire")
    tb.write_events(_base(spark, sf), path)
    tb.expire_partitions(spark, path, "2024-01-25 00:00:00", days=10)
    return tb.read_events(spark, path).groupBy(F.col("event_date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def _state(spark, sf):
    """Keyed state after an upsert and a deletion: the newest event per user, without users that had an error last."""
    e = events(spark, sf).filter("identity IS NOT NULL").select("identity", "eventid", "utctimestamp", "category")
    newest = lambda df: tb.latest(df, ["identity"], ["utctimestamp", "eventid"])
    early, late = e.filter("utctimestamp < '2024-01-20'"), e.filter("utctimestamp >= '2024-01-20'")
    kept = tb.upsert(newest(early), newest(late), "identity")
    return flat(tb.delete_keys(kept, kept.filter("category = 'error'"), "identity"))


def _documents(spark, sf):
    """Rules from a table of documents, bad and switched-off ones among them, run over the events."""
    users = events(spark, sf).select("identity").filter("identity LIKE 'user%'").distinct()
    body = F.concat(F.lit('{"alert_name": "by_'), "identity", F.lit('", "criteria": "category = \'click\' AND JSON_VALUE(details.user) = \''), "identity",
                    F.lit('\'", "lookback_minutes": 43200, "threshold": 2, "summary": "{{metadata.count}} clicks"}'))
    number = F.regexp_extract("identity", r"(\d+)", 1).cast("int")
    table = users.select(F.col("identity").alias("name"), F.when(number % 10 == 7, "no rule").otherwise(body).alias("yaml"), F.when(number % 10 == 8, False).alias("enabled"))
    rules, _ = load_rules(table=table)
    return ri.evaluate(events(spark, sf), rules, AS_OF).alerts.select("alert_name", "event_count", "summary")


def _clicked(spark, sf):
    """Conditions made by clicking values of an event, for one event of each category, applied together."""
    e = events(spark, sf)
    first = e.groupBy("category").agg(F.min_by(F.struct("severity", F.get("tags", F.lit(0)).alias("tag"), F.col("project").alias("project")), F.struct("utctimestamp", "eventid")).alias("r"))
    found = None
    for r in first.collect():
        rows = [q.row_for_path(["category"], r["category"]), q.row_for_path(["severity"], r["r"]["severity"]), q.row_for_path(["tags", 0], r["r"]["tag"]),
                q.row_for_path(["details", "project"], r["r"]["project"]), q.row_for_path(["details"], {"a": 1})]
        part = e.filter(q.all_rows(e, [x for x in rows if x])).select("eventid", "category")
        found = part if found is None else found.unionByName(part)
    return found


def _refused(spark, sf):
    """Which of the texts made from events are no criteria."""
    e = events(spark, sf)
    kinds = [r["category"] for r in e.select("category").distinct().collect()]
    texts = [t_.format(c) for c in kinds for t_ in ("category = '{}'", "category = '{}'; x", "drop {}", "category = '{}' -- x", " ")]

    def ok(text: str) -> bool:
        try:
            q.validate_criteria(text)
            return True
        except q.InvalidCriteria:
            return False

    return spark.createDataFrame([(x, ok(x)) for x in texts], "text string, ok boolean").groupBy("ok").agg(F.count(F.lit(1)).alias("n"))


def _first_hits(spark, sf):
    """What three cycles send out: alerts of the login rule, and of the silent feed its first hit only."""
    e, state = events(spark, sf), StateFolder(spark, run_dir(spark, "sent"))
    silent = Rule("silent", "deadman", severity="HIGH", criteria="source = 'nothing'", summary="gone")
    login = Rule(**{**vars(LOGIN), "severity": "HIGH", "lookback_minutes": 30 * DAY})
    for at in ("2024-01-31 00:00:00", "2024-01-31 00:01:00", "2024-01-31 00:02:00"):
        run_tick(e, [login, silent], state, at, notify={"enabled": True, "webhook_url": "u", "min_severity": "HIGH"})
    sent = spark.read.parquet(f"{state.path}/outbox/*")
    return sent.join(state.alerts().select("alert_id", "alert_name"), "alert_id").groupBy("alert_name").agg(F.count(F.lit(1)).alias("n"))


def _heartbeat(spark, sf):
    """The closed loop: a cycle over the events, its heartbeat through the stream ingest, the platform's rules over what came back."""
    e, path = events(spark, sf), run_dir(spark, "loop")
    out = run_tick(e, [LOGIN, Rule("bad", criteria="nope = 1")], StateFolder(spark, f"{path}/state"), AS_OF)
    out["heartbeat"].write.text(f"{path}/in")
    ingest(m.read_event_stream(spark, path=f"{path}/in"), f"{path}/events", f"{path}/cp", trigger={"availableNow": True}, now=F.lit(AS_OF).cast("timestamp")).awaitTermination()
    both = e.select(*_PLAIN).unionByName(tb.read_events(spark, f"{path}/events").select(*_PLAIN))
    rules = [r for r in platform_rules() if r.alert_name in ("cron_degraded", "deadman_ingest_pipeline", "deadman_gcp_audit_feed")]
    return ri.evaluate(both, [*rules, LOGIN], AS_OF, scope="rule").alerts.select("alert_name", "value", "event_count")


def _reports(spark, sf):
    """Hunt reports, one file each, read back with what is wrong with them."""
    ids = events(spark, sf).groupBy("category").agg(F.min("eventid").alias("id"), F.count(F.lit(1)).alias("n"))
    path = run_dir(spark, "reports")
    finding = F.struct(F.lit("t").alias("title"), F.when(F.col("category") == "error", "sure").otherwise("high").alias("confidence"),
                       F.when(F.col("category") == "view", F.array().cast("array<string>")).otherwise(F.array("id")).alias("evidence_eventids"), F.lit("w").alias("why_not_benign"))
    body = F.struct(F.when(F.col("category") == "click", "perhaps").otherwise("findings").alias("verdict"), F.concat(F.lit("about "), "category").alias("summary"), F.array(finding).alias("findings"))
    docs = ids.select("category", F.to_json(body).alias("value"))
    docs.repartition(F.col("category")).write.partitionBy("category").text(path)
    return flat(sc.read_report(spark, f"{path}/*").select("summary", "problems"))


def _bounded(spark, sf):
    """The first rows of each category, and whether there were more."""
    e = events(spark, sf)
    kinds = sorted(r["category"] for r in e.select("category").distinct().collect())
    rows = []
    for kind in kinds:
        got = q.bounded_result(q.newest_first(e.filter(F.col("category") == kind), 1_000_000).select("eventid"), 50)
        rows.append((kind, got["row_count"], got["truncated"], ",".join(sorted(r["eventid"] for r in got["rows"]))))
    return spark.createDataFrame(rows, "category string, n long, truncated boolean, ids string")


def _strict_cycles(spark, sf):
    """An ordered sequence in three cycles: each match is reported once, with the cycle's other alerts."""
    e, state = events(spark, sf), StateFolder(spark, run_dir(spark, "strict"))
    rule = Rule(**{**vars(THEN), "strict_order": True})
    for at in ("2024-01-04 00:00:00", "2024-01-07 00:00:00", "2024-01-10 00:00:00"):
        run_tick(e, [rule, LOGIN], state, at)
    found = state.alerts().filter(F.col("alert_type") == "sequence")
    ids = F.array_join(F.transform("events", lambda x: x["eventid"]), ",")
    return flat(found.select("alert_name", "value", "summary", "created_at", ids.alias("steps")))


def _guarded(spark, sf):
    """The counts of labelled windows of several lengths, with what the guard says to them."""
    ie = v.identity_events(events(spark, sf))
    rows = []
    for canary, since in (("svc3@proj.iam.gserviceaccount.com", "2024-01-01 00:00:00"), ("svc3@proj.iam.gserviceaccount.com", "2025-01-01 00:00:00"), ("nobody", "2024-01-01 00:00:00")):
        counts = sc.manifest_counts(sc.label_events(ie, canary, ["user1@example.com"], since, "2026-01-01 00:00:00")).first().asDict()
        try:
            told = "little background" if sc.labelled_window_guard(counts) else "fine"
        except sc.EmptyFixture as refused:
            told = str(refused)
        rows.append((canary, since[:4], counts["total"], counts["attack"], told))
    return spark.createDataFrame(rows, "canary string, since string, total long, attack long, told string")


QUERIES = {
    "events_jsonl": (_jsonl, duck("SELECT eventid, category, k::BIGINT AS k FROM ev")),
    "cloudtrail_files": (_files, duck("SELECT eventid FROM ev WHERE source = 'cloudtrail' AND category <> 'view'")),
    "expired_partitions": (
        _expired,
        duck("SELECT CAST(event_date AS VARCHAR) AS day, count(*) AS n FROM ev WHERE event_date >= DATE '2024-01-15' GROUP BY 1"),
    ),
    "keyed_state": (
        _state,
        duck("""l AS (SELECT identity, max((utctimestamp, eventid)) AS m, arg_max(category, (utctimestamp, eventid)) AS category FROM ev WHERE identity IS NOT NULL GROUP BY identity)
---
SELECT identity, utctimestamp, eventid, category FROM (SELECT l.identity, ev.utctimestamp, ev.eventid, ev.category FROM l JOIN ev ON ev.eventid = l.m[2] AND ev.utctimestamp = l.m[1])
WHERE category <> 'error'"""),
    ),
    "rule_documents": (
        _documents,
        duck(f"""SELECT 'by_' || identity AS alert_name, count(*) AS event_count, count(*) || ' clicks' AS summary FROM ev
WHERE category = 'click' AND identity LIKE 'user%' AND user_id % 10 NOT IN (7, 8) AND utctimestamp >= {ts()} - INTERVAL 30 DAY GROUP BY identity HAVING count(*) >= 2"""),
    ),
    "clicked_conditions": (
        _clicked,
        duck("""f AS (SELECT category, arg_min(severity, (utctimestamp, eventid)) AS s, arg_min(tags[1], (utctimestamp, eventid)) AS t,
  arg_min({'p': project}, (utctimestamp, eventid)).p AS p FROM ev GROUP BY category)
---
SELECT eventid, ev.category FROM ev JOIN f ON ev.category = f.category AND severity = s AND list_contains(tags, t) AND (p IS NULL OR project = p)"""),
    ),
    "criteria_refused": (_refused, "SELECT ok, (n * CASE WHEN ok THEN 2 ELSE 3 END)::BIGINT AS n FROM (SELECT count(DISTINCT event_type) AS n FROM events), (SELECT unnest([true, false]) AS ok)"),
    "first_hits_sent": (
        _first_hits,
        duck("""SELECT 'console_login' AS alert_name, count(*) AS n FROM (SELECT identity FROM ev WHERE eventname = 'ConsoleLogin' AND identity IS NOT NULL
  AND utctimestamp BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-31 00:00:00' GROUP BY identity HAVING count(*) >= 3)
UNION ALL SELECT 'silent', 1"""),
    ),
    "heartbeat_loop": (
        _heartbeat,
        duck(f"""SELECT 'console_login' AS alert_name, identity AS value, count(*) AS event_count FROM ev WHERE eventname = 'ConsoleLogin' AND identity IS NOT NULL
  AND utctimestamp >= {ts()} - INTERVAL 20 DAY GROUP BY identity HAVING count(*) >= 3
UNION ALL SELECT 'cron_degraded', 'detection', 1
UNION ALL SELECT 'deadman_gcp_audit_feed', 'all', 0 WHERE NOT EXISTS (SELECT 1 FROM ev WHERE source = 'gcp_audit' AND audit_log_type = 'activity' AND utctimestamp >= {ts()} - INTERVAL 10 MINUTE)"""),
    ),
    "hunt_reports_read": (
        _reports,
        """SELECT 'about ' || event_type AS summary, concat_ws(',', CASE WHEN event_type = 'click' THEN 'verdict' END, CASE WHEN event_type = 'error' THEN 'confidence' END,
  CASE WHEN event_type = 'view' THEN 'evidence' END) AS problems FROM (SELECT DISTINCT event_type FROM events)""",
    ),
    "bounded_results": (
        _bounded,
        duck("""r AS (SELECT category, eventid, row_number() OVER (PARTITION BY category ORDER BY utctimestamp DESC, eventid) AS n, count(*) OVER (PARTITION BY category) AS c FROM ev)
---
SELECT category, least(max(c), 50) AS n, max(c) > 50 AS truncated, string_agg(eventid, ',' ORDER BY eventid) AS ids FROM r WHERE n <= 50 GROUP BY category"""),
    ),
    "cycle_ordered_sequences": (
        _strict_cycles,
        duck(_THEN_SQL + f"""
---
SELECT 'click_then_error' AS alert_name, value, value || ': ' || split_part(steps, ',', 1) || ' then ' || split_part(steps, ',', 2) AS summary, ended AS created_at, steps
FROM done WHERE ended <= {ts('2024-01-10 00:00:00')}"""),
    ),
    "labelled_windows": (
        _guarded,
        duck("""w AS (SELECT unnest(['svc3@proj.iam.gserviceaccount.com', 'svc3@proj.iam.gserviceaccount.com', 'nobody']) AS canary, unnest(['2024', '2025', '2024']) AS since),
c AS (SELECT canary, since, count(identity) AS total, count(*) FILTER (identity = canary) AS attack, count(*) FILTER (identity NOT IN (canary, 'user1@example.com')) AS benign
  FROM w LEFT JOIN ev ON identity IS NOT NULL AND utctimestamp >= (since || '-01-01')::TIMESTAMP AND utctimestamp < TIMESTAMP '2026-01-01' GROUP BY canary, since)
---
SELECT canary, since, total, attack, CASE WHEN total = 0 THEN 'no events in the window' WHEN attack = 0 THEN 'no event of the window belongs to the canary identity'
  WHEN benign < 50 THEN 'little background' ELSE 'fine' END AS told FROM c"""),
    ),
}

