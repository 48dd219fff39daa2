"""Hunting views."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilake.catalog.base import AS_OF, duck, events, flat, ts
from vigilake.operators import kept
from vigilake.operators import views as v
from vigilake.schema import LIFTED, LIFTED_ARRAYS
from vigilake.session import run_dir
from vigilake.sources.manifest import Manifest

_ACTION = "coalesce(methodname, eventname)"

IDENTITY_SQL = f"""SELECT utctimestamp, eventid, source, category, severity, summary, identity, source_ip, user_agent,
  audit_log_type, {_ACTION} AS action, coalesce(servicename, eventsource) AS service,
  resourcename AS resource, project, workspace_event, array_to_string(tags, ',') AS tags
FROM ev WHERE identity IS NOT NULL"""

IAM_FILTER = """source = 'gcp_audit' AND (list_contains(tags, 'iam-policy-change')
  OR lower(methodname) LIKE '%setiampolicy%' OR lower(methodname) LIKE '%serviceaccountkey%'
  OR lower(methodname) LIKE '%createserviceaccount%')"""

FIRST_SEENS_SQL = "\nUNION ALL\n".join(
    f"""SELECT identity, '{d}' AS dimension, {d} AS value, min(utctimestamp) AS first_seen_at,
  max(utctimestamp) AS last_seen_at, count(*) AS event_count
FROM ev WHERE identity IS NOT NULL AND {d} IS NOT NULL GROUP BY identity, {d}"""
    for d in v.FIRST_SEEN_DIMENSIONS
)


DAILY_SQL = """SELECT identity, CAST(utctimestamp AS DATE) AS day, count(*) AS event_count,
  array_to_string(list_sort(list(DISTINCT source)), ',') AS sources,
  array_to_string(list_sort(list(DISTINCT category)), ',') AS categories,
  count(DISTINCT source_ip) AS distinct_ips,
  coalesce(array_to_string(list_sort(list(DISTINCT source_ip) FILTER (WHERE source_ip IS NOT NULL)), ','), '') AS ips,
  coalesce(array_to_string(list_sort(list(DISTINCT user_agent) FILTER (WHERE user_agent IS NOT NULL)), ','), '') AS user_agents,
  CAST(count(*) FILTER (WHERE severity IN ('WARNING', 'CRITICAL')) AS BIGINT) AS warning_events,
  min(utctimestamp) AS first_event_at, max(utctimestamp) AS last_event_at
FROM ev WHERE identity IS NOT NULL GROUP BY identity, CAST(utctimestamp AS DATE)"""


def _unlifted(df):
    """The same events without lifted columns: everything must come out of the VARIANT."""
    return df.select("utctimestamp", "eventid", "severity", "summary", "category", "source", "tags", "plugins", "details")


def _incremental(spark, sf):
    e = events(spark, sf)
    cut = F.lit("2024-01-15").cast("date")
    old, new = e.filter(F.col("event_date") < cut), e.filter(F.col("event_date") >= cut)
    return flat(v.merge_first_seens(v.first_seens(old), v.first_seens(new)))


def _kept(kind, name):
    """A view kept while its table is written in batches, joined up, and a batch is replaced by what it should have been."""

    def run(spark, sf):
        e = events(spark, sf)
        base = e.select("utctimestamp", "eventid", "severity", "summary", "category", "source", "tags", "plugins", "details", *LIFTED.values(), *LIFTED_ARRAYS.values(), "event_date")
        part = F.pmod(F.xxhash64("eventid"), F.lit(4))
        path = run_dir(spark, name)
        log, view = Manifest(spark, f"{path}/events"), kept.KeptView(spark, f"{path}/events", f"{path}/view", kind)
        for i in range(3):
            # the second batch comes wrong at first: half of its rows, all by one identity
            rows = base.filter(part == i) if i != 1 else base.filter((part == i) & (F.col("category") != "view")).withColumn("identity", F.lit("nobody"))
            log.write_batch(rows, "s", i)
            if i:
                view.refresh()
        log.write_batch(base.filter(part == 1), "s", 1, replace=True)
        log.compact(fan=3)
        log.write_batch(base.filter(part == 3), "s", 3)
        view.refresh()
        return view

    return run


kept_seens, _daily, _sketches = _kept(kept.FIRST_SEENS, "seens"), _kept(kept.DAILY_ACTIVITY, "daily"), _kept(kept.IDENTITY_SKETCHES, "sketches")


def _sketched_window(spark, sf):
    """Kept sketches over a window of days beside the exact numbers: within five per cent and one."""
    near = kept.sketched(_sketches(spark, sf).read("2024-01-08", "2024-01-22"))
    e = events(spark, sf)
    days = e.filter("identity IS NOT NULL AND event_date >= '2024-01-08' AND event_date < '2024-01-22'")
    exact = days.groupBy("identity").agg(F.count_distinct("source_ip").alias("ips"), F.count_distinct("user_agent").alias("agents"))
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.col(b) * 0.05 + 1
    return near.join(exact, "identity").select("identity", "event_count", close("approx_ips", "ips").alias("ips_near"), close("approx_agents", "agents").alias("agents_near"))


QUERIES = {
    "first_seens_kept": (lambda s, d: flat(kept_seens(s, d).read()), duck(FIRST_SEENS_SQL)),
    "first_seens_kept_window": (
        lambda s, d: flat(kept_seens(s, d).read("2024-01-10", "2024-01-20")),
        duck(FIRST_SEENS_SQL.replace("WHERE", "WHERE utctimestamp >= '2024-01-10' AND utctimestamp < '2024-01-20' AND")),
    ),
    "daily_activity_kept": (lambda s, d: flat(_daily(s, d).read()), duck(DAILY_SQL)),
    "identity_sketches_kept": (
        _sketched_window,
        duck("""SELECT identity, count(*) AS event_count, TRUE AS ips_near, TRUE AS agents_near FROM ev
WHERE identity IS NOT NULL AND utctimestamp >= '2024-01-08' AND utctimestamp < '2024-01-22' GROUP BY identity"""),
    ),
    "identity_events": (lambda s, d: flat(v.identity_events(events(s, d)).drop("event_date")), duck(IDENTITY_SQL)),
    "identity_events_from_variant": (
        lambda s, d: flat(v.identity_events(_unlifted(events(s, d)))),
        duck(IDENTITY_SQL),
    ),
    "entity_daily_activity": (
        lambda s, d: flat(v.entity_daily_activity(events(s, d))),
        duck(DAILY_SQL),
    ),
    "first_seens": (lambda s, d: flat(v.first_seens(events(s, d))), duck(FIRST_SEENS_SQL)),
    "first_seens_incremental": (_incremental, duck(FIRST_SEENS_SQL)),
    "feed_coverage": (
        lambda s, d: flat(v.feed_coverage(events(s, d), AS_OF)),
        duck(f"""SELECT source, coalesce(audit_log_type, 'n/a') AS audit_log_type, count(*) AS events_7d,
  count(DISTINCT identity) AS distinct_identities, count(DISTINCT project) AS distinct_projects,
  min(utctimestamp) AS first_event_at, max(utctimestamp) AS last_event_at,
  CAST(date_sub('hour', max(utctimestamp), {ts()}) AS BIGINT) AS hours_since_last_event
FROM ev WHERE utctimestamp >= {ts()} - INTERVAL 7 DAY GROUP BY 1, 2"""),
    ),
    "iam_changes": (
        lambda s, d: flat(v.iam_changes(events(s, d)).drop("event_date")),
        duck(f"""SELECT utctimestamp, eventid, identity, methodname AS action, resourcename AS resource, project,
  members_csv AS granted_members, roles_csv AS granted_roles,
  split_part(members_csv, ',', 1) AS granted_member, roles_csv AS policy_delta, source_ip, severity, summary
FROM ev WHERE {IAM_FILTER}"""),
    ),
    "orient": (
        lambda s, d: flat(v.orient(events(s, d), "2024-01-10 00:00:00", "2024-01-24 00:00:00")),
        duck("""SELECT source, audit_log_type, count(*) AS event_count FROM ev
WHERE identity IS NOT NULL AND utctimestamp >= TIMESTAMP '2024-01-10 00:00:00'
  AND utctimestamp < TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1, 2"""),
    ),
    "approx_identity_ips": (
        lambda s, d: v.approx_identity_ips(v.approx_daily_activity(events(s, d))),
        duck("""SELECT identity, count(*) AS event_count, count(DISTINCT source_ip) AS approx_ips
FROM ev WHERE identity IS NOT NULL GROUP BY identity"""),
    ),
}
