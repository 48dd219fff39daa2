"""Analyst work replayed from the test tables: orders are alerts, their line items and events the actions."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilake.catalog.base import flat
from vigilake.operators import query as q
from vigilake.operators import triage as t
from vigilake.plans.ranges import places
from vigilake.session import configure
from vigilake.sources.sample import raw_table

SEV = ("CRITICAL", "High", "medium", "LOW", "info")


def _alerts(s, p):
    configure(s)
    o = raw_table(s, p, "orders")
    return o.select(
        F.concat(F.lit("a"), "o_orderkey").alias("alert_id"), F.concat(F.lit("rule "), F.col("o_custkey") % 50).alias("alert_name"),
        F.element_at(F.array(*[F.lit(x) for x in SEV]), (F.col("o_orderkey") % 5 + 1).cast("int")).alias("severity"),
        F.lit("OPEN").alias("status"), F.col("o_orderdate").cast("timestamp").alias("created_at"), "o_orderkey",
    )


def _actions(s, p):
    l = raw_table(s, p, "lineitem")
    key, no = F.col("l_orderkey"), F.col("l_linenumber")
    action = F.element_at(F.array(*[F.lit(x) for x in ("resolve", "claim", "escalate", "unclaim", "resolve", "claim")]), ((key + no) % 6 + 1).cast("int"))
    # one action per (alert, line number, part): the part key makes the instants distinct
    at = F.timestamp_micros((F.unix_micros(F.lit("2024-01-01").cast("timestamp")) + no * 1_000_000 + F.col("l_partkey") * 10 + F.col("l_suppkey") % 10).cast("long"))
    return l.select(
        F.concat(F.lit("a"), key).alias("alert_id"), action.alias("action"), at.alias("at"),
        F.concat(F.lit("u"), F.col("l_suppkey") % 3).alias("user_id"), F.concat(F.lit("User "), F.col("l_suppkey") % 3).alias("user_name"),
        F.when(no % 2 == 0, "true_positive").alias("resolution"), F.when(F.col("l_suppkey") % 2 == 0, "high").alias("impact"),
    )


def _triaged(s, p):
    return t.apply_alert_actions(_alerts(s, p), _actions(s, p))


_ALERT_SQL = """al AS (SELECT 'a' || o_orderkey AS alert_id, 'rule ' || (o_custkey % 50) AS alert_name,
    ['CRITICAL', 'High', 'medium', 'LOW', 'info'][o_orderkey % 5 + 1] AS severity, o_orderdate AS created_at, o_orderkey FROM orders),
  act AS (SELECT 'a' || l_orderkey AS alert_id,
    ['resolve', 'claim', 'escalate', 'unclaim', 'resolve', 'claim'][(l_orderkey + l_linenumber) % 6 + 1] AS action,
    make_timestamp(CAST(epoch_us(TIMESTAMP '2024-01-01') + l_linenumber * 1000000 + l_partkey * 10 + l_suppkey % 10 AS BIGINT)) AS at_,
    'u' || (l_suppkey % 3) AS user_id,
    CASE WHEN l_linenumber % 2 = 0 THEN 'true_positive' END AS resolution, CASE WHEN l_suppkey % 2 = 0 THEN 'high' END AS impact FROM lineitem),
  st AS (SELECT alert_id, arg_max(CASE WHEN action = 'escalate' THEN 'ESCALATED' WHEN resolution IS NOT NULL AND impact IS NOT NULL
      THEN 'RESOLVED' ELSE 'OPEN' END, at_) AS status FROM act WHERE action IN ('resolve', 'escalate') GROUP BY alert_id),
  rs AS (SELECT * FROM act WHERE action = 'resolve' QUALIFY row_number() OVER (PARTITION BY alert_id ORDER BY at_ DESC) = 1),
  cl AS (SELECT alert_id, arg_max(CASE WHEN action = 'claim' THEN user_id ELSE '' END, at_) AS who FROM act WHERE action IN ('claim', 'unclaim') GROUP BY alert_id),
  es AS (SELECT DISTINCT alert_id FROM act WHERE action = 'escalate'),
  tri AS (SELECT al.alert_id, alert_name, severity, created_at, coalesce(st.status, 'OPEN') AS status, rs.resolution, rs.impact,
    CASE WHEN rs.resolution IS NOT NULL AND rs.impact IS NOT NULL THEN rs.at_ END AS resolved_at, nullif(cl.who, '') AS assignee_id,
    CASE WHEN es.alert_id IS NOT NULL THEN al.alert_id || '-incident' END AS incident_id
    FROM al LEFT JOIN st USING (alert_id) LEFT JOIN rs USING (alert_id) LEFT JOIN cl USING (alert_id) LEFT JOIN es USING (alert_id))"""


def _sql(body):
    return f"WITH {_ALERT_SQL}\n{body}"


def _items(s, p):
    """Item actions of incidents: events are the log, users the incidents."""
    configure(s)
    e = raw_table(s, p, "events")
    n = F.col("event_id") % 40
    action = F.when(n == 39, "remove").when(F.col("event_type") == "click", "toggle").when(F.col("event_type") == "view", "edit").otherwise("add")
    return e.select(
        F.concat(F.lit("incident-"), "user_id").alias("incident_id"),
        F.when(F.col("event_id") % 5 < 3, "task").otherwise("theory").alias("kind"),
        (F.col("event_id") % 20).cast("string").alias("item_id"), action.alias("action"),
        F.concat(F.lit("text "), "event_id").alias("text"),
        F.when(F.col("event_id") % 2 == 0, "high").otherwise("low").alias("likelihood"),
        F.concat(F.lit("User "), F.col("event_id") % 3).alias("user_name"), F.col("ts").cast("timestamp").alias("at"),
    )


_ITEM_SQL = """log AS (SELECT 'incident-' || user_id AS incident_id, CASE WHEN event_id % 5 < 3 THEN 'task' ELSE 'theory' END AS kind,
    CAST(event_id % 20 AS VARCHAR) AS item_id, CASE WHEN event_id % 40 = 39 THEN 'remove' WHEN event_type = 'click' THEN 'toggle'
      WHEN event_type = 'view' THEN 'edit' ELSE 'add' END AS action, 'text ' || event_id AS text,
    CASE WHEN event_id % 2 = 0 THEN 'high' ELSE 'low' END AS likelihood, 'User ' || (event_id % 3) AS user_name, ts AS at_ FROM events),
  it AS (SELECT incident_id, kind, item_id, arg_max(text, at_) FILTER (WHERE action IN ('add', 'edit')) AS text,
    arg_max(likelihood, at_) FILTER (WHERE action IN ('add', 'edit')) AS likelihood, min(at_) FILTER (WHERE action = 'add') AS added_at,
    kind = 'task' AND count(*) FILTER (WHERE action = 'toggle') % 2 = 1 AS done,
    max(at_) FILTER (WHERE action = 'toggle') AS last_toggle, arg_max(user_name, at_) FILTER (WHERE action = 'toggle') AS toggler
    FROM log GROUP BY incident_id, kind, item_id HAVING added_at IS NOT NULL AND count(*) FILTER (WHERE action = 'remove') = 0)"""


def _incidents(s, p):
    configure(s)
    users = raw_table(s, p, "events").select("user_id").distinct()
    return users.select(F.concat(F.lit("incident-"), "user_id").alias("incident_id"), F.concat(F.lit("Case "), "user_id").alias("title"))


def _links(s, p):
    o = raw_table(s, p, "orders")
    return o.select(F.concat(F.lit("incident-"), F.col("o_custkey") % 200).alias("incident_id"), F.concat(F.lit("a"), "o_orderkey").alias("alert_id"))


def _entries(s, p):
    configure(s)
    e = raw_table(s, p, "events")
    action = F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "view", "edit").otherwise("add")
    return e.select(
        F.concat(F.lit("t"), F.col("event_id") % 300).alias("id"), F.concat(F.lit("incident-"), F.col("event_id") % 30).alias("context_id"),
        action.alias("action"), F.concat(F.lit("u"), F.col("user_id") % 4).alias("actor_id"), F.concat(F.lit("note "), "event_id").alias("message"),
        F.col("ts").cast("timestamp").alias("timestamp"), F.when(F.col("event_id") % 9 == 0, F.col("event_id") % 100).alias("sort_order"),
        F.col("ts").cast("timestamp").alias("at"),
    ).filter((F.col("action") != "delete") | (F.col("id") < "t2"))


_TIME_SQL = """ent AS (SELECT 't' || (event_id % 300) AS id, 'incident-' || (event_id % 30) AS context_id, event_type, 'u' || (user_id % 4) AS actor_id,
    'note ' || event_id AS message, ts AS at_, CASE WHEN event_id % 9 = 0 THEN event_id % 100 END AS sort_order FROM events
    WHERE event_type <> 'error' OR 't' || (event_id % 300) < 't2'),
  tl AS (SELECT context_id, id, arg_max(actor_id, at_) AS actor_id, arg_max(message, at_) AS message, max(at_) AS timestamp,
    arg_max(sort_order, at_) AS sort_order, max(at_) FILTER (WHERE event_type = 'view') AS edited_at FROM ent GROUP BY context_id, id
    HAVING count(*) FILTER (WHERE event_type = 'error') = 0)"""


def _all_entries(s, p):
    """Three actions per entry, deletions among them: about half of the entries are left."""
    configure(s)
    e = raw_table(s, p, "events")
    action = F.when(F.col("event_type") == "error", "delete").when(F.col("event_type") == "view", "edit").otherwise("add")
    no = F.expr("event_id div 3")
    return e.select(
        F.concat(F.lit("t"), no).alias("id"), F.concat(F.lit("incident-"), no % 150).alias("context_id"),
        action.alias("action"), F.concat(F.lit("u"), F.col("user_id") % 4).alias("actor_id"), F.concat(F.lit("note "), "event_id").alias("message"),
        F.col("ts").cast("timestamp").alias("timestamp"), F.when(F.col("event_id") % 9 == 0, F.col("event_id") % 100).alias("sort_order"),
        F.col("ts").cast("timestamp").alias("at"),
    )


_ALL_TIME_SQL = """ent AS (SELECT 't' || (event_id // 3) AS id, 'incident-' || (event_id // 3 % 150) AS context_id, event_type, 'u' || (user_id % 4) AS actor_id,
    'note ' || event_id AS message, ts AS at_, CASE WHEN event_id % 9 = 0 THEN event_id % 100 END AS sort_order FROM events),
  tl AS (SELECT context_id, id, arg_max(actor_id, at_) AS actor_id, arg_max(message, at_) AS message, max(at_) AS timestamp,
    arg_max(sort_order, at_) AS sort_order, max(at_) FILTER (WHERE event_type = 'view') AS edited_at FROM ent GROUP BY context_id, id
    HAVING count(*) FILTER (WHERE event_type = 'error') = 0)"""
_SHOWN = "coalesce(sort_order::DOUBLE, epoch_ms(timestamp)::DOUBLE), timestamp, id"


def _whole_timeline(s, p):
    """All entries, with the place of each in the whole of the display order."""
    return flat(places(t.timeline_of(_all_entries(s, p))).withColumn("sort_order", F.coalesce("sort_order", F.lit(-1).cast("long"))))


def _reports(s, p):
    inc = _incidents(s, p)
    shown = t.timeline_of(_all_entries(s, p)).join(inc.select(F.col("incident_id").alias("context_id")), "context_id", "left_semi")
    return t.incident_reports(t.incident_markdown(inc, t.fold_incident_items(_items(s, p)), shown, _links(s, p), "2024-01-31 00:00:00"))


def _markdown(s, p):
    return flat(t.incident_markdown(
        _incidents(s, p), t.fold_incident_items(_items(s, p)), t.timeline_of(_entries(s, p)).join(
            _incidents(s, p).select(F.col("incident_id").alias("context_id")), "context_id", "left_semi"),
        _links(s, p), "2024-01-31 00:00:00").select("incident_id", "section", "line"))


_MD_SQL = f"""WITH {_ITEM_SQL}, {_TIME_SQL}, inc AS (SELECT DISTINCT user_id, 'incident-' || user_id AS incident_id FROM events),
  st AS (SELECT i.incident_id, i.user_id, count(*) FILTER (WHERE kind = 'task' AND done) AS d, count(*) FILTER (WHERE kind = 'task' AND NOT done) AS t,
    count(*) FILTER (WHERE kind = 'theory') AS h FROM inc i LEFT JOIN it USING (incident_id) GROUP BY ALL),
  vis AS (SELECT * FROM tl WHERE context_id IN (SELECT incident_id FROM inc))
SELECT incident_id, 0 AS section, unnest(['# Incident Summary: Case ' || user_id, '**Generated At:** 2024-01-31 00:00:00',
  '**Incident ID:** ' || user_id, '', '## Status Overview', '- **Theories:** ' || h || ' active hypotheses',
  '- **Actions Taken:** ' || d || ' tasks completed', '- **Pending Tasks:** ' || t || ' tasks remaining', '']) AS line FROM st
UNION ALL SELECT incident_id, 1, unnest(['## Active Theories', '']) FROM st WHERE h > 0
UNION ALL SELECT incident_id, 2, unnest(['## Actions Taken (HAVEDONE)', '']) FROM st WHERE d > 0
UNION ALL SELECT incident_id, 3, unnest(['## Next Steps (TODO)', '']) FROM st WHERE t > 0
UNION ALL SELECT DISTINCT context_id, 4, '## Key Timeline Events' FROM vis
UNION ALL SELECT incident_id, 1, '- [' || upper(likelihood) || '] ' || text FROM it WHERE kind = 'theory'
UNION ALL SELECT incident_id, 2, '- ' || text || ' (Completed by: ' || toggler || ')' FROM it WHERE done
UNION ALL SELECT incident_id, 3, '- [ ] ' || text FROM it WHERE kind = 'task' AND NOT done
UNION ALL SELECT context_id, 4, '- `' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '` **' || actor_id || '**: ' || message FROM vis"""

_REPORT_SQL = f"""WITH {_ITEM_SQL}, {_ALL_TIME_SQL}, inc AS (SELECT DISTINCT user_id, 'incident-' || user_id AS incident_id FROM events),
  st AS (SELECT i.incident_id, i.user_id, count(*) FILTER (WHERE kind = 'task' AND done) AS d, count(*) FILTER (WHERE kind = 'task' AND NOT done) AS t,
    count(*) FILTER (WHERE kind = 'theory') AS h FROM inc i LEFT JOIN it USING (incident_id) GROUP BY ALL),
  vis AS (SELECT * FROM tl WHERE context_id IN (SELECT incident_id FROM inc)),
  line AS (SELECT incident_id, 0 AS section, unnest(range(0, 9)) AS a, NULL::TIMESTAMP AS b, '' AS c, unnest(['# Incident Summary: Case ' || user_id,
    '**Generated At:** 2024-01-31 00:00:00', '**Incident ID:** ' || user_id, '', '## Status Overview', '- **Theories:** ' || h || ' active hypotheses',
    '- **Actions Taken:** ' || d || ' tasks completed', '- **Pending Tasks:** ' || t || ' tasks remaining', '']) AS line FROM st
  UNION ALL SELECT incident_id, 1, unnest([0, 2]), NULL, '', unnest(['## Active Theories', '']) FROM st WHERE h > 0
  UNION ALL SELECT incident_id, 2, unnest([0, 2]), NULL, '', unnest(['## Actions Taken (HAVEDONE)', '']) FROM st WHERE d > 0
  UNION ALL SELECT incident_id, 3, unnest([0, 2]), NULL, '', unnest(['## Next Steps (TODO)', '']) FROM st WHERE t > 0
  UNION ALL SELECT DISTINCT context_id, 4, -1, NULL::TIMESTAMP, '', '## Key Timeline Events' FROM vis
  UNION ALL SELECT incident_id, 1, 1, added_at, item_id, '- [' || upper(likelihood) || '] ' || text FROM it WHERE kind = 'theory'
  UNION ALL SELECT incident_id, 2, 1, added_at, item_id, '- ' || text || ' (Completed by: ' || toggler || ')' FROM it WHERE done
  UNION ALL SELECT incident_id, 3, 1, added_at, item_id, '- [ ] ' || text FROM it WHERE kind = 'task' AND NOT done
  UNION ALL SELECT context_id, 4, coalesce(sort_order, epoch_ms(timestamp)), timestamp, id,
    '- `' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '` **' || actor_id || '**: ' || message FROM vis)
SELECT incident_id, string_agg(line, chr(10) ORDER BY section, a, b NULLS FIRST, c) AS report FROM line GROUP BY incident_id"""

QUERIES = {
    "alert_lifecycle": (
        lambda s, p: flat(_triaged(s, p).drop("o_orderkey", "assignee_name")),
        _sql("SELECT * FROM tri"),
    ),
    "triage_counts": (
        lambda s, p: t.triage_counts(_triaged(s, p), "u1"),
        _sql("""SELECT count(*) AS total, count(*) FILTER (WHERE assignee_id = 'u1') AS my_queue,
  count(*) FILTER (WHERE status = 'ESCALATED') AS escalated, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
  count(*) FILTER (WHERE severity = 'High') AS high, count(*) FILTER (WHERE severity = 'medium') AS medium,
  count(*) FILTER (WHERE severity = 'LOW') AS low, count(*) FILTER (WHERE severity = 'info') AS info FROM tri"""),
    ),
    "alert_facets": (
        lambda s, p: t.alert_facets(_triaged(s, p), ["Critical", "INFO"], "u2").select("alert_id", "severity"),
        _sql("SELECT alert_id, severity FROM tri WHERE severity IN ('CRITICAL', 'info') AND assignee_id = 'u2'"),
    ),
    "page_alerts": (
        lambda s, p: flat(q.page(_triaged(s, p), 50, 3, "RESOLVED").select("alert_id", "created_at", "status")),
        _sql("SELECT alert_id, created_at, status FROM tri WHERE status = 'RESOLVED' ORDER BY created_at DESC, alert_id LIMIT 150"),
    ),
    "escalated_incidents": (
        lambda s, p: flat(t.escalate(_triaged(s, p).filter("status = 'ESCALATED'"), "2024-02-01 00:00:00")[0]),
        _sql("""SELECT alert_id || '-incident' AS incident_id, 'Incident: ' || alert_name AS title, alert_id,
  TIMESTAMP '2024-02-01 00:00:00' AS created_at FROM tri WHERE status = 'ESCALATED'"""),
    ),
    "escalation_tasks": (
        lambda s, p: t.escalate(_triaged(s, p).filter("status = 'ESCALATED'"), "2024-02-01 00:00:00")[1].select("incident_id", "item_id", "text"),
        _sql("""SELECT alert_id || '-incident' AS incident_id, unnest(['1', '2']) AS item_id,
  unnest(['Investigate root cause', 'Contain the threat']) AS text FROM tri WHERE status = 'ESCALATED'"""),
    ),
    "alerts_with_incidents": (
        lambda s, p: t.alerts_with_incidents(_alerts(s, p), _links(s, p)).select("alert_id", "incident_id", "severity"),
        _sql("SELECT alert_id, 'incident-' || (o_custkey % 200) AS incident_id, severity FROM al JOIN orders USING (o_orderkey)"),
    ),
    "incident_items": (
        lambda s, p: flat(t.fold_incident_items(_items(s, p))),
        f"""WITH {_ITEM_SQL} SELECT incident_id, kind, item_id, text, likelihood, added_at, done,
  CASE WHEN done THEN last_toggle END AS completed_at, CASE WHEN done THEN toggler END AS completed_by FROM it""",
    ),
    "incident_task_stats": (
        lambda s, p: t.incident_task_stats(_incidents(s, p), t.fold_incident_items(_items(s, p)), _links(s, p)),
        f"""WITH {_ITEM_SQL}, inc AS (SELECT DISTINCT user_id, 'incident-' || user_id AS incident_id FROM events),
  ln AS (SELECT 'incident-' || (o_custkey % 200) AS incident_id, count(*) AS n FROM orders GROUP BY 1)
SELECT i.incident_id, 'Case ' || user_id AS title, count(*) FILTER (WHERE kind = 'task' AND done) AS done,
  count(*) FILTER (WHERE kind = 'task' AND NOT done) AS todo, count(*) FILTER (WHERE kind = 'theory') AS theories,
  coalesce(max(n), 0) AS alerts FROM inc i LEFT JOIN it USING (incident_id) LEFT JOIN ln USING (incident_id) GROUP BY i.incident_id, user_id""",
    ),
    "timeline": (
        lambda s, p: flat(t.timeline_of(_entries(s, p)).withColumn("sort_order", F.coalesce("sort_order", F.lit(-1).cast("long")))),
        f"WITH {_TIME_SQL} SELECT * REPLACE (coalesce(sort_order, -1) AS sort_order) FROM tl",
    ),
    "incident_markdown": (_markdown, _MD_SQL),
    "timeline_whole": (
        _whole_timeline,
        f"""WITH {_ALL_TIME_SQL} SELECT * REPLACE (coalesce(sort_order, -1) AS sort_order), row_number() OVER (ORDER BY context_id, {_SHOWN}) AS position FROM tl""",
    ),
    "incident_reports": (_reports, _REPORT_SQL),
    "rule_toggle": (
        lambda s, p: t.rule_toggle(
            raw_table(configure(s), p, "part").select(F.col("p_partkey").cast("string").alias("name"), F.lit(True).alias("enabled")),
            raw_table(s, p, "lineitem").select(
                F.col("l_partkey").cast("string").alias("name"), (F.col("l_linenumber") % 2 == 0).alias("enabled"),
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))),
        """SELECT CAST(p_partkey AS VARCHAR) AS name, coalesce(on_, true) AS enabled FROM part LEFT JOIN
  (SELECT l_partkey, arg_max(l_linenumber % 2 = 0, (l_orderkey * 10 + l_linenumber, l_linenumber % 2 = 0)) AS on_ FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""",
    ),
}
