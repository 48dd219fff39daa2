"""Hunts, correlation, gating, technique checks, labelling and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilake.catalog.base import AS_OF, duck, events, flat, ts
from vigilake.catalog.views import IAM_FILTER, kept_seens
from vigilake.operators import hunts as h
from vigilake.operators import score as sc
from vigilake.operators import views as v

SINCE = "2024-01-20 00:00:00"
CANARY = "svc13@proj.iam.gserviceaccount.com"
OPERATORS = ["user1@example.com", "user2@example.com"]
GAP = 6 * 3600
DAY = 86400

_IAM = f"iam AS (SELECT *, methodname AS action, resourcename AS resource FROM ev WHERE {IAM_FILTER})"
_INSIDE = r"@(example\.com|.*\.iam\.gserviceaccount\.com)$"
_MEMBERS = "mem AS (SELECT *, unnest(string_split(members_csv, ',')) AS member FROM iam WHERE members_csv IS NOT NULL)"
_ROLES = "rol AS (SELECT *, unnest(string_split(roles_csv, ',')) AS role FROM iam WHERE roles_csv IS NOT NULL)"
_PRIV = r"^roles/(owner|editor|.*serviceAccountTokenCreator)$"


def _ie(s, p):
    return v.identity_events(events(s, p))


def _iam(s, p):
    return v.iam_changes(events(s, p))


def _suspects(s, p):
    return h.privileged_roles(_iam(s, p), "2024-01-28 00:00:00").select("identity").filter(F.col("identity").isNotNull())


def _skills(s, p):
    """One skill per category and source of the table, needing feeds that may or may not flow."""
    e = events(s, p)
    pairs = e.groupBy("category", "source").agg(F.count(F.lit(1)).alias("n"))
    return pairs.select(
        F.concat_ws("/", "category", "source").alias("skill"),
        F.when(F.col("category") == "view", F.array(F.lit("gcp_data_access"), F.lit("okta")))
        .when(F.col("category") == "error", F.array().cast("array<string>"))
        .otherwise(F.array(F.col("source"), F.lit("gcp_activity"))).alias("requires"),
    )


def _reports(s, p):
    """Four reports citing events of the table: report r cites ids ending in r, and some invented ones."""
    e = events(s, p)
    last = F.substring("eventid", -1, 1)
    cited = e.filter(last.isin("0", "1", "2", "3")).select(
        last.alias("report_id"),
        F.when((last == "3") & F.col("eventid").endswith("13"), F.concat(F.lit("no-"), "eventid")).otherwise(F.col("eventid")).alias("eventid"),
    )
    reports = cited.groupBy("report_id").agg(F.count(F.lit(1)).alias("n_findings")).withColumn(
        "verdict", F.when(F.col("report_id") == "2", "nothing_of_concern").otherwise("findings"))
    return cited, reports


def _labelled(s, p):
    return sc.label_events(_ie(s, p), CANARY, OPERATORS, SINCE, AS_OF)


def _scores(s, p):
    cited, reports = _reports(s, p)
    lab = _labelled(s, p)
    return sc.score_summary(reports, sc.score_citations(cited, lab), lab).withColumn("n_findings", F.col("n_findings").cast("long"))


def _chains(s, p, actor="identity"):
    return flat(h.correlated_chains(h.signal_events(_iam(s, p), ["example.com"]), GAP, actor))


_SIG = _IAM + f""", sig AS (
  SELECT identity, source_ip, utctimestamp, eventid, 'key_creation' AS signal FROM iam WHERE lower(action) LIKE '%serviceaccountkey%'
  UNION ALL SELECT identity, source_ip, utctimestamp, eventid, 'account_creation' FROM iam WHERE lower(action) LIKE '%createserviceaccount'
  UNION ALL SELECT identity, source_ip, utctimestamp, eventid, 'external_grant' FROM iam
    WHERE len(list_filter(string_split(members_csv, ','), lambda m: NOT regexp_matches(m, '{_INSIDE}'))) > 0
  UNION ALL SELECT identity, source_ip, utctimestamp, eventid, 'privileged_role' FROM iam
    WHERE len(list_filter(string_split(roles_csv, ','), lambda r: regexp_matches(r, '{_PRIV}'))) > 0)"""


def _chain_sql(actor):
    return _SIG + f""", m AS (SELECT *, CASE WHEN utctimestamp - lag(utctimestamp) OVER w <= INTERVAL {GAP} SECOND THEN 0 ELSE 1 END AS fresh
  FROM sig WHERE {actor} IS NOT NULL WINDOW w AS (PARTITION BY {actor} ORDER BY utctimestamp, eventid, signal)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY {actor} ORDER BY utctimestamp, eventid, signal ROWS UNBOUNDED PRECEDING) AS sid FROM m),
step AS (SELECT {actor}, sid, signal, min(utctimestamp) AS t, max(utctimestamp) AS e, count(*) AS c FROM n GROUP BY ALL)
---
SELECT {actor}, min(t) AS session_start, max(e) AS session_end, CAST(sum(c) AS BIGINT) AS signal_count,
  count(*) AS signal_kinds, string_agg(signal, ',' ORDER BY t, signal) AS steps FROM step GROUP BY {actor}, sid HAVING count(*) >= 2"""


def _rows(checks):
    """UNION ALL of (technique, check, condition on rows, detail, table)"""
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS technique, '{c}' AS \"check\", count(*) > 0 AS passed, max({d}) AS detail FROM {tab} WHERE {cond}"
        for t, c, cond, d, tab in checks
    )


_OWN = f"identity = '{CANARY}' AND utctimestamp >= {ts(SINCE)}"
_G = "gcp.persistence."
_TECH_SQL = _rows([
    (_G + "invite-external-user", "landed in identity_events", f"{_OWN} AND lower(act) LIKE '%setiampolicy%'", "act", "ie"),
    (_G + "create-service-account-key", "landed in identity_events", f"{_OWN} AND lower(act) LIKE '%createserviceaccountkey%'", "act", "ie"),
    (_G + "create-admin-service-account", "landed in identity_events", f"{_OWN} AND lower(act) LIKE '%createserviceaccount'", "act", "ie"),
    (_G + "backdoor-service-account-policy", "landed in identity_events", f"{_OWN} AND lower(act) LIKE '%setiampolicy%'", "act", "ie"),
    ("gcp.privilege-escalation.impersonate-service-accounts", "data access feed is alive", f"utctimestamp >= {ts(SINCE)} AND lower(act) LIKE '%generateaccesstoken%'", "act", "ie"),
    ("gcp.privilege-escalation.impersonate-service-accounts", "a canary-attributed impersonation exists", f"{_OWN} AND lower(act) LIKE '%generateaccesstoken%'", "resourcename", "ie"),
    ("workspace.assign-admin-role", "workspace event landed", f"utctimestamp >= {ts(SINCE)} AND lower(workspace_event) LIKE '%role%'", "workspace_event", "ie"),
    (_G + "invite-external-user", "iam_changes row exists", _OWN, "action", "iam"),
    (_G + "invite-external-user", "granted_member populated", f"{_OWN} AND members_csv IS NOT NULL", "split_part(members_csv, ',', 1)", "iam"),
    (_G + "invite-external-user", "an external member is findable", f"{_OWN} AND NOT regexp_matches(member, '\\.iam\\.gserviceaccount\\.com$')", "member", "mem"),
    (_G + "create-service-account-key", "iam_changes catches key creation", f"{_OWN} AND lower(action) LIKE '%serviceaccountkey%'", "resource", "iam"),
    (_G + "create-admin-service-account", "the owner-role grant survived", f"{_OWN} AND lower(role) LIKE '%owner%'", "role", "rol"),
    (_G + "backdoor-service-account-policy", "event reaches iam_changes", f"{_OWN} AND lower(resource) LIKE '%serviceaccount%'", "resource", "iam"),
    (_G + "backdoor-service-account-policy", "granted_member populated", f"{_OWN} AND lower(resource) LIKE '%serviceaccount%' AND members_csv IS NOT NULL", "members_csv", "iam"),
]) + f"""
UNION ALL SELECT '{_G}create-admin-service-account', 'both create and grant are present',
  count(*) FILTER (WHERE lower(action) LIKE '%createserviceaccount') > 0 AND count(*) FILTER (WHERE lower(action) LIKE '%setiampolicy%') > 0,
  count(*) FILTER (WHERE lower(action) LIKE '%createserviceaccount') || '/' || count(*) FILTER (WHERE lower(action) LIKE '%setiampolicy%')
  FROM iam WHERE {_OWN}
UNION ALL SELECT 'workspace.assign-admin-role', 'workspace and gcp identities are joinable', count(DISTINCT source) >= 2,
  CAST(count(DISTINCT source) AS VARCHAR) FROM ie WHERE utctimestamp >= {ts(SINCE)}"""

_LABEL = f"CASE WHEN identity = '{CANARY}' THEN 'attack' WHEN identity IN ('{OPERATORS[0]}', '{OPERATORS[1]}') THEN 'operator' ELSE 'benign' END"
_LAB = f"""lab AS (SELECT eventid, identity, source, {_LABEL} AS label FROM ev
  WHERE identity IS NOT NULL AND utctimestamp >= {ts(SINCE)} AND utctimestamp < {ts()})"""
_SUSPECTS = f"""{_IAM}, {_ROLES}, sus AS (SELECT DISTINCT identity FROM rol WHERE utctimestamp >= TIMESTAMP '2024-01-28 00:00:00'
  AND regexp_matches(role, '{_PRIV}') AND identity IS NOT NULL)"""

_NOVELTY_SQL = duck(_SUSPECTS + ", fs AS (" + "\nUNION ALL\n".join(
            f"SELECT identity, '{d}' AS dimension, {d} AS value, min(utctimestamp) AS first_seen_at, max(utctimestamp) AS last_seen_at, "
            f"count(*) AS event_count FROM ev WHERE {d} IS NOT NULL GROUP BY identity, {d}" for d in v.FIRST_SEEN_DIMENSIONS
        ) + ")\n---\nSELECT * FROM fs WHERE identity IN (SELECT identity FROM sus) AND first_seen_at >= TIMESTAMP '2024-01-10 00:00:00'")

QUERIES = {
    "external_grants": (
        lambda s, p: flat(h.external_grants(_iam(s, p), ["example.com"], SINCE)),
        duck(f"""{_IAM}, {_MEMBERS}
---
SELECT utctimestamp, eventid, identity, member AS granted_member, roles_csv AS policy_delta, resource, source_ip FROM mem
WHERE utctimestamp >= {ts(SINCE)} AND NOT regexp_matches(member, '{_INSIDE}')"""),
    ),
    "new_ips": (
        lambda s, p: flat(h.new_ips(v.first_seens(events(s, p)), "2024-01-15 00:00:00")),
        duck("""SELECT identity, source_ip AS new_ip, min(utctimestamp) AS first_seen_at, count(*) AS event_count FROM ev
WHERE identity IS NOT NULL AND source_ip IS NOT NULL GROUP BY ALL HAVING min(utctimestamp) >= TIMESTAMP '2024-01-15 00:00:00'"""),
    ),
    "category_breadth": (
        lambda s, p: flat(h.category_breadth(v.entity_daily_activity(events(s, p)), "2024-01-29")),
        duck("""SELECT identity, CAST(utctimestamp AS DATE) AS day, count(DISTINCT category) AS category_breadth, count(*) AS event_count
FROM ev WHERE identity IS NOT NULL AND utctimestamp >= DATE '2024-01-29' GROUP BY 1, 2"""),
    ),
    "privileged_roles": (
        lambda s, p: flat(h.privileged_roles(_iam(s, p))),
        duck(f"""{_IAM}, {_ROLES}
---
SELECT utctimestamp, eventid, identity, role, members_csv AS granted_members, resource, source_ip FROM rol WHERE regexp_matches(role, '{_PRIV}')"""),
    ),
    "key_creation": (
        lambda s, p: flat(h.key_creation(_iam(s, p), SINCE)),
        duck(f"""{_IAM}
---
SELECT utctimestamp, eventid, identity, action, resource, source_ip FROM iam
WHERE lower(action) LIKE '%serviceaccountkey%' AND utctimestamp >= {ts(SINCE)}"""),
    ),
    "unnest_members": (
        lambda s, p: flat(h.unnest_members(_iam(s, p)).select("eventid", "member", "granted_member")),
        duck(f"{_IAM}, {_MEMBERS}\n---\nSELECT eventid, member, split_part(members_csv, ',', 1) AS granted_member FROM mem"),
    ),
    "pivot_suspects": (
        lambda s, p: flat(h.pivot_suspects(_ie(s, p), _suspects(s, p), SINCE).select("eventid", "identity", "utctimestamp")),
        duck(f"""{_SUSPECTS}
---
SELECT eventid, identity, utctimestamp FROM ev WHERE identity IN (SELECT identity FROM sus) AND utctimestamp >= {ts(SINCE)}"""),
    ),
    "novelty": (
        lambda s, p: flat(h.novelty(_suspects(s, p), v.first_seens(events(s, p)), "2024-01-10 00:00:00")),
        _NOVELTY_SQL,
    ),
    "novelty_kept": (
        lambda s, p: flat(h.novelty(_suspects(s, p), kept_seens(s, p).read(), "2024-01-10 00:00:00")),
        _NOVELTY_SQL,
    ),
    "create_then_grant": (
        lambda s, p: flat(h.create_then_grant(_iam(s, p), DAY)),
        duck(f"""{_IAM}, {_MEMBERS}, g AS (SELECT regexp_extract(member, '([^/:]+@[^/:]+)$', 1) AS account, utctimestamp AS granted_at,
    eventid AS grant_id, identity AS granter FROM mem),
  c AS (SELECT regexp_extract(resource, '([^/:]+@[^/:]+)$', 1) AS account, utctimestamp AS created_at, eventid AS create_id, identity AS creator
    FROM iam WHERE lower(action) LIKE '%createserviceaccount'),
  j AS (SELECT g.*, created_at, create_id, creator, row_number() OVER (PARTITION BY grant_id, g.account ORDER BY created_at DESC, create_id) AS rn
    FROM g JOIN c ON g.account = c.account AND created_at <= granted_at AND granted_at - created_at <= INTERVAL {DAY} SECOND)
---
SELECT account, granted_at, grant_id, granter, created_at, create_id, creator FROM j WHERE rn = 1"""),
    ),
    "impersonation_off_baseline": (
        lambda s, p: flat(h.impersonation_off_baseline(_ie(s, p), "2024-01-12 00:00:00")),
        duck("""SELECT identity, resourcename AS target, min(utctimestamp) AS first_at, count(*) AS event_count FROM ev
WHERE identity IS NOT NULL AND methodname = 'GenerateAccessToken' GROUP BY ALL HAVING min(utctimestamp) >= TIMESTAMP '2024-01-12 00:00:00'"""),
    ),
    "requires_gate": (
        lambda s, p: flat(h.requires_gate(_skills(s, p), v.feed_coverage(events(s, p), AS_OF))),
        duck("""SELECT category || '/' || source AS skill, CASE WHEN category = 'view' THEN 'okta' ELSE '' END AS missing,
  CASE WHEN category = 'view' THEN 'skipped' ELSE 'run' END AS status FROM ev GROUP BY category, source"""),
    ),
    "cross_source_identity": (
        lambda s, p: flat(h.cross_source_identity(_ie(s, p))),
        duck("""SELECT identity, count(DISTINCT source) AS sources, array_to_string(list_sort(list(DISTINCT source)), ',') AS source_list
FROM ev WHERE identity IS NOT NULL GROUP BY identity HAVING count(DISTINCT source) >= 2"""),
    ),
    "paired_counts": (
        lambda s, p: h.paired_counts(_iam(s, p)),
        duck(f"""{_IAM}
---
SELECT count(*) FILTER (WHERE lower(action) LIKE '%createserviceaccount') AS creates,
  count(*) FILTER (WHERE lower(action) LIKE '%setiampolicy%') AS grants FROM iam"""),
    ),
    "landing_check": (
        lambda s, p: h.landing_check(_ie(s, p), "%createserviceaccountkey%"),
        duck("""SELECT count(*) AS n, min(identity) AS identity, min(methodname) AS action, min(project) AS project, min(source_ip) AS source_ip
FROM ev WHERE identity IS NOT NULL AND lower(methodname) LIKE '%createserviceaccountkey%'"""),
    ),
    "distinct_sources_since": (
        lambda s, p: h.distinct_sources_since(v.entity_daily_activity(events(s, p)), "2024-01-15"),
        duck("SELECT count(DISTINCT source) AS sources FROM ev WHERE identity IS NOT NULL AND utctimestamp >= DATE '2024-01-15'"),
    ),
    "sweep": (
        lambda s, p: flat(h.sweep(_ie(s, p), SINCE, AS_OF)),
        duck(f"""SELECT identity, count(*) AS event_count, min(utctimestamp) AS first_event_at, max(utctimestamp) AS last_event_at,
  coalesce(array_to_string(list_sort(list(DISTINCT source_ip) FILTER (WHERE source_ip IS NOT NULL)), ','), '') AS ips,
  coalesce(array_to_string(list_sort(list(DISTINCT project) FILTER (WHERE project IS NOT NULL)), ','), '') AS projects
FROM ev WHERE identity IS NOT NULL AND utctimestamp >= {ts(SINCE)} AND utctimestamp < {ts()} GROUP BY identity"""),
    ),
    "feed_alive": (
        lambda s, p: h.feed_alive(v.feed_coverage(events(s, p), AS_OF), "gcp_audit", "data_access", 24),
        duck(f"SELECT {ts()} - max(utctimestamp) < INTERVAL 25 HOUR AS alive FROM ev WHERE audit_log_type = 'data_access'"),
    ),
    "attribution_check": (
        lambda s, p: flat(h.attribution_check(_ie(s, p), CANARY, "serviceAccounts/sa13@")),
        duck(f"""SELECT utctimestamp, eventid, identity, methodname AS action, resourcename AS resource FROM ev
WHERE identity = '{CANARY}' AND resourcename LIKE '%serviceAccounts/sa13@%'"""),
    ),
    "latest_grant": (
        lambda s, p: h.latest_grant(_iam(s, p)),
        duck(f"""{_IAM}
---
SELECT identity, split_part(members_csv, ',', 1) AS granted_member, roles_csv AS policy_delta, action FROM iam WHERE members_csv IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY identity ORDER BY utctimestamp DESC, eventid DESC) = 1"""),
    ),
    "correlated_chains": (_chains, duck(_chain_sql("identity"))),
    "correlated_chains_by_ip": (lambda s, p: _chains(s, p, "source_ip"), duck(_chain_sql("source_ip"))),
    "technique_checks": (
        lambda s, p: h.technique_checks(_ie(s, p), _iam(s, p), v.entity_daily_activity(events(s, p)), CANARY, SINCE),
        duck(f"{_IAM}, {_MEMBERS}, {_ROLES}, ie AS (SELECT *, coalesce(methodname, eventname) AS act FROM ev WHERE identity IS NOT NULL)\n---\n{_TECH_SQL}"),
    ),
    "label_events": (
        lambda s, p: _labelled(s, p).select("eventid", "label"),
        duck(f"{_LAB}\n---\nSELECT eventid, label FROM lab"),
    ),
    "fixture_manifest": (
        lambda s, p: flat(sc.manifest_counts(_labelled(s, p))),
        duck(f"""{_LAB}
---
SELECT count(*) AS total, count(*) FILTER (WHERE label = 'attack') AS attack, count(*) FILTER (WHERE label = 'operator') AS operator,
  count(*) FILTER (WHERE label = 'benign') AS benign, count(DISTINCT identity) AS distinct_identities,
  array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM lab"""),
    ),
    "score_hunt": (
        _scores,
        duck(f"""{_LAB}, cite AS (SELECT DISTINCT right(eventid, 1) AS report_id,
    CASE WHEN eventid LIKE '%13' THEN 'no-' || eventid ELSE eventid END AS eventid FROM ev WHERE right(eventid, 1) IN ('0', '1', '2', '3')),
  b AS (SELECT report_id, CASE WHEN label IS NULL THEN 'h' ELSE label END AS k FROM cite LEFT JOIN lab USING (eventid)),
  n AS (SELECT report_id, count(*) AS c, count(*) FILTER (WHERE k = 'h') AS h, count(*) FILTER (WHERE k = 'attack') AS a,
    count(*) FILTER (WHERE k = 'operator') AS o, count(*) FILTER (WHERE k = 'benign') AS f FROM b GROUP BY report_id)
---
SELECT report_id, CASE WHEN report_id = '2' THEN 'nothing_of_concern' ELSE 'findings' END AS verdict, c AS n_findings,
  (SELECT count(*) FROM lab WHERE label = 'attack') AS attack_total, c AS cited_total, h AS hallucinated, a AS true_positive,
  o AS dont_care_operator, f AS false_positive, report_id <> '2' AS verdict_coherent,
  round(a / (SELECT count(*) FROM lab WHERE label = 'attack'), 6) AS citation_recall,
  h = 0 AND a > 0 AND f = 0 AND report_id <> '2' AS passed FROM n"""),
    ),
}
