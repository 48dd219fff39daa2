"""Ad-hoc queries, condition rows, record filters, scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilake.catalog.base import AS_OF, duck, events, flat, ts
from vigilake.functions import jsonfn as j
from vigilake.functions import scalars as sc
from vigilake.functions.templates import render_document
from vigilake.functions.walk import merge
from vigilake.operators import query as q
from vigilake.operators.textindex import TextIndex
from vigilake.plans.ranges import places
from vigilake.sources.rules import rule_quality
from vigilake.sources.sample import raw_table
from vigilake.sources.tables import scan_window
from vigilake.session import configure, run_dir
from vigilake.sources.manifest import Manifest

DAY = 1440
BRIEF = ("utctimestamp", "eventid", "severity", "source", "category", "summary")
_BRIEF = ", ".join(BRIEF)


def _brief(df):
    return flat(df.select(*BRIEF))


def _criteria(spark, sf):
    crit = (
        "source='gcp_audit' AND JSON_VALUE(details.methodname) = 'SetIamPolicy' "
        "OR CAST(json_extract_scalar(details, '$.k') AS INT64) >= 95 AND 'login' IN UNNEST(tags)"
    )
    return _brief(q.query_events(events(spark, sf), crit, 20 * DAY, 500, as_of=AS_OF))


def _builder(spark, sf):
    e = events(spark, sf)
    rows = [
        q.Condition("source", "=", "cloudtrail"), q.Condition("details.eventname", "contains", "Bucket"),
        q.Condition("details.risk_score", ">", "40"), q.Condition("tags", "=", "aws"),
        q.Condition("sourceipaddress", "!=", "10.0.1.1"), q.Condition("", "=", "x"), q.Condition("severity", "=", " "),
    ]
    return _brief(e.filter(q.all_rows(e, rows)))


def _record_match(spark, sf):
    e = events(spark, sf)
    rows = [
        q.Condition("tags", "contains", "WORK"), q.Condition("details.k", ">=", "50"),
        q.Condition("details.missing.path", "!=", "x"), q.Condition("SEVERITY".lower(), "=", "info"),
        q.Condition("details.user", "contains", "USER1"),
    ]
    return _brief(e.filter(q.matches_all_rows(e, rows)))


def _columns(spark, sf):
    e = events(spark, sf)
    out = q.select_columns(e, ["eventid", "details.nested.c-ip.id", "tags[1]", "details.policy_members[0]", "details.nope"])
    return out.toDF("eventid", "nested_id", "second_tag", "first_member", "nope")


def _sorted(spark, sf):
    """Position in a sort by a nested path, missing last, shown through the first 50 rows."""
    e = events(spark, sf)
    return flat(q.sort_any(e.select(*BRIEF, "source_ip", "details"), "source_ip", True, "eventid").limit(50).select("eventid", "source_ip"))


_TAGGED = ("{{summary}}{{#tags}} #{{.}}{{/tags}}{{#details.policy_members}} <{{.}}>{{/details.policy_members}}"
           "{{^details.user}} nobody{{/details.user}}{{#details.events}} {{name}}/{{{source}}}{{/details.events}}{{! no remark }}")


def _sections(spark, sf):
    """A template with sections over every event."""
    e = events(spark, sf)
    return e.select("eventid", render_document(_TAGGED, F.try_parse_json(j.record_json(e))).alias("line"))


def _sorted_whole(spark, sf):
    """Every row with its position in a sort by a nested path, missing last."""
    e = events(spark, sf).select(*BRIEF, "source_ip", "details")
    return flat(places(q.sort_any(e, "source_ip", True, "eventid")).select("eventid", "source_ip", "position"))


def _sorted_numbers(spark, sf):
    """Every row with its position in a sort by a number inside the details."""
    e = events(spark, sf).select(*BRIEF, "details")
    return flat(places(q.sort_any(e, "utctimestamp", False, "eventid")).select("eventid", "position"))


def _indexed_search(spark, sf):
    """Text search through the trigram index of a table written in batches, the last of which the index does not know yet."""
    e = events(spark, sf)
    base = e.select("utctimestamp", "eventid", "severity", "summary", "category", "source", "tags", "plugins", "details", "event_date")
    path = run_dir(spark, "search")
    log, index = Manifest(spark, f"{path}/events"), TextIndex(spark, f"{path}/events", f"{path}/index")
    for i, cond in enumerate(("category IN ('click', 'view')", "category = 'error'", "category NOT IN ('click', 'view', 'error')")):
        log.write_batch(base.filter(cond), "s", i)
        if i == 1:
            index.refresh()
    return _brief(index.search("SIGNIN", "2024-01-03 00:00:00", "2024-01-20 00:00:00", "cloudtrail"))


def _rule_quality(spark, sf):
    configure(spark)
    p = raw_table(spark, sf, "part")
    drafts = p.select(
        F.col("p_partkey").alias("rule_id"),
        F.regexp_replace(F.lower("p_name"), " ", "_").alias("alert_name"),
        F.expr("CASE p_partkey % 4 WHEN 0 THEN 'deadman' WHEN 1 THEN 'sequence' WHEN 2 THEN 'threshold' ELSE NULL END").alias("alert_type"),
        F.expr("CASE WHEN p_partkey % 9 = 0 THEN ' ' ELSE p_type END").alias("summary"),
        F.expr("CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'source = ''x''' END").alias("criteria"),
        (F.col("p_size") - 3).alias("threshold"),
        F.expr("CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE 10 END").alias("lookback_minutes"),
        F.expr("CASE WHEN p_partkey % 3 = 0 THEN array('a') WHEN p_partkey % 3 = 1 THEN array('a', ' ') ELSE array('a', 'b') END").alias("slot_criteria"),
    )
    return flat(rule_quality(drafts).select("rule_id", "problems", "ok"))


def _time_texts(spark, sf):
    """Order dates written in many spellings, read back by `to_utc`."""
    configure(spark)
    o = raw_table(spark, sf, "orders")
    # epoch digits are told apart from ten-digit seconds on, so the dates are moved past 2001
    t = F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 4400 DAYS") + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    secs = F.unix_seconds(t)
    iso = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    forms = [
        F.concat(iso, F.lit("Z")), F.date_format(t, "yyyy-MM-dd HH:mm:ss"), secs.cast("string"),
        (secs * 1000).cast("string"), (secs * 1000000).cast("string"), (secs * 1000000000).cast("string"),
        F.concat(secs.cast("string"), F.lit(".0")), F.concat(iso, F.lit("+0000")), F.concat(iso, F.lit(".000+00:00")),
        F.date_format(t, "EEE, d MMM yyyy HH:mm:ss '+0000'"), F.date_format(t, "MMM d, yyyy HH:mm:ss"),
        F.date_format(t, "MM/dd/yyyy HH:mm:ss"), F.lit("nada"), F.lit("-5"), F.lit("0"),
    ]
    pick = F.element_at(F.array(*forms), (F.col("o_orderkey") % len(forms) + 1).cast("int"))
    return flat(o.select("o_orderkey", sc.to_utc(pick).alias("utc")))


def _addresses(spark, sf):
    """Address-like texts made from every customer row, judged by `is_ip`."""
    configure(spark)
    c = raw_table(spark, sf, "customer")
    k = "c_custkey"
    forms = [
        f"concat_ws('.', {k} % 300, {k} % 7, 0, 1)", f"concat('10.1.', {k} % 256, '.9/', {k} % 40)",
        f"concat('2001:db8::', lower(hex({k})))", f"concat('fe80::', {k} % 10, '::1')", f"cast({k} as string)",
        f"concat('1:2:3:4:5:6:7:', lower(hex({k} % 65536)))", f"concat('1:2:3:4:5:6:', {k} % 10)",
        f"concat('::ffff:10.0.0.', {k} % 300)", "'nada'", f"concat('2001:db8::/', {k} % 140)", "''",
    ]
    pick = F.element_at(F.array(*[F.expr(f) for f in forms]), (F.col(k) % len(forms) + 1).cast("int"))
    text = c.select(k, pick.alias("text"))
    return text.select(k, sc.is_ip(F.col("text")).alias("ip"), sc.is_ipv4(F.col("text")).alias("v4"))


def _severity_gate(spark, sf):
    configure(spark)
    o = raw_table(spark, sf, "orders")
    sev = F.element_at(F.array(*[F.lit(x) for x in ("CRITICAL", "high", "Medium", "LOW", "INFO", "WARNING")]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    least = F.element_at(F.array(*[F.lit(x) for x in ("LOW", "bogus", "CRITICAL", "info")]), (F.col("o_custkey") % 4 + 1).cast("int"))
    return o.select("o_orderkey", sc.severity_rank(sev).cast("long").alias("rank"), sc.severity_allows(sev, least).alias("allowed"))


def _cells(spark, sf):
    e = events(spark, sf)
    kinds = {f.name: f.dataType for f in e.schema}
    show = lambda c: sc.format_cell(F.col(c), kinds[c]).alias(c)
    return e.select("eventid", show("utctimestamp"), show("source_ip"), show("tags"))


def _lifespans(spark, sf):
    configure(spark)
    p = raw_table(spark, sf, "part")
    unit = F.element_at(F.array(*[F.lit(x) for x in (" days", " day", " hours", " min", " weeks", "")]), (F.col("p_partkey") % 6 + 1).cast("int"))
    text = F.concat(F.col("p_size").cast("string"), unit)
    created = F.lit("2024-01-01 00:00:00").cast("timestamp")
    ends = F.timestamp_seconds(F.unix_seconds(created) + sc.lifespan_seconds(text))
    return p.select(
        "p_partkey", sc.lifespan_seconds(text).alias("seconds"), sc.is_expired(ends, AS_OF).alias("expired"),
        sc.clamp(F.concat(F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 5 == 0, "x").otherwise("")), 60, 30).cast("long").alias("clamped"),
    )


def _rendered(spark, sf):
    e = events(spark, sf)
    look = j.row_lookup(e)
    template = {"text": '{{severity}}: "{{details.user}}"', "n": 1, "on": True, "parts": ["{{ details.nested.c-ip.id }}", "{{tags.0}}", "{{no.such}}", None]}
    return e.select("eventid", j.render("{{details.user}} did {{category}} ({{details.k}})", look).alias("line"),
                    j.render_payload(template, look).alias("payload"))


def _props(spark, sf):
    e = events(spark, sf)
    k = j.jv(F.col("details"), "k").try_cast("bigint")
    return _brief(e.filter((k > 50) & (F.col("category") == "click")))


def _json_kinds(spark, sf):
    """Scalar extraction of scalars, objects, lists and missing paths."""
    d = F.col("details")
    return events(spark, sf).select(
        "eventid", j.jv(d, "k").alias("number"), j.jv(d, "nested").alias("object"), j.jv(d, "policy_members").alias("list"),
        F.array_join(j.jv_array(d, "policy_members"), ",").alias("members"), j.jv(d, 'nested.c-ip.id').alias("deep"),
        j.jv(d, "user").alias("user"), j.jv(d, "x.y").alias("missing"), j.has_path(d, "user").alias("has_user"),
        j.dict_match(d, {"project": "proj-1", "audit_log_type": "activity"}).alias("matched"),
    )


def _merged(spark, sf):
    """Details merged with a patch, nested objects included."""
    e = events(spark, sf)
    patch = F.to_json(F.struct(
        F.col("category").alias("user"), F.struct(F.struct(F.lit("x").alias("extra")).alias("c-ip")).alias("nested")))
    d = F.try_parse_json(merge(F.to_json("details"), patch))
    return e.select("eventid", j.jv(d, "user").alias("user"), j.jv(d, "k").alias("k"),
                    j.jv(d, "nested.c-ip.extra").alias("extra"), j.jv(d, "nested.c-ip.id").alias("id"))


def _names_and_dates(spark, sf):
    e = events(spark, sf)
    parts = sc.event_date_parts(F.col("utctimestamp"))
    return e.select(
        "eventid", *[parts[k].alias(k) for k in ("now_hour", "now_day", "last_hour_hour", "last_hour_month", "last_hour_year")],
        sc.service_short(F.coalesce("servicename", "eventsource")).alias("service"),
        sc.short_id(sc.stable_id(F.col("eventid"))).alias("short"),
        sc.display_incident_id(F.concat(F.lit("incident-"), F.md5("eventid"))).alias("shown"),
        (F.length(sc.stable_id(F.col("eventid"), F.col("source"))) == 36).alias("long_enough"),
    )


QUERIES = {
    "merge_documents": (
        _merged,
        duck("SELECT eventid, category AS \"user\", CAST(k AS VARCHAR) AS k, 'x' AS extra, CAST(user_id AS VARCHAR) AS id FROM ev"),
    ),
    "names_and_dates": (
        _names_and_dates,
        duck("""SELECT eventid, strftime(utctimestamp, '%H') AS now_hour, strftime(utctimestamp, '%d') AS now_day,
  strftime(utctimestamp - INTERVAL 1 HOUR, '%H') AS last_hour_hour, strftime(utctimestamp - INTERVAL 1 HOUR, '%m') AS last_hour_month,
  strftime(utctimestamp - INTERVAL 1 HOUR, '%Y') AS last_hour_year,
  replace(replace(coalesce(servicename, eventsource), '.amazonaws.com', ''), '.googleapis.com', '') AS service,
  left(md5(eventid), 8) AS short, upper(left(md5(eventid), 8)) AS shown, true AS long_enough FROM ev"""),
    ),
    "query_events": (
        _criteria,
        duck(f"""SELECT {_BRIEF} FROM ev WHERE (source = 'gcp_audit' AND methodname = 'SetIamPolicy'
  OR k >= 95 AND list_contains(tags, 'login')) AND utctimestamp >= {ts()} - INTERVAL {20 * DAY} MINUTE
ORDER BY utctimestamp DESC, eventid LIMIT 500"""),
    ),
    "browse": (
        lambda s, p: _brief(q.browse(events(s, p), 10 * DAY, 5000, as_of=AS_OF, most=5000)),
        duck(f"""SELECT {_BRIEF} FROM ev WHERE utctimestamp >= {ts()} - INTERVAL {10 * DAY} MINUTE
ORDER BY utctimestamp DESC, eventid LIMIT 5000"""),
    ),
    "scan_window": (
        lambda s, p: _brief(scan_window(events(s, p), "2024-01-05 00:00:00", "2024-01-12 12:00:00")),
        duck(f"""SELECT {_BRIEF} FROM ev WHERE utctimestamp >= TIMESTAMP '2024-01-05 00:00:00'
  AND utctimestamp < TIMESTAMP '2024-01-12 12:00:00'"""),
    ),
    "criteria_builder": (
        _builder,
        duck(f"""SELECT {_BRIEF} FROM ev WHERE source = 'cloudtrail' AND eventname LIKE '%Bucket%' AND value > 40
  AND list_contains(tags, 'aws') AND source_ip <> '10.0.1.1'"""),
    ),
    "record_match": (
        _record_match,
        duck(f"""SELECT {_BRIEF} FROM ev WHERE source = 'google_workspace' AND k >= 50 AND severity = 'INFO'
  AND identity LIKE '%user1%'"""),
    ),
    "deep_search": (
        lambda s, p: _brief(q.deep_search(events(s, p).select(*BRIEF, "tags", "details"), "EXT1@other", ["summary", "eventid"])),
        duck(f"SELECT {_BRIEF} FROM ev WHERE members_csv LIKE '%ext1@other%'"),
    ),
    "log_search": (
        lambda s, p: _brief(q.log_search(events(s, p), "2024-01-03 00:00:00", "2024-01-20 00:00:00", "cloudtrail", "SIGNIN")),
        duck(f"""SELECT {_BRIEF} FROM ev WHERE source = 'cloudtrail' AND eventsource LIKE '%signin%'
  AND utctimestamp >= TIMESTAMP '2024-01-03 00:00:00' AND utctimestamp < TIMESTAMP '2024-01-20 00:00:00'"""),
    ),
    "json_props_filter": (_props, duck(f"SELECT {_BRIEF} FROM ev WHERE k > 50 AND category = 'click'")),
    "json_kinds": (
        _json_kinds,
        duck("""SELECT eventid, CAST(k AS VARCHAR) AS number, CAST(NULL AS VARCHAR) AS object, CAST(NULL AS VARCHAR) AS list,
  members_csv AS members, CAST(user_id AS VARCHAR) AS deep, identity AS "user", CAST(NULL AS VARCHAR) AS missing,
  identity IS NOT NULL AS has_user, coalesce(project = 'proj-1' AND audit_log_type = 'activity', false) AS matched FROM ev"""),
    ),
    "select_columns": (
        _columns,
        duck("""SELECT eventid, CAST(user_id AS VARCHAR) AS nested_id, tags[2] AS second_tag,
  split_part(members_csv, ',', 1) AS first_member, CAST(NULL AS VARCHAR) AS nope FROM ev"""),
    ),
    "template_sections": (
        _sections,
        duck("""SELECT eventid, summary || array_to_string(list_transform(tags, lambda x: ' #' || x), '')
  || coalesce(array_to_string(list_transform(string_split(members_csv, ','), lambda x: ' <' || x || '>'), ''), '')
  || CASE WHEN identity IS NULL THEN ' nobody' ELSE '' END || coalesce(' ' || workspace_event || '/' || source, '') AS line FROM ev"""),
    ),
    "log_search_indexed": (
        _indexed_search,
        duck(f"""SELECT {_BRIEF} FROM ev WHERE source = 'cloudtrail' AND eventsource LIKE '%signin%'
  AND utctimestamp >= TIMESTAMP '2024-01-03 00:00:00' AND utctimestamp < TIMESTAMP '2024-01-20 00:00:00'"""),
    ),
    "sort_any_whole": (
        _sorted_whole,
        duck("SELECT eventid, source_ip, row_number() OVER (ORDER BY source_ip DESC NULLS LAST, eventid) AS position FROM ev"),
    ),
    "sort_any_times": (_sorted_numbers, duck("SELECT eventid, row_number() OVER (ORDER BY utctimestamp, eventid) AS position FROM ev")),
    "sort_any": (
        _sorted,
        duck("SELECT eventid, source_ip FROM ev ORDER BY source_ip DESC NULLS LAST, eventid LIMIT 50"),
    ),
    "format_cells": (
        _cells,
        duck("""SELECT eventid, strftime(utctimestamp, '%Y-%m-%d %H:%M:%S') AS utctimestamp, coalesce(source_ip, '—') AS source_ip,
  '["' || array_to_string(tags, '","') || '"]' AS tags FROM ev"""),
    ),
    "render_templates": (
        _rendered,
        duck("""SELECT eventid, coalesce(identity, '') || ' did ' || category || ' (' || k || ')' AS line,
  '{"text":"' || severity || ': \\"' || coalesce(identity, '') || '\\"","n":1,"on":true,"parts":["' || user_id || '","'
  || tags[1] || '","",null]}' AS payload FROM ev"""),
    ),
    "rule_quality": (
        _rule_quality,
        """WITH r AS (SELECT p_partkey AS rule_id, replace(lower(p_name), ' ', '_') AS n,
  CASE p_partkey % 4 WHEN 0 THEN 'deadman' WHEN 1 THEN 'sequence' ELSE 'threshold' END AS t,
  p_partkey % 9 = 0 AS no_summary, p_partkey % 5 = 0 AS no_criteria, p_size - 3 AS th, p_partkey % 8 = 0 AS no_back,
  p_partkey % 3 AS s FROM part), p AS (
SELECT rule_id, list_filter([
  CASE WHEN NOT regexp_full_match(n, '[a-z0-9_]{3,64}') THEN 'name' END,
  CASE WHEN no_summary THEN 'summary' END,
  CASE WHEN t <> 'sequence' AND no_criteria THEN 'criteria' END,
  CASE WHEN t <> 'sequence' AND th < CASE t WHEN 'deadman' THEN 0 ELSE 1 END THEN 'threshold' END,
  CASE WHEN t = 'deadman' AND no_back THEN 'lookback' END,
  CASE WHEN t = 'sequence' AND s = 0 THEN 'slots' END,
  CASE WHEN t = 'sequence' AND s = 1 THEN 'slot criteria' END], lambda x: x IS NOT NULL) AS problems FROM r)
SELECT rule_id, array_to_string(problems, ',') AS problems, len(problems) = 0 AS ok FROM p""",
    ),
    "to_utc": (
        _time_texts,
        """SELECT o_orderkey, CASE WHEN o_orderkey % 15 = 12 THEN NULL
  WHEN o_orderkey % 15 >= 13 THEN TIMESTAMP '1970-01-01 00:00:00'
  ELSE o_orderdate + INTERVAL 4400 DAY + to_seconds(o_orderkey % 86400) END AS utc FROM orders""",
    ),
    "is_ip": (
        _addresses,
        """SELECT c_custkey, CASE c_custkey % 11 WHEN 0 THEN c_custkey % 300 < 256 WHEN 1 THEN c_custkey % 40 <= 32
  WHEN 2 THEN c_custkey < 65536 WHEN 5 THEN true WHEN 7 THEN c_custkey % 300 < 256 WHEN 9 THEN c_custkey % 140 <= 128
  ELSE false END AS ip, c_custkey % 11 = 0 AND c_custkey % 300 < 256 AS v4 FROM customer""",
    ),
    "severity_gate": (
        _severity_gate,
        """WITH s AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS r,
  CASE o_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 4 ELSE 0 END AS m FROM orders)
SELECT o_orderkey, CAST(r AS BIGINT) AS rank, r >= m AS allowed FROM s""",
    ),
    "lifespan_expiry": (
        _lifespans,
        f"""WITH s AS (SELECT p_partkey, p_size, CAST(CASE p_partkey % 6 WHEN 0 THEN p_size * 86400 WHEN 1 THEN p_size * 86400
  WHEN 2 THEN p_size * 3600 WHEN 3 THEN p_size * 60 ELSE 259200 END AS BIGINT) AS seconds FROM part)
SELECT p_partkey, seconds, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(seconds) < {ts()} AS expired,
  CAST(CASE WHEN p_partkey % 5 = 0 THEN 60 ELSE least(greatest(p_size, 1), 30) END AS BIGINT) AS clamped FROM s""",
    ),
}
