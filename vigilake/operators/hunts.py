"""Hunt queries over the views, correlation, feed gating, and the technique checks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.plans.ranges import last_before, sessionize
from vigilake.sources.tables import ts_lit, within

PRIVILEGED_ROLE = r"^roles/(owner|editor|.*serviceAccountTokenCreator)$"
SERVICE_ACCOUNT = r"\.iam\.gserviceaccount\.com$"


def unnest_members(iam: DataFrame) -> DataFrame:
    """One row per granted member; the first-delta scalars stay as context."""
    return iam.withColumn("member", F.explode("granted_members"))


def unnest_roles(iam: DataFrame) -> DataFrame:
    return iam.withColumn("role", F.explode("granted_roles"))


def external_grants(iam: DataFrame, org_domains: Sequence[str], since: datetime | str) -> DataFrame:
    """Grants to members outside the organisation that are no service accounts, newest first."""
    inside = "|".join(d.replace(".", r"\.") for d in org_domains)
    known = rf"@({inside}|.*{SERVICE_ACCOUNT[:-1]})$"
    return (
        unnest_members(within(iam, since)).filter(~F.col("member").rlike(known))
        .select("utctimestamp", "eventid", "identity", F.col("member").alias("granted_member"), "policy_delta", "resource", "source_ip")
        .orderBy(F.desc("utctimestamp"), "eventid", "granted_member")
    )


def new_ips(first_seens: DataFrame, since: datetime | str) -> DataFrame:
    """Addresses an identity used for the first time since then."""
    return (
        first_seens.filter((F.col("dimension") == "source_ip") & (F.col("first_seen_at") >= ts_lit(since)))
        .select("identity", F.col("value").alias("new_ip"), "first_seen_at", "event_count")
        .orderBy(F.desc("first_seen_at"), "identity", "new_ip")
    )


def category_breadth(daily: DataFrame, since_day: str) -> DataFrame:
    """Identities by how many categories they touched in a day, then by volume."""
    return (
        daily.filter(F.col("day") >= F.lit(since_day).cast("date"))
        .select("identity", "day", F.size("categories").cast("long").alias("category_breadth"), "event_count")
        .orderBy(F.desc("category_breadth"), F.desc("event_count"), "identity", "day")
    )


def privileged_roles(iam: DataFrame, since: datetime | str | None = None) -> DataFrame:
    rows = within(iam, since) if since else iam
    return unnest_roles(rows).filter(F.col("role").rlike(PRIVILEGED_ROLE)).select(
        "utctimestamp", "eventid", "identity", "role", "granted_members", "resource", "source_ip"
    )


def key_creation(iam: DataFrame, since: datetime | str | None = None) -> DataFrame:
    """Long-lived credentials being made."""
    rows = within(iam, since) if since else iam
    return rows.filter(F.lower("action").like("%serviceaccountkey%")).select(
        "utctimestamp", "eventid", "identity", "action", "resource", "source_ip"
    )


def pivot_suspects(identity_events: DataFrame, suspects: DataFrame, since=None, until=None) -> DataFrame:
    """All activity of the given identities."""
    rows = within(identity_events, since, until) if since else identity_events
    return rows.join(suspects.select("identity").distinct(), "identity", "left_semi")


def novelty(suspects: DataFrame, first_seens: DataFrame, since: datetime | str) -> DataFrame:
    """What is new about the suspects: everything of theirs first seen since then."""
    recent = first_seens.filter(F.col("first_seen_at") >= ts_lit(since))
    return recent.join(suspects.select("identity").distinct(), "identity", "left_semi")


def account_of(resource: Column) -> Column:
    """Service account address at the end of a resource path or after a member prefix."""
    return F.regexp_extract(resource, r"([^/:]+@[^/:]+)$", 1)


def create_then_grant(iam: DataFrame, within_seconds: int) -> DataFrame:
    """Service accounts made and then granted a role: each grant with the latest creation before it."""
    creates = (
        iam.filter(F.lower("action").like("%createserviceaccount"))
        .select(
            account_of(F.col("resource")).alias("account"), "utctimestamp",
            F.col("eventid").alias("create_id"), F.col("identity").alias("creator"),
        )
        .filter(F.col("account") != "")
    )
    grants = (
        unnest_members(iam)
        .select(
            account_of(F.col("member")).alias("account"), "utctimestamp",
            F.col("eventid").alias("grant_id"), F.col("identity").alias("granter"),
        )
        .filter(F.col("account") != "")
    )
    out = last_before(grants, creates, ["account"], "utctimestamp", within_seconds, ["create_id", "creator"])
    return out.withColumnsRenamed({"utctimestamp": "granted_at", "matched_ts": "created_at"})


def impersonation_off_baseline(identity_events: DataFrame, since: datetime | str) -> DataFrame:
    """Token minting by (actor, target) pairs that did not occur before `since`.

    Pairs are grouped first, so the comparison runs over pairs and not over events.
    """
    tokens = identity_events.filter(F.lower("action").like("%generateaccesstoken%"))
    start = ts_lit(since)
    pairs = tokens.groupBy("identity", F.col("resource").alias("target")).agg(
        F.min("utctimestamp").alias("first_at"),
        F.count_if(F.col("utctimestamp") >= start).alias("event_count"),
    )
    # a pair is off baseline exactly when its first use lies in the window
    return pairs.filter(F.col("first_at") >= start)


def requires_gate(skills: DataFrame, feeds: DataFrame, max_silence_hours: int | None = None) -> DataFrame:
    """Which hunts can run: `skills(skill, requires array)` against the feed coverage.

    A feed is named `gcp_data_access`, `gcp_activity`, ... or by its plain source.
    """
    alive = feeds if max_silence_hours is None else feeds.filter(F.col("hours_since_last_event") <= max_silence_hours)
    by_stream = F.when(
        F.col("source") == "gcp_audit", F.array(F.concat(F.lit("gcp_"), "audit_log_type"), F.concat(F.lit("gcp_audit_"), "audit_log_type"))
    ).otherwise(F.array().cast("array<string>"))
    names = alive.select(F.explode(F.concat(F.array("source"), by_stream)).alias("feed")).distinct().withColumn("flowing", F.lit(True))
    need = skills.select("skill", F.explode_outer("requires").alias("feed"))
    return (
        need.join(names, "feed", "left")
        .groupBy("skill")
        .agg(
            F.sort_array(F.collect_set(F.when(F.col("feed").isNotNull() & F.col("flowing").isNull(), F.col("feed")))).alias("missing")
        )
        .withColumn("status", F.when(F.size("missing") == 0, "run").otherwise("skipped"))
    )


def cross_source_identity(identity_events: DataFrame) -> DataFrame:
    """Identities seen in more than one source."""
    pairs = identity_events.select("identity", "source").distinct()
    return pairs.groupBy("identity").agg(
        F.count(F.lit(1)).alias("sources"), F.array_sort(F.collect_set("source")).alias("source_list")
    ).filter(F.col("sources") >= 2)


def paired_counts(iam: DataFrame) -> DataFrame:
    """Creations and policy changes in one pass."""
    action = F.lower("action")
    return iam.agg(
        F.count_if(action.like("%createserviceaccount")).alias("creates"),
        F.count_if(action.like("%setiampolicy%")).alias("grants"),
    )


def landing_check(identity_events: DataFrame, pattern: str) -> DataFrame:
    """How many events match an action pattern, with one example of each column."""
    hit = identity_events.filter(F.lower("action").like(pattern))
    return hit.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.min(c).alias(c) for c in ("identity", "action", "project", "source_ip")],
    )


def distinct_sources_since(daily: DataFrame, day: str) -> DataFrame:
    recent = daily.filter(F.col("day") >= F.lit(day).cast("date"))
    return recent.select(F.explode("sources").alias("source")).agg(F.count_distinct("source").alias("sources"))


def sweep(identity_events: DataFrame, since, until) -> DataFrame:
    """The population of a window: per identity its volume, span, addresses and projects."""
    base = within(identity_events, since, until)
    combos = base.groupBy("identity", "source_ip", "project").agg(
        F.count(F.lit(1)).alias("n"), F.min("utctimestamp").alias("lo"), F.max("utctimestamp").alias("hi")
    )
    return combos.groupBy("identity").agg(
        F.sum("n").alias("event_count"), F.min("lo").alias("first_event_at"), F.max("hi").alias("last_event_at"),
        F.array_sort(F.collect_set("source_ip")).alias("ips"), F.array_sort(F.collect_set("project")).alias("projects"),
    )


def feed_alive(feeds: DataFrame, source: str, audit_log_type: str, hours: int) -> DataFrame:
    hit = feeds.filter((F.col("source") == source) & (F.col("audit_log_type") == audit_log_type))
    return hit.agg((F.count_if(F.col("hours_since_last_event") <= hours) > 0).alias("alive"))


def attribution_check(identity_events: DataFrame, actor: str, victim: str) -> DataFrame:
    """Events of one actor on one resource, newest first."""
    rows = identity_events.filter((F.col("identity") == actor) & F.col("resource").contains(victim))
    return rows.select("utctimestamp", "eventid", "identity", "action", "resource").orderBy(F.desc("utctimestamp"), "eventid")


def latest_grant(iam: DataFrame) -> DataFrame:
    """The most recent change of each identity that named a member."""
    named = iam.filter(F.col("granted_member").isNotNull())
    pick = F.max_by(F.struct("granted_member", "policy_delta", "action"), F.struct("utctimestamp", "eventid"))
    return named.groupBy("identity").agg(pick.alias("p")).select("identity", "p.*")


# --- correlation -------------------------------------------------------------


def signal_events(iam: DataFrame, org_domains: Sequence[str]) -> DataFrame:
    """Findings per event: (identity, source_ip, utctimestamp, eventid, signal). One pass, no join."""
    action = F.lower("action")
    inside = "|".join(d.replace(".", r"\.") for d in org_domains)
    outside = F.exists("granted_members", lambda m: ~m.rlike(rf"@({inside}|.*{SERVICE_ACCOUNT[:-1]})$"))
    signals = F.array_compact(F.array(
        F.when(outside, "external_grant"),
        F.when(F.exists("granted_roles", lambda r: r.rlike(PRIVILEGED_ROLE)), "privileged_role"),
        F.when(action.like("%serviceaccountkey%"), "key_creation"),
        F.when(action.like("%createserviceaccount"), "account_creation"),
    ))
    return iam.select("identity", "source_ip", "utctimestamp", "eventid", F.explode(signals).alias("signal"))


SIGNALS = ("external_grant", "privileged_role", "key_creation", "account_creation")


def correlated_chains(findings: DataFrame, gap_seconds: int, actor: str = "identity", least: int = 2) -> DataFrame:
    """Several kinds of signal by one actor in a tight time cluster as one finding with ordered steps."""
    col = F.col("signal")
    sums = {f"n_{s}": F.when(col == s, 1).otherwise(0) for s in SIGNALS}
    mins = {f"t_{s}": F.when(col == s, F.col("utctimestamp")) for s in SIGNALS}
    sessions = sessionize(findings.filter(F.col(actor).isNotNull()), [actor], "utctimestamp", gap_seconds, sums, mins)
    seen = F.array_compact(F.array(*[
        F.when(F.col(f"t_{s}").isNotNull(), F.struct(F.col(f"t_{s}").alias("t"), F.lit(s).alias("s"))) for s in SIGNALS
    ]))
    kinds = reduce(lambda a, b: a + b, [F.when(F.col(f"n_{s}") > 0, 1).otherwise(0) for s in SIGNALS])
    return sessions.filter(kinds >= least).select(
        actor, "session_start", "session_end", F.col("rows").alias("signal_count"),
        kinds.cast("long").alias("signal_kinds"),
        F.transform(F.sort_array(seen), lambda x: x["s"]).alias("steps"),
    )


# --- technique checks --------------------------------------------------------


def technique_checks(identity_events: DataFrame, iam: DataFrame, daily: DataFrame, canary: str, since: datetime | str) -> DataFrame:
    """Did each rehearsed technique arrive with the columns the hunts need?

    All checks on one view are aggregates of a single scan of it, laid out as (technique, check, passed,
    detail) afterwards.
    """
    def one_scan(view: DataFrame, checks: list[tuple[str, str, Column, Column]]) -> DataFrame:
        """(technique, check, condition, detail to show for a matching row)"""
        aggs = []
        for i, (_, _, cond, detail) in enumerate(checks):
            aggs += [F.count_if(F.coalesce(cond, F.lit(False))).alias(f"n{i}"), F.max(F.when(cond, detail)).alias(f"d{i}")]
        rows = [
            F.struct(F.lit(t).alias("technique"), F.lit(c).alias("check"), (F.col(f"n{i}") > 0).alias("passed"), F.col(f"d{i}").alias("detail"))
            for i, (t, c, _, _) in enumerate(checks)
        ]
        return view.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")

    own = F.col("identity") == canary
    action = F.lower("action")
    invite, key, admin, backdoor = (f"gcp.persistence.{t}" for t in (
        "invite-external-user", "create-service-account-key", "create-admin-service-account", "backdoor-service-account-policy"))
    impersonate, workspace = "gcp.privilege-escalation.impersonate-service-accounts", "workspace.assign-admin-role"
    ie, ic = within(identity_events, since), within(iam, since)
    token = action.like("%generateaccesstoken%")
    on_account = F.lower("resource").like("%serviceaccount%")
    landed = one_scan(ie, [
        (invite, "landed in identity_events", own & action.like("%setiampolicy%"), F.col("action")),
        (key, "landed in identity_events", own & action.like("%createserviceaccountkey%"), F.col("action")),
        (admin, "landed in identity_events", own & action.like("%createserviceaccount"), F.col("action")),
        (backdoor, "landed in identity_events", own & action.like("%setiampolicy%"), F.col("action")),
        (impersonate, "data access feed is alive", token, F.col("action")),
        (impersonate, "a canary-attributed impersonation exists", own & token, F.col("resource")),
        (workspace, "workspace event landed",
         (F.col("source") == "google_workspace") & F.lower("workspace_event").like("%role%"), F.col("workspace_event")),
    ])
    outside = F.filter("granted_members", lambda m: ~m.rlike(SERVICE_ACCOUNT))
    owner = F.filter("granted_roles", lambda r: F.lower(r).like("%owner%"))
    changed = one_scan(ic, [
        (invite, "iam_changes row exists", own, F.col("action")),
        (invite, "granted_member populated", own & F.col("granted_member").isNotNull(), F.col("granted_member")),
        (invite, "an external member is findable", own & (F.size(outside) > 0), F.array_max(outside)),
        (key, "iam_changes catches key creation", own & action.like("%serviceaccountkey%"), F.col("resource")),
        (admin, "the owner-role grant survived", own & (F.size(owner) > 0), F.array_max(owner)),
        (backdoor, "event reaches iam_changes", own & on_account, F.col("resource")),
        (backdoor, "granted_member populated", own & on_account & F.col("granted_member").isNotNull(), F.col("granted_member")),
    ])
    both = paired_counts(ic.filter(own)).select(
        F.lit(admin).alias("technique"), F.lit("both create and grant are present").alias("check"),
        ((F.col("creates") > 0) & (F.col("grants") > 0)).alias("passed"),
        F.concat_ws("/", "creates", "grants").alias("detail"),
    )
    day = str(since)[:10]
    joinable = distinct_sources_since(daily, day).select(
        F.lit(workspace).alias("technique"), F.lit("workspace and gcp identities are joinable").alias("check"),
        (F.col("sources") >= 2).alias("passed"), F.col("sources").cast("string").alias("detail"),
    )
    return reduce(lambda a, b: a.unionByName(b), [landed, changed, both, joinable])
