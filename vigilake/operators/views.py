"""The five hunting views and the orientation count."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions.jsonfn import detail, detail_array
from vigilake.sources.tables import as_datetime, ts_lit, within

FIRST_SEEN_DIMENSIONS = ("source_ip", "user_agent", "project", "source")


def _day(events: DataFrame) -> list[str]:
    """The partition column, where the table has one: a hunt over a view can only prune days it still sees."""
    return ["event_date"] if "event_date" in events.columns else []


def identity_events(events: DataFrame) -> DataFrame:
    """One row per event that names a user, with the usual detail fields as columns."""
    user = detail(events, "user")
    return events.filter(user.isNotNull()).select(
        "utctimestamp", "eventid", "source", "category", "severity", "summary",
        user.alias("identity"),
        detail(events, "sourceipaddress").alias("source_ip"),
        detail(events, "useragent").alias("user_agent"),
        detail(events, "audit_log_type").alias("audit_log_type"),
        F.coalesce(detail(events, "methodname"), detail(events, "eventname")).alias("action"),
        F.coalesce(detail(events, "servicename"), detail(events, "eventsource")).alias("service"),
        detail(events, "resourcename").alias("resource"),
        detail(events, "project").alias("project"),
        detail(events, "events[0].name").alias("workspace_event"),
        "tags",
        "details",
        *_day(events),
    )


def _attributed(events: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    user = detail(events, "user")
    return events.filter(user.isNotNull()).select(
        user.alias("identity"),
        "utctimestamp", "source", "category", "severity",
        detail(events, "sourceipaddress").alias("source_ip"),
        detail(events, "useragent").alias("user_agent"),
        detail(events, "project").alias("project"),
        *_day(events),
        *more,
    )


def combination_counts() -> dict[str, Column]:
    return {
        "n": F.count(F.lit(1)), "warn": F.count_if(F.col("severity").isin("WARNING", "CRITICAL")),
        "lo": F.min("utctimestamp"), "hi": F.max("utctimestamp"),
    }


def activity_of_combinations(combos: DataFrame) -> DataFrame:
    """Sets and sums per (identity, day) from counts per combination."""
    ips = F.collect_set("source_ip")
    return combos.groupBy("identity", "day").agg(
        F.sum("n").alias("event_count"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.array_sort(F.collect_set("category")).alias("categories"),
        F.size(ips).cast("long").alias("distinct_ips"),
        F.array_sort(ips).alias("ips"),
        F.array_sort(F.collect_set("user_agent")).alias("user_agents"),
        F.sum("warn").alias("warning_events"),
        F.min("lo").alias("first_event_at"),
        F.max("hi").alias("last_event_at"),
    )


def entity_daily_activity(events: DataFrame) -> DataFrame:
    """Activity per (identity, day).

    The first grouping collapses rows to distinct combinations with plain counters, combined in the map
    tasks; a hot identity spreads over its combinations. The sets are then built from combinations, so
    no task ever holds the raw rows of one identity.
    """
    # the partition column is the day, so a filter on `day` prunes
    day = F.col("event_date") if "event_date" in events.columns else F.to_date("utctimestamp")
    combos = (
        _attributed(events)
        .withColumn("day", day)
        .groupBy("identity", "day", "source", "category", "source_ip", "user_agent")
        .agg(*[c.alias(n) for n, c in combination_counts().items()])
    )
    return activity_of_combinations(combos)


def first_seens(events: DataFrame) -> DataFrame:
    """First and last time each identity was seen with each ip, agent, project and source. One scan."""
    long = (
        _attributed(events)
        .select("identity", "utctimestamp", *FIRST_SEEN_DIMENSIONS)
        .unpivot(["identity", "utctimestamp"], list(FIRST_SEEN_DIMENSIONS), "dimension", "value")
    )
    return long.filter(F.col("value").isNotNull()).groupBy("identity", "dimension", "value").agg(
        F.min("utctimestamp").alias("first_seen_at"),
        F.max("utctimestamp").alias("last_seen_at"),
        F.count(F.lit(1)).alias("event_count"),
    )


def merge_first_seens(*partials: DataFrame) -> DataFrame:
    """Combine `first_seens` results of separate days: yesterday's table plus today's events."""
    both = partials[0]
    for p in partials[1:]:
        both = both.unionByName(p)
    return both.groupBy("identity", "dimension", "value").agg(
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.sum("event_count").alias("event_count"),
    )


def feed_coverage(events: DataFrame, as_of: datetime | str, days: int = 7) -> DataFrame:
    """What flowed per (source, audit log type) in the last days.

    The groups are few and huge, so rows are first counted per (feed, identity, project); the distinct
    counts then run over those combinations.
    """
    since = as_datetime(as_of) - timedelta(days=days)
    recent = within(events, since)
    combos = (
        recent.groupBy(
            "source",
            F.coalesce(detail(events, "audit_log_type"), F.lit("n/a")).alias("audit_log_type"),
            detail(events, "user").alias("identity"),
            detail(events, "project").alias("project"),
        ).agg(
            F.count(F.lit(1)).alias("n"), F.min("utctimestamp").alias("lo"), F.max("utctimestamp").alias("hi")
        )
    )
    hours = F.floor((F.unix_micros(ts_lit(as_of)) - F.unix_micros("last_event_at")) / 3_600_000_000)
    return (
        combos.groupBy("source", "audit_log_type")
        .agg(
            F.sum("n").alias("events_7d"),
            F.count_distinct("identity").alias("distinct_identities"),
            F.count_distinct("project").alias("distinct_projects"),
            F.min("lo").alias("first_event_at"),
            F.max("hi").alias("last_event_at"),
        )
        .withColumn("hours_since_last_event", hours.cast("long"))
    )


def iam_changes(events: DataFrame) -> DataFrame:
    """Policy changes, grants, key and account creation in the cloud audit log."""
    method = F.lower(detail(events, "methodname"))
    wanted = (
        F.array_contains("tags", "iam-policy-change")
        | method.like("%setiampolicy%")
        | method.like("%serviceaccountkey%")
        | method.like("%createserviceaccount%")
    )
    return events.filter((F.col("source") == "gcp_audit") & wanted).select(
        "utctimestamp", "eventid",
        detail(events, "user").alias("identity"),
        detail(events, "methodname").alias("action"),
        detail(events, "resourcename").alias("resource"),
        detail(events, "project").alias("project"),
        detail_array(events, "policy_members").alias("granted_members"),
        detail_array(events, "policy_roles").alias("granted_roles"),
        detail(events, "policy_member").alias("granted_member"),
        detail(events, "policy_delta").alias("policy_delta"),
        detail(events, "sourceipaddress").alias("source_ip"),
        "severity", "summary", "details",
        *_day(events),
    )


def orient(events: DataFrame, since: datetime | str, until: datetime | str | None = None) -> DataFrame:
    """Attributed events per source and audit log type in a window."""
    recent = within(events, since, until)
    return (
        recent.filter(detail(events, "user").isNotNull())
        .groupBy("source", detail(events, "audit_log_type").alias("audit_log_type"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def approx_daily_activity(events: DataFrame) -> DataFrame:
    """Sketch variant of the distinct-ip count, mergeable over days with `hll_union_agg`."""
    return (
        _attributed(events)
        .groupBy("identity", (F.col("event_date") if "event_date" in events.columns else F.to_date("utctimestamp")).alias("day"))
        .agg(F.count(F.lit(1)).alias("event_count"), F.hll_sketch_agg("source_ip").alias("ip_sketch"))
    )


def approx_identity_ips(daily: DataFrame) -> DataFrame:
    """Approximate distinct ips per identity over all days of `approx_daily_activity`."""
    return daily.groupBy("identity").agg(
        F.sum("event_count").alias("event_count"),
        F.hll_sketch_estimate(F.hll_union_agg("ip_sketch")).alias("approx_ips"),
    )


def register_views(spark, events: DataFrame, as_of: datetime | str) -> None:
    """The views by name for SQL users."""
    for name, view in {
        "identity_events": identity_events(events),
        "entity_daily_activity": entity_daily_activity(events),
        "first_seens": first_seens(events),
        "feed_coverage": feed_coverage(events, as_of),
        "iam_changes": iam_changes(events),
    }.items():
        view.createOrReplaceTempView(name)
