"""Analyst work as folds over action logs: alerts, incidents, tasks, theories, timelines, reports.

Actions are rows with an `at` time; the state is the fold of all of them. Items of incidents stay rows:
an incident with very many items is never gathered in one place.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.functions.scalars import display_incident_id
from vigilake.plans.blocked import latest
from vigilake.session import materialise
from vigilake.sources.tables import ts_lit

# The first tasks of an incident made from an alert, and of one opened by hand.
ESCALATION_TASKS = ("Investigate root cause", "Contain the threat")
MANUAL_TASKS = ("Investigate source",)


def apply_alert_actions(alerts: DataFrame, actions: DataFrame) -> DataFrame:
    """Alerts after the analysts' actions (`alert_id, action, at, user_id, user_name, resolution, impact`).

    Actions: resolve (RESOLVED when both resolution and impact are given, else OPEN again), claim, unclaim,
    escalate. Each kind of field follows its own latest action; one pass, combined in the map tasks.
    """
    kind, order = F.col("action"), F.col("at")
    status = kind.isin("resolve", "escalate")
    picked = actions.groupBy("alert_id").agg(
        F.max_by(F.struct("action", "resolution", "impact", "at"), F.when(status, F.struct(order, kind))).alias("_s"),
        F.max_by(F.struct("resolution", "impact", "at"), F.when(kind == "resolve", order)).alias("_r"),
        F.max_by(F.struct("action", "user_id", "user_name"), F.when(kind.isin("claim", "unclaim"), F.struct(order, kind))).alias("_c"),
        F.max(F.when(kind == "escalate", order)).alias("_e"),
    )
    both = lambda s: s["resolution"].isNotNull() & s["impact"].isNotNull()
    s, r, c = F.col("_s"), F.col("_r"), F.col("_c")
    new_status = (
        F.when(s["action"] == "escalate", "ESCALATED").when(s["action"] == "resolve", F.when(both(s), "RESOLVED").otherwise("OPEN"))
        .otherwise(F.col("status"))
    )
    mine = c["action"] == "claim"
    joined = alerts.join(picked, "alert_id", "left")
    return joined.select(
        *[F.col(x) for x in alerts.columns if x != "status"],
        new_status.alias("status"),
        r["resolution"].alias("resolution"), r["impact"].alias("impact"),
        F.when(both(r), r["at"]).alias("resolved_at"),
        F.when(mine, c["user_id"]).alias("assignee_id"), F.when(mine, c["user_name"]).alias("assignee_name"),
        F.when(F.col("_e").isNotNull(), F.concat("alert_id", F.lit("-incident"))).alias("incident_id"),
    )


def triage_counts(alerts: DataFrame, me: str) -> DataFrame:
    """Totals of the queue: all, mine, escalated, per severity."""
    sev = F.lower("severity")
    return alerts.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("assignee_id") == me).alias("my_queue"),
        F.count_if(F.col("status") == "ESCALATED").alias("escalated"),
        *[F.count_if(sev == x).alias(x) for x in ("critical", "high", "medium", "low", "info")],
    )


def alert_facets(alerts: DataFrame, severities: list[str] | None = None, assignee: str | None = None) -> DataFrame:
    out = alerts
    if severities:
        out = out.filter(F.lower("severity").isin(*[s.lower() for s in severities]))
    return out.filter(F.col("assignee_id") == assignee) if assignee else out


def escalate(alerts: DataFrame, at: datetime | str) -> tuple[DataFrame, DataFrame]:
    """Incidents for alerts, and their first tasks: (incidents, incident actions)."""
    incident = F.concat("alert_id", F.lit("-incident"))
    incidents = alerts.select(
        incident.alias("incident_id"), F.concat(F.lit("Incident: "), "alert_name").alias("title"),
        F.col("alert_id"), ts_lit(at).alias("created_at"),
    )
    first = F.array(*[F.struct(F.lit(str(i + 1)).alias("id"), F.lit(t).alias("text")) for i, t in enumerate(ESCALATION_TASKS)])
    tasks = alerts.select(incident.alias("incident_id"), F.explode(first).alias("t")).select(
        "incident_id", F.lit("task").alias("kind"), F.col("t.id").alias("item_id"), F.lit("add").alias("action"),
        F.col("t.text").alias("text"), F.lit(None).cast("string").alias("likelihood"), F.lit(None).cast("string").alias("user_name"),
        ts_lit(at).alias("at"),
    )
    return incidents, tasks


def alerts_with_incidents(alerts: DataFrame, incident_alerts: DataFrame) -> DataFrame:
    """Alerts with the incidents that list them (`incident_alerts(incident_id, alert_id)`)."""
    return alerts.join(incident_alerts.select("incident_id", "alert_id"), "alert_id")


def fold_incident_items(actions: DataFrame) -> DataFrame:
    """Current theories and tasks out of the item log, one row per item.

    `actions(incident_id, kind, item_id, action, text, likelihood, user_name, at)`; actions are add, edit,
    remove and, for tasks, toggle. An odd number of toggles means done, by the
    user and at the time of the last one.
    """
    kind, at = F.col("action"), F.col("at")
    worded = kind.isin("add", "edit")
    items = actions.groupBy("incident_id", "kind", "item_id").agg(
        F.max_by("action", F.struct(at, kind)).alias("_last"),
        F.max_by("text", F.when(worded, at)).alias("text"),
        F.max_by("likelihood", F.when(worded & F.col("likelihood").isNotNull(), at)).alias("likelihood"),
        F.min(F.when(kind == "add", at)).alias("added_at"),
        F.count_if(kind == "toggle").alias("_toggles"),
        F.max_by(F.struct("user_name", "at"), F.when(kind == "toggle", at)).alias("_done"),
        F.max(F.when(kind == "remove", at)).alias("_removed"),
    )
    done = (F.col("kind") == "task") & (F.col("_toggles") % 2 == 1)
    alive = F.col("added_at").isNotNull() & F.col("_removed").isNull()
    return items.filter(alive).select(
        "incident_id", "kind", "item_id", "text", "likelihood", "added_at", done.alias("done"),
        F.when(done, F.col("_done.at")).alias("completed_at"), F.when(done, F.col("_done.user_name")).alias("completed_by"),
    )


def incident_task_stats(incidents: DataFrame, items: DataFrame, incident_alerts: DataFrame) -> DataFrame:
    """Open and finished tasks, theories and alerts per incident."""
    task, theory = F.col("kind") == "task", F.col("kind") == "theory"
    per = items.groupBy("incident_id").agg(
        F.count_if(task & F.col("done")).alias("done"), F.count_if(task & ~F.col("done")).alias("todo"),
        F.count_if(theory).alias("theories"),
    )
    linked = incident_alerts.groupBy("incident_id").agg(F.count(F.lit(1)).alias("alerts"))
    out = incidents.join(per, "incident_id", "left").join(linked, "incident_id", "left")
    return out.fillna(0, ["done", "todo", "theories", "alerts"])


def timeline_of(entries: DataFrame, context_id: str | None = None) -> DataFrame:
    """Timeline entries after edits and deletions, in display order.

    `entries(id, context_id, action, actor_id, message, timestamp, sort_order, at)`; each column follows
    the latest action that set it.
    """
    rows = entries.filter(F.col("context_id") == context_id) if context_id else entries
    at = F.col("at")
    pick = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c)
    now = rows.groupBy("context_id", "id").agg(
        *[pick(c) for c in ("actor_id", "message", "timestamp", "sort_order")],
        F.max(F.when(F.col("action") == "edit", at)).alias("edited_at"),
        F.bool_or(F.col("action") == "delete").alias("_gone"),
    )
    place = F.coalesce(F.col("sort_order").cast("double"), F.unix_millis("timestamp").cast("double"))
    return now.filter(~F.col("_gone")).drop("_gone").orderBy("context_id", place, "timestamp", "id")


def rule_toggle(rules: DataFrame, actions: DataFrame) -> DataFrame:
    """Rules with the enabled flag of the latest switch (`name, enabled, at`); rules start enabled."""
    last = latest(actions.select("name", "at", F.col("enabled").alias("_on")), ["name"], ["at"])
    joined = rules.join(last.select("name", "_on"), "name", "left")
    return joined.withColumn("enabled", F.coalesce("_on", "enabled", F.lit(True))).drop("_on")


def incident_markdown(
    incidents: DataFrame, items: DataFrame, timeline: DataFrame, incident_alerts: DataFrame, generated_at: datetime | str
) -> DataFrame:
    """The incident report as lines `(incident_id, section, place, line)`.

    Read in the order of these columns the lines of one incident are its Markdown text. Lines, not one
    string per incident, keep a report with very many entries spread over the cluster.
    """
    # the fold and the counts are used by every part of the report
    items, timeline = materialise(items, "items"), materialise(timeline, "timeline")
    stats = materialise(incident_task_stats(incidents, items, incident_alerts), "stats")
    # The headings of the report.
    heads = [
        ("0", F.concat(F.lit("# Incident Summary: "), "title")),
        ("1", F.concat(F.lit("**Generated At:** "), F.date_format(ts_lit(generated_at), "yyyy-MM-dd HH:mm:ss"))),
        ("2", F.concat(F.lit("**Incident ID:** "), display_incident_id(F.col("incident_id")))),
        ("3", F.lit("")), ("4", F.lit("## Status Overview")),
        ("5", F.concat(F.lit("- **Theories:** "), F.col("theories"), F.lit(" active hypotheses"))),
        ("6", F.concat(F.lit("- **Actions Taken:** "), F.col("done"), F.lit(" tasks completed"))),
        ("7", F.concat(F.lit("- **Pending Tasks:** "), F.col("todo"), F.lit(" tasks remaining"))), ("8", F.lit("")),
    ]

    def lines(df: DataFrame, section: int, place, line) -> DataFrame:
        return df.select("incident_id", F.lit(section).alias("section"), place.alias("place"), line.alias("line"))

    def titled(count: str, section: int, title: str) -> list[DataFrame]:
        some = stats.filter(F.col(count) > 0)
        return [lines(some, section, F.lit(""), F.lit(title)), lines(some, section, F.lit("~"), F.lit(""))]

    head = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), c.alias("l")) for p, c in heads])).alias("h")
    parts = [stats.select("incident_id", head).select("incident_id", F.lit(0).alias("section"), F.col("h.p").alias("place"), F.col("h.l").alias("line"))]
    place = F.concat_ws(" ", F.date_format("added_at", "yyyyMMddHHmmssSSSSSS"), "item_id")
    task = items.filter("kind = 'task'")
    parts += titled("theories", 1, "## Active Theories")
    parts.append(lines(items.filter("kind = 'theory'"), 1, place, F.concat(F.lit("- ["), F.upper("likelihood"), F.lit("] "), "text")))
    parts += titled("done", 2, "## Actions Taken (HAVEDONE)")
    finished = F.concat(F.lit("- "), "text", F.lit(" (Completed by: "), F.coalesce("completed_by", F.lit("System")), F.lit(")"))
    parts.append(lines(task.filter("done"), 2, place, finished))
    parts += titled("todo", 3, "## Next Steps (TODO)")
    parts.append(lines(task.filter("NOT done"), 3, place, F.concat(F.lit("- [ ] "), "text")))
    shown = timeline.withColumnRenamed("context_id", "incident_id")
    some = shown.select("incident_id").distinct()
    parts.append(lines(some, 4, F.lit(""), F.lit("## Key Timeline Events")))
    order = F.coalesce(F.col("sort_order").cast("double"), F.unix_millis("timestamp").cast("double"))
    at = F.concat_ws(" ", F.format_string("%020.3f", order), F.date_format("timestamp", "yyyyMMddHHmmssSSSSSS"), "id")
    entry = F.concat(F.lit("- `"), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit("` **"), "actor_id", F.lit("**: "), "message")
    parts.append(lines(shown, 4, at, entry))
    return reduce(lambda a, b: a.unionByName(b), parts)


def incident_reports(lines: DataFrame) -> DataFrame:
    """The report of each incident as one text, from the lines of `incident_markdown`; for incidents of a size that is read."""
    one = F.array_sort(F.collect_list(F.struct("section", "place", "line")))
    return lines.groupBy("incident_id").agg(F.array_join(F.transform(one, lambda x: x["line"]), "\n").alias("report"))
