"""Labelled datasets and the scoring of hunt reports against them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.sources.tables import scan_window, within

REPORT_SCHEMA = (  # as text: usable before a session exists
    "verdict string, summary string, findings array<struct<title: string, confidence: string, "
    "entities: array<string>, narrative: string, evidence_eventids: array<string>, why_not_benign: string>>"
)
VERDICTS = ("nothing_of_concern", "findings")
CONFIDENCE = ("high", "medium", "low")
LITTLE_BACKGROUND = 50


def label_of(identity: Column, canary: str, operators: Sequence[str]) -> Column:
    """attack, operator or benign by the acting identity."""
    benign = F.lit("benign")
    operator = F.when(identity.isin(*operators), F.lit("operator")).otherwise(benign) if operators else benign
    return F.when(identity == canary, F.lit("attack")).otherwise(operator)


def label_events(identity_events: DataFrame, canary: str, operators: Sequence[str], since=None, until=None) -> DataFrame:
    rows = within(identity_events, since, until) if since else identity_events
    return rows.withColumn("label", label_of(F.col("identity"), canary, operators))


def manifest_counts(labelled: DataFrame) -> DataFrame:
    """Totals per label, distinct identities and the sources of a labelled window, as one row."""
    combos = labelled.groupBy("identity", "source", "label").agg(F.count(F.lit(1)).alias("n"))
    of = lambda l: F.coalesce(F.sum(F.when(F.col("label") == l, F.col("n"))), F.lit(0)).cast("long")
    return combos.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"),
        of("attack").alias("attack"), of("operator").alias("operator"), of("benign").alias("benign"),
        F.count_distinct("identity").alias("distinct_identities"),
        F.array_sort(F.collect_set("source")).alias("sources"),
    )


class EmptyFixture(ValueError):
    pass


def labelled_window_guard(counts: dict) -> list[str]:
    """Refuse a window without events or without attack events; warn when there is little background."""
    if not counts["total"]:
        raise EmptyFixture("no events in the window")
    if not counts["attack"]:
        raise EmptyFixture("no event of the window belongs to the canary identity")
    if counts["benign"] < LITTLE_BACKGROUND:
        return [f"only {counts['benign']} benign events: precision is hardly measured"]
    return []


def export_fixture(
    identity_events: DataFrame, path: str, name: str, canary: str, operators: Sequence[str],
    since: datetime | str, until: datetime | str, techniques: Sequence[str], untested: Sequence[str] = (),
    notes: str = "",
) -> dict:
    """Write a labelled, replayable dataset: events, ground truth (one row per labelled event), manifest.

    Events and labels are written by the executors; only the counts come to the driver.
    """
    labelled = label_events(identity_events, canary, operators, since, until)
    counts = manifest_counts(labelled).first().asDict()
    warnings = labelled_window_guard(counts)
    spark = identity_events.sparkSession
    ordered = scan_window(identity_events, since, until)
    ordered.withColumn("details", F.to_json("details")).write.json(f"{path}/events")
    truth = labelled.filter(F.col("label") != "benign").select("eventid", "identity", "label")
    truth.write.json(f"{path}/ground_truth")
    manifest = {
        "name": name, "exported_at": datetime.now(timezone.utc).isoformat(), "window": {"since": str(since), "until": str(until)},
        "canary_identity": canary, "operator_identities": list(operators), "techniques": list(techniques),
        "untested_techniques": list(untested), "counts": counts, "notes": notes, "warnings": warnings,
    }
    import json

    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{path}/manifest")
    return manifest


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Hunt reports (one JSON document per file) with `problems`; the empty list means acceptable."""
    return report_problems(spark.read.schema(REPORT_SCHEMA).option("multiLine", "true").json(path))


def report_problems(reports: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.length(F.trim(c)), F.lit(0)) == 0
    bad = lambda test: F.coalesce(F.exists("findings", test), F.lit(False))
    checks = {
        "verdict": ~F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False)),
        "summary": blank(F.col("summary")),
        "confidence": bad(lambda f: ~F.coalesce(f["confidence"].isin(*CONFIDENCE), F.lit(False))),
        "title": bad(lambda f: blank(f["title"])),
        "evidence": bad(lambda f: F.coalesce(F.size(f["evidence_eventids"]), F.lit(0)) == 0),
        "why_not_benign": bad(lambda f: blank(f["why_not_benign"])),
    }
    return reports.withColumn("problems", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()])))


def score_citations(cited: DataFrame, labelled: DataFrame) -> DataFrame:
    """Each distinct cited id of each report in exactly one bucket.

    `cited(report_id, eventid)`, `labelled(eventid, label)`: hallucinated when no such event exists, else
    true_positive, dont_care_operator or false_positive.
    """
    known = labelled.groupBy("eventid").agg(F.min("label").alias("label"))
    joined = cited.select("report_id", "eventid").distinct().join(known, "eventid", "left")
    bucket = (
        F.when(F.col("label").isNull(), "hallucinated")
        .when(F.col("label") == "attack", "true_positive")
        .when(F.col("label") == "operator", "dont_care_operator")
        .otherwise("false_positive")
    )
    return joined.select("report_id", "eventid", bucket.alias("bucket"))


def score_summary(reports: DataFrame, scored: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row per report: buckets, citation recall, coherence of the verdict, pass.

    `reports(report_id, verdict, n_findings)`.
    """
    n = lambda b: F.coalesce(F.col(b), F.lit(0)).alias(b)
    names = ("hallucinated", "true_positive", "dont_care_operator", "false_positive")
    per = scored.groupBy("report_id").agg(
        F.count(F.lit(1)).alias("cited_total"), *[F.count_if(F.col("bucket") == b).alias(b) for b in names]
    )
    total = labelled.agg(F.count_if(F.col("label") == "attack").alias("attack_total"))
    # the total is one row: a scalar subquery, no product
    out = reports.join(per, "report_id", "left").withColumn("attack_total", total.scalar())
    out = out.select("report_id", "verdict", "n_findings", "attack_total", F.coalesce("cited_total", F.lit(0)).alias("cited_total"), *[n(b) for b in names])
    coherent = ((F.col("verdict") == "findings") & (F.col("n_findings") > 0)) | (
        (F.col("verdict") == "nothing_of_concern") & (F.col("n_findings") == 0)
    )
    return out.withColumn("verdict_coherent", coherent).withColumn(
        "citation_recall", F.when(F.col("attack_total") > 0, F.round(F.col("true_positive") / F.col("attack_total"), 6))
    ).withColumn(
        "passed",
        (F.col("hallucinated") == 0) & (F.col("true_positive") > 0) & (F.col("false_positive") == 0) & F.col("verdict_coherent"),
    )
