"""The test tables seen as canonical security events.

`EVENT_COLUMNS` is plain SQL both Spark and DuckDB read the same way, so a query and its check start
from one definition. Only the array and JSON columns are spelled per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.session import spread

AS_OF = "2024-01-31 00:00:00"

EVENT_COLUMNS = {
    "eventid": "'e' || event_id",
    "severity": "CASE WHEN event_type <> 'error' THEN 'INFO' WHEN value > 60 THEN 'CRITICAL' ELSE 'WARNING' END",
    "summary": "'actor ' || user_id || ' ' || event_type",
    "category": "event_type",
    "source": "CASE event_id % 3 WHEN 0 THEN 'gcp_audit' WHEN 1 THEN 'google_workspace' ELSE 'cloudtrail' END",
    "identity": (
        "CASE WHEN event_id % 11 = 0 THEN NULL "
        "WHEN user_id % 10 = 3 THEN 'svc' || user_id || '@proj.iam.gserviceaccount.com' "
        "ELSE 'user' || user_id || '@example.com' END"
    ),
    "source_ip": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE '10.0.' || (user_id % 8) || '.' || (event_id % 5) END",
    "user_agent": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'agent/' || (user_id % 4) END",
    "audit_log_type": (
        "CASE WHEN event_id % 3 <> 0 THEN NULL WHEN event_type = 'view' THEN 'data_access' ELSE 'activity' END"
    ),
    "methodname": (
        "CASE WHEN event_id % 3 <> 0 THEN NULL ELSE CASE event_type "
        "WHEN 'signup' THEN 'google.iam.admin.v1.CreateServiceAccount' "
        "WHEN 'purchase' THEN 'SetIamPolicy' "
        "WHEN 'click' THEN 'google.iam.admin.v1.CreateServiceAccountKey' "
        "WHEN 'view' THEN 'GenerateAccessToken' ELSE 'storage.buckets.delete' END END"
    ),
    "eventname": (
        "CASE WHEN event_id % 3 <> 2 THEN NULL ELSE CASE event_type "
        "WHEN 'signup' THEN 'CreateUser' WHEN 'purchase' THEN 'PutObject' WHEN 'click' THEN 'ConsoleLogin' "
        "WHEN 'view' THEN 'DescribeInstances' ELSE 'DeleteBucket' END END"
    ),
    "servicename": (
        "CASE WHEN event_id % 3 <> 0 THEN NULL ELSE CASE event_type "
        "WHEN 'purchase' THEN 'cloudresourcemanager.googleapis.com' "
        "WHEN 'view' THEN 'iamcredentials.googleapis.com' "
        "WHEN 'error' THEN 'storage.googleapis.com' ELSE 'iam.googleapis.com' END END"
    ),
    "eventsource": (
        "CASE WHEN event_id % 3 <> 2 THEN NULL ELSE CASE event_type "
        "WHEN 'signup' THEN 'iam.amazonaws.com' WHEN 'click' THEN 'signin.amazonaws.com' "
        "WHEN 'view' THEN 'ec2.amazonaws.com' ELSE 's3.amazonaws.com' END END"
    ),
    "resourcename": (
        "CASE WHEN event_id % 3 <> 0 THEN NULL "
        "WHEN event_type IN ('signup', 'view', 'click') "
        "THEN 'projects/p/serviceAccounts/sa' || (user_id % 20) || '@p.iam.gserviceaccount.com' "
        "ELSE 'projects/proj-' || (user_id % 5) END"
    ),
    "project": "CASE WHEN event_id % 3 = 1 THEN NULL ELSE 'proj-' || (user_id % 5) END",
    "workspace_event": (
        "CASE WHEN event_id % 3 <> 1 THEN NULL ELSE CASE event_type "
        "WHEN 'signup' THEN 'CREATE_USER' WHEN 'purchase' THEN 'ASSIGN_ROLE' WHEN 'click' THEN 'login_success' "
        "WHEN 'view' THEN 'view' ELSE 'login_failure' END END"
    ),
    "members_csv": (
        "CASE WHEN event_id % 3 <> 0 OR event_type <> 'purchase' THEN NULL "
        "WHEN event_id % 4 = 0 THEN 'user:ext' || user_id || '@other.org' "
        "WHEN event_id % 4 = 1 THEN 'user:user' || user_id || '@example.com' "
        "ELSE 'serviceAccount:sa' || (user_id % 20) || '@p.iam.gserviceaccount.com,user:ext' "
        "|| (user_id % 7) || '@other.org' END"
    ),
    "roles_csv": (
        "CASE WHEN event_id % 3 <> 0 OR event_type <> 'purchase' THEN NULL "
        "WHEN event_id % 4 = 0 THEN 'roles/owner' WHEN event_id % 4 = 1 THEN 'roles/viewer' "
        "ELSE 'roles/viewer,roles/iam.serviceAccountTokenCreator' END"
    ),
    "tags_csv": (
        "CASE WHEN event_id % 3 = 0 AND event_type = 'purchase' THEN 'gcp_audit,iam-policy-change' "
        "WHEN event_id % 3 = 0 THEN 'gcp_audit,gcp' "
        "WHEN event_id % 3 = 1 THEN 'google_workspace' "
        "WHEN event_type = 'click' THEN 'cloudtrail,aws,login' ELSE 'cloudtrail,aws' END"
    ),
}

_DETAIL_KEYS = {
    "user": "identity",
    "sourceipaddress": "source_ip",
    "useragent": "user_agent",
    "audit_log_type": "audit_log_type",
    "methodname": "methodname",
    "eventname": "eventname",
    "servicename": "servicename",
    "eventsource": "eventsource",
    "resourcename": "resourcename",
    "project": "project",
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sec_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `events` table as canonical events, lifted columns included.

    `details` is built like a writer would have stored it; column pruning drops its cost from every
    query that only needs lifted columns.
    """
    return canonical(spread(raw_table(spark, sf_dir, "events"), "event_id"))


def canonical(raw: DataFrame) -> DataFrame:
    """Rows of the `events` table, batch or stream, in canonical shape."""
    cols = {name: F.expr(sql) for name, sql in EVENT_COLUMNS.items()}
    base = raw.select(
        F.col("ts").cast("timestamp").alias("utctimestamp"),
        F.to_date("ts").alias("event_date"),
        *[c.alias(n) for n, c in cols.items()],
        "event_id",
        "user_id",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    members, roles = F.split("members_csv", ","), F.split("roles_csv", ",")
    details = F.struct(
        *[F.col(col).alias(key) for key, col in _DETAIL_KEYS.items()],
        F.col("k").alias("k"),
        F.col("value").alias("risk_score"),
        members.alias("policy_members"),
        roles.alias("policy_roles"),
        F.element_at(members, 1).alias("policy_member"),
        F.col("roles_csv").alias("policy_delta"),
        F.when(
            F.col("workspace_event").isNotNull(),
            F.array(F.struct(F.col("workspace_event").alias("name"))),
        ).alias("events"),
        F.struct(F.struct(F.col("user_id").alias("id")).alias("c-ip")).alias("nested"),
    )
    return base.select(
        "utctimestamp", "eventid", "severity", "summary", "category", "source",
        F.split("tags_csv", ",").alias("tags"),
        F.array(F.concat(F.lit("normalization_"), F.col("source"))).alias("plugins"),
        F.parse_json(F.to_json(details)).alias("details"),
        "event_date",
        *_DETAIL_KEYS.values(),
        "workspace_event",
        F.element_at(members, 1).alias("policy_member"),
        F.col("roles_csv").alias("policy_delta"),
        members.alias("policy_members"),
        roles.alias("policy_roles"),
    )


def duck_events(extra: str = "") -> str:
    """The same events as the body of a DuckDB CTE."""
    cols = ",\n  ".join(f"{sql} AS {name}" for name, sql in EVENT_COLUMNS.items())
    return (
        f"SELECT ts AS utctimestamp, CAST(ts AS DATE) AS event_date, {cols},\n"
        "  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_id, user_id, value, event_type,\n"
        "  string_split(CASE WHEN event_id % 3 = 0 AND event_type = 'purchase' THEN 'gcp_audit,iam-policy-change' "
        "WHEN event_id % 3 = 0 THEN 'gcp_audit,gcp' WHEN event_id % 3 = 1 THEN 'google_workspace' "
        "WHEN event_type = 'click' THEN 'cloudtrail,aws,login' ELSE 'cloudtrail,aws' END, ',') AS tags\n"
        f"{extra} FROM events"
    )
