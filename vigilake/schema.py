"""Table shapes, defaults and the fixed values every operator shares."""

from __future__ import annotations

from pyspark.sql import types as T

RETENTION_DAYS = 425
MAX_LOOKBACK_MINUTES = 612_000  # RETENTION_DAYS in minutes
DEFAULT_LOOKBACK_MINUTES = 5
DEFAULT_QUERY_MINUTES = 60
DEFAULT_QUERY_LIMIT = 100
MAX_QUERY_LIMIT = 1_000

# The shell of every event, in table order, with the defaults for what a message lacks.
SHELL_STRING_DEFAULTS = {
    "eventid": "",
    "severity": "INFO",
    "summary": "UNKNOWN",
    "category": "UNKNOWN",
    "source": "UNKNOWN",
}
SHELL_FIELDS = (
    "utctimestamp", "eventid", "severity", "summary", "category", "source", "tags", "plugins", "details",
)
TOP_LEVEL_STRING_FIELDS = ("source", "category", "severity", "summary", "eventid")

# Paths below `details` that the writers also store as real columns. Views, rules and hunts read the
# column when it is there (pruned, pushed down) and the VARIANT only when it is not.
LIFTED = {
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
    "events[0].name": "workspace_event",
    "policy_member": "policy_member",
    "policy_delta": "policy_delta",
}
LIFTED_ARRAYS = {"policy_members": "policy_members", "policy_roles": "policy_roles"}

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("utctimestamp", T.TimestampType()),
        T.StructField("eventid", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("plugins", T.ArrayType(T.StringType())),
        T.StructField("details", T.VariantType()),
    ]
)

# Notification scale. Anything else, WARNING and NOTICE included, ranks 0.
SEVERITY_RANK = {"CRITICAL": 4, "HIGH": 3, "MEDIUM": 2, "LOW": 1, "INFO": 0}
ALERT_STATUS = ("OPEN", "ACKNOWLEDGED", "ESCALATED", "RESOLVED")
ALERT_TYPES = ("threshold", "deadman", "sequence")

# One sampled event inside an alert. `record` is the whole event as JSON text, for templates.
SAMPLE_EVENT = T.StructType(
    [
        T.StructField("utctimestamp", T.TimestampType()),
        T.StructField("eventid", T.StringType()),
        T.StructField("record", T.StringType()),
    ]
)

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("alert_name", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("value", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("new_count", T.LongType()),
        T.StructField("events", T.ArrayType(SAMPLE_EVENT)),
        T.StructField("deadman_hits", T.LongType()),
        T.StructField("last_triggered_at", T.TimestampType()),
    ]
)

# A filled slot of a running sequence.
SLOT_STATE = T.StructType(
    [
        T.StructField("slot_no", T.IntegerType()),
        T.StructField("alert_name", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("summary", T.StringType()),
        T.StructField("first_event", T.StringType()),
        T.StructField("filled_at", T.TimestampType()),
    ]
)

INFLIGHT_SCHEMA = T.StructType(
    [
        T.StructField("inflight_id", T.StringType()),
        T.StructField("alert_name", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("expiration", T.TimestampType()),
        T.StructField("slots", T.ArrayType(SLOT_STATE)),
    ]
)

PROCESSED_SCHEMA = T.StructType(
    [T.StructField("eventid", T.StringType()), T.StructField("processed_at", T.TimestampType())]
)
