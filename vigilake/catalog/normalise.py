"""Raw vendor messages written out of the events table, and their way through normalisation.

The raw documents use the vendors' mixed-case keys and nesting. The SQL states the expected outcome
straight from the table, without any JSON.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vigilake.catalog.base import duck, events, flat
from vigilake.functions import walk as w
from vigilake.functions.jsonfn import jv, jv_array
from vigilake.operators.normalize import Change, Stage, normalize
from vigilake.session import configure, spread
from vigilake.sources.messages import decode_envelope
from vigilake.sources.sample import EVENT_COLUMNS, raw_table

def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


ISO = "date_format(utctimestamp, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"


def _base(spark, sf):
    configure(spark)
    return with_columns(spread(raw_table(spark, sf, "events"), "event_id"))


def with_columns(raw):
    """The events table, batch or stream, with the columns the raw messages are written from."""
    raw = raw.withColumn("utctimestamp", F.col("ts").cast("timestamp"))
    return raw.select("*", *[F.expr(sql).alias(n) for n, sql in EVENT_COLUMNS.items()])


def _obj(**fields: str):
    """A struct of SQL expressions; names keep their case, NULL members vanish in `to_json`."""
    return F.struct(*[(v if not isinstance(v, str) else F.expr(v)).alias(k) for k, v in fields.items()])


def cloudtrail_raw(spark, sf):
    b = _base(spark, sf).filter("source = 'cloudtrail'")
    identity = _obj(
        type="CASE user_id % 4 WHEN 0 THEN 'Root' WHEN 1 THEN 'IAMUser' ELSE 'AssumedRole' END",
        userName="CASE WHEN user_id % 4 = 1 THEN 'name' || user_id END",
        principalId="CASE WHEN user_id % 4 = 2 THEN 'ID:session:' || user_id ELSE 'ID' END",
        arn="'arn:aws:iam::1:user/u' || user_id",
    )
    details = _obj(
        eventName="eventname", eventSource="eventsource", sourceIPAddress="source_ip", EventTime=ISO,
        awsRegion="CASE WHEN event_id % 2 = 0 THEN 'us-east-' || (user_id % 3) END",
        readOnly="event_type = 'view'", managementEvent="event_id % 4 = 0",
        errorCode="CASE WHEN event_id % 10 = 0 THEN 'AccessDenied' END",
    ).withField("userIdentity", identity).withField(
        "responseElements", _obj(ConsoleLogin="CASE WHEN event_type = 'click' THEN CASE WHEN value > 50 THEN 'Failure' ELSE 'Success' END END")
    ).withField("additionalEventData", _obj(MFAUsed="CASE WHEN event_type = 'click' THEN CASE WHEN user_id % 2 = 0 THEN 'No' ELSE 'Yes' END END"))
    body = _obj(Source="'cloudtrail'", EventID="eventid", Tags=F.array(F.lit("raw"))).withField("Details", details)
    return b.select(F.to_json(body).alias("value"))


def _cloudtrail(spark, sf):
    out = normalize(cloudtrail_raw(spark, sf), now=now())
    d = F.col("details")
    return flat(
        out.select(
            "eventid", "utctimestamp", "category", "severity", "summary", "tags", "plugins",
            jv(d, "_errorcode").alias("errorcode"), jv(d, "_mfa_used").alias("mfa"), jv(d, "_login_result").alias("login"),
            jv(d, "sourceipaddress").alias("ip"), jv_array(d, "_ipaddresses").alias("ips"),
        )
    )


_PLUGINS = "'normalization_lowercase_keys,normalization_event_shell,{}normalization_ip_addresses,normalization_timestamps,enrichment_ensure_eventid'"

CLOUDTRAIL_SQL = """c AS (SELECT *, replace(eventsource, '.amazonaws.com', '') AS service,
  CASE user_id % 4 WHEN 0 THEN 'root' WHEN 1 THEN 'name' || user_id WHEN 2 THEN 'session:' || user_id ELSE 'user/u' || user_id END AS who,
  event_type = 'click' AND value > 50 AS bad_login FROM ev WHERE source = 'cloudtrail')
---
SELECT eventid, utctimestamp,
  CASE service WHEN 'iam' THEN 'iam' WHEN 'signin' THEN 'authentication' WHEN 'ec2' THEN 'compute' ELSE 'storage' END AS category,
  CASE WHEN event_id % 10 = 0 OR eventname = 'DeleteBucket' OR user_id % 4 = 0 OR bad_login THEN 'WARNING' ELSE 'INFO' END AS severity,
  concat_ws(' ', who, eventname, 'from ' || source_ip, CASE WHEN event_id % 2 = 0 THEN 'in us-east-' || (user_id % 3) END) AS summary,
  concat_ws(',', 'raw,cloudtrail,aws', CASE WHEN event_type = 'view' THEN 'read' ELSE 'write' END,
    CASE WHEN event_id % 4 = 0 THEN 'management' END, service, CASE WHEN event_id % 10 = 0 THEN 'error' END,
    CASE WHEN user_id % 4 = 0 THEN 'root' END,
    CASE WHEN bad_login THEN 'login-failure' WHEN event_type = 'click' THEN 'login-success' END,
    CASE WHEN event_type = 'click' AND user_id % 2 = 0 THEN 'no-mfa' END) AS tags,
  """ + _PLUGINS.format("normalization_cloudtrail,") + """ AS plugins,
  CASE WHEN event_id % 10 = 0 THEN 'AccessDenied' END AS errorcode,
  CASE WHEN event_type = 'click' THEN CASE WHEN user_id % 2 = 0 THEN 'false' ELSE 'true' END END AS mfa,
  CASE WHEN bad_login THEN 'Failure' WHEN event_type = 'click' THEN 'Success' END AS login, source_ip AS ip, source_ip AS ips
FROM c"""


def gcp_raw(spark, sf, **extra):
    b = _base(spark, sf).filter("source = 'gcp_audit'")
    delta = F.expr(
        "CASE WHEN members_csv IS NULL THEN NULL WHEN event_id % 4 < 2 THEN "
        "array(named_struct('action', 'ADD', 'role', roles_csv, 'member', members_csv)) ELSE "
        "array(named_struct('action', 'ADD', 'role', split(roles_csv, ',')[0], 'member', split(members_csv, ',')[0]), "
        "named_struct('action', 'REMOVE', 'role', split(roles_csv, ',')[1], 'member', split(members_csv, ',')[1])) END"
    )
    payload = _obj(
        serviceName="servicename", methodName="methodname", resourceName="resourcename",
        authenticationInfo=_obj(principalEmail="identity"),
        requestMetadata=_obj(callerIp="source_ip", callerSuppliedUserAgent="user_agent"),
        status=_obj(code="CASE WHEN event_id % 10 = 0 THEN 7 WHEN event_id % 10 = 1 THEN 0 END"),
        authorizationInfo=F.array(_obj(granted="event_id % 14 <> 0")),
        serviceData=F.struct(F.struct(delta.alias("bindingDeltas")).alias("policyDelta")),
        **extra,
    ).withField("`@type`", F.lit("type.googleapis.com/google.cloud.audit.AuditLog"))
    body = _obj(
        logName="CASE WHEN event_id % 5 = 4 THEN 'projects/x/logs/cloudaudit.googleapis.com%2Fsystem_event' "
        "WHEN event_type = 'view' THEN 'projects/x/logs/cloudaudit.googleapis.com%2Fdata_access' "
        "ELSE 'projects/x/logs/cloudaudit.googleapis.com%2Factivity' END",
        severity="CASE WHEN event_id % 6 = 0 THEN 'ALERT' ELSE 'NOTICE' END", eventId="eventid", timestamp=ISO,
        resource=_obj(labels=_obj(project_id="project")), protoPayload=payload,
    )
    return b.select(F.to_json(body).alias("value"))


def _gcp(spark, sf):
    d = F.col("details")
    return flat(
        normalize(gcp_raw(spark, sf), now=now()).select(
            "eventid", "utctimestamp", "category", "severity", "summary", "tags", "plugins",
            *[jv(d, k).alias(k) for k in ("user", "audit_log_type", "sourceipaddress", "useragent", "project", "policy_member", "policy_delta", "policy_delta_count")],
            jv_array(d, "policy_members").alias("policy_members"), jv_array(d, "policy_roles").alias("policy_roles"),
        )
    )


GCP_SQL = """c AS (SELECT *, event_id % 4 >= 2 AND members_csv IS NOT NULL AS two, event_id % 14 = 0 AS denied, event_id % 10 = 0 AS err,
  CASE WHEN event_id % 5 = 4 THEN 'system_event' WHEN event_type = 'view' THEN 'data_access' ELSE 'activity' END AS stream,
  CASE WHEN members_csv IS NULL THEN NULL WHEN event_id % 4 < 2 THEN 'ADD ' || roles_csv || ' ' || members_csv
    ELSE 'ADD ' || split_part(roles_csv, ',', 1) || ' ' || split_part(members_csv, ',', 1) || '; REMOVE '
      || split_part(roles_csv, ',', 2) || ' ' || split_part(members_csv, ',', 2) END AS delta
  FROM ev WHERE source = 'gcp_audit')
---
SELECT eventid, utctimestamp,
  CASE event_type WHEN 'error' THEN 'storage' ELSE 'iam' END AS category,
  CASE WHEN denied OR err THEN 'WARNING' WHEN event_id % 6 = 0 THEN 'CRITICAL' WHEN event_type = 'error' THEN 'WARNING' ELSE 'INFO' END AS severity,
  concat_ws(' ', coalesce(identity, 'unknown'), methodname, resourcename, '(' || delta || ')', 'from IP ' || source_ip) AS summary,
  concat_ws(',', 'gcp_audit,gcp', 'gcp_audit_' || stream, CASE WHEN identity LIKE '%gserviceaccount.com' THEN 'service-account' END,
    CASE WHEN event_type = 'purchase' THEN 'iam-policy-change' END, CASE WHEN two THEN 'multi-binding-change' END,
    CASE WHEN denied THEN 'denied' WHEN err THEN 'error' END) AS tags,
  CASE WHEN stream = 'data_access' THEN
  """ + _PLUGINS.format("normalization_gcp_audit,").replace("normalization_timestamps,", "normalization_timestamps,normalization_drop_self_telemetry,") + """
  ELSE """ + _PLUGINS.format("normalization_gcp_audit,") + """ END AS plugins,
  identity AS "user", stream AS audit_log_type, source_ip AS sourceipaddress, user_agent AS useragent, project,
  split_part(members_csv, ',', 1) AS policy_member, delta AS policy_delta, CASE WHEN two THEN '2' END AS policy_delta_count,
  members_csv AS policy_members, roles_csv AS policy_roles
FROM c"""


def workspace_raw(spark, sf):
    b = _base(spark, sf).filter("source = 'google_workspace'")
    named = lambda n, v: _obj(name=f"'{n}'", value=v)
    params = F.array_compact(F.array(
        F.when(F.expr("event_type IN ('signup', 'click')"), named("Event_Title", "'title ' || user_id")),
        F.when(F.expr("event_type = 'purchase'"), named("app_name", "'app' || user_id")),
        F.when(F.expr("event_type = 'view'"), named("device_type", "'phone'")),
        named("other", "'x'"),
    ))
    flag = F.when(F.expr("event_id % 13 = 0"), F.array(_obj(name="'is_suspicious'", boolValue="true")))
    body = _obj(
        kind="'admin#reports#activity'", etag="'t'", eventId="eventid", ipAddress="source_ip",
        id=_obj(time=ISO, applicationName="CASE event_type WHEN 'signup' THEN 'calendar' WHEN 'click' THEN 'login' "
                "WHEN 'purchase' THEN 'token' WHEN 'view' THEN 'mobile' END"),
        actor=_obj(email="identity"),
        events=F.array(_obj(name="workspace_event", parameters=params)),
        extra=_obj(flags=flag),
    )
    return b.select(F.to_json(body).alias("value"))


def _workspace(spark, sf):
    d = F.col("details")
    return flat(
        normalize(workspace_raw(spark, sf), now=now()).select(
            "eventid", "utctimestamp", "source", "category", "severity", "summary", "tags",
            jv(d, "user").alias("user"), jv(d, "extra_info").alias("extra"), jv(d, "success").alias("success"),
            jv(d, "sourceipaddress").alias("ip"), jv(d, "ipaddress").alias("old_ip"),
        )
    )


WORKSPACE_SQL = """c AS (SELECT *, CASE event_type WHEN 'signup' THEN 'title ' || user_id WHEN 'purchase' THEN 'app' || user_id
  WHEN 'view' THEN 'phone' END AS extra FROM ev WHERE source = 'google_workspace')
---
SELECT eventid, utctimestamp, source, 'INFO' AS severity,
  CASE event_type WHEN 'signup' THEN 'calendar' WHEN 'click' THEN 'login' WHEN 'purchase' THEN 'token'
    WHEN 'view' THEN 'mobile' ELSE 'google_workspace' END AS category,
  coalesce(identity, '') || ' ' || workspace_event || coalesce(' (' || extra || ')', '') || coalesce(' from IP ' || source_ip, '') AS summary,
  'google_workspace' AS tags, identity AS "user", extra,
  CASE workspace_event WHEN 'login_success' THEN 'true' WHEN 'login_failure' THEN 'false' END AS success,
  source_ip AS ip, CAST(NULL AS VARCHAR) AS old_ip FROM c"""


def generic_raw(spark, sf):
    return generic_messages(_base(spark, sf))


def generic_messages(b):
    """Events of no known vendor, with addresses and times under many names and depths."""
    body = _obj(
        eventId="eventid", Category="event_type",
        SrcAddr="CASE WHEN event_id % 4 = 0 THEN 'nada' WHEN event_id % 4 = 1 THEN source_ip END",
        wrap=F.array(_obj(deep=_obj(
            **{"C-IP": "CASE WHEN event_id % 4 IN (0, 2) THEN '192.168.0.' || (user_id % 200) END",
               "x-forwarded-for": "CASE WHEN event_id % 4 = 3 THEN '172.16.0.' || (user_id % 200) || ', 10.9.9.9' END"},
            dest_ip="CASE WHEN event_id % 3 = 0 THEN '2001:db8::' || (user_id % 10) WHEN event_id % 3 = 1 THEN '900.1.2.3.4' END",
        ))),
        when=_obj(
            **{"Time": "CASE WHEN event_id % 2 = 0 THEN date_format(utctimestamp, 'HH:mm:ss') END",
               "Date": "CASE WHEN event_id % 2 = 0 THEN date_format(utctimestamp, 'yyyy-MM-dd') END"},
            Start="CASE WHEN event_id % 2 = 1 THEN unix_millis(utctimestamp) END",
            timestamp="CASE WHEN event_id % 6 = 0 THEN 'nada' END",
        ),
    )
    return b.select(F.to_json(body).alias("value"))


def _generic(spark, sf):
    d = F.col("details")
    return flat(
        normalize(generic_raw(spark, sf), now=now()).select(
            "eventid", "utctimestamp", "source", "category", "severity", "summary",
            jv(d, "sourceipaddress").alias("src"), jv(d, "destinationipaddress").alias("dst"),
            jv_array(d, "_ipaddresses").alias("ips"), jv(d, "_utcprocessedtimestamp").alias("processed"),
        )
    )


GENERIC_SQL = """c AS (SELECT *, CASE event_id % 4 WHEN 1 THEN source_ip WHEN 3 THEN '172.16.0.' || (user_id % 200)
    ELSE '192.168.0.' || (user_id % 200) END AS src,
  CASE WHEN event_id % 3 = 0 THEN '2001:db8::' || (user_id % 10) END AS dst FROM ev)
---
SELECT eventid, CASE WHEN event_id % 2 = 0 THEN date_trunc('second', utctimestamp) ELSE date_trunc('millisecond', utctimestamp) END AS utctimestamp,
  'UNKNOWN' AS source, event_type AS category, 'INFO' AS severity, 'UNKNOWN' AS summary, src, dst,
  CASE WHEN src IS NULL AND dst IS NULL THEN NULL ELSE concat_ws(',', src, dst) END AS ips,
  '2024-02-01T00:00:00.000000Z' AS processed FROM c"""


def _selfnoise(spark, sf):
    """Data access of the platform itself: queries are dropped, writes and strangers kept."""
    b = _base(spark, sf)
    request = _obj(
        writes="CASE WHEN event_type = 'purchase' THEN array(named_struct('update', named_struct('name', "
        "'projects/p/databases/d/documents/' || CASE WHEN event_id % 2 = 0 THEN 'rules' ELSE 'alerts' END || '/x'))) END",
        structuredQuery="CASE WHEN event_type = 'click' THEN named_struct('from', array(named_struct('collectionId', 'alerts'))) END",
    )
    payload = _obj(
        serviceName="CASE WHEN event_type IN ('signup', 'view') THEN 'bigquery.googleapis.com' WHEN event_type = 'error' "
        "THEN 'iamcredentials.googleapis.com' ELSE 'firestore.googleapis.com' END",
        methodName="CASE WHEN event_type = 'purchase' THEN 'google.firestore.v1.Firestore.Commit' ELSE 'x.Query' END",
        authenticationInfo=_obj(principalEmail="CASE WHEN event_id % 4 = 0 THEN 'someone@example.com' WHEN event_id % 4 = 1 "
                                "THEN 'web@firebase-rules.iam.gserviceaccount.com' ELSE 'worker@lake.iam.gserviceaccount.com' END"),
        metadata=_obj(jobInsertion=_obj(job=_obj(statementType="CASE WHEN event_type = 'signup' THEN CASE WHEN user_id % 2 = 0 "
                                                 "THEN 'select' ELSE 'export' END END"))),
        request=request,
    )
    body = _obj(
        logName="CASE WHEN event_id % 7 = 0 THEN 'logs/cloudaudit.googleapis.com%2Factivity' ELSE 'logs/cloudaudit.googleapis.com%2Fdata_access' END",
        eventId="eventid", protoPayload=payload,
    )
    out = normalize(b.select(F.to_json(body).alias("value")), now=now(), project="lake", keep_dropped=True)
    return out.select("eventid", "dropped")


SELFNOISE_SQL = """SELECT eventid, event_id % 7 <> 0 AND CASE
  WHEN event_type = 'error' THEN false
  WHEN event_type = 'view' THEN event_id % 4 >= 2
  WHEN event_type = 'signup' THEN event_id % 4 >= 2 AND user_id % 2 = 0
  WHEN event_type = 'click' THEN event_id % 4 >= 1
  ELSE event_id % 4 >= 1 AND event_id % 2 = 1 END AS dropped FROM ev"""


def _envelopes(spark, sf):
    b = _base(spark, sf)
    body = F.to_json(_obj(eventId="eventid", source="source"))
    text = F.expr("CASE event_id % 5 WHEN 0 THEN 'plain line ' || event_id WHEN 1 THEN '[1, 2]' ELSE NULL END")
    data = F.base64(F.coalesce(text, body).cast("binary"))
    value = F.when(F.expr("event_id % 5 = 2"), F.lit('{"nothing": 1}')).when(
        F.expr("event_id % 5 = 3"), F.lit('{"message": {"id": 1}}')
    ).otherwise(F.to_json(F.struct(F.struct(data.alias("data")).alias("message"))))
    out = decode_envelope(b.select("eventid", "source", value.alias("value")))
    doc = F.try_parse_json("text")
    return out.select("eventid", "problem", jv(doc, "raw_log").alias("raw_log"), jv(doc, "source").alias("doc_source"))


def _keys(spark, sf):
    raw = gcp_raw(spark, sf)
    seen = raw.select(w.unfold(F.col("value"), ["principalemail", "granted"]).alias("u"))
    doc = F.try_parse_json("u.doc")
    first = F.try_element_at(F.col("u.found"), F.lit(1))
    return seen.select(
        jv(doc, "eventid").alias("eventid"), jv(doc, "protopayload.methodname").alias("method"),
        F.array_contains("u.keys", "callersupplieduseragent").alias("has_agent"),
        F.array_join(F.transform("u.found", lambda x: F.concat_ws("=", x["key"], x["value"])), ",").alias("found"),
    )


def _blocks(spark, sf):
    """Ten documents to a blob, cut apart again."""
    b = _base(spark, sf)
    one = F.to_json(_obj(id="event_id", nested=_obj(kind="event_type")))
    blobs = b.groupBy(F.floor(F.col("event_id") / 10).alias("blob")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", one.alias("t")))), lambda x: x["t"]), "\n").alias("text")
    )
    parts = w.split_json_blocks(blobs, "text")
    doc = F.try_parse_json("block")
    return parts.select(jv(doc, "id").try_cast("bigint").alias("event_id"), jv(doc, "nested.kind").alias("kind"), "blob")


def _user_stage(spark, sf):
    """A stage of the user's own, gated on a key, running after the built-in ones."""
    mark = Stage("mark_errors", ("errorcode",), lambda df: Change(
        guard=F.array_contains("tags", "error"), tags=[F.lit("reviewed")], details={"marked": F.lit(True).cast("variant")}), 40)
    out = normalize(cloudtrail_raw(spark, sf), now=now(), extra_stages=[mark])
    return out.select("eventid", F.array_contains("tags", "reviewed").alias("reviewed"),
                      jv(F.col("details"), "marked").alias("marked"),
                      F.array_contains("plugins", "normalization_mark_errors").alias("ran"))


QUERIES = {
    "normalize_cloudtrail": (_cloudtrail, duck(CLOUDTRAIL_SQL)),
    "normalize_gcp_audit": (_gcp, duck(GCP_SQL)),
    "normalize_workspace": (_workspace, duck(WORKSPACE_SQL)),
    "normalize_generic": (_generic, duck(GENERIC_SQL)),
    "drop_self_telemetry": (_selfnoise, duck(SELFNOISE_SQL)),
    "decode_envelope": (
        _envelopes,
        duck("""SELECT eventid, CASE event_id % 5 WHEN 1 THEN 'not a JSON object' WHEN 2 THEN 'invalid envelope' END AS problem,
  CASE event_id % 5 WHEN 0 THEN 'plain line ' || event_id WHEN 3 THEN 'No data in Pub/Sub message' END AS raw_log,
  CASE WHEN event_id % 5 = 4 THEN source END AS doc_source FROM ev"""),
    ),
    "walk_keys": (
        _keys,
        duck("""SELECT eventid, methodname AS method, user_agent IS NOT NULL AS has_agent,
  concat_ws(',', CASE WHEN identity IS NOT NULL THEN 'principalemail=' || identity END,
    'granted=' || CASE WHEN event_id % 14 = 0 THEN 'false' ELSE 'true' END) AS found FROM ev WHERE source = 'gcp_audit'"""),
    ),
    "split_json_blocks": (
        _blocks,
        "SELECT event_id, event_type AS kind, CAST(event_id // 10 AS BIGINT) AS blob FROM events",
    ),
    "user_stage": (
        _user_stage,
        duck("""SELECT eventid, event_id % 10 = 0 AS reviewed, CASE WHEN event_id % 10 = 0 THEN 'true' END AS marked,
  event_id % 10 = 0 AS ran FROM ev WHERE source = 'cloudtrail'"""),
    ),
}
