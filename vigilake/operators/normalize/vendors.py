"""Stages for the vendor formats: AWS CloudTrail, GCP audit logs, Google Workspace activity.

Event times are left to the timestamps stage: it reads the same fields and has the last word anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions.jsonfn import jtext
from vigilake.operators.normalize.stage import (
    Change, Stage, as_variant, dbool, dlist, dtext, dvariant, entry, is_object, list_variant, nonempty,
)

# Service names to categories.
AWS_CATEGORIES = {
    "signin.amazonaws.com": "authentication",
    "sts.amazonaws.com": "authentication",
    "sso.amazonaws.com": "authentication",
    "iam.amazonaws.com": "iam",
    "organizations.amazonaws.com": "iam",
    "s3.amazonaws.com": "storage",
    "ec2.amazonaws.com": "compute",
    "lambda.amazonaws.com": "compute",
    "ecs.amazonaws.com": "compute",
    "eks.amazonaws.com": "compute",
    "rds.amazonaws.com": "database",
    "dynamodb.amazonaws.com": "database",
    "kms.amazonaws.com": "encryption",
    "secretsmanager.amazonaws.com": "secrets",
    "cloudtrail.amazonaws.com": "audit",
    "config.amazonaws.com": "audit",
    "guardduty.amazonaws.com": "security",
    "securityhub.amazonaws.com": "security",
    "waf.amazonaws.com": "security",
    "logs.amazonaws.com": "logging",
    "cloudwatch.amazonaws.com": "monitoring",
    "sns.amazonaws.com": "messaging",
    "sqs.amazonaws.com": "messaging",
    "cloudformation.amazonaws.com": "infrastructure",
    "elasticloadbalancing.amazonaws.com": "networking",
    "route53.amazonaws.com": "networking",
    "vpc.amazonaws.com": "networking",
}
GCP_CATEGORIES = {
    "iam.googleapis.com": "iam",
    "cloudresourcemanager.googleapis.com": "iam",
    "iamcredentials.googleapis.com": "iam",
    "sts.googleapis.com": "authentication",
    "login.googleapis.com": "authentication",
    "storage.googleapis.com": "storage",
    "bigquery.googleapis.com": "database",
    "spanner.googleapis.com": "database",
    "sqladmin.googleapis.com": "database",
    "firestore.googleapis.com": "database",
    "compute.googleapis.com": "compute",
    "run.googleapis.com": "compute",
    "container.googleapis.com": "compute",
    "cloudfunctions.googleapis.com": "compute",
    "cloudkms.googleapis.com": "encryption",
    "secretmanager.googleapis.com": "secrets",
    "logging.googleapis.com": "logging",
    "monitoring.googleapis.com": "monitoring",
    "pubsub.googleapis.com": "messaging",
    "cloudscheduler.googleapis.com": "infrastructure",
    "cloudbuild.googleapis.com": "infrastructure",
    "serviceusage.googleapis.com": "infrastructure",
    "dns.googleapis.com": "networking",
    "networkservices.googleapis.com": "networking",
}
# Prefixes of calls that take something away.
AWS_DESTRUCTIVE = ("Delete", "Terminate", "Remove", "Deregister", "Revoke")
GCP_DESTRUCTIVE = ("delete", "remove", "destroy", "purge")
# Log severities that are not INFO.
GCP_SEVERITY = {
    "EMERGENCY": "CRITICAL",
    "ALERT": "CRITICAL",
    "CRITICAL": "CRITICAL",
    "ERROR": "WARNING",
    "WARNING": "WARNING",
}
# Log name parts and the audit stream they stand for, tried in this order.
AUDIT_STREAMS = {
    "%2factivity": "activity",
    "%2fdata_access": "data_access",
    "%2fsystem_event": "system_event",
    "%2fpolicy": "policy_denied",
}


def literal_map(pairs: dict[str, str]) -> Column:
    return F.expr("map(" + ", ".join(f"'{x}'" for kv in pairs.items() for x in kv) + ")")


def starts_with_any(text: Column, prefixes: tuple[str, ...]) -> Column:
    return text.rlike("^(" + "|".join(prefixes) + ")")


def cloudtrail_username() -> Column:
    """The most telling name in the identity block."""
    principal = dtext("useridentity", "principalid")
    session = F.when(principal.contains(":"), F.regexp_extract(principal, r"^[^:]*:(?s)(.*)$", 1))
    arn = F.split(dtext("useridentity", "arn"), ":")
    return F.coalesce(
        nonempty(dtext("useridentity", "username")),
        session,
        F.when(dtext("useridentity", "type") == "Root", F.lit("root")),
        nonempty(dtext("useridentity", "invokedby")),
        F.when(F.size(arn) >= 6, F.element_at(arn, -1)),
        F.lit("unknown"),
    )


def cloudtrail(df: DataFrame) -> Change:
    source = dtext("eventsource")
    name = F.coalesce(dtext("eventname"), F.lit("UNKNOWN"))
    service = F.replace(source, F.lit(".amazonaws.com"), F.lit(""))
    ip, region = nonempty(dtext("sourceipaddress")), nonempty(dtext("awsregion"))
    code, message = nonempty(dtext("errorcode")), nonempty(dtext("errormessage"))
    failed = code.isNotNull() | message.isNotNull()
    root = F.coalesce(dtext("useridentity", "type") == "Root", F.lit(False))
    signin = source == "signin.amazonaws.com"
    login = F.when(signin, nonempty(dtext("responseelements", "consolelogin")))
    mfa = F.when(signin, nonempty(dtext("additionaleventdata", "mfaused")))
    destructive = starts_with_any(name, AWS_DESTRUCTIVE) & (F.col("severity") == "INFO")
    warn = failed | destructive | root | F.coalesce(login == "Failure", F.lit(False))
    # a tag already given by the message is not repeated for these two
    once = lambda tag, cond: F.when(cond & ~F.array_contains("tags", tag) & (service != tag), F.lit(tag))
    read_only = dbool("readonly")
    return Change(
        guard=(F.col("source") == "cloudtrail") & source.endswith(".amazonaws.com"),
        columns={
            "summary": F.concat_ws(
                " ", F.concat_ws(" ", cloudtrail_username(), name),
                F.concat(F.lit("from "), ip), F.concat(F.lit("in "), region),
            ),
            "category": F.coalesce(F.try_element_at(literal_map(AWS_CATEGORIES), source), service),
            "severity": F.when(warn, F.lit("WARNING")).otherwise(F.col("severity")),
        },
        tags=[
            F.lit("cloudtrail"), F.lit("aws"),
            F.when(read_only, F.lit("read")).when(~read_only, F.lit("write")),
            F.when(dbool("managementevent"), F.lit("management")),
            service,
            once("error", failed), once("root", root),
            F.when(login == "Failure", F.lit("login-failure")).when(login == "Success", F.lit("login-success")),
            F.when(mfa == "No", F.lit("no-mfa")),
        ],
        details={
            "_errorcode": as_variant(code), "_errormessage": as_variant(message),
            "_login_result": as_variant(login), "_mfa_used": as_variant(mfa == "Yes"),
        },
    )


def policy_deltas() -> Column:
    """Rendered binding changes of a policy call: array<struct<action, role, member>>."""
    found = F.filter(dlist("protopayload", "servicedata", "policydelta", "bindingdeltas"), is_object)
    return F.transform(
        found, lambda d: F.struct(*[F.coalesce(jtext(d, [k]), F.lit("")).alias(k) for k in ("action", "role", "member")])
    )


def gcp_audit(log_severity: bool = True):
    """Audit log entries. With `log_severity` the entry's own severity sets the baseline, else INFO does."""

    def apply(df: DataFrame) -> Change:
        log_name = F.lower(F.coalesce(dtext("logname"), F.lit("")))
        payload = F.lower(F.coalesce(dtext("protopayload", "@type"), F.lit("")))
        stream = F.lit("unknown")
        for part, label in reversed(AUDIT_STREAMS.items()):
            stream = F.when(log_name.contains(part), F.lit(label)).otherwise(stream)
        principal = nonempty(dtext("protopayload", "authenticationinfo", "principalemail"))
        method = nonempty(dtext("protopayload", "methodname"))
        service = nonempty(dtext("protopayload", "servicename"))
        resource = nonempty(dtext("protopayload", "resourcename"))
        ip = nonempty(dtext("protopayload", "requestmetadata", "callerip"))
        agent = nonempty(dtext("protopayload", "requestmetadata", "callersupplieduseragent"))
        project = nonempty(dtext("resource", "labels", "project_id"))

        policy = F.coalesce(F.lower(method).endswith("setiampolicy"), F.lit(False))
        deltas = F.col("_deltas")
        texts = F.filter(
            F.transform(deltas, lambda d: F.trim(F.concat_ws(" ", d["action"], d["role"], d["member"]))), lambda t: t != ""
        )
        members = F.filter(F.transform(deltas, lambda d: d["member"]), lambda t: t != "")
        roles = F.filter(F.transform(deltas, lambda d: d["role"]), lambda t: t != "")
        filled = lambda a: F.when(F.size(a) > 0, a)
        many = F.when(F.size(deltas) > 1, F.size(deltas))
        extra = F.array_join(filled(texts), "; ")

        denied = F.exists(
            dlist("protopayload", "authorizationinfo"),
            lambda a: F.coalesce(F.try_variant_get(a, "$.granted", "string") == "false", F.lit(False)),
        )
        raw_code = dvariant("protopayload", "status", "code")
        code = F.when(F.schema_of_variant(raw_code) == "BIGINT", F.try_variant_get(raw_code, "$", "bigint"))
        error = F.coalesce(code != 0, F.lit(False))
        given = F.coalesce(F.col("_severity") if log_severity else dtext("severity"), F.lit(""))
        baseline = F.coalesce(F.try_element_at(literal_map(GCP_SEVERITY), F.upper(given)), F.lit("INFO"))
        leaf = F.lower(F.element_at(F.split(method, r"\."), -1))
        destructive = F.coalesce(starts_with_any(leaf, GCP_DESTRUCTIVE), F.lit(False))
        short = F.replace(service, F.lit(".googleapis.com"), F.lit(""))
        return Change(
            let=[{"_deltas": F.when(policy, policy_deltas())}],
            guard=payload.contains("google.cloud.audit.auditlog") | log_name.contains("cloudaudit.googleapis.com"),
            columns={
                "source": F.lit("gcp_audit"),
                "severity": F.when(denied | error | (destructive & (baseline == "INFO")), F.lit("WARNING")).otherwise(baseline),
                "category": F.coalesce(F.try_element_at(literal_map(GCP_CATEGORIES), service), nonempty(short), F.lit("gcp")),
                "summary": F.concat_ws(
                    " ", F.coalesce(principal, F.lit("unknown")), F.coalesce(method, F.lit("unknown")), resource,
                    F.concat(F.lit("("), extra, F.lit(")")), F.concat(F.lit("from IP "), ip),
                ),
            },
            tags=[
                F.lit("gcp_audit"), F.lit("gcp"), F.concat(F.lit("gcp_audit_"), stream),
                F.when(principal.endswith("gserviceaccount.com"), F.lit("service-account")),
                F.when(policy, F.lit("iam-policy-change")),
                F.when(many.isNotNull(), F.lit("multi-binding-change")),
                F.when(denied, F.lit("denied")).when(error, F.lit("error")),
            ],
            details={
                "audit_log_type": as_variant(stream), "user": as_variant(principal), "methodname": as_variant(method),
                "servicename": as_variant(service), "resourcename": as_variant(resource),
                "sourceipaddress": as_variant(ip), "useragent": as_variant(agent), "project": as_variant(project),
                "policy_members": list_variant(filled(members)), "policy_roles": list_variant(filled(roles)),
                "policy_delta_count": as_variant(many.cast("long")), "policy_delta": as_variant(extra),
                "policy_member": as_variant(F.get(members, F.lit(0))),
            },
        )

    return apply


# The value fields of a Workspace parameter, first present wins.
PARAMETER_VALUES = ("value", "boolvalue", "intvalue", "multivalue", "messagevalue", "multimessagevalue")


def workspace_params(items: Column) -> Column:
    """Parameters as (name in lower case, value), those without any value left out."""
    read = F.transform(
        items,
        lambda p: F.struct(
            F.lower(jtext(p, ["name"])).alias("name"),
            F.coalesce(*[F.try_variant_get(p, f"$.{k}", "variant") for k in PARAMETER_VALUES]).alias("value"),
        ),
    )
    return F.filter(read, lambda p: p["value"].isNotNull())


def workspace_param(params: Column, name: str) -> Column:
    """The value of a named parameter as VARIANT."""
    return F.get(F.filter(params, lambda p: p["name"] == name), F.lit(0))["value"]


def _text(v: Column) -> Column:
    return nonempty(F.try_variant_get(v, "$", "string"))


def _listed(v: Column, path: str = "$") -> Column:
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))


def workspace(flag_suspicious: bool = True):
    """Admin report activity. `flag_suspicious` marks events with a true `is_suspicious` parameter."""

    def apply(df: DataFrame) -> Change:
        params = F.col("_params")
        pick = lambda name: _text(workspace_param(params, name))
        # a list counts by its first element
        lead = lambda v: F.coalesce(_text(F.get(F.try_variant_get(v, "$", "array<variant>"), F.lit(0))), _text(v))
        subject = workspace_param(workspace_params(_listed(workspace_param(params, "message_info"), "$.parameter")), "subject")
        extra = (
            F.when(F.col("_app") == "gmail", _text(subject))
            .when(F.col("_app") == "calendar", pick("event_title"))
            .when(F.col("_app") == "mobile", F.coalesce(pick("device_model"), pick("device_type")))
            .when(F.col("_app") == "token", pick("app_name"))
            .when(
                F.col("_app") == "access_evaluation",
                F.coalesce(lead(workspace_param(params, "scopes_requested")), lead(workspace_param(params, "service_account"))),
            )
        )
        summary = F.concat(
            F.coalesce("_actor", dtext("user"), F.lit("")), F.lit(" "), F.coalesce(dtext("events", 0, "name"), F.lit("")),
            F.coalesce(F.concat(F.lit(" ("), F.col("_extra"), F.lit(")")), F.lit("")),
            F.coalesce(F.concat(F.lit(" from IP "), F.coalesce(dtext("ipaddress"), dtext("sourceipaddress"))), F.lit("")),
        )
        text = F.col("_text")
        suspicious = F.exists(
            dlist("events"),
            lambda e: F.exists(
                _listed(e, "$.parameters"),
                lambda p: F.coalesce(
                    (jtext(p, ["name"]) == "is_suspicious") & (jtext(p, ["boolvalue"]) == "true"), F.lit(False)
                ),
            ),
        )
        return Change(
            guard=dtext("kind").contains("admin#reports#activity")
            & F.map_contains_key("details", "id") & F.map_contains_key("details", "etag"),
            let=[
                {
                    "_params": workspace_params(dlist("events", 0, "parameters")),
                    "_app": dtext("id", "applicationname"), "_actor": nonempty(dtext("actor", "email")),
                },
                {"_extra": extra},
                {"_text": summary},
            ],
            columns={
                "source": F.lit("google_workspace"),
                "summary": text,
                "category": F.coalesce("_app", F.lit("google_workspace")),
            },
            tags=[F.lit("google_workspace")],
            details={
                "sourceipaddress": entry("ipaddress"),
                "user": as_variant(F.col("_actor")),
                "extra_info": as_variant(F.col("_extra")),
                "success": as_variant(F.when(text.contains("success"), F.lit(True)).when(text.contains("fail"), F.lit(False))),
                **({"suspicious": as_variant(F.when(suspicious, F.lit(True)))} if flag_suspicious else {}),
            },
            unset={"ipaddress": F.map_contains_key("details", "ipaddress")},
        )

    return apply


def vendor_stages(log_severity: bool = True, flag_suspicious: bool = True) -> list[Stage]:
    return [
        Stage("cloudtrail", ("eventsource",), cloudtrail, 15),
        Stage("gcp_audit", ("protopayload",), gcp_audit(log_severity), 20),
        Stage("google_admin", ("kind",), workspace(flag_suspicious), 20),
    ]
