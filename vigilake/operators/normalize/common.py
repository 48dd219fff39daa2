"""Stages that look at every event: addresses, times, self telemetry, ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions.jsonfn import jv
from vigilake.functions.scalars import is_ip, stable_id, to_utc
from vigilake.operators.normalize.stage import (
    Change, as_variant, dlist, dtext, entry, is_object, list_variant, nonempty,
)

# Field names that may hold an address, most telling first.
SOURCE_FIELDS = (
    "src", "srcaddr", "srcip", "src_ip", "source_ip", "sourceipaddress", "source_ip_address", "c-ip", "clientip",
    "remoteip", "remote_ip", "remoteaddr", "remote_host_ip_address", "ipaddress", "ip_address", "ipaddr",
    "id_orig_h", "x-forwarded-for", "http-x-forwarded-for",
)
DESTINATION_FIELDS = (
    "dst", "dstip", "dst_ip", "dstaddr", "dest", "destaddr", "dest_ip", "destination_ip", "destinationipaddress",
    "destination_ip_address", "id_resp_h", "serverip",
)
# Field names that may hold the event time, most telling first.
TIME_FIELDS = ("timestamp", "@timestamp", "time", "eventtime", "start")

WANTED_KEYS = (*SOURCE_FIELDS, *DESTINATION_FIELDS, *TIME_FIELDS, "date", "statementtype")


def _array(names: Sequence[str]) -> Column:
    return F.expr("array(" + ", ".join(f"'{n}'" for n in names) + ")")


def best_address(names: Sequence[str], first_of_list: bool) -> Column:
    """The first valid address under the most telling field name, wherever it is in the document."""
    ranked = F.transform(
        F.filter("found", lambda x: (x["kind"] == "string") & F.array_contains(_array(names), x["key"])),
        lambda x, i: F.struct(
            F.array_position(_array(names), x["key"]).alias("rank"),
            i.alias("i"),
            (F.trim(F.substring_index(x["value"], ",", 1)) if first_of_list else x["value"]).alias("ip"),
        ),
    )
    return F.array_min(F.filter(ranked, lambda x: is_ip(x["ip"])))["ip"]


def ip_addresses(df: DataFrame) -> Change:
    own, agent, own_target = (nonempty(dtext(k)) for k in ("sourceipaddress", "useragent", "destinationipaddress"))
    source = F.when(own.isNull(), best_address(SOURCE_FIELDS, True)).when(is_ip(own), own)
    target = F.when(own_target.isNull(), best_address(DESTINATION_FIELDS, False)).when(is_ip(own_target), own_target)
    mine = F.array_compact(F.array("_source", "_target"))
    listed = F.try_variant_get(entry("_ipaddresses"), "$", "array<string>")
    ips = F.when(F.size(listed) > 0, F.concat(listed, F.array_except(mine, listed))).when(
        nonempty(dtext("_ipaddresses")).isNull() | listed.isNotNull(), mine
    )
    return Change(
        let=[{"_source": source, "_target": target}],
        details={
            # an existing value stays as it is
            "sourceipaddress": as_variant(F.when(own.isNull(), F.col("_source"))),
            "destinationipaddress": as_variant(F.when(own_target.isNull(), F.col("_target"))),
            "_ipaddresses": list_variant(F.when(F.size(mine) > 0, ips)),
        },
        # some services write their own name as address and agent
        unset={"sourceipaddress": own.isNotNull() & F.col("_source").isNull() & (own == agent)},
    )


def timestamps(processed_at: Column):
    def apply(df: DataFrame) -> Change:
        of = lambda key: F.filter("found", lambda x: (x["key"] == key) & x["kind"].isin("string", "number"))
        candidates = []
        for name in TIME_FIELDS:
            texts = F.transform(of(name), lambda x: x["value"])
            if name == "time":
                dates = F.transform(of("date"), lambda x: x["value"])
                n = F.least(F.size(dates), F.size(texts))
                zipped = F.transform(
                    F.slice(texts, 1, n), lambda t, i: F.concat_ws(" ", F.get(dates, i), t)
                )
                texts = F.when(F.size(dates) > 0, zipped).otherwise(texts)
            candidates.append(texts)
        # last resorts: the time of a Workspace activity by itself, the time the message came with
        activity = F.when(F.col("source") == "google_workspace", dtext("id", "time"))
        candidates.append(F.array_compact(F.array(activity, F.col("_utctimestamp"))))
        parsed = F.array_compact(F.transform(F.concat(*candidates), to_utc))
        return Change(
            columns={"utctimestamp": F.coalesce(F.get(parsed, F.lit(0)), F.col("utctimestamp"))},
            details={"_utcprocessedtimestamp": as_variant(F.date_format(processed_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))},
        )

    return apply


# Statements that change something.
WRITE_STATEMENTS = (
    "CREATE_TABLE_AS_SELECT", "CREATE_TABLE", "CREATE_VIEW", "CREATE_MATERIALIZED_VIEW", "INSERT", "UPDATE",
    "DELETE", "MERGE", "EXPORT", "DROP_TABLE", "TRUNCATE_TABLE",
)
# Document store services, their write calls, and the agent behind the web client.
DOCUMENT_SERVICES = ("firestore.googleapis.com", "datastore.googleapis.com")
DOCUMENT_WRITES = ("commit", "batchwrite", "write")
RULES_AGENT_SUFFIX = "@firebase-rules.iam.gserviceaccount.com"
CONFIG_COLLECTIONS = ("rules", "settings")


def statement_type() -> Column:
    """The first statement type named anywhere in the document, upper case; '' if none."""
    found = F.filter("found", lambda x: (x["key"] == "statementtype") & (x["kind"] == "string"))
    first = F.array_min(F.transform(found, lambda x: F.struct(x["pos"].alias("pos"), x["value"].alias("value"))))
    return F.coalesce(F.upper(first["value"]), F.lit(""))


def document_collection() -> Column:
    """The collection a document store call touches; '' when it cannot be told."""
    request = ("protopayload", "request")
    queries = [
        dlist(*request, "addtarget", "query", "structuredquery", "from"),
        dlist(*request, "structuredquery", "from"),
        dlist(*request, "newtransaction", "structuredquery", "from"),
    ]
    named = F.filter(
        F.transform(F.concat(*queries), lambda f: F.when(is_object(f), jv(f, ["collectionid"]))), lambda c: c != ""
    )
    texts = lambda items: F.filter(
        F.transform(items, lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))),
        lambda t: t.isNotNull(),
    )
    writes = F.transform(
        dlist(*request, "writes"), lambda w: F.coalesce(nonempty(jv(w, ["update", "name"])), jv(w, ["delete"]))
    )
    places = F.concat(
        texts(dlist("protopayload", "metadata", "keys")),
        texts(dlist(*request, "addtarget", "documents", "documents")),
        F.array_compact(writes),
    )
    in_path = F.filter(F.transform(places, lambda p: F.regexp_extract(p, "/documents/([^/]+)/", 1)), lambda c: c != "")
    return F.coalesce(F.get(named, F.lit(0)), F.get(in_path, F.lit(0)), F.lit(""))


def drop_self_telemetry(project: str, config_collections: Sequence[str] = CONFIG_COLLECTIONS):
    """Discard data-access events the platform causes by running; keep whatever is not surely that."""

    def apply(df: DataFrame) -> Change:
        who, service, method = (F.coalesce(dtext(k), F.lit("")) for k in ("user", "servicename", "methodname"))
        ours = who.endswith(f"@{project}.iam.gserviceaccount.com") if project else F.lit(False)
        reads = ours & ~statement_type().isin(*WRITE_STATEMENTS)
        collection = document_collection()
        leaf = F.element_at(F.split(F.lower(method), r"\."), -1)
        config_change = collection.isin(*config_collections) & leaf.isin(*DOCUMENT_WRITES)
        usage = (ours | who.endswith(RULES_AGENT_SUFFIX)) & (collection != "") & ~config_change
        return Change(
            guard=dtext("audit_log_type") == "data_access",
            drop=F.when(service == "bigquery.googleapis.com", reads).when(service.isin(*DOCUMENT_SERVICES), usage),
        )

    return apply


def ensure_eventid(id_from: Sequence[str] | None):
    """An id where none is given: random, or derived from the named columns so that a replay repeats it."""

    def apply(df: DataFrame) -> Change:
        fresh = stable_id(*[F.col(c) for c in id_from]) if id_from else F.uuid()
        return Change(columns={"eventid": F.coalesce(nonempty(F.col("eventid")), fresh)})

    return apply
