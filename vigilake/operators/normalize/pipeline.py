"""Raw JSON text to canonical events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions.jsonfn import jtext, variant_path
from vigilake.functions.walk import unfold
from vigilake.operators.normalize import common
from vigilake.operators.normalize.stage import Stage, apply_stage, stages
from vigilake.operators.normalize.vendors import vendor_stages
from vigilake.schema import SHELL_FIELDS, SHELL_STRING_DEFAULTS


def builtin_stages(
    now: Column, project: str = "", log_severity: bool = True, flag_suspicious: bool = True,
    id_from: Sequence[str] | None = ("value",),
) -> list[Stage]:
    return [
        *vendor_stages(log_severity, flag_suspicious),
        Stage("ip_addresses", ("*",), common.ip_addresses, 20),
        Stage("timestamps", ("*",), common.timestamps(now), 20),
        Stage("drop_self_telemetry", ("gcp_audit_data_access",), common.drop_self_telemetry(project), 30),
        Stage("ensure_eventid", ("*",), common.ensure_eventid(id_from), 10, "enrichment"),
    ]


def _shell_list(doc: Column, name: str) -> Column:
    """A list of texts; a single text counts as a list of one."""
    listed = F.try_variant_get(doc, variant_path([name]), "array<string>")
    one = jtext(doc, [name])
    return F.coalesce(listed, F.when(one.isNotNull(), F.array(one)), F.array().cast("array<string>"))


def event_shell(raw: DataFrame, text: str, now: Column, wanted: Sequence[str], tokens: Sequence[str]) -> DataFrame:
    """Lower-case keys, shell columns with defaults, everything else below `details`.

    A top-level key that is no shell field wins over one of the same name inside `details`.
    """
    rest = [c for c in raw.columns if c not in SHELL_FIELDS]
    doc = raw.select(*rest, unfold(F.col(text), wanted, tokens).alias("_u"))
    doc = doc.select(*rest, F.try_parse_json("_u.doc").alias("_doc"), "_u.keys", "_u.found")
    d = F.col("_doc")
    top = F.try_variant_get(d, "$", "map<string,variant>")
    none = F.create_map().cast("map<string,variant>")
    inner = F.coalesce(F.try_variant_get(d, "$.details", "map<string,variant>"), none)
    cols = {
        "_outer": F.map_filter(top, lambda k, v: ~k.isin(*SHELL_FIELDS)),
        "_inner": inner,
        "utctimestamp": F.coalesce(F.try_to_timestamp(jtext(d, ["utctimestamp"])), now),
        "_utctimestamp": jtext(d, ["utctimestamp"]),
        "tags": _shell_list(d, "tags"),
        "plugins": _shell_list(d, "plugins"),
        "_severity": jtext(d, ["severity"]),
        "_drop": F.col("_doc").isNull(),
        "_doc_read": F.col("_doc").isNotNull(),
        "_ran": F.array(F.lit("normalization_lowercase_keys"), F.lit("normalization_event_shell")),
    }
    cols.update({n: F.coalesce(jtext(d, [n]), F.lit(default)) for n, default in SHELL_STRING_DEFAULTS.items()})
    parts = doc.select(*rest, "keys", "found", *[c.alias(n) for n, c in cols.items()])
    merged = F.map_concat(F.map_filter("_inner", lambda k, v: ~F.map_contains_key("_outer", k)), "_outer")
    names = [c for c in parts.columns if c not in ("_outer", "_inner")]
    return parts.select(*names, F.coalesce(merged, none).alias("details"))


def normalize(
    raw: DataFrame,
    text: str = "value",
    now: Column | None = None,
    extra_stages: Sequence[Stage] = (),
    keep_dropped: bool = False,
    keep_unreadable: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Events out of a column of JSON objects; rows that are no JSON object are left out (see sources).

    User stages go into `extra_stages`; they run by priority among the built-in ones. Everything after
    key rewriting is column work on independent rows: no shuffle. With `keep_unreadable`, a list of columns
    of `raw`, rows that are no readable object stay: they have `unreadable` set, and every row those columns.
    """
    now = F.current_timestamp() if now is None else now
    registered = [*builtin_stages(now, **options), *extra_stages]
    tokens = sorted({r.lower() for s in registered for r in s.registration})
    df = event_shell(raw, text, now, common.WANTED_KEYS, tokens)
    for group in ("normalization", "enrichment"):
        for stage in stages(registered, group):
            df = apply_stage(df, stage)
    if keep_unreadable:
        df = df.withColumn("_drop", F.col("_drop") & F.col("_doc_read"))
    out = {c: F.col(c) for c in SHELL_FIELDS}
    out["plugins"] = F.concat("plugins", "_ran")
    out["details"] = F.to_variant_object("details")
    kept = [F.col("_drop").alias("dropped")] if keep_dropped else []
    if keep_unreadable:
        kept += [(~F.col("_doc_read")).alias("unreadable"), *[F.col(c) for c in keep_unreadable]]
    record = F.struct(*[c.alias(n) for n, c in out.items()], *kept)
    # A plain filter on the drop flag would be pushed down through every stage and repeat all of them.
    # A generated column stops that, for this filter and for those of the caller.
    gone = F.lit(False) if keep_dropped else F.col("_drop")
    one = df.select(F.explode_outer(F.when(~gone, F.array(record))).alias("_e"))
    return one.filter(F.col("_e").isNotNull()).select("_e.*")
