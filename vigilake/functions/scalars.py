"""Scalar functions on strings, addresses, times and severities."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilake.schema import SEVERITY_RANK
from vigilake.sources.tables import ts_lit

# --- addresses ---------------------------------------------------------------

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IPV4 = rf"{_OCTET}(\.{_OCTET}){{3}}"
_IPV4_RE = rf"^{_IPV4}$"
_IPV4_NET_RE = rf"^{_IPV4}(/(3[0-2]|[12]?[0-9]))?$"
_IPV6_MASK_RE = r"/(12[0-8]|1[01][0-9]|[1-9]?[0-9])$"
_H = "[0-9a-fA-F]{1,4}"
# eight groups, or n groups before '::' and at most 7 - n after it
_IPV6_RE = "^(" + "|".join(
    [f"({_H}:){{7}}{_H}", f"({_H}:){{1,7}}:", f":(:{_H}){{1,7}}", "::"]
    + [f"({_H}:){{1,{7 - n}}}(:{_H}){{1,{n}}}" for n in range(1, 7)]
) + ")$"
_DOTTED_TAIL_RE = rf":{_IPV4}$"


def is_ipv4(s: Column) -> Column:
    """Dotted quad without a mask."""
    return F.coalesce(s.rlike(_IPV4_RE), F.lit(False))


def is_ipv6(s: Column) -> Column:
    """IPv6 without a mask; a dotted quad may stand for the last two groups."""
    return F.coalesce(F.regexp_replace(s, _DOTTED_TAIL_RE, ":0:0").rlike(_IPV6_RE), F.lit(False))


def is_ip(s: Column) -> Column:
    """An IPv4 or IPv6 address or network; plain numbers are not addresses."""
    v6 = F.regexp_replace(F.regexp_replace(s, _IPV6_MASK_RE, ""), _DOTTED_TAIL_RE, ":0:0")
    return F.coalesce(s.rlike(_IPV4_NET_RE) | (s.contains(":") & v6.rlike(_IPV6_RE)), F.lit(False))


# --- times -------------------------------------------------------------------

# Text formats tried after ISO 8601 (a leading weekday is dropped before), each with the
# shape of the texts it can read, so a row tries one or two formats and not all of them.
TIME_FORMATS = (
    (r"^\d{1,2} [A-Za-z]{3} \d{4} [\d:]{8} [+-]\d{4}$", "d MMM yyyy HH:mm:ss Z"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4} [\d:]{8} [A-Za-z]+$", "d MMM yyyy HH:mm:ss z"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4} [\d:]{8}$", "d MMM yyyy HH:mm:ss"),
    (r"^[A-Za-z]{3} +\d{1,2} [\d:]{8} \d{4}$", "MMM d HH:mm:ss yyyy"),
    (r"^[A-Za-z]{3} +\d{1,2} [\d:]{8} [A-Za-z]+ \d{4}$", "MMM d HH:mm:ss z yyyy"),
    (r"^\d{1,2}/[A-Za-z]{3}/\d{4}:[\d:]{8} [+-]\d{4}$", "d/MMM/yyyy:HH:mm:ss Z"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4} [\d:]{8}$", "MMM d, yyyy HH:mm:ss"),
    (r"^[A-Za-z]{3} \d{1,2} \d{4} [\d:]{8}$", "MMM d yyyy HH:mm:ss"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4} [\d:]{7,8} [AaPp][Mm]$", "MMM d, yyyy h:mm:ss a"),
    (r"^\d\d/\d\d/\d{4} [\d:]{8}$", "MM/dd/yyyy HH:mm:ss"),
    (r"^\d\d/\d\d/\d{4}$", "MM/dd/yyyy"),
    (r"^\d{4}/\d\d/\d\d [\d:]{8}$", "yyyy/MM/dd HH:mm:ss"),
    (r"^\d{4}/\d\d/\d\d$", "yyyy/MM/dd"),
    (r"^\d{8}T\d{6}(Z|[+-]\d\d)$", "yyyyMMdd'T'HHmmssX"),
    (r"^\d{8}T\d{6}$", "yyyyMMdd'T'HHmmss"),
)
_WEEKDAY = r"^(?i)(mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+"
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"
_NUMBER = r"^[+-]?\d+(\.\d+)?([eE][+-]?\d+)?$"


def epoch_to_utc(value: Column) -> Column:
    """An epoch number in seconds, milli-, micro- or nanoseconds, told apart by magnitude.

    Seconds have ten digits at most; every digit more is one power of ten to divide by. Zero and
    negative numbers are 1970-01-01.
    """
    v = value.cast("double")
    extra = F.greatest(F.coalesce(F.floor(F.log10(F.floor(v))), F.lit(0)) - 9, F.lit(0))
    micros = F.round(v * F.pow(F.lit(10.0), F.lit(6) - extra)).cast("long")
    return F.timestamp_micros(F.when(v <= 0, F.lit(0).cast("long")).otherwise(micros))


def to_utc(text: Column) -> Column:
    """A timestamp out of almost anything; NULL when nothing fits. Zone-less text is UTC."""
    t = F.trim(text)
    numeric = t.rlike(_NUMBER)
    # comma fractions and a blank before the zone are common in logs
    iso = F.regexp_replace(F.regexp_replace(t, r",(\d+)", r".$1"), r"\s+([+-]\d{2}:?\d{2}|Z|UTC)$", "$1")
    # Spark reads +0000 only with a colon
    iso = F.regexp_replace(iso, r"(:\d{2}(?:\.\d+)?)([+-]\d{2})(\d{2})$", "$1$2:$3")
    parsed = F.when(t.rlike(_ISO), F.try_to_timestamp(iso))
    plain = F.regexp_replace(t, _WEEKDAY, "")
    others = [F.when(plain.rlike(shape), F.try_to_timestamp(plain, F.lit(f))) for shape, f in TIME_FORMATS]
    # words without a digit cannot be a time: skip the format list for them
    free = F.when(~t.rlike(_ISO) & t.rlike(r"\d"), F.coalesce(*others))
    return F.when(numeric, epoch_to_utc(t.try_cast("double"))).otherwise(F.coalesce(parsed, free))


def is_expired(expiration: Column, as_of: datetime | str, kind: T.DataType | None = None) -> Column:
    """Strictly before `as_of`. NULL and garbage never expire; text without a zone is UTC."""
    if isinstance(kind, T.StringType):
        expiration = F.try_to_timestamp(expiration)
    elif isinstance(kind, T.NumericType):
        expiration = F.timestamp_micros((expiration.cast("double") * 1_000_000).cast("long"))
    return F.coalesce(expiration.cast("timestamp") < ts_lit(as_of), F.lit(False))


def lifespan_seconds(text: Column) -> Column:
    """`"7 days"`, `"1 hour"`, `"30 min"` in seconds; anything else is three days."""
    n = F.try_element_at(F.regexp_extract_all(F.lower(text), F.lit(r"^\s*(\d+)\s*(day|hour|min)"), 1), F.lit(1))
    unit = F.regexp_extract(F.lower(text), r"^\s*\d+\s*(day|hour|min)", 1)
    size = F.when(unit == "day", 86_400).when(unit == "hour", 3_600).when(unit == "min", 60)
    return F.coalesce(n.try_cast("long") * size, F.lit(3 * 86_400)).cast("long")


def event_date_parts(now: Column) -> dict[str, Column]:
    """Zero-padded hour, month, day and year of `now` and of one hour before."""
    before = now - F.expr("INTERVAL 1 HOUR")
    parts = {"hour": "HH", "month": "MM", "day": "dd", "year": "yyyy"}
    out = {f"now_{k}": F.date_format(now, f) for k, f in parts.items()}
    out.update({f"last_hour_{k}": F.date_format(before, f) for k, f in parts.items()})
    return out


# --- severities, cells, names ------------------------------------------------


def severity_rank(severity: Column, default: int = 0) -> Column:
    pairs = [F.lit(x) for kv in SEVERITY_RANK.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(severity)), F.lit(default))


def severity_allows(severity: Column, minimum: Column) -> Column:
    """Rank at least the minimum's; an unknown severity ranks 0, an unknown minimum as HIGH."""
    return severity_rank(severity, 0) >= severity_rank(minimum, SEVERITY_RANK["HIGH"])


def clamp(value: Column, default: int, top: int) -> Column:
    """Text or number kept within 1..top; anything else gives the default."""
    number = value.try_cast("int")
    return F.when(number.isNull(), F.lit(default)).otherwise(F.least(F.greatest(number, F.lit(1)), F.lit(top)))


def format_cell(value: Column, kind: T.DataType) -> Column:
    """How a result cell is shown: dash for NULL, seconds for times, JSON for nested values."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        text = F.to_json(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("—"))


def service_short(name: Column) -> Column:
    """`signin.amazonaws.com` -> `signin`, `iam.googleapis.com` -> `iam`."""
    return F.replace(F.replace(name, F.lit(".amazonaws.com"), F.lit("")), F.lit(".googleapis.com"), F.lit(""))


def short_id(text: Column) -> Column:
    return F.substring(text, 1, 8)


def display_incident_id(incident_id: Column) -> Column:
    trimmed = F.regexp_replace(F.regexp_replace(incident_id, "^incident-", ""), "-incident$", "")
    return F.upper(F.substring(trimmed, 1, 8))


def stable_id(*parts: Column) -> Column:
    """An id in UUID form derived from its parts: the same after a task is retried or a job replayed."""
    h = F.md5(F.concat_ws("\u0001", *[F.coalesce(p.cast("string"), F.lit("\u0002")) for p in parts]))
    return F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)
    )
