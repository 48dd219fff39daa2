"""Detection rules: their shape, where they come from, and what makes one acceptable."""

from __future__ import annotations

import glob
import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.schema import ALERT_TYPES, DEFAULT_LOOKBACK_MINUTES
from vigilake.sources.tables import clamp_minutes

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Rule:
    """A rule, or one slot of a sequence rule."""

    alert_name: str
    alert_type: str = "threshold"
    severity: str = "INFO"
    summary: str = ""
    category: str = "general"
    tags: tuple[str, ...] = ()
    criteria: str = ""
    threshold: int | None = None
    aggregation_key: str = ""
    event_snippet: str = ""
    event_sample_count: int | None = None
    lookback_minutes: int = DEFAULT_LOOKBACK_MINUTES
    lifespan: str | None = None
    slots: tuple["Rule", ...] = field(default=())
    strict_order: bool = False  # of a sequence: its slots follow each other in time
    expected_values: tuple[str, ...] = ()  # of a keyed deadman: groups that are missed even if none of their events came

    @property
    def keyed(self) -> bool:
        return bool(self.aggregation_key) and self.aggregation_key != "none"

    @property
    def limit(self) -> int:
        """The count compared with: at least this many fire, for deadman at most this many."""
        default = 0 if self.alert_type == "deadman" else 1
        return default if self.threshold is None else int(self.threshold)

    @property
    def samples(self) -> int:
        default = 0 if self.alert_type == "deadman" else 3
        return default if self.event_sample_count is None else max(0, int(self.event_sample_count))

    def with_slots(self, slots: Iterable["Rule"]) -> "Rule":
        return replace(self, slots=tuple(slots))


def rule_from_dict(doc: dict) -> Rule:
    """A rule out of a parsed YAML or JSON document; unknown keys are ignored."""
    known = {k: v for k, v in doc.items() if k in Rule.__dataclass_fields__ and v is not None}
    known["tags"] = tuple(str(t) for t in known.get("tags") or ())
    known["expected_values"] = tuple(str(v) for v in known.get("expected_values") or ())
    known["strict_order"] = known.get("strict_order") is True
    known["lookback_minutes"] = clamp_minutes(known.get("lookback_minutes", DEFAULT_LOOKBACK_MINUTES))
    slots = []
    for i, slot in enumerate(known.get("slots") or ()):
        slots.append(rule_from_dict({"alert_name": f"{known['alert_name']}_slot_{i + 1}", **slot}))
    known["slots"] = tuple(slots)
    return Rule(**known)


def _parse(text: str) -> dict | None:
    import json

    try:
        import yaml
    except ImportError:  # JSON rule documents need no YAML reader
        return json.loads(text)
    return yaml.safe_load(text)


def read_rule(text: str) -> Rule:
    """The rule of one YAML or JSON document; raises when there is none in it."""
    doc = _parse(text)
    if not isinstance(doc, dict) or not doc.get("alert_name"):
        raise ValueError("not a rule document with a name")
    return rule_from_dict(doc)


class Documents(Sequence):
    """Rules from documents in files and in a table, in the order of files and then of names.

    `table` (name, yaml) stays a table: `ruleindex.evaluate` reads many rules from it where they are. They come to the
    driver only when they are looked at as a list, a partition at a time.
    """

    def __init__(self, texts: list[tuple[str, str]], table: DataFrame | None):
        self.texts, self.table = texts, table
        self.rules: list[Rule] | None = None
        self.bad: list[tuple[str, str]] = []

    def read(self) -> "Documents":
        if self.rules is None:
            rows = self.table.toLocalIterator() if self.table is not None else ()
            self.rules = self.parsed([*self.texts, *sorted(((str(r["name"]), r["yaml"] or "") for r in rows), key=lambda x: x[0])])
        return self

    def parsed(self, texts: Iterable[tuple[str, str]]) -> list[Rule]:
        """The rules of some documents; a bad one is put aside in `bad`."""
        rules: list[Rule] = []
        for origin, text in texts:
            try:
                rules.append(read_rule(text))
            except Exception as e:  # noqa: BLE001 - any defect of one document stays with that document
                log.error("rule %s refused: %s", origin, e)
                self.bad.append((origin, str(e)))
        return rules

    def __len__(self) -> int:
        return len(self.read().rules)

    def __getitem__(self, i):
        return self.read().rules[i]


class Refused(Sequence):
    """(origin, reason) of the documents put aside, read when they are looked at."""

    def __init__(self, documents: Documents):
        self.documents = documents

    def __len__(self) -> int:
        return len(self.documents.read().bad)

    def __getitem__(self, i):
        return self.documents.read().bad[i]


def load_rules(paths: str | None = None, table: DataFrame | None = None) -> tuple[Documents, Refused]:
    """Rules from files and from a rules table (`name`, `yaml`, `enabled`), plus what was refused.

    A bad document is put aside with its reason and never stops the others. Nothing of the table is read yet.
    """
    texts: list[tuple[str, str]] = []
    for path in sorted(glob.glob(paths)) if paths else []:
        with open(path, encoding="utf-8") as f:
            texts.append((path, f.read()))
    live = table.filter(F.coalesce(F.col("enabled"), F.lit(True))).select("name", "yaml") if table is not None else None
    found = Documents(texts, live)
    return found, Refused(found)


def rule_problems() -> Column:
    """What is wrong with each row of a rules table, as an array of short texts (empty when fine)."""
    kind = F.coalesce(F.col("alert_type"), F.lit("threshold"))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    sequence = kind == "sequence"
    checks = {
        "name": ~F.coalesce(F.col("alert_name").rlike("^[a-z0-9_]{3,64}$"), F.lit(False)),
        "type": ~kind.isin(*ALERT_TYPES),
        "summary": blank(F.col("summary")),
        "criteria": ~sequence & blank(F.col("criteria")),
        "threshold": F.coalesce(F.col("threshold") < F.when(kind == "deadman", 0).otherwise(1), F.lit(False)) & ~sequence,
        "lookback": (kind == "deadman") & F.coalesce(F.col("lookback_minutes") < 1, F.lit(True)),
        "slots": sequence & (F.coalesce(F.size("slot_criteria"), F.lit(0)) < 2),
        "slot criteria": sequence & F.exists("slot_criteria", blank),
    }
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks.items()]))


def rule_quality(rules: DataFrame) -> DataFrame:
    """The rules table with `problems` and `ok`; write `ok` rows on and the others to quarantine."""
    return rules.withColumn("problems", rule_problems()).withColumn("ok", F.size("problems") == 0)


# Rules every installation starts with: the platform watching its own feeds.
HEARTBEAT_SOURCE = "platform"


def platform_rules(heartbeat_source: str = HEARTBEAT_SOURCE) -> list[Rule]:
    own = f"source = '{heartbeat_source}' AND json_value(details, '$.heartbeat') = 'cron'"
    feed = lambda name, criteria, severity, what, tags: Rule(
        alert_name=name, alert_type="deadman", category="deadman", severity=severity, criteria=criteria,
        lookback_minutes=10, threshold=0, summary=f"DEADMAN: no {what}",
        event_snippet="last event: {{summary}}", event_sample_count=1, tags=("deadman", *tags),
    )
    return [
        Rule(
            alert_name="cron_degraded", category="deadman", severity="HIGH", lookback_minutes=10, threshold=1,
            criteria=f"{own} AND try_cast(json_value(details, '$.failed') AS BIGINT) > 0",
            summary="detection is degraded: {{metadata.count}} heartbeats report failed rules",
            event_snippet="{{summary}}", event_sample_count=5, aggregation_key="details.service",
            tags=("deadman", "self-monitoring"),
        ),
        feed("deadman_gcp_audit_feed", "source = 'gcp_audit' AND json_value(details, '$.audit_log_type') = 'activity'",
             "CRITICAL", "admin activity audit logs", ("gcp", "defense-evasion")),
        feed("deadman_gcp_data_access_feed",
             "source = 'gcp_audit' AND json_value(details, '$.audit_log_type') = 'data_access'",
             "HIGH", "data access audit logs", ("gcp", "defense-evasion", "credential-access")),
        feed("deadman_google_workspace_feed", "source = 'google_workspace'", "CRITICAL", "workspace events",
             ("workspace", "identity")),
        replace(
            feed("deadman_ingest_pipeline", own, "CRITICAL", "heartbeat: ingest is broken or detection stands still",
                 ("pipeline", "self-monitoring")),
            lookback_minutes=15,
        ),
    ]
