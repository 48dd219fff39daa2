"""What a stage is, how stages are ordered and gated, and how their changes are applied."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilake.functions.jsonfn import jtext, jv, variant_path


@dataclass
class Change:
    """What a stage does to the rows it is active for.

    `columns` replaces shell columns; `tags` are appended where not NULL; `details` sets keys where the
    value is not NULL; `unset` removes keys where the condition holds; `drop` marks rows to discard.
    `let` names values computed in projections of their own beforehand, later steps may use earlier
    ones; what several outputs share belongs there, so the plan holds it once.
    """

    guard: Column | None = None
    columns: dict[str, Column] = field(default_factory=dict)
    tags: list[Column] = field(default_factory=list)
    details: dict[str, Column] = field(default_factory=dict)
    unset: dict[str, Column] = field(default_factory=dict)
    drop: Column | None = None
    let: list[dict[str, Column]] = field(default_factory=list)


@dataclass(frozen=True)
class Stage:
    """A named step. `registration` lists the key names, tags or categories it wants; `*` is all."""

    name: str
    registration: tuple[str, ...]
    apply: Callable[[DataFrame], Change]
    priority: int = 100
    group: str = "normalization"


def stages(registered: Sequence[Stage], group: str) -> list[Stage]:
    """Stages of a group by priority, equal ones by name."""
    return sorted((s for s in registered if s.group == group), key=lambda s: (s.priority, s.name))


def tokens(df: DataFrame) -> Column:
    """Everything a registration can match: nested key names, keys added so far, tags, category."""
    return F.concat("keys", F.map_keys("details"), F.coalesce("tags", F.array()), F.array("category"))


def gate(df: DataFrame, registration: Sequence[str]) -> Column:
    if "*" in registration:
        return F.lit(True)
    wanted = F.array(*[F.lit(r.lower()) for r in registration])
    return F.coalesce(F.arrays_overlap(tokens(df), wanted), F.lit(False))


# --- access to `details`, a map of VARIANTs while the pipeline runs -----------


def entry(key: str) -> Column:
    return F.try_element_at(F.col("details"), F.lit(key))


def dv(*path: str | int) -> Column:
    """Scalar below details as string, like `jv`."""
    return jv(entry(str(path[0])), list(path[1:]))


def dtext(*path: str | int) -> Column:
    return jtext(entry(str(path[0])), list(path[1:]))


def dvariant(*path: str | int) -> Column:
    return F.try_variant_get(entry(str(path[0])), variant_path(path[1:]), "variant")


def dlist(*path: str | int) -> Column:
    """The elements of an array below details as VARIANTs; empty when there is none."""
    got = F.try_variant_get(entry(str(path[0])), variant_path(path[1:]), "array<variant>")
    return F.coalesce(got, F.array().cast("array<variant>"))


def dbool(*path: str | int) -> Column:
    """A JSON true or false; NULL for anything else, the text "true" included."""
    raw = dvariant(*path)
    return F.when(F.schema_of_variant(raw) == "BOOLEAN", F.try_variant_get(raw, "$", "boolean"))


def present(text: Column) -> Column:
    """Neither NULL nor empty."""
    return F.coalesce(text != "", F.lit(False))


def nonempty(text: Column) -> Column:
    return F.when(text != "", text)


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def as_variant(value: Column) -> Column:
    return value.cast("variant")


def list_variant(value: Column) -> Column:
    """A Spark array as VARIANT; NULL stays NULL."""
    return F.when(value.isNotNull(), F.to_variant_object(value))


def apply_stage(df: DataFrame, stage: Stage) -> DataFrame:
    """Run one stage: rows outside its gate or guard keep their values.

    Two projections per stage: flags and the given details first, so each is computed once per row.
    """
    change = stage.apply(df)
    passed = gate(df, stage.registration)
    active = passed if change.guard is None else passed & F.coalesce(change.guard, F.lit(False))
    original = df.columns
    for names in change.let:
        df = df.select("*", *[c.alias(n) for n, c in names.items()])
    helpers = []
    if change.details:
        pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in change.details.items()])
        helpers.append(F.filter(pairs, lambda p: p["value"].isNotNull()).alias("_given"))
    if change.unset:
        gone = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in change.unset.items()]))
        helpers.append(gone.alias("_gone"))
    df = df.select("*", passed.alias("_passed"), active.alias("_active"), *helpers)

    on = F.col("_active")
    new = {name: F.when(on, c).otherwise(F.col(name)) for name, c in change.columns.items()}
    if change.tags:
        new["tags"] = F.when(on, F.concat("tags", F.array_compact(F.array(*change.tags)))).otherwise(F.col("tags"))
    if helpers:
        out = F.transform("_given", lambda p: p["key"]) if change.details else F.array().cast("array<string>")
        if change.unset:
            out = F.concat(out, "_gone")
        merged = F.map_filter("details", lambda k, v: ~F.array_contains(out, k))
        if change.details:
            merged = F.map_concat(merged, F.map_from_entries("_given"))
        new["details"] = F.when(on, merged).otherwise(F.col("details"))
    if change.drop is not None:
        new["_drop"] = F.col("_drop") | (on & F.coalesce(change.drop, F.lit(False)))
    name = F.array(F.lit(f"{stage.group}_{stage.name}"))
    new["_ran"] = F.when(F.col("_passed"), F.concat("_ran", name)).otherwise(F.col("_ran"))
    return df.select(*[new.get(c, F.col(c)).alias(c) for c in original])
