"""Running values over ordered groups of any length: ranges of rows with carries.

Rows are sorted in ranges of (key, order), so a key that holds most rows lies in many ranges and no task
sorts more than one. Inside a range a window gives the running value; what a range starts with, the carry, is the
running value over the summaries of its key's earlier ranges. Only ranges that go on with a key another one
began have a carry, fewer than there are ranges, so the carries are few whatever the data. Unlike blocks of
time, ranges follow the rows: a look back over years costs what one over minutes does.

Defined cases: rows with equal order are in one range; null keys are a key; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilake.session import materialise

AT, RANGE = "_at", "_range"


def laid_out(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """The rows in ranges of (keys, order), written with their number (AT) and that of their range (RANGE)."""
    by = [*keys, *order]
    ranged = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    placed = ranged.sortWithinPartitions(*by).withColumn(AT, F.monotonically_increasing_id())
    return materialise(placed.withColumn(RANGE, F.shiftrightunsigned(AT, 33)), "ranges")


def places(ordered: DataFrame, name: str = "position") -> DataFrame:
    """The place of each row of a table that is in order already, from 1."""
    laid = materialise(ordered.withColumn(AT, F.monotonically_increasing_id()).withColumn(RANGE, F.shiftrightunsigned(AT, 33)), "ranges")
    sizes = laid.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n"), F.min(AT).alias("_low"))
    # as many rows as there are ranges
    before = F.coalesce(F.sum("_n").over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select(RANGE, (before - F.col("_low") + 1).alias("_shift"))
    return laid.join(shifts, RANGE).withColumn(name, F.col(AT) + F.col("_shift")).drop(AT, RANGE, "_shift")


def _equal(a: DataFrame, b: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[n].eqNullSafe(b[n]) for n in names])


def carried(laid: DataFrame, keys: Sequence[str], values: dict[str, tuple[str, Column]], before: bool = False) -> DataFrame:
    """Add running values of `laid_out` rows: name -> ('sum' or 'max', column), up to the row (`before`: without it).

    A sum starts at 0, a maximum (of anything that has an order, structs too) at null; nulls are passed over.
    """
    pick = {"sum": F.sum, "max": F.max}
    rows = laid.withColumns({f"_v_{n}": c for n, (_, c) in values.items()})
    parts = rows.groupBy(*keys, RANGE).agg(*[pick[how](f"_v_{n}").alias(f"_c_{n}") for n, (how, _) in values.items()])
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carries = parts.select(*keys, RANGE, *[pick[how](f"_c_{n}").over(earlier).alias(f"_c_{n}") for n, (how, _) in values.items()])
    carries = carries.filter(reduce(lambda a, b: a | b, [F.col(f"_c_{n}").isNotNull() for n in values]))
    inner = Window.partitionBy(*keys, RANGE).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    run = rows.select("*", *[pick[how](f"_v_{n}").over(inner).alias(f"_i_{n}") for n, (how, _) in values.items()])
    met = run.join(carries, _equal(run, carries, [*keys, RANGE]), "left").select(run["*"], *[carries[f"_c_{n}"] for n in values])
    out = {}
    for n, (how, _) in values.items():
        i, c = F.col(f"_i_{n}"), F.col(f"_c_{n}")
        out[n] = F.coalesce(i, F.lit(0)) + F.coalesce(c, F.lit(0)) if how == "sum" else F.greatest(i, c)
    return met.withColumns(out).drop(*[f"_{x}_{n}" for n in values for x in "vic"])


def rolling_count(df: DataFrame, keys: list[str], ts: str, seconds: int, name: str, ranges: int | None = None) -> DataFrame:
    """For each row: rows of the same key in the `seconds` up to and including it.

    The rows up to an instant less those before the window's begin: both are running counts, one read where
    the row is and one at a mark laid at its window's begin.
    """
    points = df.filter(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("_n"))
    here = F.unix_micros(F.col(ts))
    marks = F.array(
        F.struct((here - seconds * 1_000_000).alias("at"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n")),
        F.struct(here.alias("at"), F.lit(1).alias("kind"), F.col("_n").alias("n")),
    )
    both = points.select(*keys, ts, F.explode(marks).alias("_m")).select(*keys, ts, F.col("_m.at").alias("_pos"), F.col("_m.kind").alias("_kind"), F.col("_m.n").alias("_n"))
    run = carried(laid_out(both, keys, ["_pos", "_kind"], ranges), keys, {"_total": ("sum", F.col("_n"))})
    of = lambda kind: F.max(F.when(F.col("_kind") == kind, F.col("_total")))
    counted = run.groupBy(*keys, ts).agg((of(1) - of(0)).alias(name))
    return df.join(counted, [*keys, ts])


def last_before(
    left: DataFrame, right: DataFrame, keys: list[str], ts: str, within_seconds: int, carry: list[str], ranges: int | None = None
) -> DataFrame:
    """As-of join: each left row gets the latest right row of its key at or before it, if close enough.

    Adds `matched_ts` and the columns named in `carry`; left rows without a match are dropped. Of several right
    rows at one instant the smallest by the carried columns counts.
    """
    reduced = right.groupBy(*keys, ts).agg(F.min(F.struct(*carry)).alias("_c"))
    r = reduced.select(*keys, ts, F.lit(0).alias("_side"), F.struct(F.unix_micros(ts).alias("at"), F.col(ts).alias("ts"), F.col("_c").alias("c")).alias("_right"))
    l = left.select(*keys, ts, F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"))
    laid = laid_out(r.unionByName(l, allowMissingColumns=True), keys, [ts, "_side"], ranges)
    found = carried(laid, keys, {"_match": ("max", F.col("_right"))}).filter("_side = 1")
    near = F.unix_micros(F.col(ts)) - F.col("_match.at") <= within_seconds * 1_000_000
    return found.filter(near).select("_left.*", F.col("_match.ts").alias("matched_ts"), *[F.col(f"_match.c.{c}").alias(c) for c in carry])


def sessionize(
    df: DataFrame, keys: list[str], ts: str, gap_seconds: int,
    sums: dict[str, Column] | None = None, mins: dict[str, Column] | None = None, maxs: dict[str, Column] | None = None, ranges: int | None = None,
) -> DataFrame:
    """Gap sessions per key: a new session starts when more than `gap_seconds` pass without a row.

    Sessions are found inside each range. Only the first and the last of a range can go on in another one:
    those are joined up over the ranges, and as there are two per range and key, that is small work for any
    key. Returns keys, session_start, session_end, rows and the named aggregates.
    """
    sums, mins, maxs = sums or {}, mins or {}, maxs or {}
    gap = gap_seconds * 1_000_000
    flat = df.select(*keys, F.col(ts).alias("_ts"), *[c.alias(n) for n, c in {**sums, **mins, **maxs}.items()])
    merged = [F.sum(n).alias(n) for n in sums] + [F.min(n).alias(n) for n in mins] + [F.max(n).alias(n) for n in maxs]
    # equal timestamps are one point: combine them before anything is sorted
    points = laid_out(flat.groupBy(*keys, "_ts").agg(F.count(F.lit(1)).alias("rows"), *merged), keys, ["_ts"], ranges)
    inner = Window.partitionBy(*keys, RANGE).orderBy(AT)
    fresh = F.when(F.unix_micros("_ts") - F.lag(F.unix_micros("_ts")).over(inner) <= gap, 0).otherwise(1)
    numbered = points.withColumn("_new", fresh).withColumn("_no", F.sum("_new").over(inner))
    totals = [F.sum("rows").alias("rows"), *merged]
    span = [F.min("_ts").alias("_start"), F.max("_ts").alias("_end")]
    parts = numbered.groupBy(*keys, RANGE, "_no").agg(*span, *totals)
    last = F.max("_no").over(Window.partitionBy(*keys, RANGE))
    parts = materialise(parts.withColumn("_edge", (F.col("_no") == 1) | (F.col("_no") == last)), "sessions")

    over = Window.partitionBy(*keys).orderBy("_start")
    edges = parts.filter("_edge")
    fresh = F.when(F.unix_micros("_start") - F.lag(F.unix_micros("_end")).over(over) <= gap, 0).otherwise(1)
    edges = edges.withColumn("_new", fresh).withColumn("_session", F.sum("_new").over(over))
    joined = edges.groupBy(*keys, "_session").agg(F.min("_start").alias("session_start"), F.max("_end").alias("session_end"), *totals).drop("_session")
    within = parts.filter("NOT _edge").select(*keys, F.col("_start").alias("session_start"), F.col("_end").alias("session_end"), "rows", *sums, *mins, *maxs)
    return joined.unionByName(within)
