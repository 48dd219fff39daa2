"""Picking rows of groups that may hold a third of the table: the first ones, the newest one, ranks.

Running values, as-of matches and sessions are in `plans.ranges`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int | Column, ceiling: int) -> DataFrame:
    """The first `n` rows of each group, marked `rn`.

    `row_number() <= ceiling` lets Spark keep only `ceiling` rows per group in each map task before the
    shuffle, so a hot group costs no more than a cold one. `n` may be a column (per-rule numbers).
    """
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    kept = df.withColumn("rn", rn).filter(F.col("rn") <= ceiling)
    return kept if isinstance(n, int) else kept.filter(F.col("rn") <= n)


def latest(df: DataFrame, keys: list[str], order: list[str], columns: list[str] | None = None) -> DataFrame:
    """The newest row per key. `max` of a struct combines map-side, no per-key sort is needed."""
    rest = columns or [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in [*order, *rest]])


def ranked(df: DataFrame, keys: list[str], buckets: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Position of each row in its group, counted from 1, without sorting a group in one task.

    `buckets` are columns that sort before `order` and split a group; rows are numbered inside a bucket
    and shifted by the size of the buckets before it. Only bucket sizes are summed over a whole group.
    """
    sizes = df.groupBy(*keys, *buckets).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inner = Window.partitionBy(*keys, *buckets).orderBy(*order)
    numbered = df.withColumn("_in", F.row_number().over(inner))
    return numbered.join(offsets, [*keys, *buckets]).withColumn(name, F.col("_in") + F.col("_off")).drop("_in", "_off")
