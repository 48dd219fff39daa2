"""Reading and writing the event table, and keyed snapshots for small state tables."""

from __future__ import annotations

import uuid
import warnings
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.functions.jsonfn import lift
from vigilake.plans.blocked import latest
from vigilake.sources.manifest import ORIGIN, Manifest
from vigilake.schema import (
    DEFAULT_LOOKBACK_MINUTES, EVENT_SCHEMA, MAX_LOOKBACK_MINUTES, RETENTION_DAYS, SHELL_STRING_DEFAULTS,
)


def as_datetime(value: datetime | str) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(str(value))


def ts_lit(value: datetime | str) -> Column:
    """A UTC timestamp literal."""
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp")


def clamp_minutes(minutes: object, default: int = DEFAULT_LOOKBACK_MINUTES, top: int = MAX_LOOKBACK_MINUTES) -> int:
    """Anything that is not a number gives the default; numbers are kept within 1..top."""
    try:
        number = int(minutes)  # type: ignore[call-overload]
    except (TypeError, ValueError):
        return default
    return max(1, min(number, top))


def within(df: DataFrame, since: datetime | str, until: datetime | str | None = None, closed: bool = False) -> DataFrame:
    """Rows from `since` on (and before `until`; up to and including it when `closed`).

    Spark does not derive a partition filter from one on `utctimestamp`, so the day bound is added.
    """
    cond = F.col("utctimestamp") >= ts_lit(since)
    if until is not None:
        end = ts_lit(until)
        cond = cond & ((F.col("utctimestamp") <= end) if closed else (F.col("utctimestamp") < end))
    if "event_date" in df.columns:
        cond = cond & (F.col("event_date") >= F.lit(as_datetime(since).date()))
        if until is not None:
            cond = cond & (F.col("event_date") <= F.lit(as_datetime(until).date()))
    return df.filter(cond)


def scan_events(df: DataFrame, as_of: datetime | str, minutes: object = DEFAULT_LOOKBACK_MINUTES, closed: bool = False) -> DataFrame:
    """The trailing window a rule or ad-hoc query reads; `closed` also hides rows later than `as_of`.

    It is no longer than the table's retention; a longer one asked for is warned about.
    """
    end, used = as_datetime(as_of), clamp_minutes(minutes)
    if isinstance(minutes, int) and minutes > used:
        warnings.warn(f"a window of {minutes} minutes was asked for, the retention holds {used}", stacklevel=2)
    since = end - timedelta(minutes=used)
    return within(df, since, end if closed else None, closed=closed)


def scan_window(df: DataFrame, since: datetime | str, until: datetime | str) -> DataFrame:
    """Half-open window, oldest first."""
    return within(df, since, until).orderBy("utctimestamp", "eventid")


def read_events_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Newline JSON of events as a `doc` VARIANT plus its text; blank lines are skipped."""
    text = F.trim(F.col("value"))
    return (
        spark.read.text(path).filter(text != "")
        .select(text.alias("value"), F.try_parse_json(text).alias("doc"))
    )


def finalise_record(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Project the nine table columns with their defaults."""
    now = F.current_timestamp() if now is None else now
    cols = {"utctimestamp": F.coalesce(F.col("utctimestamp").cast("timestamp"), now)}
    for name, default in SHELL_STRING_DEFAULTS.items():
        cols[name] = F.coalesce(F.col(name), F.lit(default))
    empty = F.array().cast("array<string>")
    cols["tags"] = F.coalesce(F.col("tags"), empty)
    cols["plugins"] = F.coalesce(F.col("plugins"), empty)
    cols["details"] = F.coalesce(F.col("details"), F.parse_json(F.lit("{}")))
    return df.select(*[cols[f.name].alias(f.name) for f in EVENT_SCHEMA])


def prepare_write(df: DataFrame) -> DataFrame:
    """The table layout: shell, VARIANT, lifted columns, day."""
    return lift(df).withColumn("event_date", F.to_date("utctimestamp"))


def write_events(df: DataFrame, path: str, mode: str = "append", batch: str = "none") -> None:
    """Append events, one folder per day and below it one per batch; a table with a log gets a commit.

    Rebalanced by day: adaptive execution splits a busy day over many tasks and files of the advisory
    partition size and joins up quiet ones, so a small micro-batch does not leave many small files.
    """
    log = Manifest(df.sparkSession, path)
    if mode == "append" and log.exists():
        log.write_batch(prepare_write(df), f"write-{uuid.uuid4().hex}", 0)
        return
    out = prepare_write(df).hint("rebalance", "event_date").withColumn("ingest_batch", F.lit(batch))
    out.sortWithinPartitions("event_date", "utctimestamp").write.mode(mode).partitionBy("event_date", "ingest_batch").parquet(path)


def forget_batch(spark: SparkSession, path: str, batch: str) -> int:
    """Remove what an unfinished run of a batch has left in the table; returns the number of folders."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(f"{path}/event_date=*/ingest_batch={batch}")
    fs = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    left = fs.globStatus(found) or []
    for status in left:
        fs.delete(status.getPath(), True)
    return len(left)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The event table as it stands: what its log of commits names, or all folders where it has none."""
    log = Manifest(spark, path)
    if not log.exists():
        return spark.read.parquet(path).drop("ingest_batch")
    found = log.read()
    if found is None:
        return prepare_write(spark.createDataFrame([], EVENT_SCHEMA))
    return found.drop("ingest_batch", ORIGIN)


def live_partitions(df: DataFrame, as_of: datetime | str, days: int = RETENTION_DAYS) -> DataFrame:
    """Events still inside retention; pruned to whole day folders."""
    oldest = (as_datetime(as_of) - timedelta(days=days)).date()
    day = F.col("event_date") if "event_date" in df.columns else F.to_date("utctimestamp")
    return df.filter(day >= F.lit(oldest))


def expire_partitions(spark: SparkSession, path: str, as_of: datetime | str, days: int = RETENTION_DAYS) -> list[str]:
    """Delete day folders that left retention; returns their names. Only folder names are listed."""
    oldest = (as_datetime(as_of) - timedelta(days=days)).date().isoformat()
    log = Manifest(spark, path)
    if log.exists():
        log.expire(oldest)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("event_date=") and name.split("=", 1)[1] < oldest:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


def upsert(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Keyed latest-wins union: rows of `changes` replace rows of `current` with the same key."""
    kept = current.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes, allowMissingColumns=True)


def delete_keys(current: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return current.join(gone.select(key), key, "left_anti")


def write_snapshot(df: DataFrame, folder: str, version: int) -> str:
    """Write one version of a state table; readers switch by version, nothing is overwritten."""
    path = f"{folder}/v{version:010d}"
    df.write.mode("errorifexists").parquet(path)
    return path


__all__ = [
    "as_datetime", "ts_lit", "clamp_minutes", "within", "scan_events", "scan_window", "read_events_jsonl",
    "finalise_record", "prepare_write", "write_events", "forget_batch", "read_events", "live_partitions", "expire_partitions",
    "upsert", "delete_keys", "write_snapshot", "latest",
]
