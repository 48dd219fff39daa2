"""Helpers shared by the catalog modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.session import configure
from vigilake.sources.sample import AS_OF, duck_events, sec_events

__all__ = ["AS_OF", "events", "flat", "duck", "ts"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return sec_events(spark, sf_dir)


def flat(df: DataFrame) -> DataFrame:
    """Result types both engines share: zone-free timestamps, arrays as joined text, no VARIANT."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind == "variant":
            continue
        c = F.col(f"`{f.name}`")
        if kind == "timestamp":
            c = c.cast("timestamp_ntz")
        elif kind == "array<string>":
            c = F.array_join(c, ",")
        elif kind == "int":
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def duck(body: str) -> str:
    """`body` with the canonical events available as `ev`."""
    with_, select = body.split("---", 1) if "---" in body else ("", body)
    return f"WITH ev AS (\n{duck_events()}\n){', ' + with_.strip() if with_.strip() else ''}\n{select.strip()}"


def ts(text: str = AS_OF) -> str:
    return f"TIMESTAMP '{text}'"
