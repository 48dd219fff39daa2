"""Continuous ingest: raw messages to the event table."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigilake.operators.kept import KeptView
from vigilake.operators.normalize import normalize
from vigilake.sources.messages import as_raw_log, decode_envelope
from vigilake.sources.manifest import FAN, Manifest
from vigilake.sources.tables import finalise_record, prepare_write


def drop_repeats(events: DataFrame, delay: str = "10 minutes", key: str = "eventid") -> DataFrame:
    """Redelivered messages: one event per id among those that arrived within `delay`.

    The watermark runs on the time of arrival, so an event that is late by its own time is never lost; only
    a repeat that arrives after `delay` is taken for new.
    """
    arrived = events.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
    return arrived.dropDuplicatesWithinWatermark([key]).drop("_arrived")


def plain_messages(raw: DataFrame) -> DataFrame:
    """Messages without an envelope: `text` and `problem`. A line that is no JSON at all is a log line of its own."""
    value = F.trim(F.col("value").cast("string"))
    doc = F.try_parse_json(value)
    is_object = value.startswith("{")  # of a text that parses; the kind of a deep document is not asked for, as that recurses
    meant = value.rlike(r"^[\[{]")  # begins like JSON but is cut or broken
    text = F.when(doc.isNull() & ~meant & (value != ""), as_raw_log(value)).otherwise(value)
    problem = F.when(doc.isNull() & (meant | (value == "")) | value.isNull(), "not readable as JSON").when(doc.isNotNull() & ~is_object, "not a JSON object")
    return raw.withColumns({"text": text, "problem": problem})


def ingest(
    raw: DataFrame,
    table: str,
    checkpoint: str,
    quarantine: str | None = None,
    enveloped: bool = False,
    trigger: dict | None = None,
    dedup: str | None = None,
    compact: int | None = FAN,
    kept: Sequence[KeptView] = (),
    **options,
) -> StreamingQuery:
    """Normalise a stream of messages in `value` and append it to the event table.

    Every row becomes an event, a row of `quarantine` (what cannot be decoded, read or written back as JSON),
    or, with `dedup` (a time span), counts as a repeat. A batch counts once the table's log names it: what one
    that died half-way has left is never read, and a batch that is replayed after its commit is not written
    again. Small folders of a day are joined up as they gather (`compact` of a tier; None: never), and the views in
    `kept` follow after each batch. Ids derive
    from the message and, where the source gives one, its position, so a replay repeats them.
    """
    position = [c for c in ("topic", "partition", "offset") if c in raw.columns]
    decoded = decode_envelope(raw) if enveloped else plain_messages(raw)
    decoded = decoded.withColumn("value", F.col("value").cast("string")).withColumn("text", F.when(F.col("problem").isNull(), F.col("text")))
    rows = normalize(decoded, "text", id_from=["text", *position], keep_unreadable=["value", "problem"], **options)
    if dedup:
        rows = rows.withColumn("_key", F.when(F.col("unreadable"), F.concat(F.lit("!"), F.sha2("value", 256))).otherwise(F.col("eventid")))
        rows = drop_repeats(rows, dedup, "_key").drop("_key")
    log = Manifest(raw.sparkSession, table)
    named: list[str] = []

    def stream(session: SparkSession) -> str:
        """The id Spark has given the checkpoint: another one, even at the same place, has another id."""
        if not named:
            named.append(json.loads(session.read.text(f"{checkpoint}/metadata").first()[0])["id"])
        return named[0]

    def sink(batch: DataFrame, number: int) -> None:
        name = stream(batch.sparkSession)
        batch.persist()  # decoded once, written to two places
        try:
            if quarantine:
                why = F.coalesce("problem", F.lit("cannot be written back as JSON")).alias("problem")
                batch.filter("unreadable").select("value", why).write.mode("overwrite").json(f"{quarantine}/ingest_batch={name}-{number}")
            log.write_batch(prepare_write(finalise_record(batch.filter(~F.col("unreadable")))), name, number)
            if compact:
                log.compact(compact)
            for view in kept:
                view.refresh()
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
