"""Detection on streams: sliding counts with a watermark, and the detection cycle on a clock."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigilake.operators.detect import key_value
from vigilake.operators.query import criteria_column
from vigilake.operators.tick import StateFolder, run_tick
from vigilake.sources.rules import Rule


def sliding_alerts(events: DataFrame, rule: Rule, slide: str = "1 minute", delay: str | None = "5 minutes") -> DataFrame:
    """Windows of the rule's lookback, moved by `slide`, whose count reaches the threshold.

    Works on batch and streaming input. On a stream `delay` is how late an event may come; later ones are
    dropped, and a window is reported once when it can no longer change.
    """
    rows = events.withWatermark("utctimestamp", delay) if events.isStreaming and delay else events
    value = key_value(rows, rule)
    hit = rows.filter(criteria_column(rows, rule.criteria) & value.isNotNull())
    counted = hit.groupBy(
        F.window("utctimestamp", f"{rule.lookback_minutes} minutes", slide).alias("w"), value.alias("value")
    ).agg(F.count(F.lit(1)).alias("event_count"))
    return counted.filter(F.col("event_count") >= rule.limit).select(
        F.lit(rule.alert_name).alias("alert_name"), F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "value", "event_count",
    )


def detection_clock(
    clock: DataFrame, read_table: Callable[[], DataFrame], rules: Callable[[], Sequence[Rule]], state: StateFolder,
    checkpoint: str, trigger: dict | None = None, publish: Callable[[DataFrame], None] | None = None, **options,
) -> StreamingQuery:
    """Run one detection cycle per micro-batch of `clock` (a rate stream): rules, deadman, sequences.

    Tables and rules are read anew each cycle. `publish` takes the heartbeat message back into ingest.
    """

    def beat(batch: DataFrame, _: int) -> None:
        out = run_tick(read_table(), rules(), state, datetime.now(timezone.utc).replace(tzinfo=None), **options)
        if publish:
            publish(out["heartbeat"])

    writer = clock.writeStream.foreachBatch(beat).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()
