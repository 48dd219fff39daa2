"""Text search that reads only the files a text can be in.

For each file of the event table the index holds a bitmap of the trigrams (three bytes of the lower-cased text)
of its searchable columns, a bitmap per task that read of it. A text that stands in a file has all its
trigrams in one of the file's bitmaps; files without such a bitmap are not opened, the others are searched as
ever, so the result is that of the scan. The index is a kept view: it follows the table's log of commits, and
folders it does not know yet are searched whole.

Defined cases: texts under three bytes name every file; nulls have no trigrams; a text in no file gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.operators.kept import FOLDER, KeptView, ViewKind
from vigilake.operators.query import log_search
from vigilake.schema import EVENT_SCHEMA
from vigilake.sources.manifest import ORIGIN
from vigilake.sources.tables import as_datetime, prepare_write

BITS = 20  # of a bitmap's size: 128 KB each
FACTOR = np.uint64(2_654_435_761)


def places(raw: bytes) -> np.ndarray:
    """Where a text's trigrams stand in a bitmap."""
    x = np.frombuffer(raw, np.uint8).astype(np.uint64)
    if len(x) < 3:
        return np.zeros(0, np.int64)
    tri = (x[:-2] << np.uint64(16)) | (x[1:-1] << np.uint64(8)) | x[2:]
    return ((tri * FACTOR & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - BITS)).astype(np.int64)


def _bitmaps(rows: DataFrame) -> DataFrame:
    """file, bits and the table's folder, a row per file and task, of rows with file, text and folder."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def out():
            keys = list(held)
            columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.string()))]
            bits = pa.array([np.packbits(held[k]).tobytes() for k in keys], pa.binary())
            held.clear()
            return pa.RecordBatch.from_arrays([*columns, bits], names=["file", *FOLDER, "bits"])

        for b in batches:
            files, texts = b["file"].to_pylist(), b["text"].cast(pa.binary())
            keys = list(zip(files, b["event_date"].to_pylist(), b["ingest_batch"].to_pylist()))
            at = 0
            while at < len(keys):  # rows of one file come together
                to = at
                while to < len(keys) and keys[to] == keys[at]:
                    to += 1
                seen = held.setdefault(keys[at], np.zeros(1 << BITS, bool))
                # a line end between texts adds trigrams that are not there, which costs a file read and no result
                seen[places(b"\n".join(t for t in texts[at:to].to_pylist() if t is not None))] = True
                at = to
            if len(held) > 64:
                yield out()
        if held:
            yield out()

    shape = "file string, event_date string, ingest_batch string, bits binary"
    return rows.mapInArrow(run, shape).withColumn("event_date", F.col("event_date").cast("date"))


@dataclass(frozen=True)
class _Files(ViewKind):
    def partial(self, events: DataFrame) -> DataFrame:
        return _bitmaps(self.rows(events))


def _texts(events: DataFrame) -> DataFrame:
    text = F.concat_ws("\n", F.lower("summary"), F.lower(F.to_json("details")))
    file = F.col("_metadata.file_path") if "ingest_batch" in events.columns and events.inputFiles() else F.lit("")
    return events.select(file.alias("file"), F.col("event_date").cast("string").alias("event_date"), F.col("ingest_batch").cast("string").alias("ingest_batch"), text.alias("text"))


FILES = _Files(rows=_texts, keys=("file",), first=dict, again=None, merged=lambda kind, partials: partials)


class TextIndex(KeptView):
    """The index, kept below `path`, of the event table at `events`."""

    def __init__(self, spark: SparkSession, events: str, path: str):
        super().__init__(spark, events, path, FILES)

    def files(self, text: str, since: datetime | str, until: datetime | str) -> tuple[list[str], int]:
        """(files and folders to search, number of files left out) of the days from `since` to `until`."""
        first, last = as_datetime(since).date().isoformat(), (as_datetime(until).date() + timedelta(days=1)).isoformat()
        wanted = places(text.lower().encode())

        @F.arrow_udf("boolean")
        def has(bits: pa.Array) -> pa.Array:
            return pa.array([bool(np.unpackbits(np.frombuffer(b, np.uint8))[wanted].all()) for b in bits.to_pylist()], pa.bool_())

        found = self.partials(first, last).groupBy("file").agg(F.max(has("bits")).alias("hit")).collect()
        known, live = {e.batch for e in self.own.state().live.values()}, self.events.state().live
        unknown = [f"{self.events.path}/{f}" for f, e in live.items() if f not in known and first <= e.day.split("=", 1)[1] < last]
        # the index may lag behind: files of folders that no longer count are passed over
        counted = [r for r in found if "/".join(r["file"].split("/")[-3:-1]) in live]
        return sorted(r["file"] for r in counted if r["hit"]) + sorted(unknown), sum(not r["hit"] for r in counted)

    def search(self, text: str, since: datetime | str, until: datetime | str, source: str | None = None) -> DataFrame:
        """`query.log_search` over the table, reading only the files the text can be in."""
        names, _ = self.files(text, since, until)
        if names:
            rows = self.spark.read.option("basePath", self.events.path).parquet(*names).drop("ingest_batch", ORIGIN)
        else:
            rows = prepare_write(self.spark.createDataFrame([], EVENT_SCHEMA))
        return log_search(rows, since, until, source, text)
