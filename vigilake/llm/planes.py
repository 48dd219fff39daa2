"""Token ids in binary shards of compressed bit or byte planes.

A shard holds the documents of one range of ids in ascending order. Their ids, one after the other, are cut
into blocks of `block` ids; each block is transposed into planes (all lowest bytes, all second bytes, ... or
all lowest bits, ...) and each plane is compressed with zstandard on its own. Layout:

    MAGIC | planes of block 0 | planes of block 1 | ... | footer | length of footer (8 bytes) | MAGIC

The footer (zstandard, then JSON for sizes and two arrays) has the chunk index, that is per block its offset,
number of ids and the sizes of its planes, and per document its id and number of tokens.

A task writes its shard under a name of its own; only names that the finished tasks have returned enter the
manifest, so what a lost or repeated attempt leaves behind is never read.

Defined cases: a null or empty text has the end id only, equal document ids keep all rows (ordered by text),
null document ids come first, an empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAGIC = b"PLANES01"
MANIFEST = "file string, first_doc long, n_docs long, n_tokens long, n_chunks long, n_bytes long"


def to_planes(ids: np.ndarray, kind: str) -> np.ndarray:
    """(planes, bytes) matrix of a block of unsigned 32-bit ids."""
    by_byte = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if kind == "byte":
        return by_byte
    bits = np.unpackbits(by_byte[:, :, None], axis=2, bitorder="little")  # (4, n, 8)
    return np.packbits(bits.transpose(0, 2, 1).reshape(32, -1), axis=1, bitorder="little")


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        return np.ascontiguousarray(np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)).view("<u4").reshape(-1)
    rows = np.unpackbits(np.stack([np.frombuffer(p, np.uint8) for p in planes]), axis=1, count=n, bitorder="little")
    by_byte = np.packbits(rows.reshape(4, 8, n).transpose(0, 2, 1), axis=2, bitorder="little")[:, :, 0]
    return np.ascontiguousarray(by_byte.T).view("<u4").reshape(-1)


class Writer:
    """One shard; `add` takes documents in order."""

    def __init__(self, out, block: int = 65_536, kind: str = "byte", level: int = 3):
        self.out, self.block, self.kind = out, block, kind
        self.pack = zstandard.ZstdCompressor(level=level)
        self.at, self.waiting, self.n_waiting = len(MAGIC), [], 0
        self.index: list[list[int]] = []
        self.docs: list[int] = []
        self.counts: list[int] = []
        self.nulls: list[int] = []
        out.write(MAGIC)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        if doc is None:
            self.nulls.append(len(self.docs))
        self.docs.append(doc or 0)
        self.counts.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block:
            self._flush(whole=False)

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, "<u4")
        end = len(ids) if whole else len(ids) // self.block * self.block
        for i in range(0, end, self.block):
            part = ids[i : min(i + self.block, end)]
            frames = [self.pack.compress(p.tobytes()) for p in to_planes(part, self.kind)]
            self.index.append([self.at, len(part), *map(len, frames)])
            for f in frames:
                self.out.write(f)
            self.at += sum(map(len, frames))
        self.waiting, self.n_waiting = [ids[end:]], len(ids) - end

    def close(self) -> int:
        self._flush(whole=True)
        head = json.dumps({"kind": self.kind, "block": self.block, "chunks": self.index, "nulls": self.nulls, "n": len(self.docs)}).encode()
        raw = struct.pack("<q", len(head)) + head + np.array(self.docs, "<i8").tobytes() + np.array(self.counts, "<i8").tobytes()
        footer = self.pack.compress(raw)
        self.out.write(footer + struct.pack("<q", len(footer)) + MAGIC)
        return self.at + len(footer) + 8 + len(MAGIC)


def read_footer(f, size: int) -> tuple[dict, list, np.ndarray]:
    f.seek(size - 8 - len(MAGIC))
    tail = f.read(8 + len(MAGIC))
    if tail[8:] != MAGIC:
        raise ValueError("not a shard of planes, or cut off")
    n = struct.unpack("<q", tail[:8])[0]
    f.seek(size - 8 - len(MAGIC) - n)
    raw = zstandard.ZstdDecompressor().decompress(f.read(n))
    h = struct.unpack("<q", raw[:8])[0]
    head = json.loads(raw[8 : 8 + h])
    numbers = np.frombuffer(raw[8 + h :], "<i8")
    docs = numbers[: head["n"]].tolist()
    for i in head["nulls"]:
        docs[i] = None
    return head, docs, numbers[head["n"] :]


def read_chunk(f, head: dict, k: int) -> np.ndarray:
    """The ids of block `k`: reads only its bytes."""
    at, n, *sizes = head["chunks"][k]
    f.seek(at)
    raw, unpack, planes = f.read(sum(sizes)), zstandard.ZstdDecompressor(), []
    at = 0
    for s in sizes:
        planes.append(unpack.decompress(raw[at : at + s]))
        at += s
    return from_planes(planes, n, head["kind"])


def read_docs(f, size: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids) in order, holding one block and the document under way."""
    head, docs, counts = read_footer(f, size)
    held, k = np.zeros(0, "<u4"), 0
    for doc, n in zip(docs, counts.tolist()):
        parts, have = [held], len(held)
        while have < n:
            parts.append(read_chunk(f, head, k))
            have += len(parts[-1])
            k += 1
        ids = np.concatenate(parts) if len(parts) > 1 else held
        yield doc, ids[:n]
        held = ids[n:]


def in_order(df: DataFrame, doc: str = "doc_id", value: str = "text") -> DataFrame:
    """`df`'s documents and values in ranges of ascending ids, each partition sorted."""
    narrow = df.select(F.col(doc).cast("long").alias("doc_id"), F.col(value).alias("value"))
    return narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("value"), "value")


def write_ids(
    ordered: DataFrame, folder: str, encode: Callable[[pa.Array], pa.Array] | None = None, end: int | None = None,
    block: int = 65_536, kind: str = "byte", level: int = 3,
) -> DataFrame:
    """Write (doc_id, value) rows as shards below `folder`, one per partition, and return the manifest.

    `encode` turns an Arrow array of values into lists of ids; without it the values are lists already.
    `end` is appended to each document.
    """
    if kind not in ("byte", "bit"):
        raise ValueError("kind is 'byte' or 'bit'")

    def run(batches):
        place, top = fs.FileSystem.from_uri(folder)
        tail = np.array([] if end is None else [end], "<u4")
        writer, first, tokens = None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                place.create_dir(top, recursive=True)
                name = f"{top}/shard-{uuid.uuid4().hex}.planes"
                out = place.open_output_stream(name)
                writer, first = Writer(out, block, kind, level), batch["doc_id"][0].as_py()
            lists = encode(batch["value"]) if encode else batch["value"]
            flat, ends = np.asarray(lists.values).astype("<u4", copy=False), np.asarray(lists.offsets)
            for i, d in enumerate(batch["doc_id"].to_pylist()):
                ids = np.concatenate([flat[ends[i] : ends[i + 1]], tail])
                tokens += len(ids)
                writer.add(d, ids)
        if writer is not None:
            size = writer.close()
            out.close()
            row = {"file": [name.rsplit("/", 1)[1]], "first_doc": [first], "n_docs": [len(writer.docs)], "n_tokens": [tokens], "n_chunks": [len(writer.index)], "n_bytes": [size]}
            yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("file", pa.string()), *((c, pa.int64()) for c in list(row)[1:])]))

    spark = ordered.sparkSession
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_ids(spark: SparkSession, folder: str, derive: dict[str, tuple[str, Callable]] | None = None) -> DataFrame:
    """Read shards back: doc_id, start (ids before the document), n_tokens, and ids or what `derive` makes of them.

    `derive` maps a column to its Spark type (long or string) and a function of the document's ids, so that
    digests need not move the ids out of the task that reads them.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy(F.col("first_doc").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", "n_bytes", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    derive = derive or {"ids": ("array<long>", lambda x: x.astype(np.int64))}
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    shape = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), *((c, kinds[k]) for c, (k, _) in derive.items())])

    def run(batches):
        place, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with place.open_input_file(f"{top}/{row['file']}") as f:
                    at, rows, held = row["base"], [], 0
                    for doc, ids in read_docs(f, row["n_bytes"]):
                        rows.append({"doc_id": doc, "start": at, "n_tokens": len(ids), **{c: g(ids) for c, (_, g) in derive.items()}})
                        at += len(ids)
                        held += len(ids)
                        if held > 1_000_000 or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=shape)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=shape)

    columns = ", ".join(["doc_id long", "start long", "n_tokens long", *(f"{c} {k}" for c, (k, _) in derive.items())])
    # a task per shard: a number of its own keeps adaptive execution from joining the small rows up again
    return placed.repartition(max(1, manifest.count())).mapInArrow(run, columns)


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
