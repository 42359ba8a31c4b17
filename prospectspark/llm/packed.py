"""Exchange of packed strings: what a batch has for one bucket travels as one compressed row to the task of that bucket.

Both substring operators use it.  An entry is a stretch of one document (a super-k-mer) that holds one or more
consecutive windows with the same minimiser; equal windows have equal minimisers, so they meet in one bucket.
What goes back is small: for each document and bucket, the stretches to remove.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, text_steps

BLOB = "bucket int, n int, blob binary"
BLOB_SCHEMA = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("blob", pa.binary())])
#: What goes to the last step: for each part (of the documents, by a hash of doc_id) spans to remove (kind 0) and then texts (kind 1).
PART = "part int, kind int, n int, blob binary"
PART_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("blob", pa.binary())])
SPANS = (("doc", np.int64), ("key", np.uint32), ("begin", np.int32), ("end", np.int32))

#: Entry columns beside the payload, in the order in which they lie in a blob.
FIELDS = (("doc", np.int64), ("key", np.uint32), ("start", np.int32), ("windows", np.int32), ("length", np.int32))
#: For those that need it in the bucket too.
WITH_MINIMISER = (*FIELDS, ("minimiser", np.uint64))
LEVEL = 3


def take_slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of many slices, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.uint8)
    kind = np.int32 if max(len(data), total) < 1 << 31 else np.int64
    shift = np.repeat((starts - (np.cumsum(lengths) - lengths)).astype(kind), lengths)
    shift += np.arange(total, dtype=kind)
    return data[shift]


def pack(entries: dict[str, np.ndarray], data: np.ndarray, at: np.ndarray, buckets: int, fields: tuple = FIELDS) -> Iterator[pa.RecordBatch]:
    """entries: the fields as arrays, with minimiser; at: where in data each payload starts.  One row for each bucket that has entries."""
    n = len(at)
    if not n:
        return
    bucket = (entries["minimiser"] % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, at = bucket[order], at[order]
    cols = {name: np.ascontiguousarray(entries[name][order].astype(kind)) for name, kind in fields}
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [n]])
    press = zstandard.ZstdCompressor(level=LEVEL)
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        payload = take_slices(data, at[a:b], cols["length"][a:b].astype(np.int64))
        out.append((int(bucket[a]), b - a, press.compress(b"".join([*(cols[name][a:b].tobytes() for name, _ in fields), payload.tobytes()]))))
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), BLOB_SCHEMA.types, strict=True)], schema=BLOB_SCHEMA)


def unpack(batches: Iterator[pa.RecordBatch], fields: tuple = FIELDS) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """All entries of one bucket, and their payloads one after another."""
    parts: dict[str, list[np.ndarray]] = {name: [] for name, _ in fields}
    data = []
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        for n, blob in zip(batch.column("n").to_pylist(), batch.column("blob"), strict=True):
            raw, at = press.decompress(blob.as_buffer()), 0
            for name, kind in fields:
                parts[name].append(np.frombuffer(raw, kind, n, at))
                at += n * np.dtype(kind).itemsize
            data.append(np.frombuffer(raw, np.uint8, offset=at))
    if not data:
        return {name: np.zeros(0, kind) for name, kind in fields}, np.zeros(0, np.uint8)
    return {name: np.concatenate(x) for name, x in parts.items()}, np.concatenate(data)


def part_of(doc: np.ndarray, parts: int) -> np.ndarray:
    return (mix(doc.astype(np.int64).view(np.uint64)) % np.uint64(parts)).astype(np.int32)


def removals(doc: np.ndarray, key: np.ndarray, begin: np.ndarray, end: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Stretches [begin, end) to remove, one row for each part of the documents."""
    if not len(doc):
        return
    part = part_of(doc, parts)
    order = np.argsort(part, kind="stable")
    part = part[order]
    cols = [x[order].astype(kind) for x, (_, kind) in zip((doc, key, begin, end), SPANS, strict=True)]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]]).tolist()
    press = zstandard.ZstdCompressor(level=LEVEL)
    out = [(int(part[a]), 0, b - a, press.compress(b"".join(x[a:b].tobytes() for x in cols))) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), PART_SCHEMA.types, strict=True)], schema=PART_SCHEMA)


def runs(flags: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each maximal run of set flags within one owner."""
    idx = np.flatnonzero(flags)
    if not len(idx):
        return idx, idx
    new = np.ones(len(idx), bool)
    new[1:] = (np.diff(idx) != 1) | (owner[idx[1:]] != owner[idx[:-1]])
    first = np.flatnonzero(new)
    return idx[first], idx[np.concatenate([first[1:], [len(idx)]]) - 1]


def with_removals(documents: DataFrame, removed: DataFrame, parts: int, apply: Callable[[pa.RecordBatch, Spans], pa.RecordBatch], schema: str) -> DataFrame:
    """Bring the stretches to the documents and let ``apply`` make the result of each step of documents.

    Texts travel compressed, those of a step for one part together.  A task sees its part's stretches before its texts.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for step in text_steps(batch):
                part = part_of(pc.fill_null(step.column("doc_id"), 0).to_numpy(zero_copy_only=False), parts)
                order = np.argsort(part, kind="stable")
                part = part[order]
                step = step.take(pa.array(order))
                edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
                out = []
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, step.schema) as writer:
                        writer.write_batch(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in step.slice(a, b - a).columns], schema=step.schema))
                    out.append((int(part[a]), 1, b - a, press.compress(sink.getvalue())))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), PART_SCHEMA.types, strict=True)], schema=PART_SCHEMA)

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        found: list[list[np.ndarray]] = [[] for _ in SPANS]
        spans = None
        for batch in batches:
            for kind, n, blob in zip(batch.column("kind").to_pylist(), batch.column("n").to_pylist(), batch.column("blob"), strict=True):
                raw = press.decompress(blob.as_buffer())
                if kind == 0:
                    at = 0
                    for column, (_, type_) in zip(found, SPANS, strict=True):
                        column.append(np.frombuffer(raw, type_, n, at))
                        at += n * np.dtype(type_).itemsize
                    continue
                if spans is None:
                    spans = Spans(found)
                for inner in pa.ipc.open_stream(raw):
                    for step in text_steps(inner):
                        yield apply(step, spans)

    texts = documents.select("doc_id", "text").mapInArrow(send, PART)
    dealt = texts.unionByName(removed).repartitionById(parts, F.col("part")).sortWithinPartitions("kind")
    return dealt.mapInArrow(receive, schema)


class Spans:
    """The stretches of one part's documents, found by doc_id and text key."""

    def __init__(self, columns: list[list[np.ndarray]]):
        doc, key, begin, end = (np.concatenate(x) if x else np.zeros(0, kind) for x, (_, kind) in zip(columns, SPANS, strict=True))
        order = np.lexsort((key, doc))
        self.doc, self.key, self.begin, self.end = doc[order], key[order], begin[order], end[order]

    def flags(self, doc: int | None, key: int, n: int) -> np.ndarray | None:
        """Flags for the n units of a text: those in a stretch; None if there is none."""
        if doc is None:
            return None
        a, b = np.searchsorted(self.doc, [doc, doc + 1]) if doc < (1 << 63) - 1 else (np.searchsorted(self.doc, doc), len(self.doc))
        own = self.key[a:b] == key
        if not own.any():
            return None
        depth = np.zeros(n + 1, np.int32)
        np.add.at(depth, self.begin[a:b][own], 1)
        np.add.at(depth, self.end[a:b][own], -1)
        return np.cumsum(depth[:-1]) > 0
