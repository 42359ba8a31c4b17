"""Exact dedup by Grace hash partitioning.

Texts are equal when identical after no change.  Of equal texts, the row with the largest doc_id stays.

1. A step (a few MB of rows) sends each distinct text once, with its largest doc_id and its number of rows.  Texts that a step has more than
   once wait for the end of the task, or until they fill ``memory`` bytes, so a large group of copies reaches the shuffle as one row
   for each task.
2. Spark's exchange is the first partitioning: texts meet by a 64-bit hash.  A task reads its bucket; when the texts
   exceed ``memory`` bytes, they go to spill files by the next bits of the hash, and each file is a bucket of its own, and
   so on until a bucket fits.  A bucket that fits fills an open-addressing table (linear probing); an entry with the same hash
   is compared by its complete content.  A text whose copies alone exceed the memory is not split further: the table
   holds it once.
3. Each distinct text gives one row, found again by its SHA-256; the documents join those rows.  A join on a hot text
   is dealt evenly by Spark's skew join, since both sides are plain shuffles.

Edge cases: null counts as empty; rows without doc_id count in group_size and lose against any other; in a group without any
doc_id keep_id is null and all its rows stay; rows that repeat a doc_id all get the same keep_id, and stay together if it is
theirs; a very long text is held once in memory and compared whole; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, shuffle_partitions, text_steps

FAN_OUT_BITS = 4


def larger(a: int | None, b: int | None) -> int | None:
    """The larger doc_id; any beats none."""
    return b if a is None else a if b is None else max(a, b)


class ContentTable:
    """Open addressing with linear probing over 64-bit hashes; equal hashes are told apart by their content."""

    def __init__(self, capacity: int):
        self.size = 1 << max(3, (2 * capacity - 1).bit_length())
        self.slot = [-1] * self.size
        self.rows: list[list] = []  # hash, text, largest doc_id, number of rows

    def add(self, h: int, text: bytes, top: int | None, n: int) -> None:
        at, mask = h & (self.size - 1), self.size - 1
        while (i := self.slot[at]) >= 0:
            row = self.rows[i]
            if row[0] == h and row[1] == text:
                row[2], row[3] = larger(row[2], top), row[3] + n
                return
            at = (at + 1) & mask
        self.slot[at] = len(self.rows)
        self.rows.append([h, text, top, n])
        if 2 * len(self.rows) > self.size:
            self.grow()

    def grow(self) -> None:
        self.size *= 2
        self.slot = [-1] * self.size
        for i, row in enumerate(self.rows):
            at = row[0] & (self.size - 1)
            while self.slot[at] >= 0:
                at = (at + 1) & (self.size - 1)
            self.slot[at] = i


def grace(records: Iterator[tuple[int, bytes, int | None, int]], memory: int, shift: int, folder: str) -> Iterator[list]:
    """One row for each distinct text.  shift: bits of the hash already used."""
    table, used, files = ContentTable(64), 0, None
    for record in records:
        if files is None:
            before = len(table.rows)
            table.add(*record)
            used += (len(record[1]) + 200) * (len(table.rows) > before)
            if used <= memory or len(table.rows) < 2 or shift + FAN_OUT_BITS > 60:
                continue
            files = [open(os.path.join(folder, f"{shift}-{i}"), "w+b") for i in range(1 << FAN_OUT_BITS)]
            for row in table.rows:
                spill(files, shift, tuple(row))
            table = ContentTable(64)
        else:
            spill(files, shift, record)
    if files is None:
        yield from table.rows
        return
    for i, f in enumerate(files):
        f.seek(0)
        inner = os.path.join(folder, f"{shift}-{i}.d")
        os.mkdir(inner)
        yield from grace(spilled(f), memory, shift + FAN_OUT_BITS, inner)
        f.close()
        os.remove(f.name)
        os.rmdir(inner)


def spill(files: list, shift: int, record: tuple[int, bytes, int | None, int]) -> None:
    pickle.dump(record, files[(record[0] >> shift) & ((1 << FAN_OUT_BITS) - 1)], protocol=5)


def spilled(f) -> Iterator[tuple[int, bytes, int | None, int]]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def distinct_texts(documents: DataFrame, memory: int, partitions: int) -> DataFrame:
    """sha256, largest doc_id and number of rows of each distinct text."""
    sent = pa.schema([("h", pa.int64()), ("text", pa.binary()), ("top", pa.int64()), ("n", pa.int64())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a text that a step has more than once is likely to come again: it waits, so that a task sends it once, so long as memory allows
        held: dict[bytes, list[int]] = {}
        used = 0
        for batch in batches:
            for step in text_steps(batch):
                found: dict[bytes, list[int]] = {}
                ids = step.column("doc_id").to_pylist()
                for doc, text in zip(ids, step.column("text").to_pylist(), strict=True):
                    row = found.setdefault((text or "").encode("utf-8", "surrogatepass"), [None, 0])
                    row[0], row[1] = larger(row[0], doc), row[1] + 1
                for text in [t for t, (_, n) in found.items() if n > 1 or t in held]:
                    top, n = found.pop(text)
                    used += (len(text) + 200) * (text not in held)
                    row = held.setdefault(text, [None, 0])
                    row[0], row[1] = larger(row[0], top), row[1] + n
                yield texts_of(found)
                if used > memory:
                    yield texts_of(held)
                    held, used = {}, 0
        yield texts_of(held)

    def texts_of(found: dict[bytes, list[int]]) -> pa.RecordBatch:
        hashes = np.array([xxhash.xxh64_intdigest(t) for t in found], np.uint64).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(list(found), pa.binary()), pa.array([x[0] for x in found.values()], pa.int64()), pa.array([x[1] for x in found.values()], pa.int64())], schema=sent)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple[int, bytes, int | None, int]]:
            for batch in batches:
                for h, text, top, n in zip(batch.column("h").to_pylist(), batch.column("text"), batch.column("top").to_pylist(), batch.column("n").to_pylist(), strict=True):
                    yield h & ((1 << 64) - 1), text.as_py(), top, n

        out = []
        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            for _, text, top, n in grace(records(), memory, 0, folder):
                out.append((hashlib.sha256(text).hexdigest(), top, n))
                if len(out) == 10_000:
                    yield result(out)
                    out = []
        if out:
            yield result(out)

    def result(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names=["text_sha256", "keep_id", "group_size"])

    texts = documents.select("doc_id", "text").mapInArrow(send, "h long, text binary, top long, n long")
    return texts.repartition(partitions, "h").mapInArrow(unite, "text_sha256 string, keep_id long, group_size long")


def exact_dedup(documents: DataFrame, memory: int = 64 << 20, partitions: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    partitions = partitions or 2 * shuffle_partitions(documents.sparkSession)
    classes = distinct_texts(documents, memory, partitions)
    rows = documents.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
    joined = rows.join(classes, "text_sha256")
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


OP10_SQL = """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
 count(*) over (partition by coalesce(text, '')) as group_size,
 doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept, sha256(coalesce(text, '')) as text_sha256
from documents
"""
