"""What the corpus operators share: session settings, tables in the shared folder, text batches and word tables."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Java and Python spelling of one word: a run without blanks and control white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"

#: Bytes of text that one step of the vectorised code holds at a time; a longer document makes a step of its own.
STEP_BYTES = 4 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

U64 = np.uint64


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a folder of our own only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"/tmp/spark-checkpoint-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options or {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- batches of texts ------------------------------------------------------------------------------------------------


def text_steps(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices whose texts have about STEP_BYTES bytes; every row is in exactly one."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cut = (np.cumsum(lengths) - 1) // STEP_BYTES
    edges = np.flatnonzero(np.diff(cut)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, one after another, and the n + 1 offsets; null counts as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def text_keys(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """CRC-32 of each text: tells rows apart that repeat a doc_id with another text."""
    view = memoryview(np.ascontiguousarray(data))
    return np.fromiter((zlib.crc32(view[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)), np.int64, len(offs) - 1)


# --- hashing ---------------------------------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 steps)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_FACTORS: dict[int, np.ndarray] = {}


def factors(seed: int, n: int) -> np.ndarray:
    """n odd factors without a rule between them, so that no pair of contents collides by its form, as powers of one base would allow."""
    have = _FACTORS.get(seed)
    if have is None or len(have) < n:
        have = mix(np.arange(1, max(n, 64) + 1, dtype=U64) * U64(seed)) | U64(1)
        if n <= 1 << 16:
            _FACTORS[seed] = have
    return have[:n]


def hash_slices(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int) -> np.ndarray:
    """64 bits of each slice: a multilinear hash over its bytes with one factor for each place, then mixed with the length.  Two contents of one
    length collide with a probability of 2 ** -57 for each seed.  The slices lie one after another, none empty."""
    if not len(start):
        return np.zeros(0, U64)
    factor = factors(seed, int(length.max()))
    out = np.empty(len(start), U64)
    step = start // STEP_BYTES  # a few MB at a time: eight bytes stand for each byte here
    edges = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(step)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        begin, end = int(start[a]), int(start[b - 1] + length[b - 1])
        own = start[a:b] - begin
        at = np.arange(end - begin, dtype=np.int32) - np.repeat(own.astype(np.int32), length[a:b])
        values = data[begin:end].astype(U64)
        values *= factor[at]
        out[a:b] = np.add.reduceat(values, own)
    return mix(out ^ (length.astype(U64) * U64(0x9E3779B97F4A7C15)))


@dataclass
class Words:
    """The words of some documents.  data: the words, each followed by one blank; start, length: of each word in data; first: n + 1 word numbers, where each document begins."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def doc(self) -> np.ndarray:
        """For each word the number of its document in the step."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, seed: int) -> np.ndarray:
        """64 bits of each word."""
        return hash_slices(self.data, self.start, self.length + 1, seed)


def words_of(data: np.ndarray, offs: np.ndarray, lower: bool = False, separator: np.ndarray = _SEPARATOR) -> Words:
    """Split the documents' bytes at the separator bytes (all ASCII, so UTF-8 sequences stay whole)."""
    n = len(offs) - 1
    if not len(data):
        return Words(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64))
    if lower:
        data = np.where((data >= 0x41) & (data <= 0x5A), data + np.uint8(32), data)
    inside = ~separator[data]
    breaks = np.zeros(len(data) + 1, bool)
    breaks[offs[(offs > 0)]] = True  # a word never runs from one document into the next
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | breaks[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | breaks[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    length = end - start
    at = np.cumsum(length + 1) - (length + 1)
    out = np.full(int(length.sum()) + len(length), 0x20, np.uint8)
    place = np.ones(len(out), bool)
    place[at + length] = False
    out[place] = data[inside]
    return Words(out, at, length, np.searchsorted(start, offs))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours; len(x) - width + 1 values."""
    if len(x) < width:
        return x[:0]
    done, out = 1, x
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < width:
        k = width - done
        out = np.minimum(out[:-k], out[k:])
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, .. of each range, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.arange(total) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
