"""SentencePiece encoding and decoding of merge-type (BPE) models.

The library merges, again and again, the neighbouring symbols whose union is the best piece (highest score, leftmost on a tie).  The same ids come
from a search without a queue of merges: a row of pieces is the encoding if and only if every two neighbours, merged anew from their characters,
come out as these two.  So the longest piece at a place is taken (Aho-Corasick), then the next shorter one, until it is compatible with its left
neighbour; a place from which nothing leads to the end is marked in a bit field and never entered again.

Texts are cut where no piece reaches across: before a run of word marks that follows another character, and around ASCII characters that no piece
has (the vocabulary tells both).  Each different cut is encoded once and kept in a table of limited size; so a text costs one look-up for each word.

Edge cases: null and empty texts have the end id only; texts may be of any length; the mark U+2581 in a text decodes as a blank, as in the
library; characters without a piece become their bytes; rows are encoded one by one, so ids may be missing or repeated; an empty table gives an
empty result; other columns are ignored.  Models with another normaliser, user-defined or unused pieces are refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_steps
from .packed import take_slices

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Cuts longer than this are not kept; the table is emptied when it holds KEPT of them, that of neighbours at PAIRS.
LONGEST_KEPT, KEPT, PAIRS = 48, 300_000, 1_000_000
#: What the library writes for the unknown id.
UNKNOWN_TEXT = " ⁇ "


class Vocabulary:
    """The pieces of one model file, and the encoding of strings over them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if model.trainer_spec.model_type != 2 or spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE} or not model.trainer_spec.byte_fallback:
            raise ValueError(f"{path}: only merge-type models with bytes, one leading mark and no other normalisation")
        self.end_id = model.trainer_spec.eos_id
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_ids = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.text = [p.piece for p in model.pieces]
        self.length = [len(p) for p in self.text]
        self.pairs: dict[int, bool] = {}
        self.cuts: dict[str, bytes] = {}
        self._automaton(model)
        self._cutter()
        self._decoder(model)

    def _automaton(self, model) -> None:
        # a piece that its own characters don't merge into never stands in an encoding
        ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL and self.merged(p.piece) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, i in ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.shorter = [0] * len(self.text)
        for piece, i in ids.items():
            self.shorter[i] = next((ids[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in ids), 0)

    def _cutter(self) -> None:
        single = {c for piece in self.score for c in piece}
        if not single <= set(self.score):
            raise ValueError("a piece has a character that is no piece")
        lone = "".join(re.escape(chr(i)) for i in range(128) if chr(i) not in single and chr(i) != " ")
        within = any(MARK in piece.lstrip(MARK) for piece in self.score)
        self.cut = re.compile(f"[{lone}]|[^{lone}]+" if within else f"[{lone}]|{MARK}+[^{MARK}{lone}]*|[^{MARK}{lone}]+").findall

    def _decoder(self, model) -> None:
        raw = []
        for p in model.pieces:
            if p.type == BYTE:
                raw.append(bytes([int(p.piece[3:-1], 16)]))
            else:
                raw.append({NORMAL: p.piece.replace(MARK, " "), UNKNOWN: UNKNOWN_TEXT, CONTROL: ""}[p.type].encode())
        self.raw = raw
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_length = np.array([len(x) for x in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_length) - self.raw_length
        self.kind = np.array([p.type for p in model.pieces])
        self.marked = np.array([p.type == NORMAL and p.piece.startswith(MARK) for p in model.pieces])

    # --- encoding

    def merged(self, text: str, border: int = 0) -> int:
        """How many symbols the characters merge into; 0 as soon as a merge goes across the border."""
        symbols, score = list(text), self.score
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            if at == border - 1:
                return 0
            if at < border:
                border -= 1
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return len(symbols)

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(self.text[a] + self.text[b], self.length[a]) > 0
        return known

    def search(self, longest: list[int], begin: int, end: int) -> list[int]:
        """The ids of the stretch [begin, end), all of whose characters have pieces."""
        failed = bytearray((end - begin >> 3) + 1)
        length, shorter, compatible = self.length, self.shorter, self.compatible
        out: list[int] = []
        at, piece = begin, longest[begin]
        while at < end:
            to = at + length[piece] - begin
            if begin + to <= end and not failed[to >> 3] >> (to & 7) & 1 and (not out or compatible(out[-1], piece)):
                out.append(piece)
                at = begin + to
                if at < end:
                    piece = longest[at]
                continue
            piece = shorter[piece]
            while not piece:  # nothing leads on from here: take the last piece back and try a shorter one
                failed[at - begin >> 3] |= 1 << (at - begin & 7)
                last = out.pop()
                at -= length[last]
                piece = shorter[last]
        return out

    def encode_cut(self, text: str) -> bytes:
        """The ids of a cut as int32."""
        longest, length = [0] * len(text), self.length
        for last, piece in self.automaton.iter(text):  # by last character, so that a longer piece replaces a shorter one
            longest[last - length[piece] + 1] = piece
        ids: list[int] = []
        begin = 0
        for i in [i for i, piece in enumerate(longest) if not piece] + [len(text)]:
            if i > begin:
                ids += self.search(longest, begin, i)
            if i < len(text):
                ids += [self.byte_ids[b] for b in text[i].encode()]
            begin = i + 1
        return np.array(ids, np.int32).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text as int32, without an end id."""
        if not text:
            return b""
        cuts, out = self.cuts, []
        for cut in self.cut(MARK + text.replace(" ", MARK)):
            ids = cuts.get(cut)
            if ids is None:
                ids = self.encode_cut(cut)
                if len(cut) <= LONGEST_KEPT:
                    if len(cuts) >= KEPT:
                        cuts.clear()
                    cuts[cut] = ids
            out.append(ids)
        return b"".join(out)

    # --- decoding

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of rows of ids; row i has ids[offsets[i] : offsets[i + 1]]."""
        ids = ids[offsets[0] : offsets[-1]]
        sizes = self.raw_length[ids]
        view = take_slices(self.data, self.raw_start[ids], sizes).tobytes()
        upto = np.concatenate([[0], np.cumsum(sizes)])
        spoken = np.concatenate([np.flatnonzero(self.kind[ids] != CONTROL), [len(ids)]])
        first = spoken[np.searchsorted(spoken, offsets[:-1] - offsets[0])]
        out = []
        for f, a, b in zip(first.tolist(), (offsets[:-1] - offsets[0]).tolist(), (offsets[1:] - offsets[0]).tolist(), strict=True):
            skip = int(f < b and self.marked[ids[f]])
            try:
                out.append(view[int(upto[a]) + skip : int(upto[b])].decode())
            except UnicodeDecodeError:
                out.append(self.repaired(ids[a:b].tolist())[skip:])
        return out

    def repaired(self, ids: list[int]) -> str:
        """The text of ids whose bytes are not all UTF-8: each byte that begins no character is U+FFFD."""
        out, run = [], b""
        for i in [*ids, -1]:
            if i >= 0 and self.kind[i] == BYTE:
                run += self.raw[i]
                continue
            while run:
                size = next((n for n in range(1, 5) if one_character(run[:n])), 0)
                out.append(run[:size].decode() if size else "�")
                run = run[size or 1 :]
            if i >= 0:
                out.append(self.raw[i].decode())
        return "".join(out)


def one_character(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(documents: DataFrame, model: str, end: bool = True) -> DataFrame:
    """doc_id, ids of every text; with the end id if ``end``.  model: path of the model file, which every executor has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(model)
        last = np.array([own.end_id], np.int32).tobytes() if end else b""
        for batch in batches:
            for step in text_steps(batch):
                rows = [own.encode(t.as_py() or "") + last for t in step.column("text")]
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in rows])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))
                yield pa.RecordBatch.from_arrays([step.column("doc_id").cast(pa.int64()), ids], names=["doc_id", "ids"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: Column | str, model: str) -> Column:
    """The text of a column of ids; null for null."""

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        own, out = vocabulary(model), []
        filled = batch.fill_null([]) if batch.null_count else batch
        offsets, values = filled.offsets.to_numpy(), filled.values.to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(offsets // (1 << 20))) + 1).tolist(), len(batch)]  # about a million ids at a time
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b > a:
                out += own.decode(values, offsets[a : b + 1].astype(np.int64))
        return pa.array([t if ok else None for t, ok in zip(out, batch.is_valid().to_pylist(), strict=True)], pa.string())

    return run(ids)


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = default_model()
    encoded = encode(read_table(spark, sf_dir, "documents"), model)
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest.alias("ids_sha256"),
        F.sha2(decoded("ids", model), 256).alias("decoded_sha256"),
    )
