"""Byte-level BPE encoding and decoding through a sentencepiece model made from a rank file.

The rank file lists byte strings by merge rank. Each becomes a piece, its bytes written as the usual
printable stand-ins, with the negative rank as score: sentencepiece merges the best-scored pair first,
leftmost on ties, which is the order of the ranks. The model is serialised directly; nothing is
trained. The normaliser is the identity, so pieces see exactly the bytes.

Texts are cut by the vocabulary's pattern and every pre-token is encoded on its own. Decoding maps ids
back to pieces and their stand-ins back to bytes.

Defined results: null and empty texts have no ids and decode to no bytes; texts of any length are
taken whole; equal rows have equal results; columns of the input pass through, one named like an output
is replaced.
"""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.columns import fields, with_arrow
from tillstream.llm.pretokens import PreTokenEncoder
from tillstream.llm.segments import gather

NORMAL, UNKNOWN, BPE_MODEL = 1, 2, 2
# Texts are encoded in groups of about so many characters; so many distinct pre-tokens are remembered.
GROUP, TABLE = 1 << 18, 200_000


@lru_cache(maxsize=1)
def stand_ins() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one after U+00FF."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranked = sorted((int(rank), base64.b64decode(word)) for word, rank in pairs)
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError(f"{path}: ranks are not 0 to {len(ranked) - 1}")
    return [word for _, word in ranked]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protocol-buffer field: varint, 32-bit float or length-delimited bytes."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialised_model(words: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; the unknown piece has the next id."""
    shown = stand_ins()
    pieces = [
        _field(1, "".join(shown[b] for b in word).encode()) + _field(2, float(-rank)) + _field(3, NORMAL)
        for rank, word in enumerate(words)
    ]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, UNKNOWN))
    none = (1 << 64) - 1  # -1: the model has no such control piece
    trainer = (_field(3, BPE_MODEL) + _field(4, len(pieces)) + _field(40, len(words))
               + _field(41, none) + _field(42, none) + _field(43, none))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


class Vocabulary:
    """Decodes: the byte string of each id, from the model's pieces by the inverse of the stand-ins."""

    def __init__(self, path: str):
        back = {s: b for b, s in enumerate(stand_ins())}
        stored = [bytes(back[c] for c in piece) for piece in pieces(path)]
        self.lengths = np.fromiter(map(len, stored), np.int64, len(stored))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.pool = np.frombuffer(b"".join(stored), np.uint8)

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4").astype(np.int64)
        if len(numbers) and numbers.max() >= len(self.lengths):
            raise ValueError(f"no such token id: {numbers.max()}")
        return self.pool[gather(self.starts[numbers], self.lengths[numbers])].tobytes()


class Encoder:
    """Encodes texts with the sentencepiece model of one rank file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(read_ranks(path)))
        self._map = str.maketrans({chr(b): s for b, s in enumerate(stand_ins())})
        # A pre-token that is itself in the vocabulary is that entry, also where merges stop earlier.
        mapped = pieces(path)
        merged = self.model.encode(mapped, out_type=int, num_threads=1)
        self.whole = {mapped[i]: [i] for i, ids in enumerate(merged) if ids != [i]}

    def table(self) -> PreTokenEncoder:
        """An empty table of pre-tokens; a task has one of its own, which goes when it ends."""
        return PreTokenEncoder(self._encode, TABLE)

    def _encode(self, found: list[str]) -> list[list[int]]:
        mapped = [p.encode().decode("latin-1").translate(self._map) for p in found]
        ids = self.model.encode(mapped, out_type=int, num_threads=1)
        return [self.whole.get(m, i) for m, i in zip(mapped, ids)] if self.whole else ids

    def encode(self, texts: list[str], table: PreTokenEncoder | None = None) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        table = table or self.table()
        out, first = [], 0
        while first < len(texts):
            size, last = 0, first
            while last < len(texts) and (size < GROUP or last == first):
                size += len(texts[last])
                last += 1
            ids, bounds = table.texts(texts[first:last])
            flat, at = ids.astype("<u4").tobytes(), (bounds * 4).tolist()
            out += [flat[a:b] for a, b in zip(at, at[1:])]
            first = last
        return out


def pieces(path: str) -> list[str]:
    """The model's pieces by id: the ranked byte strings in stand-ins."""
    shown = stand_ins()
    return ["".join(shown[b] for b in word) for word in read_ranks(path)]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of a rank file, built once per process."""
    return Encoder(path)


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """The decoder of a rank file, built once per process."""
    return Vocabulary(path)


def encode(df: DataFrame, ranks: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the token ids of each text as little-endian unsigned 32-bit integers, a binary column."""
    def prepare():
        own = encoder(ranks)
        table = own.table()
        return lambda column: [pa.array(
            own.encode(pc.fill_null(column, "").to_pylist(), table), pa.binary())]

    return with_arrow(df, [text], fields(**{ids: "binary"}), prepare)


def decode(df: DataFrame, ranks: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`df` with the bytes that the ids stand for; null ids give no bytes."""
    def prepare():
        own = vocabulary(ranks)
        return lambda column: [pa.array(
            [own.decode(i) for i in pc.fill_null(column, b"").to_pylist()], pa.binary())]

    return with_arrow(df, [ids], fields(**{decoded: "binary"}), prepare)


def round_trip_digests(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    encoded = encode(docs.select("doc_id", "text"), ranks).drop("text")
    return decode(encoded, ranks).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
