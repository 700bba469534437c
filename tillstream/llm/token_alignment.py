"""How two tokenizers cut the same texts: tokens linked by the bytes they share, pairs of ids counted over the corpus.

1. Both vocabularies encode space + text; ids are staged as packed numbers, a text to a row. Texts whose tokens don't
   give back these bytes have no tokens.
2. Per Arrow batch: lists are flattened with their parent indices; a cumulative sum of byte lengths, less its value where the
   document begins, gives each token's end; a full outer hash join (Acero) of both tables on the document-end key
   holds every end once. In order of ends, filled backwards, each row is a link: the two tokens that share these bytes.
   Rows that both sides have end a group.
3. `Table.group_by` counts the documents of each id pair within a batch; Spark adds the batches up.
4. The counts return to the documents in blocks of `pairs` id pairs, as sorted arrays; each block is one pass over the staged
   ids, whose results are sums.

A batch is the most that a task holds, and one text at least. Defined results: null and empty texts, and texts that do not round-trip, have
zeros and '' for the digest; every row counts as a document, whatever its id; strings of special tokens are plain text;
extra columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.segments import gather
from tillstream.llm.token_files import Encoder
from tillstream.session import stage

#: Id pairs with their counts that a task holds at once.
PAIRS = 4_000_000
#: Characters of texts that are encoded and linked at once.
GROUP = 1 << 21


class Vocabulary:
    """The bytes of every id, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)

    def gives(self, ids: np.ndarray, bounds: np.ndarray, wanted: list[bytes]) -> np.ndarray:
        """Whether the ids between bounds give back the wanted bytes, text by text."""
        ends = np.concatenate(([0], np.cumsum(self.sizes[ids])))[bounds]
        made = self.pool[gather(self.starts[ids], self.sizes[ids])]
        same = np.diff(ends) == np.fromiter(map(len, wanted), np.int64, len(wanted))
        for i in np.flatnonzero(same).tolist():
            same[i] = made[ends[i]:ends[i + 1]].tobytes() == wanted[i]
        return same


@lru_cache(maxsize=1)
def byte_level(path: str) -> tuple[Encoder, Vocabulary]:
    """A tokenizers file of byte-level BPE."""
    encoder = Encoder(path, plain=True)
    # Printable bytes stand for themselves, all others for the code points from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
    words = [encoder.library.id_to_token(i) or "" for i in range(encoder.library.get_vocab_size())]
    return encoder, Vocabulary([bytes(byte_of.get(c, 63) for c in w) for w in words])


@lru_cache(maxsize=1)
def pieces(path: str):
    """A sentencepiece model, which puts a space in front of each text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    tokens = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
              else model.id_to_piece(i).replace("▁", " ").encode() for i in ids]
    return model, Vocabulary(tokens)


def encoded(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row, doc_id, a, b: the ids of both vocabularies as packed 16-bit numbers; staged."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (a_model, a_words), (b_model, b_words) = byte_level(os.fspath(a_path)), pieces(b_path)
        for batch in batches:
            texts, first = batch.column(2).fill_null("").to_pylist(), 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (size < GROUP or last == first):
                    size += len(texts[last])
                    last += 1
                own = texts[first:last]
                a, a_at = a_model.texts([" " + t if t else "" for t in own])
                lists = b_model.encode(own, num_threads=1)
                b_at = np.concatenate(([0], np.cumsum([len(v) for v in lists])))
                b = np.fromiter((i for v in lists for i in v), np.int64, int(b_at[-1]))
                wanted = [b" " + t.encode() if t else b"" for t in own]
                good = a_words.gives(a, a_at, wanted) & b_words.gives(b, b_at, wanted)
                packed = [[v[x:y].astype("<u2").tobytes() if g else b"" for x, y, g in zip(at.tolist(), at[1:].tolist(), good)]
                          for v, at in ((a, a_at), (b, b_at))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first),
                     *(pa.array(v, pa.binary()) for v in packed)], names=["row", "doc_id", "a", "b"])
                first = last

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return stage(rows.mapInArrow(encode, "row long, doc_id long, a binary, b binary"), "token-ids")


def _listed(column: pa.Array) -> pa.LargeListArray:
    """Packed numbers as lists."""
    raw = column.to_pylist()
    at = np.concatenate(([0], np.cumsum([len(v) // 2 for v in raw])))
    return pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), pa.array(np.frombuffer(b"".join(raw), "<u2").astype(np.int32)))


def _ends(lists: pa.LargeListArray, sizes: np.ndarray, name: str) -> pa.Table:
    """key, the document and the place of a token's last byte in it, and the token."""
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    sums = pc.cumulative_sum(pc.take(pa.array(sizes), flat))
    before = pa.array(np.concatenate(([0], sums.to_numpy()))[lists.offsets.to_numpy()[:-1]])
    ends = pc.subtract(sums, pc.take(before, parent))
    return pa.table({"key": pc.add(pc.shift_left(parent, pa.scalar(32, pa.int64())), ends), name: flat})


def links(a: pa.Array, b: pa.Array, a_sizes: np.ndarray, b_sizes: np.ndarray) -> pa.Table:
    """doc, a, b, a_ends, b_ends: the linked tokens of a batch in order, and which of them ends there; with both, a group ends."""
    left, right = _ends(_listed(a), a_sizes, "a"), _ends(_listed(b), b_sizes, "b")
    met = left.join(right, keys=["key"], join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
    # Both sides have the last end of each document, so nothing comes from the next one.
    return pa.table({"doc": pc.shift_right(met["key"], pa.scalar(32, pa.int64())), "a": pc.fill_null_backward(met["a"]),
                     "b": pc.fill_null_backward(met["b"]), "a_ends": pc.is_valid(met["a"]), "b_ends": pc.is_valid(met["b"])})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches again, in slices of about GROUP ids."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("a")).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(batch):
            last = int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + GROUP, "right"))
            last = min(max(last, first + 1), len(batch))
            yield batch.slice(first, last - first)
            first = last


def pair_counts(ids: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """a, b, n, best: the documents in which an id pair is linked, and whether no pair of its A id has more."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_sizes, b_sizes = byte_level(a_path)[1].sizes, pieces(b_path)[1].sizes
        for batch in _blocks(batches):
            found = links(batch.column("a"), batch.column("b"), a_sizes, b_sizes)
            each = found.group_by(["doc", "a", "b"], use_threads=False).aggregate([])
            part = each.group_by(["a", "b"], use_threads=False).aggregate([("doc", "count")]).select(["a", "b", "doc_count"])
            yield from part.rename_columns(["a", "b", "n"]).to_batches()

    counted = stage(ids.mapInArrow(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "id-pairs")
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    return counted.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


class _Counts:
    def __init__(self, table: pa.Table):
        key = table["a"].to_numpy().astype(np.uint32) << np.uint32(16) | table["b"].to_numpy().astype(np.uint32)
        order = np.argsort(key)
        self.key, self.n = key[order], table["n"].to_numpy()[order]
        self.best = table["best"].to_numpy()[order]


def _written(found: pa.Table, batch: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    """How many groups each document has, and the groups written out."""
    ends = np.flatnonzero(pc.and_(found["a_ends"], found["b_ends"]).to_numpy())
    sides = []
    for side in ("a", "b"):
        at = np.concatenate(([0], np.cumsum(found[f"{side}_ends"].to_numpy())[ends]))
        ids = pc.cast(_listed(batch.column(side)).values, pa.string())
        sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), ids), ","))
    groups = pc.binary_join_element_wise(*sides, "|")
    at = np.searchsorted(found["doc"].to_numpy()[ends], np.arange(len(batch) + 1))
    return np.diff(at), pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), groups), ";").to_pylist()


_SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _scored(ids: DataFrame, a_path: str, b_path: str, counts, first: bool) -> DataFrame:
    """What one block of counts adds to each document; the first one also what needs no counts."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_sizes, b_sizes = byte_level(a_path)[1].sizes, pieces(b_path)[1].sizes
        known = counts.value
        for batch in _blocks(batches):
            found = links(batch.column("a"), batch.column("b"), a_sizes, b_sizes)
            doc = found["doc"].to_numpy()
            key = found["a"].to_numpy().astype(np.uint32) << np.uint32(16) | found["b"].to_numpy().astype(np.uint32)
            at = np.minimum(np.searchsorted(known.key, key), max(len(known.key) - 1, 0))
            hit = known.key[at] == key if len(known.key) else np.zeros(len(key), bool)
            total, best = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
            total[hit], best[hit] = known.n[at[hit]], known.best[at[hit]]
            bounds = np.searchsorted(doc, np.arange(len(batch) + 1))
            summed = [np.diff(np.concatenate(([0], np.cumsum(v)))[bounds]) for v in (best, total)]
            zero = np.zeros(len(batch), np.int64)
            n_groups, digests = zero, [""] * len(batch)
            n_a = n_b = n_links = zero
            if first:
                n_a, n_b = (pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False) // 2 for c in ("a", "b"))
                n_links = np.diff(bounds)
                n_groups, text = _written(found, batch)
                digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in text]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"),
                 *(pa.array(v, pa.int64()) for v in (n_a, n_b, n_groups, n_links, *summed)), pa.array(digests, pa.string())],
                names=["row", "doc_id", *_SUMS, "groups_sha256"])

    schema = "row long, doc_id long, " + ", ".join(f"{c} long" for c in _SUMS) + ", groups_sha256 string"
    return ids.mapInArrow(score, schema)


def aligned(docs: DataFrame, a_path: str, b_path: str, pairs: int = PAIRS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of `docs`."""
    spark = docs.sparkSession
    ids = encoded(docs, a_path, b_path, doc_id, text)
    counts = stage(pair_counts(ids, a_path, b_path), "id-pair-counts")
    # Blocks of whole A ids; the numbers of pairs of each one are as many as the vocabulary.
    sizes = counts.groupBy("a").agg(F.count("*").alias("n")).orderBy("a").toArrow()
    at = np.cumsum(sizes["n"].to_numpy()) // max(pairs, 1)
    cuts = np.flatnonzero(np.diff(at)) + 1
    first = [0, *sizes["a"].to_numpy()[cuts].tolist()]
    made = []
    for low, high in zip(first, [*first[1:], 1 << 16]):
        block = _Counts(counts.where((F.col("a") >= low) & (F.col("a") < high)).toArrow())
        made.append(_scored(ids, a_path, b_path, spark.sparkContext.broadcast(block), not made))
    if len(made) == 1:
        return made[0].drop("row")
    whole = made[0]
    for more in made[1:]:
        whole = whole.union(more)
    return whole.groupBy("row", "doc_id").agg(
        *(F.sum(c).alias(c) for c in _SUMS), F.max("groups_sha256").alias("groups_sha256")).drop("row")
