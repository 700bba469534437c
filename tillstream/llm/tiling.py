"""Benchmark passages in documents, by greedy string tiling.

Words are runs of letters and digits, in lower case. A document and an item share a seed where a run of
five words has the same running (Karp-Rabin) hash; neighbouring seeds on a diagonal make a match. The
longest match whose words are still free is marked as a tile, again and again, until none of five words
is left; a match that runs into a tile goes on with its free stretches. The share of the item's words
under tiles decides, so a passage that was cut up and put in another order is found like a whole one.

The items are dealt into blocks of bounded size. A block goes to all executors and every document is
held against it where it is read, so documents are never shuffled.

Defined results: null and empty texts match nothing, on either side; an item shorter than five words
must occur whole; among equally long matches the first in the document, then in the item, goes first;
repeated rows of either table give repeated results.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tillstream.llm.columns import with_row_keys
from tillstream.llm.segments import ALPHANUMERIC, chunks
from tillstream.llm.shingles import shingle_hashes, word_hashes

SEED = 5
COVERAGE = 0.5
# Characters of items that are sent to the executors at once.
BLOCK_CHARS = 8_000_000
_SLICE = 100_000
RESULT = ("doc_id long, item_id long, n_words long, n_covered long, coverage double, "
          "tiles array<struct<doc_word: int, item_word: int, length: int>>")


def word_rows(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, row bounds) of each chunk of texts."""
    lower = pc.utf8_lower(column.cast(pa.large_string()))
    for first, _, data, bounds in chunks(lower):
        yield first, *word_hashes(data, bounds, ALPHANUMERIC)


class Items:
    """Benchmark items of one block, with an index of their seeds by seed length."""

    def __init__(self, ids: list, texts: list):
        self.ids, self.words = ids, []
        for _, hashes, rows in word_rows(pa.array(texts, pa.string())):
            self.words += np.split(hashes, rows[1:-1])
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.index = {}
        for length in sorted({min(SEED, n) for n in self.sizes.tolist() if n}):
            own = np.flatnonzero(np.minimum(self.sizes, SEED) == length)
            flat = np.concatenate([self.words[i] for i in own])
            rows = np.concatenate(([0], np.cumsum(self.sizes[own])))
            seeds, at = shingle_hashes(flat, rows, length)
            item = np.repeat(own, np.diff(at))
            place = np.arange(len(seeds)) - np.repeat(at[:-1], np.diff(at))
            order = np.argsort(seeds, kind="stable")
            keys, begins = np.unique(seeds[order], return_index=True)
            seen = np.zeros(1 << 20, bool)
            seen[keys >> np.uint64(44)] = True
            self.index[length] = (keys, np.append(begins, len(seeds)), item[order], place[order], seen)


def _runs(place: np.ndarray, item_place: np.ndarray, length: int) -> np.ndarray:
    """Seeds of a pair as matches: rows of (place in the document, place in the item, words)."""
    order = np.lexsort((place, place - item_place))
    place, item_place = place[order], item_place[order]
    same = (np.diff(place) == 1) & (np.diff(item_place) == 1)
    begins = np.flatnonzero(np.concatenate(([True], ~same)))
    counts = np.diff(np.append(begins, len(place)))
    return np.stack([place[begins], item_place[begins], counts + length - 1], 1)


def _joined(matches: np.ndarray, length: int) -> np.ndarray:
    """Matches found in slices of a document, with those that continue each other made one."""
    order = np.lexsort((matches[:, 0], matches[:, 0] - matches[:, 1]))
    m = matches[order]
    ends = m[:, 0] + m[:, 2]
    on = (np.diff(m[:, 0] - m[:, 1]) == 0) & (m[1:, 0] == ends[:-1] - length + 1)
    begins = np.flatnonzero(np.concatenate(([True], ~on)))
    last = np.append(begins[1:], len(m)) - 1
    return np.stack([m[begins, 0], m[begins, 1], ends[last] - m[begins, 0]], 1)


def tiles(matches: np.ndarray, n_item: int, least: int) -> list[tuple[int, int, int]]:
    """The greedy tiling: (place in the document, place in the item, words) of each tile."""
    heap = [(-n, d, p) for d, p, n in matches.tolist()]
    heapq.heapify(heap)
    marked, taken, found, free = np.zeros(n_item, bool), set(), [], n_item
    while heap and free >= least:
        size, d, p = heapq.heappop(heap)
        open_at = ~marked[p:p - size]
        if taken:
            open_at &= [k not in taken for k in range(d, d - size)]
        if open_at.all():
            found.append((d, p, -size))
            marked[p:p - size] = True
            taken.update(range(d, d - size))
            free += size
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], open_at.astype(np.int8), [0]))))
        for a, b in edges.reshape(-1, 2).tolist():
            if b - a >= least:
                heapq.heappush(heap, (a - b, d + a, p + a))
    return found


def _pairs(items: Items, hashes: np.ndarray, rows: np.ndarray, share: float) -> Iterator[tuple]:
    """(row, item, covered words, tiles) of all rows of a chunk whose tiles cover enough of an item."""
    for length, (keys, begins, item, place, seen) in items.index.items():
        seeds, at = shingle_hashes(hashes, rows, length)
        maybe = np.flatnonzero(seen[seeds >> np.uint64(44)])
        where = np.minimum(np.searchsorted(keys, seeds[maybe]), len(keys) - 1)
        hit = keys[where] == seeds[maybe]
        maybe, where = maybe[hit], where[hit]
        owner = np.searchsorted(at, maybe, "right") - 1
        # A document with fewer words than a seed has one shorter run, which is none.
        whole = np.diff(rows)[owner] >= length
        maybe, where, owner = maybe[whole], where[whole], owner[whole]
        for a, b in zip(*_groups(owner)):
            row, found = int(owner[a]), {}
            for s in range(a, b, _SLICE):
                hits = where[s:min(s + _SLICE, b)]
                counts = begins[hits + 1] - begins[hits]
                flat = np.repeat(begins[hits] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                spot = np.repeat(maybe[s:min(s + _SLICE, b)] - at[row], counts)
                order = np.argsort(item[flat], kind="stable")
                for c, d in zip(*_groups(item[flat][order])):
                    pick = order[c:d]
                    which = int(item[flat[pick[0]]])
                    found.setdefault(which, []).append(_runs(spot[pick], place[flat[pick]], length))
            for which, parts in found.items():
                matches = _joined(np.concatenate(parts), length)
                n = int(items.sizes[which])
                reach = np.zeros(n + 1, np.int64)
                np.add.at(reach, matches[:, 1], 1)
                np.add.at(reach, matches[:, 1] + matches[:, 2], -1)
                if np.count_nonzero(np.cumsum(reach)[:n]) < share * n:
                    continue
                made = tiles(matches, n, length)
                covered = sum(t[2] for t in made)
                if covered >= share * n:
                    yield row, which, covered, made


def _groups(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Bounds of the runs of equal values."""
    if not len(values):
        return [], []
    edges = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))).tolist()
    return edges, edges[1:] + [len(values)]


def matched(docs: DataFrame, benchmark: DataFrame, share: float = COVERAGE) -> DataFrame:
    """Every pair of a document and an item whose tiles cover at least `share` of the item's words."""
    spark = docs.sparkSession
    total = benchmark.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS) or 1
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    results = []
    for block in range(blocks):
        rows = benchmark.where(own == block).where("text IS NOT NULL").select("item_id", "text").collect()
        shared = spark.sparkContext.broadcast(
            Items([r.item_id for r in rows], [r.text for r in rows]) if rows else None)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                ids, out = batch.column(0).cast(pa.int64()).to_pylist(), []
                for first, hashes, at in word_rows(batch.column(1)) if items else ():
                    for row, which, covered, made in _pairs(items, hashes, at, share):
                        n = int(items.sizes[which])
                        out.append((ids[first + row], items.ids[which], n, covered, covered / n, [
                            {"doc_word": d, "item_word": p, "length": k} for d, p, k in sorted(made)]))
                tile = pa.list_(pa.struct([(k, pa.int32()) for k in ("doc_word", "item_word", "length")]))
                kinds = [pa.int64()] * 4 + [pa.float64(), tile]
                columns = zip(*out) if out else [[]] * 6
                names = ["doc_id", "item_id", "n_words", "n_covered", "coverage", "tiles"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        results.append(docs.select("doc_id", "text").mapInArrow(run, RESULT))
    return reduce(DataFrame.unionByName, results)


def decontaminated(docs: DataFrame, benchmark: DataFrame, share: float = COVERAGE) -> DataFrame:
    """The documents that hold no item.

    Rows without an id, and different texts under one id, are judged on their own. Empty tables give all
    documents back, or none; all columns pass through, whatever their names.
    """
    keyed, key = with_row_keys(docs)
    rows = keyed.select(F.col(key).alias("doc_id"), "text")
    leaks = matched(rows, benchmark, share).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(leaks, key, "left_anti").select(docs.columns)
