"""Sets of hashed word shingles of whole texts, chunk by chunk."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tillstream.llm.segments import NOT_SPACE, chunks, lowered, mix, span_hashes, words

_STEP = np.uint64(0x9DDFEA08EB382D69)


def word_hashes(data: np.ndarray, bounds: np.ndarray, of: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words of a chunk, and where each row's words begin."""
    starts, ends, rows = words(data, bounds, of)
    return span_hashes(lowered(data), starts, ends), rows


def shingle_hashes(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words within a row, in order, and where each row's runs begin.

    A row with fewer words has the whole of them as its only run; a row without words has none.
    """
    counts = np.diff(rows)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate(([0], np.cumsum(runs)))
    owner = np.repeat(np.arange(len(counts)), runs)
    first = rows[owner] + np.arange(bounds[-1]) - bounds[owner]
    length = np.minimum(counts, size)[owner]
    found = mix(length.astype(np.uint64))
    for k in range(size):
        inside = k < length
        word = hashes[np.where(inside, first + k, 0)] if len(hashes) else found
        found = np.where(inside, mix(found * _STEP + word), found)
    return found, bounds


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; null counts as empty."""
    for _, _, data, bounds in chunks(column):
        found, at = shingle_hashes(*word_hashes(data, bounds), size)
        for a, b in zip(at.tolist(), at[1:].tolist()):
            yield np.unique(found[a:b])
