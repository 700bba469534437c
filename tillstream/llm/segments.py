"""Vectorised cutting and hashing of text, shared by the operators that work on Arrow batches.

A chunk is the concatenation of whole texts as one numeric array, so that a handful of numpy passes
serves many short texts or one long one. Nothing here depends on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Any odd multiplier works; its powers and their inverses are built once per process.
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
CHUNK = 1 << 18

_powers = _inverses = np.ones(1, np.uint64)


def _ladder(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, for at least `length` places."""
    global _powers, _inverses
    if len(_powers) < length:
        size = 1 << (length - 1).bit_length()
        for name, base in (("_powers", _MULTIPLIER), ("_inverses", pow(_MULTIPLIER, -1, 1 << 64))):
            steps = np.full(size, base & _MASK, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)
    return _powers, _inverses


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of a well-known hash)."""
    h = values.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of `values`, equal for equal contents wherever they stand.

    One running sum serves all spans: the polynomial of a span is a difference of two sums, moved
    back to place zero. Lengths enter the hash, so that zero values count.
    """
    powers, inverses = _ladder(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers[:len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + (ends - starts).astype(np.uint64))


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past-last row, bytes, row bounds) of consecutive rows with about `limit` bytes.

    A row is never cut, so one longer text makes a chunk of its own. Null counts as empty.
    """
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, at, data = column.buffers()
    rows = len(column)
    if not rows:
        return
    bounds = np.frombuffer(at, np.int64)[column.offset:column.offset + rows + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, flat[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first]
        first = last


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z in lower case; all other bytes stay."""
    return _LOWER[data]


NOT_SPACE = ~_SPACE
# ASCII letters and digits, and all bytes of other characters.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words(data: np.ndarray, bounds: np.ndarray, of: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a chunk, and where each row's words begin.

    A word is a run of bytes that `of` admits; by default `[^\\x20\\x09-\\x0D]+`. The third array has a
    place for each row and one more: row i owns words[third[i]:third[i + 1]].
    """
    inside = of[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    # A row boundary cuts a word where neither side of it is white space.
    borders = bounds[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    opens[borders] |= inside[borders]
    closes = np.zeros(len(data) + 1, bool)
    closes[1:] = inside
    closes[1:-1] &= ~inside[1:]
    closes[borders] |= inside[borders - 1] if len(borders) else False
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    return starts, ends, np.searchsorted(starts, bounds)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all places of ragged pieces, piece after piece."""
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return shift + np.arange(total)
