"""Byte-level BPE of whole texts: cut into pre-tokens, look each distinct one up, encode the rest.

Pre-tokens are encoded independently of each other, so an encoder needs to see each distinct one
only once. The cut is the published pattern of the vocabulary, done with array operations.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np

from tillstream.llm.segments import gather, span_hashes

OTHER, LETTER, NUMBER, SPACE, END = range(5)
_APOSTROPHE, _BLANK = 39, 32
# Longer pre-tokens are encoded without the table: their polynomial hashes are weaker.
_LONG = 512


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point: letter, number, white space, other; one more place ends a text."""
    import regex

    table = np.zeros(0x110001, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(pattern, every):
            table[ord(run.group()[0]):ord(run.group()[-1]) + 1] = kind
    table[0x110000] = END
    return table


def cut(points: np.ndarray) -> np.ndarray:
    """First places of all pre-tokens, and of all text ends, in code points; each text ends in END.

    The pattern in words: a contraction; else a run of letters, numbers or others, with one blank
    before it if there is one; else white space, of which the last character before something else
    stands alone or, if a blank, belongs to what follows.
    """
    kind, n = classes()[points], len(points)
    first = np.ones(n, bool)
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    first |= kind == END
    space = kind == SPACE
    after = np.flatnonzero(space[:-1] & ~space[1:] & (kind[1:] != END)) + 1
    first[after - 1] = True
    first[after[points[after - 1] == _BLANK]] = False
    marks = np.flatnonzero(points == _APOSTROPHE)
    if len(marks):
        # Each text is followed by END, so place -1 of the array is an end as well.
        marks = marks[(kind[marks - 1] != OTHER) & (points[marks - 1] != _BLANK)]
        one, two = points[marks + 1], points[np.minimum(marks + 2, n - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (np.isin(one, [ord(c) for c in "rv"]) & (two == ord("e"))) | (
            (one == ord("l")) & (two == ord("l")))
        first[marks[short | long] + 1] = False
        first[marks[short] + 2] = True
        first[marks[long] + 2] = False
        first[marks[long] + 3] = True
    return np.flatnonzero(first)


class PreTokenEncoder:
    """Token ids of whole texts by an encoder of single pre-tokens, with a bounded table of them.

    `encode` takes a list of distinct pre-tokens and returns a list of id lists. The table is
    emptied when it holds `limit` entries, so memory stays bounded whatever the vocabulary.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 400_000):
        self.encode, self.limit = encode, limit
        self._empty()

    def _empty(self) -> None:
        self.slots: dict[int, int] = {}
        self.starts = np.zeros(1 << 16, np.int64)
        self.lengths = np.zeros(1 << 16, np.int64)
        self.pool = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _learn(self, keys: list[int], ids: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for one in ids for i in one), np.uint32, int(lengths.sum()))
        slot, past = len(self.slots), len(self.slots) + len(keys)
        while past > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
            self.lengths = np.concatenate((self.lengths, np.zeros_like(self.lengths)))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.pool[self.used:self.used + len(flat)] = flat
        self.starts[slot:past] = self.used + np.cumsum(lengths) - lengths
        self.lengths[slot:past] = lengths
        self.slots.update(zip(keys, range(slot, past)))
        self.used += len(flat)

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and the bounds of each text's ids."""
        joined = "".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.full(len(joined) + len(texts), 0x110000, np.uint32)
        inside = np.arange(len(joined)) + np.repeat(np.arange(len(texts)), sizes)
        points[inside] = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(sizes + 1) - 1
        first = cut(points)
        past = np.append(first[1:], len(points))
        is_end = points[first] == 0x110000
        starts, stops = first[~is_end], past[~is_end]
        keys = span_hashes(points, starts, stops)
        far = stops - starts > _LONG
        # Each long pre-token counts as distinct, under a key of its place that no table keeps.
        distinct, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.slots) + len(distinct) > self.limit:
            self._empty()
        slots = self.slots
        found = np.fromiter((slots.get(k, -1) for k in distinct.tolist()), np.int64, len(distinct))
        new = np.flatnonzero(found < 0)
        if len(new):
            at = where[new]
            text_of = np.searchsorted(ends, starts[at])
            shift = text_of
            pieces = [joined[a:b] for a, b in zip((starts[at] - shift).tolist(), (stops[at] - shift).tolist())]
            found[new] = np.arange(len(slots), len(slots) + len(new))
            self._learn(distinct[new].tolist(), self.encode(pieces))
        slot = found[inverse]
        counts = self.lengths[slot]
        begins = self.starts[slot]
        bounds = np.concatenate(([0], np.cumsum(counts)))[
            np.concatenate(([0], np.searchsorted(starts, ends)))]
        ids = self.pool[gather(begins, counts)]
        if far.any():
            return self._with_long(joined, ids, bounds, counts, starts, stops, far, ends)
        return ids, bounds

    def _with_long(self, joined, ids, bounds, counts, starts, stops, far, ends):
        """The same with all long pre-tokens encoded on their own."""
        at = np.flatnonzero(far)
        shift = np.searchsorted(ends, starts[at])
        own = self.encode([joined[a:b] for a, b in zip(
            (starts[at] - shift).tolist(), (stops[at] - shift).tolist())])
        places = np.concatenate(([0], np.cumsum(counts)))
        parts, last = [], 0
        sizes = counts.copy()
        for k, one in zip(at.tolist(), own):
            parts += [ids[last:places[k]], np.asarray(one, np.uint32)]
            last, sizes[k] = places[k + 1], len(one)
        parts.append(ids[last:])
        bounds = np.concatenate(([0], np.cumsum(sizes)))[
            np.concatenate(([0], np.searchsorted(starts, ends)))]
        return np.concatenate(parts), bounds
