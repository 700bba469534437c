"""A bitmap of 64-bit hashes, of one size whatever their number, to drop most rows before a shuffle.

Rows that pass may be false hits, more of them the fuller the map; none that belongs is dropped, so what
follows must hold exactly for the rows that pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: 16 MB, gathered as slices.
_BITS, _SLICE = 27, 16


def hash_map(hashes: DataFrame) -> np.ndarray:
    """The map of the hashes in the first column of a frame; null isn't one."""
    name = hashes.columns[0]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - _BITS)
            part = (at >> np.uint64(_SLICE)).astype(np.int64)
            for k in np.unique(part).tolist():
                bits = slices.setdefault(k, np.zeros(1 << _SLICE, bool))
                bits[(at[part == k] & np.uint64((1 << _SLICE) - 1)).astype(np.int64)] = True
        for k, bits in slices.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())],
                names=["part", "bits"])

    parts = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = hashes.where(F.col(name).isNotNull()).repartition(parts, F.shiftrightunsigned(name, 64 - _BITS + _SLICE))
    bits, width = np.zeros(1 << (_BITS - 3), np.uint8), 1 << (_SLICE - 3)
    for batch in dealt.mapInArrow(mark, "part int, bits binary").toArrow().to_batches():  # each slice once
        for k, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            bits[k * width:(k + 1) * width] |= np.frombuffer(own, np.uint8)
    return bits


def in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the map."""
    at = hashes >> np.uint64(64 - _BITS)
    return bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
