"""Near-duplicate documents by MinHash bands, odd sketches and a check on the full shingle sets.

1. Every text becomes its set of hashed word shingles; documents with the same set form a class, and
   the class goes on under its smallest document id.
2. 128 MinHash samples of the set make 32 bands of four. A pair with a likeness of 0.75 shares no band
   with a probability of (1 - 0.75^4)^32 = 5e-6.
3. The samples are also folded into an odd sketch: each flips one of 512 bits. The bits in which two
   sketches differ stem from samples that differ, so their number estimates how many do.
4. In every band bucket all members meet one member of the bucket. Pairs whose sketches allow the
   likeness are confirmed on the full sets, and the links make components.
5. Buckets that still hold several components compare all pairs of different components, in blocks of
   bounded size, by sketches and then by full sets, and return only links that join components.
6. Components of all links.

The sketch bound lets a pair at the limit fail with a probability below 1e-6: of 128 samples, at least
69 agree then, so at most 118 flips differ, which differ in 95 of 512 bits on average (5 deviations: 120).

Defined results: null and empty texts have no shingles and link with nothing; rows are judged by their
text, so repeated rows agree; a row without an id belongs to the group of its text but is not kept, and
brings no links; ties go to the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.columns import fields, with_arrow, with_row_keys
from tillstream.llm.components import components
from tillstream.llm.segments import mix
from tillstream.llm.shingles import shingle_sets
from tillstream.session import stage

SAMPLES, ROWS, BITS = 128, 4, 512
MOST_DIFFERENT = 120
# Shingles of the members of a bucket that meet as many others in one task.
BLOCK = 250_000
_SLICE = 1 << 13


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * SAMPLES + 1))
    values = (seeds >> np.uint64(32)).astype(np.uint32)
    return values[:SAMPLES] | np.uint32(1), values[SAMPLES:]


def min_hashes(hashes: np.ndarray) -> np.ndarray:
    """The least value of a non-empty set of hashes under each permutation."""
    factor, shift = _permutations()
    high = (hashes >> np.uint64(32)).astype(np.uint32)[:, None]
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(high), _SLICE):
        np.minimum(least, (high[a:a + _SLICE] * factor + shift).min(0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One signed 64-bit key for each band; the band's number is part of it."""
    key = np.arange(SAMPLES // ROWS, dtype=np.uint64)
    for column in least.reshape(-1, ROWS).T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """512 bits as eight signed 64-bit numbers; a sample flips the bit that its place and value choose."""
    place = np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32)
    bit = (mix(place | least) % np.uint64(BITS)).astype(np.int64)
    parity = np.bincount(bit, minlength=BITS).astype(np.uint8) & 1
    return np.packbits(parity, bitorder="little").view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the set), bands and sketch of each row."""
    def prepare():
        import xxhash

        def work(column: pa.Array) -> list[pa.Array]:
            counts, keys, bands, sketches = [], [], [], []
            for hashes in shingle_sets(column, size):
                counts.append(len(hashes))
                keys.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                least = min_hashes(hashes) if len(hashes) else None
                bands.append(None if least is None else band_keys(least))
                sketches.append(None if least is None else odd_sketch(least))
            return [pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))]

        return work

    outputs = fields(n_shingles="long", set_key="binary", bands="array<long>", sketch="array<long>")
    return with_arrow(docs.select("doc_id", "text"), ["text"], outputs, prepare).drop("text")


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """cid and the shingle set of each row."""
    def prepare():
        def work(column: pa.Array) -> list[pa.Array]:
            return [pa.array([h.view(np.int64) for h in shingle_sets(column, size)], pa.list_(pa.int64()))]

        return work

    rows = docs.select(F.col("doc_id").alias("cid"), "text")
    return with_arrow(rows, ["text"], fields(shingles="array<long>"), prepare).drop("text")


def _different_bits(a: Column, b: Column) -> Column:
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(BITS // 64)), F.lit(0))


def _block_links(keys: tuple, table: pa.Table) -> pa.Table:
    """Links that join components within one task: rows of a block against those of another one.

    Pairs of one component are passed over, also where a link just found made it one, so a task returns
    fewer links than it has rows.
    """
    left, right, main = (k.as_py() for k in keys[1:])
    cid, label = table["cid"].to_numpy(), table["label"].to_numpy()
    sketch = np.stack(table["sketch"].to_pylist()).astype(np.int64).view(np.uint64)
    sets = [np.sort(np.asarray(s, np.int64)) for s in table["shingles"].to_pylist()]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    block, in_main = table["block"].to_numpy(), table["in_main"].to_numpy(zero_copy_only=False)
    first = np.flatnonzero(~in_main & (block == left))
    second = np.flatnonzero(in_main) if main else np.flatnonzero(~in_main & (block == right))
    same = not main and left == right
    found = []
    for a in first.tolist():
        others = second[(label[second] != label[a]) & ((second > a) | (not same))]
        away = np.bitwise_count(sketch[others] ^ sketch[a]).sum(1)
        others = others[away <= MOST_DIFFERENT]
        if not len(others):
            continue
        flat = np.concatenate([sets[o] for o in others.tolist()])
        at = np.minimum(np.searchsorted(sets[a], flat), sizes[a] - 1)
        starts = np.cumsum(sizes[others]) - sizes[others]
        both = np.add.reduceat((sets[a][at] == flat).astype(np.int64), starts)
        for o in others[100 * both >= _percent(table) * (sizes[a] + sizes[others] - both)].tolist():
            if label[o] != label[a]:
                found.append((min(cid[a], cid[o]), max(cid[a], cid[o])))
                label = np.where(label == label[o], label[a], label)
    return pa.table([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _percent(table: pa.Table) -> int:
    return table["percent"][0].as_py()


def _across_components(shared: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame,
                       percent: int) -> DataFrame:
    """Links (a, b) between members of a bucket that are in different components so far.

    The bucket's largest component is not compared within itself. Its blocks meet those of the other
    members, and these meet each other; a block holds about `BLOCK` shingles.
    """
    known = classes.select("cid", "sketch", "n_shingles")
    members = shared.where("size > 2").select("bucket", "cid").join(
        labels.withColumnRenamed("b", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid")) \
        .join(classes.select("cid", "n_shingles"), "cid")
    kinds = members.groupBy("bucket", "label").agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("weight"))
    totals = kinds.groupBy("bucket").agg(
        F.max(F.struct("rows", "label", "weight")).alias("main"), F.sum("weight").alias("weight"),
        F.count("*").alias("kinds")).where("kinds > 1")

    def blocks(weight: Column) -> Column:
        return F.ceil(weight / BLOCK).cast("int")

    def each(n: Column, made) -> Column:
        return F.transform(F.sequence(F.lit(0), n - 1), made)

    def task(first: Column, second: Column, main: bool) -> Column:
        return F.struct(first.alias("left"), second.alias("right"), F.lit(main).alias("main"))

    placed = members.drop("n_shingles").join(totals, "bucket").select(
        "bucket", "cid", "label", (F.col("label") == F.col("main.label")).alias("in_main"),
        blocks(F.col("main.weight")).alias("n_main"), blocks(F.col("weight") - F.col("main.weight")).alias("n_rest"),
    ).withColumn("block", F.pmod(F.xxhash64("cid"), F.when(F.col("in_main"), F.col("n_main")).otherwise(
        F.col("n_rest"))).cast("int"))
    block, n_main, n_rest = F.col("block"), F.col("n_main"), F.col("n_rest")
    tasks = F.when(F.col("in_main"), each(n_rest, lambda i: task(i, block, True))).otherwise(F.concat(
        each(n_main, lambda j: task(block, j, True)),
        each(n_rest, lambda k: task(F.least(block, k), F.greatest(block, k), False))))
    return placed.select("bucket", "cid", "label", "in_main", "block", F.explode(tasks).alias("task")).join(
        known.drop("n_shingles"), "cid").join(sets, "cid").select(
        "bucket", "task.left", "task.right", "task.main", "cid", "label", "in_main", "block", "sketch", "shingles",
        F.lit(percent).alias("percent"),
    ).groupBy("bucket", "left", "right", "main").applyInArrow(_block_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Rows link where `100 * intersection >= percent * union` of their sets of `size`-word shingles. The
    bands and the sketch bound are laid out for a `percent` of 75 or more.
    """
    if percent < 75:
        raise ValueError("the bands find pairs from a likeness of 0.75 on")
    signed = stage(signatures(docs, size), "signatures")
    classes = stage(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_key").agg(
            F.min("doc_id").alias("cid"), F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
        "classes")

    members = classes.select("cid", F.explode("bands").alias("bucket")).withColumn(
        "draw", F.xxhash64("bucket", "cid"))
    tops = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("draw").alias("top")).where(
        "size > 1")
    shared = stage(members.join(tops, "bucket"), "shared-buckets")

    inside = shared.select("cid").distinct()
    wanted = docs.select("doc_id", "text").join(inside, F.col("doc_id") == F.col("cid"), "left_semi")
    # A class's smallest id may stand in several rows, with the same or with other texts.
    sets = stage(sets_of(wanted, size).where(F.size("shingles") > 0).dropDuplicates(["cid", "shingles"]),
                 "shingle-sets")
    sketches = classes.join(inside, "cid", "left_semi").select("cid", "sketch")

    def confirmed(pairs: DataFrame) -> DataFrame:
        a, b = (sets.select(F.col("cid").alias(k), F.col("shingles").alias(f"set_{k}")) for k in "ab")
        both = F.size(F.array_intersect("set_a", "set_b"))
        return pairs.join(a, "a").join(b, "b").where(
            100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b").distinct()

    pivots = shared.where("draw = top").select("bucket", F.col("cid").alias("pivot"))
    met = shared.join(pivots, "bucket").where("cid <> pivot").select(
        F.least("cid", "pivot").alias("a"), F.greatest("cid", "pivot").alias("b")).distinct()
    sketch_a, sketch_b = (sketches.select(F.col("cid").alias(k), F.col("sketch").alias(f"sketch_{k}"))
                          for k in "ab")
    close = met.join(sketch_a, "a").join(sketch_b, "b").where(
        _different_bits(F.col("sketch_a"), F.col("sketch_b")) <= MOST_DIFFERENT).select("a", "b").distinct()
    links = stage(confirmed(close), "links")
    labels = components(links, "b", "a")

    more = stage(_across_components(shared, labels, classes, sets, percent), "more-links")
    every = components(links.union(more), "b", "a")

    of_class = classes.join(every.withColumnRenamed("b", "cid"), "cid", "left").select(
        "set_key", F.coalesce("label", "cid").alias("reached"))
    return signed.join(of_class, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("reached")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """The documents that `near_duplicates` keeps, each row once.

    Rows without an id, and different texts under one id, are documents of their own. An empty table gives
    an empty one; all columns pass through, whatever their names.
    """
    keyed, key = with_row_keys(docs)
    rows = keyed.select(F.col(key).alias("doc_id"), "text")
    kept = near_duplicates(rows, size, percent).where("kept").select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).select(docs.columns)
