"""Document fingerprints: every shingle hash below a fixed fraction of the hash range.

All documents keep hashes by the same threshold, so fingerprints of very unequal documents can be
compared: the share of one's hashes that the other has estimates containment, shared over all estimates
likeness, and the union of two fingerprints is that of the joined sets. A text whose shingles all lie
above the threshold keeps its least hash, so only texts without words have an empty fingerprint.

Everything here is DataFrame functions.

Defined results: null counts as an empty text; texts without words have empty fingerprints, which are
like each other (1) and unlike all others (0); a text of fewer words than a shingle is one shingle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

# One hash in four is kept.
FRACTION = 1 / 4
_WORD_BREAK = r"[\x20\x09-\x0D]+"


def with_fingerprint(df: DataFrame, text: str, name: str, size: int = 5, fraction: float = FRACTION) -> DataFrame:
    """`df` with the column `name`: the sorted distinct hashes that the text keeps, array<long>."""
    limit = int(-(1 << 63) + (1 << 64) * fraction)
    words, hashes = f"{name}__words", f"{name}__hashes"
    cut = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _WORD_BREAK), lambda w: w != "")
    runs = F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0)))
    hashed = F.transform(runs, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    low = F.filter(hashes, lambda h: h < limit)
    # Each step is a projection of its own, so that no array is computed once per element.
    return (
        df.withColumn(words, F.transform(cut, lambda w: F.xxhash64(w)))
        .withColumn(hashes, F.when(F.size(words) > 0, hashed).otherwise(F.array().cast("array<bigint>")))
        .withColumn(name, low)
        .withColumn(name, F.when((F.size(name) > 0) | (F.size(hashes) == 0), F.sort_array(F.array_distinct(name)))
                    .otherwise(F.array(F.array_min(hashes))))
        .drop(words, hashes)
    )


def likeness(a: Column | str, b: Column | str) -> Column:
    """Estimated intersection over union of the shingle sets of two fingerprints."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - shared
    return F.when(every > 0, shared / every).otherwise(F.lit(1.0))


def containment(a: Column | str, b: Column | str) -> Column:
    """Estimated share of the shingles of `a` that `b` has; 1 where `a` has none."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(1.0))


def merged(a: Column | str, b: Column | str) -> Column:
    """The fingerprint of both texts' shingles together."""
    return F.sort_array(F.array_union(a, b))


def as_text(fingerprint: Column | str) -> Column:
    """The hashes as 16 hexadecimal digits each, in order."""
    return F.array_join(F.transform(fingerprint, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(
    docs: DataFrame, key: str, text: str, derive: Callable[[DataFrame], DataFrame], columns: list[str],
) -> DataFrame:
    """`derive(docs)` with `next_<column>`: the values of the row that follows in descending order of `key`.

    After the last row comes the first. Rows are dealt to pieces by quantiles of the key and a window
    finds the next row within a piece; each piece also gets a copy of the first row of the following
    one, which its last row looks up. Equal keys stand in descending order of `text`, null keys last.
    """
    spark = docs.sparkSession
    pieces = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(docs.stat.approxQuantile(key, [i / pieces for i in range(1, pieces)], 1 / (4 * pieces))))
    # Piece 0 has the largest keys, the last one the nulls.
    above = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c > F.col(key))) if cuts else F.lit(0)
    piece = F.when(F.col(key).isNull(), len(cuts) + 1).otherwise(above)
    placed = docs.withColumn("__piece", piece)
    tops = docs.select(key).withColumn("__piece", piece).groupBy("__piece").agg(F.max(key).alias("__top"))
    # One row per piece.
    first = placed.join(F.broadcast(tops), "__piece").where(F.col(key).eqNullSafe(F.col("__top")))
    heads = first.groupBy("__piece").agg(F.max(text).alias(text))
    ring = Window.orderBy(F.col("__piece").desc())
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    copies = heads.select(
        F.coalesce(F.lead("__piece").over(ring), F.first("__piece").over(whole)).alias("__piece"), text)
    following = Window.partitionBy("__piece").orderBy("__copy", F.col(key).desc_nulls_last(), F.col(text).desc_nulls_last())
    every = derive(placed.withColumn("__copy", F.lit(False)).unionByName(
        copies.withColumn("__copy", F.lit(True)), allowMissingColumns=True))
    return every.select(
        "*", *[F.lead(c).over(following).alias(f"next_{c}") for c in columns],
    ).where("NOT __copy").drop("__copy", "__piece")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document against the next one, and against itself with the latter half overwritten by it."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = with_next(texts, "doc_id", "text", lambda rows: with_fingerprint(rows, "text", "kept"), ["text", "kept"])
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = own.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half)))
    both = with_fingerprint(edited.drop("next_text"), "edited", "edited_kept")
    return both.select(
        "doc_id", size.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text("kept").alias("fingerprint"), as_text("edited_kept").alias("edited_fingerprint"),
        likeness("kept", "edited_kept").alias("near_edited"),
        likeness("kept", "next_kept").alias("near_next"),
    )
