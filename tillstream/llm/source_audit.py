"""How sources of a language differ in their words: terms counted through distinct chunks of text.

1. A chunk is a run of bytes other than white space (0x20, 0x09 to 0x0D). Each document's chunks are sorted
   within its row, so that documents and occurrences of (language, source, chunk) are sums, made in
   partial aggregates; a frequent chunk reaches its reducer as a row for each task and group.
2. Every chunk that the collection holds is cut into terms once: runs of characters other than ASCII ones that
   aren't letters, only A-Z lower-cased. No term crosses white space. The terms are joined back to the groups' chunks.
3. A document that has a term in several chunks counts once. The sum over chunks is the most, the largest chunk's
   number in each source the least that a term's documents can be. Only terms for which `least` lies between are
   counted by document: their chunks, found by a bitmap and then a join, are rare ones by that very rule.
4. Each language keeps the terms of at least `least` of its documents. Sources are compared by their shares of
   them in billionths, all in whole numbers. Terms that one of two sources or both lack enter through the number of terms with
   each count, so that only terms in both are joined.

Defined results: null text, lang and source count as ''; a group without terms, and a language without kept terms,
are compared like others (value 0 without kept terms); every row counts as a document, whatever its id, equal
rows too; extra columns are left out; an empty table gives an empty result; equal values go by the item's UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.llm.hash_map import hash_map, in_map
from tillstream.llm.segments import chunks, span_hashes, words
from tillstream.session import stage

LEAST, TOP = 10, 10
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_SPACE = r"[\x20\x09-\x0D]+"


def terms_of(chunk: Column) -> Column:
    """The terms of a chunk, with repeats."""
    return F.regexp_extract_all(F.translate(chunk, _UPPER, _UPPER.lower()), F.lit(_TERM), F.lit(0))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))


def chunk_counts(texts: DataFrame) -> DataFrame:
    """lang, source, chunk, documents, occurrences."""
    marked = F.expr("transform(chunks, (x, i) -> struct(x AS chunk, i = 0 OR chunks[i - 1] <> x AS first))")
    each = texts.select("lang", "source", F.sort_array(F.split("text", _SPACE)).alias("chunks")).select(
        "lang", "source", F.inline(marked)).where("chunk <> ''")
    return each.groupBy("lang", "source", "chunk").agg(
        F.count_if("first").alias("documents"), F.count("*").alias("occurrences"))



def _by_document(texts: DataFrame, sought: DataFrame) -> DataFrame:
    """lang, term, documents of the (lang, chunk, term) in `sought`, each document counted once a term."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [span_hashes(data, bounds[:-1], bounds[1:]) for _, _, data, bounds in chunks(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["hash"])

    bits = texts.sparkSession.sparkContext.broadcast(
        hash_map(sought.select("chunk").distinct().mapInArrow(hashed, "hash long")))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, lang = batch.column(0), batch.column(1)
            for low, _, data, bounds in chunks(batch.column(2)):
                starts, ends, at = words(data, bounds)
                hit = np.flatnonzero(in_map(bits.value, span_hashes(data, starts, ends)))
                row = pa.array(low + np.searchsorted(at, hit, "right") - 1)
                own = [data[a:b].tobytes().decode() for a, b in zip(starts[hit].tolist(), ends[hit].tolist())]
                yield pa.RecordBatch.from_arrays([doc.take(row), lang.take(row), pa.array(own, pa.string())],
                                                 names=["doc", "lang", "chunk"])

    # The number is used within this one pass and its shuffle alone.
    met = texts.select(F.monotonically_increasing_id().alias("doc"), "lang", "text").mapInArrow(
        find, "doc long, lang string, chunk string").distinct()
    return met.join(sought, ["lang", "chunk"]).select("doc", "lang", "term").distinct().groupBy("lang", "term").agg(
        F.count("*").alias("documents"))


def kept_terms(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, source, term, n: occurrences of each kept term of a language in each of its sources that has it."""
    texts = _texts(docs)
    counts = stage(chunk_counts(texts), "chunk-counts")
    cut = stage(counts.select("chunk").distinct().select("chunk", F.explode(terms_of(F.col("chunk"))).alias("term")).groupBy(
        "chunk", "term").agg(F.count("*").alias("times")), "chunk-terms")
    by_source = counts.join(cut, "chunk").groupBy("lang", "source", "term").agg(
        F.sum(F.col("occurrences") * F.col("times")).alias("n"),
        F.sum("documents").alias("most"), F.max("documents").alias("fewest"))
    both = Window.partitionBy("lang", "term")
    likely = stage(by_source.withColumn("most", F.sum("most").over(both)).withColumn("fewest", F.sum("fewest").over(both)).where(
        F.col("most") >= least), "likely-terms")
    sure = likely.where(F.col("fewest") >= least)
    open_terms = likely.where(F.col("fewest") < least).select("lang", "term").distinct()
    sought = stage(cut.select("chunk", "term").join(open_terms, "term").join(
        counts.select("lang", "chunk").distinct(), ["lang", "chunk"]).select("lang", "chunk", "term"), "open-terms")
    if sought.isEmpty():
        return sure.select("lang", "source", "term", "n")
    found = _by_document(texts, sought).where(F.col("documents") >= least).select("lang", "term")
    return sure.union(likely.where(F.col("fewest") < least).join(found, ["lang", "term"]).select(likely.columns)).select(
        "lang", "source", "term", "n")


def _share(n: Column, total: Column, terms: Column) -> Column:
    """In billionths, with two occurrences more for each term, rounded down, and one."""
    return F.lit(1) + F.call_function(
        "div", (n + 2).cast("decimal(20,0)") * F.lit(1_000_000_000), (total + 2 * terms).cast("decimal(38,0)"))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: how far a source is from each other one of its language (`pair`), and the
    terms by which it stands out from the language (`term`), up to rank `top`."""
    groups = stage(_texts(docs).select("lang", "source").distinct(), "groups")
    kept = stage(kept_terms(docs, least), "kept-terms")
    by_lang = kept.groupBy("lang", "term").agg(F.sum("n").alias("all"))
    sizes = stage(groups.select("lang").distinct().join(
        by_lang.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("total")), "lang", "left").select(
        "lang", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("total", F.lit(0)).alias("total")), "languages")
    totals = groups.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.count("*").alias("had")),
                         ["lang", "source"], "left").join(sizes, "lang").select(
        "lang", "source", "terms", "total", F.coalesce("own", F.lit(0)).alias("own"), F.coalesce("had", F.lit(0)).alias("had"))
    # Where a language has no kept term, nothing is divided by its shares.
    none = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("own"), F.greatest("terms", F.lit(1)))).otherwise(F.lit(1))
    totals = stage(totals.withColumn("none", none), "groups-sized")
    shares = stage(kept.join(totals, ["lang", "source"]).withColumn(
        "p", _share(F.col("n"), F.col("own"), F.col("terms"))).select("lang", "source", "term", "n", "p", "none"), "shares")

    a = totals.select("lang", F.col("source").alias("a"), "terms", F.col("had").alias("had_a"), F.col("none").alias("none_a"))
    b = totals.select("lang", F.col("source").alias("b"), F.col("had").alias("had_b"), F.col("none").alias("none_b"))
    pairs = a.join(b, "lang").where("a < b")  # as many as the result has, by half
    # How many terms of a source have each share; against the least share of each other source.
    spread = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("terms"))
    against = spread.join(totals.select("lang", F.col("source").alias("other"), F.col("none").alias("q")), "lang").where(
        "source <> other").groupBy("lang", "source", "other").agg(
        F.sum(F.col("terms") * _apart(F.col("p"), F.col("q"))).alias("alone"))
    left = shares.select("lang", "term", F.col("source").alias("a"), "p", F.col("none").alias("none_a"))
    right = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("q"), F.col("none").alias("none_b"))
    shared = left.join(right, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b").agg(
        F.count("*").alias("both"),
        F.sum(_apart(F.col("p"), F.col("q")) - _apart(F.col("p"), F.col("none_b")) - _apart(F.col("none_a"), F.col("q"))).alias("more"))
    zero = F.lit(0).cast("long")
    near = pairs.join(shared, ["lang", "a", "b"], "left").join(
        against.select("lang", F.col("source").alias("a"), F.col("other").alias("b"), F.col("alone").alias("alone_a")),
        ["lang", "a", "b"], "left").join(
        against.select("lang", F.col("source").alias("b"), F.col("other").alias("a"), F.col("alone").alias("alone_b")),
        ["lang", "a", "b"], "left").select(
        "lang", "a", "b", (
            F.coalesce("more", zero) + F.coalesce("alone_a", zero) + F.coalesce("alone_b", zero)
            + (F.col("terms") - F.col("had_a") - F.col("had_b") + F.coalesce("both", zero))
            * _apart(F.col("none_a"), F.col("none_b"))).cast("long").alias("value"))
    pair = near.select("lang", F.inline(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")))), "value").select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value")

    whole = by_lang.join(sizes, "lang").withColumn("q", _share(F.col("all"), F.col("total"), F.col("terms"))).select(
        "lang", "term", "q")
    term = shares.join(whole, ["lang", "term"]).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pair.withColumn("rank", F.row_number().over(order)).union(
        term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
