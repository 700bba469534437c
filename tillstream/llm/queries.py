"""The operators over the given tables, as named queries, and their SQL where SQL can say it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import (
    bpe_codec, containment, language_codes, lattice, nearest_toxic, odd_sketches, repeated_spans, source_audit, surrogates,
    tiling, token_alignment, token_files, warc_derivatives,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_codec.round_trip_digests(_table(spark, folder, "documents"), ranks)


def op2_containment(spark: SparkSession, folder: str) -> DataFrame:
    return containment.edited_pairs(_table(spark, folder, "documents"))


def op3_language_codes(spark: SparkSession, folder: str) -> DataFrame:
    return language_codes.languages(_table(spark, folder, "documents").select("doc_id", "text", "lang"))


def op4_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """A production run takes its key from a secret store; this one is for the given tables."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.pseudonymised(docs, key="key of the given tables")


def op5_tiling(spark: SparkSession, folder: str) -> DataFrame:
    return tiling.matched(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op6_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    records = warc_derivatives.responses(_table(spark, folder, "pages"), date="2025-01-01T00:00:00Z")
    return warc_derivatives.derivatives(records)


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.stored_tokens(_table(spark, folder, "documents"), tokenizer)


def op8_odd_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return odd_sketches.near_duplicates(_table(spark, folder, "documents"))


def op9_nearest_toxic(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_toxic.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.probabilities(
        _table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_induced(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans.without_repeats(_table(spark, folder, "documents"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.aligned(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                   public_tokenizers.path("piece_bpe_32k.model"))


def op13_sources(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.audit(_table(spark, folder, "documents"))


#: Rows and bytes that pass between the JVM and a Python worker at once; a document is never cut.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
           "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as `--py-files` would, once a session, and bound Arrow batches."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    name = f"tillstream-{context.applicationId}.zip"
    if any(f.endswith(name) for f in context._python_includes):
        return
    root = Path(__file__).resolve().parents[2]
    archive = os.path.join(tempfile.mkdtemp(prefix="tillstream-code-"), name)
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "tillstream").rglob("*.py")):
            out.write(file, file.relative_to(root))
    context.addPyFile(archive)


def _shipped(query):
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(query) for name, query in _QUERIES.items()}


_QUERIES = {
    "op1_bpe_codec": op1_bpe_codec,
    "op2_containment": op2_containment,
    "op3_language_codes": op3_language_codes,
    "op4_surrogates": op4_surrogates,
    "op5_tiling": op5_tiling,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_token_files": op7_token_files,
    "op8_odd_sketches": op8_odd_sketches,
    "op9_nearest_toxic": op9_nearest_toxic,
    "op10_lattice": op10_lattice,
    "op11_induced": op11_induced,
    "op12_alignment": op12_alignment,
    "op13_sources": op13_sources,
}


def llm_oracles() -> dict[str, str]:
    """SQL where it can say the whole result in reasonable time; tests hold the others against plain versions."""
    return {"op8_odd_sketches": _NEAR_DUPLICATES, "op13_sources": _SOURCES}


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NEAR_DUPLICATES = rf"""WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g FROM worded),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY ALL),
link AS (
  SELECT x, y FROM pair JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reached.doc_id, y FROM reached JOIN edge ON other = x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, min(other) = doc_id AS kept
FROM reached LEFT JOIN size USING (doc_id) GROUP BY doc_id"""

_SOURCES = rf"""WITH own AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
word AS (SELECT doc, lang, source, unnest(w) AS term FROM own),
kept AS (SELECT lang, term, count(*) AS total FROM word GROUP BY ALL HAVING count(DISTINCT doc) >= 10),
duo AS (SELECT DISTINCT lang, source FROM own),
had AS (SELECT lang, source, term, count(*) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
every AS (SELECT duo.lang, duo.source, term, total, coalesce(n, 0) AS n FROM duo JOIN kept USING (lang)
  LEFT JOIN had USING (lang, source, term)),
share AS (SELECT *, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p,
  1 + (1000000000::HUGEINT * (total + 2)) // (sum(total) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS q FROM every),
near AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM duo a JOIN duo b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN near ON near.lang = a.lang AND near.source = a.source AND near.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM share WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""
