"""From raw documents to token ids: reject toxic texts, keep one of each group of near duplicates, reject
texts that hold benchmark passages, replace personal data, encode.

Every stage takes (spark, docs, folder of the given tables) and returns a DataFrame; `run` writes what
each stage returns to the shared folder and reads it back as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.llm import bpe_codec, nearest_toxic, odd_sketches, surrogates, tiling
from tillstream.llm.queries import ship
from tillstream.session import stage


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted to be toxic."""
    ship(spark)
    return nearest_toxic.not_toxic(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    ship(spark)
    return odd_sketches.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no passage of the benchmark."""
    ship(spark)
    return tiling.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates; n_chars, where there is one, follows the text."""
    changed = surrogates.pseudonymised(docs, key="key of the given tables", count=None)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return changed


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids, their number and digest, and the digest of the decoded text."""
    ship(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe_codec.encode(docs.select("doc_id", "text"), ranks).drop("text")
    return bpe_codec.decode(encoded, ranks).select(
        "doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name.replace(' ', '-')}")
    return docs


# SQL can state neither the classifier nor the encoder; tests hold the rows against plain versions.
ORACLE_SQL = None
