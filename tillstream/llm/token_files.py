"""Token ids of a collection as flat files, with 64-bit document offsets, read by memory mapping.

A collection is a folder of parts in document order. Part k has three files of plain little-endian
numbers: `k.ids` (unsigned 16 or 32 bits, as the vocabulary needs), `k.off` (signed 64 bits: the
place of each document's first id in `k.ids`, and the end) and `k.doc` (signed 64 bits: how many
leading documents have no id, then each document's id). The manifest has a row for each part; where a
part begins in the whole collection is the sum of all earlier parts' sizes.

Files are written under a name of their own and then renamed, so a repeated task leaves whole files.

Defined results: null and empty texts have the end id alone; null document ids come first (read back
as null); equal document ids stand in the order of their texts; no documents make no parts.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillstream.llm.pretokens import PreTokenEncoder
from tillstream.session import stage, staging_root

MANIFEST = "part int, path string, documents long, ids long, wide boolean"
# Up to here the Unicode tables of the libraries agree on what letters and numbers are.
SETTLED = "԰"
GROUP = 1 << 20


class Encoder:
    """Whole texts to ids with a tokenizers file; pre-tokens that were seen are not encoded again.

    A string of a special token is its id, as the library has it by default, or with `plain` ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        self.special = [] if plain else [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.wide = self.library.get_vocab_size() > 1 << 16
        self.pre_tokens = PreTokenEncoder(self._encode)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _settled(self, text: str) -> bool:
        return (not text or text.isascii() or max(text) < SETTLED) and not any(s in text for s in self.special)

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the bounds of each text's. Texts with rarer characters or special tokens go to the library whole."""
        plain = list(map(self._settled, texts))
        if all(plain):
            return self.pre_tokens.texts(texts)
        ids, bounds = self.pre_tokens.texts([t for t, p in zip(texts, plain) if p])
        rare = iter(self._encode([t for t, p in zip(texts, plain) if not p]))
        known = iter(np.split(ids, bounds[1:-1])) if any(plain) else iter(())
        parts = [next(known) if p else np.asarray(next(rare), np.uint32) for p in plain]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of a tokenizers file, built once per process."""
    return Encoder(path)


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode `docs` into `folder`, a new or empty folder that all executors share; the manifest.

    Documents are range partitioned by id, and by a hash of the text where ids repeat, then sorted
    in each part. No step holds more than a batch of texts.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.col("part_key"), F.col("text").asc_nulls_first()]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn(
        "part_key", F.when(F.col("doc_id").isNull() | F.col("text").isNotNull(), F.xxhash64("text")))
    ranged = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), None
        work = encoder(tokenizer)
        kind = "<u4" if work.wide else "<u2"
        system, base = _file_system(folder)
        names = {k: f"{base}/{part:06d}.{k}" for k in ("ids", "off", "doc")}
        mine = uuid.uuid4().hex
        documents = ids = nulls = 0
        numbers: list[np.ndarray] = []
        ends: list[np.ndarray] = [np.zeros(1, np.int64)]
        for batch in batches:
            column, texts = batch.column(0), batch.column(1).fill_null("").to_pylist()
            if not texts:
                continue
            made = made or system.open_output_stream(f"{names['ids']}.{mine}")
            nulls += column.null_count
            numbers.append(column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            first = 0
            while first < len(texts):
                size, last = 0, first
                while last < len(texts) and (size < GROUP or last == first):
                    size += len(texts[last])
                    last += 1
                found, bounds = work.texts(texts[first:last])
                # Each text's ids move up by the ends before it; the free places become ends.
                flat = np.full(len(found) + last - first, end_id, kind)
                at = np.arange(len(found)) + np.repeat(np.arange(last - first), np.diff(bounds))
                flat[at] = found
                made.write(flat.tobytes())
                ends.append(ids + bounds[1:] + np.arange(1, last - first + 1))
                ids += len(flat)
                first = last
            documents += len(texts)
        if made is None:
            return
        made.close()
        for k, value in (("off", np.concatenate(ends)), ("doc", np.concatenate([[nulls], *numbers]))):
            with system.open_output_stream(f"{names[k]}.{mine}") as out:
                out.write(value.astype("<i8").tobytes())
        for name in names.values():
            system.move(f"{name}.{mine}", name)
        yield pa.RecordBatch.from_arrays(
            [pa.array([v]) for v in (part, f"{folder}/{part:06d}", documents, ids, work.wide)],
            schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("documents", pa.int64()),
                              ("ids", pa.int64()), ("wide", pa.bool_())]))

    system, base = _file_system(folder)
    system.create_dir(base)
    manifest = ranged.select("doc_id", "text").mapInArrow(put, MANIFEST)
    return stage(manifest, "token-manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with `base`, the ids of all parts before each one: a prefix sum over its few rows."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


@contextmanager
def mapped(path: str, kind: str):
    """A file's numbers as a memory map; a file of a remote store is first copied to a passing folder."""
    system, base = _file_system(path)
    copy = None
    if system.type_name != "local":
        copy = tempfile.mkdtemp(prefix="token-part-")
        base, remote = f"{copy}/part", base
        with system.open_input_stream(remote) as source, open(base, "wb") as out:
            shutil.copyfileobj(source, out, 1 << 20)
    try:
        yield np.memmap(base, kind, "r") if os.path.getsize(base) else np.zeros(0, kind)
    finally:
        if copy:
            shutil.rmtree(copy)


def read(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and the ids) of every document, read from the files alone."""
    spark = manifest.sparkSession
    parts = with_bases(manifest).repartition(
        max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "part")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with mapped(f"{row['path']}.off", "<i8") as off, mapped(f"{row['path']}.doc", "<i8") as doc, \
                        mapped(f"{row['path']}.ids", "<u4" if row["wide"] else "<u2") as ids:
                    nulls = int(doc[0])
                    for first in range(0, row["documents"], 4096):
                        last = min(first + 4096, row["documents"])
                        at = np.asarray(off[first:last + 1])
                        each = [np.asarray(ids[a:b], "<u4") for a, b in zip(at.tolist(), at[1:].tolist())]
                        columns = [
                            pa.array(np.asarray(doc[first + 1:last + 1]),
                                     mask=np.arange(first, last) < nulls),
                            pa.array(at[:-1] + row["base"]), pa.array(np.diff(at)),
                            pa.array([zlib.crc32(e.tobytes()) for e in each], pa.int64()),
                        ]
                        if with_ids:
                            columns.append(pa.array([e.astype(np.int32) for e in each], pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(
                            columns, names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    return parts.mapInArrow(get, schema)


def new_folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex}"


def stored_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents into a new shared folder and read them back."""
    return read(write(docs, new_folder(docs.sparkSession), tokenizer))
