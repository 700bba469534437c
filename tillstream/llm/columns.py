"""Small helpers between DataFrames and Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tillstream.session import stage


def with_arrow(df: DataFrame, inputs: list[str], outputs: T.StructType,
               prepare: Callable[[], Callable[..., list[pa.Array]]]) -> DataFrame:
    """`df` with the columns `outputs`, computed batch by batch from the columns `inputs`.

    `prepare` runs once a task and returns the function of a batch. A column of `df` that has the
    name of an output, in any case, is replaced; all others pass through unchanged.
    """
    taken = {name.lower() for name in outputs.names}
    kept = [f for f in df.schema if f.name.lower() not in taken]
    names = [f.name for f in df.schema]
    at, stay = [names.index(c) for c in inputs], [names.index(f.name) for f in kept]
    schema = T.StructType(kept + outputs.fields)
    labels = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            work = work or prepare()
            made = work(*[batch.column(i) for i in at])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in stay] + made, names=labels)

    return df.mapInArrow(run, schema)


def fields(**kinds: str) -> T.StructType:
    """A struct type from names and simple type names."""
    return T.StructType([T.StructField(k, T._parse_datatype_string(v)) for k, v in kinds.items()])


def unused(df: DataFrame, name: str) -> str:
    """`name`, with underscores until no column has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def with_row_keys(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """`df` with a number that tells apart rows without an id, and different texts under one id; and its name.

    It is the id itself wherever that does, else a 64-bit hash of id and text, so equal rows share it.
    """
    key = unused(df, "row_key")
    of_text = F.xxhash64(text)
    shared = stage(df.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("shared_id")).agg(
        F.min(of_text).alias("low"), F.max(of_text).alias("high")).where("low <> high").select("shared_id"), "shared-ids")
    if shared.isEmpty():
        several = F.col(doc_id).isNull()
        keyed = df
    else:
        shared = shared.withColumnRenamed("shared_id", unused(df, "shared_id"))
        keyed = df.join(shared, df[doc_id] == shared[shared.columns[0]], "left")
        several = F.col(doc_id).isNull() | shared[shared.columns[0]].isNotNull()
    made = F.when(several, F.xxhash64(doc_id, text, F.lit("row"))).otherwise(F.col(doc_id).cast("long"))
    return keyed.withColumn(key, made).select(*df.columns, key), key
