"""Stored tables: Parquet folders with declared schemas, plus JDBC and document collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillstream.schemas import TABLES
from tillstream.operators.ranking import latest_per_key

# The run of batches that no streaming query wrote.
FIRST_RUN = "0"
_LIST = "kind string, name string, n bigint"
# Facts are laid out by day so that date filters prune folders.
PARTITIONED_BY = {"fact_sales": ["date_id"], "fact_sessions": ["date_id"]}


def conform(df: DataFrame, name: str) -> DataFrame:
    """`df` with exactly the declared columns and types; columns it lacks become NULL.

    Casts are strict: a value that does not fit the declared type fails the job.
    """
    return df.select(*[
        (F.col(field.name) if field.name in df.columns else F.lit(None))
        .cast(field.dataType).alias(field.name)
        for field in TABLES[name]
    ])


class TableStore:
    """Named Parquet tables below one root folder.

    A table is either a plain folder (`overwrite`, `append`) or a change log (`put_batch`), whose
    folders `run=<query run>/batch_id=<n>` are each replaced as a whole, so that replaying a batch
    changes nothing. A query with a new checkpoint is a new run, so its batches stand beside the
    earlier ones; runs are named so that a later one sorts after an earlier one.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        files = jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return files.exists(jvm_path)

    def read(self, name: str) -> DataFrame:
        """The table, or an empty frame with its schema where it was never written."""
        if not self.exists(name):
            return self.spark.createDataFrame([], TABLES[name])
        rows = self.spark.read.schema(TABLES[name]).parquet(self.path(name))
        # Folder columns come last, and change logs have one more.
        return rows.select(*TABLES[name].names)

    def overwrite(self, name: str, df: DataFrame, only_days: bool = False) -> None:
        """Replace the table, or with `only_days` just the day folders that `df` has rows for."""
        rows = conform(df, name)
        keys = PARTITIONED_BY.get(name, [])
        if only_days and not keys:
            raise ValueError(f"{name} is not partitioned")
        if keys:
            # One task per day would hang on a hot day; rebalance splits it by size.
            rows = rows.hint("rebalance", *keys)
        rows.write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic" if only_days else "static"
        ).partitionBy(*keys).parquet(self.path(name))

    def append(self, name: str, df: DataFrame) -> None:
        conform(df, name).write.mode("append").parquet(self.path(name))

    # Change logs -----------------------------------------------------------------------------

    def put_batch(self, name: str, df: DataFrame, batch_id: int, run: str = FIRST_RUN) -> None:
        """Store a micro-batch under its run and id, replacing what an earlier attempt left there."""
        conform(df, name).write.mode("overwrite").parquet(f"{self.path(name)}/run={run}/batch_id={batch_id}")

    def changes(self, name: str) -> DataFrame:
        """All batches of a change log, with `run` and `batch_id`."""
        fields = [StructField("run", StringType()), StructField("batch_id", LongType())]
        with_batch = StructType([*TABLES[name].fields, *fields])
        if not self.exists(name):
            return self.spark.createDataFrame([], with_batch)
        return self.spark.read.schema(with_batch).parquet(self.path(name))

    def newest_batch(self, name: str) -> int | None:
        """The highest batch id of a change log; reads one number."""
        return self.changes(name).agg(F.max("batch_id")).first()[0]

    def current(self, name: str, keys: list[str], keep_first: list[str] = (), tie: tuple[str, ...] = ()) -> DataFrame:
        """The newest row per key; `keep_first` columns stay as first written (upsert on read).

        Rows go by run, batch and `tie`. After `compact` this reads the base and the batches behind it only.
        """
        base = self._base(name)
        rows = self.changes(name) if base is None else self._rows_of_base(name, base).unionByName(self._behind(name, base))
        return latest_per_key(rows, keys, "run", keep_first, tie=["batch_id", *tie]).drop("run", "batch_id")

    # Compaction ------------------------------------------------------------------------------
    #
    # `<name>_base/rows/generation=<g>/bucket=<b>` holds current rows by a hash of their key. The list
    # `<name>_base/list/generation=<g>` names, for each bucket, the generation that has its rows, and for each run
    # the last batch that they include. The newest list counts; it is written last.

    def compact(self, name: str, keys: list[str], keep_first: list[str] = (), tie: tuple[str, ...] = (),
                buckets: int = 64) -> None:
        """Fold the batches behind the base into it; only buckets that have new rows are rewritten.

        A run's batches must come in order, and a run must have ended before a later one begins. After a crash
        the next call starts over, as no list names what was half written. Earlier generations and
        folded batches stay in place, for readers that still use them.
        """
        base = self._base(name)
        buckets = buckets if base is None else base["buckets"]
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        fresh = (self.changes(name) if base is None else self._behind(name, base)).withColumn("bucket", bucket)
        upto = {r.run: r.last for r in fresh.groupBy("run").agg(F.max("batch_id").alias("last")).collect()}
        if not upto:
            return
        # No more than `buckets` numbers.
        changed = [r.bucket for r in fresh.select("bucket").distinct().collect()]
        generation = 0 if base is None else base["generation"] + 1
        rows = fresh.drop("bucket")
        if base is not None:
            rows = self._rows_of_base(name, base, changed).unionByName(rows)
        merged = latest_per_key(rows, keys, "run", keep_first, tie=["batch_id", *tie]).withColumn("bucket", bucket)
        merged.repartition(min(buckets, len(changed)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.path(name)}_base/rows/generation={generation}")
        places = ({} if base is None else base["places"]) | {b: generation for b in changed}
        covered = ({} if base is None else base["covered"]) | upto
        listed = [("bucket", str(b), g) for b, g in places.items()] + [("run", run, last) for run, last in covered.items()]
        self.spark.createDataFrame([*listed, ("buckets", "", buckets)], _LIST).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path(name)}_base/list/generation={generation}")

    def _base(self, name: str) -> dict | None:
        """What the newest list says; a row for each bucket and run."""
        if not self.exists(f"{name}_base/list"):
            return None
        lists = self.spark.read.schema(f"{_LIST}, generation bigint").parquet(f"{self.path(name)}_base/list")
        newest = lists.agg(F.max("generation")).first()[0]
        if newest is None:
            return None
        found = lists.filter(F.col("generation") == newest).collect()
        return {"generation": newest, "buckets": next(r.n for r in found if r.kind == "buckets"),
                "places": {int(r.name): r.n for r in found if r.kind == "bucket"},
                "covered": {r.name: r.n for r in found if r.kind == "run"}}

    def _rows_of_base(self, name: str, base: dict, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the base with run and batch, of all or some buckets; other folders are not read."""
        root = f"{self.path(name)}_base/rows"
        wanted = [b for b in base["places"] if buckets is None or b in buckets]
        fields = [StructField("run", StringType()), StructField("batch_id", LongType())]
        with_batch = StructType([*TABLES[name].fields, *fields])
        if not wanted:
            return self.spark.createDataFrame([], with_batch)
        return self.spark.read.schema(with_batch).parquet(
            *[f"{root}/generation={base['places'][b]}/bucket={b}" for b in wanted])

    def _behind(self, name: str, base: dict) -> DataFrame:
        """Batches that the base doesn't include; the filter is on folder names, so others are not read."""
        folded = F.lit(False)
        for run, last in base["covered"].items():
            folded = folded | ((F.col("run") == run) & (F.col("batch_id") <= last))
        return self.changes(name).filter(~folded)


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """A name for the query that owns a checkpoint folder: when the folder was made, and the query's id.

    Both stay the same when the query restarts from the folder.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    made = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getModificationTime()
    number = spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id
    return f"{made:015d}-{number}"


def jdbc_reader(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], *,
    column: str | None = None, lower=None, upper=None, partitions: int = 1,
) -> DataFrameReader:
    """Reader of a database table; with `column` and bounds it reads `partitions` ranges in parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **properties}
    if column:
        options.update({
            "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions),
        })
    return spark.read.format("jdbc").options(**options)


def jdbc_write_options(url: str, table: str, properties: dict[str, str], batch_size: int = 10_000) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **properties}


def collection_reader(spark: SparkSession, database: str, name: str, **options: str) -> DataFrameReader:
    """Reader of a document collection; needs the MongoDB connector on the classpath."""
    return (
        spark.read.format("mongodb").schema(TABLES[name])
        .option("database", database).option("collection", name).options(**options)
    )


def collection_writer(df: DataFrame, database: str, name: str, **options: str):
    return (
        conform(df, name).write.format("mongodb").mode("overwrite")
        .option("database", database).option("collection", name).options(**options)
    )


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
