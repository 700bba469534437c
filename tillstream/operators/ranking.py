"""Ranking, paging and newest-row-per-key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillstream.session import stage

# monotonically_increasing_id() = partition index << 33 | row index within the partition.
_ROW_BITS = 33


def tile_of(rank: Column, rows, tiles: int) -> Column:
    """Tile (1..tiles) of the 1-based `rank` among `rows`, the first tiles one row larger."""
    rows = rows if isinstance(rows, Column) else F.lit(rows)
    small = F.floor(rows / tiles)
    large_rows = (rows % tiles) * (small + 1)
    index = F.when(
        rank <= large_rows, F.floor((rank - 1) / (small + 1))
    ).otherwise((rows % tiles) + F.floor(F.try_divide(rank - 1 - large_rows, small)))
    return (index + 1).cast("int")


def ranked_by_range(df: DataFrame, order: list[Column], rank: str, partitions: int) -> DataFrame:
    """Exact global 1-based rank in `order` (which must be total) without a single-task sort.

    Rows are range partitioned and sorted in place. A row's position is its index within the
    partition plus the sizes of the partitions before it. The sorted rows are staged, because the
    range bounds are sampled and a second run of the same plan could place rows differently.
    """
    placed = stage(
        df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id()),
        rank,
    )
    part = F.shiftright("_row", _ROW_BITS).alias("_part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("_size"))
    # One row per range partition: a bound we chose ourselves, so the broadcast below is safe.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
        .withColumn(rank, F.col("_start") + within + 1)
        .drop("_part", "_row", "_start")
    )


def global_ntile(df: DataFrame, scores: dict[str, list[Column]], tiles: int) -> DataFrame:
    """Add one `ntile(tiles)` column per entry of `scores` (name -> total order).

    Each score is one range sort, whatever the number of rows; no task sees all of them.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = None
    for name, order in scores.items():
        ranked = ranked_by_range(df, order, "_rank", partitions)
        rows = ranked.agg(F.count("*")).scalar() if rows is None else rows
        df = ranked.withColumn(name, tile_of(F.col("_rank"), rows, tiles)).drop("_rank")
    return df


def latest_per_key(
    df: DataFrame, keys: list[str], version: str, keep_first: list[str] = (), tie: list[str] = (),
) -> DataFrame:
    """One row per key: the newest by `version` (then `tie`), `keep_first` columns from the oldest."""
    keep_first = list(keep_first)
    order = F.struct(version, *tie) if tie else F.col(version)
    newest = [c for c in df.columns if c not in keys and c not in keep_first]
    aggregates = [F.max_by(F.struct(*newest), order).alias("_new")]
    if keep_first:
        aggregates.append(F.min_by(F.struct(*keep_first), order).alias("_old"))
    found = df.groupBy(*keys).agg(*aggregates)
    source = {**{c: f"_new.{c}" for c in newest}, **{c: f"_old.{c}" for c in keep_first}}
    return found.select(*[F.col(source.get(c, c)).alias(c) for c in df.columns])


def page(df: DataFrame, order: list[Column], limit: int = 100, offset: int = 0) -> DataFrame:
    """Rows offset+1 .. offset+limit in `order`, which should end in a unique key."""
    ordered = df.orderBy(*order)
    return ordered.offset(offset).limit(limit) if offset else ordered.limit(limit)
