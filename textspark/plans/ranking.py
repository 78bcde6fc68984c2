"""Row numbers and top-k that never pull one group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textspark.plans.lineage import durable
from textspark.plans.skew import heavy_keys, lookup_join

# monotonically_increasing_id keeps the partition number above this bit.
_PARTITION_BIT = 33
# Spark inserts a map-side WindowGroupLimit up to this rank (spark.sql.optimizer.windowGroupLimitThreshold).
_GROUP_LIMIT = 1000
_SLICES = 64


def row_index(df: DataFrame, order: Sequence[Column], name: str = "idx") -> DataFrame:
    """Global 0-based row number by `order`, for frames of any size.

    A range shuffle on the whole order key balances the partitions, also when a leading column is hot.
    Each row keeps its place inside its partition; only one count per partition is summed in one place.
    The placed rows are checkpointed because range bounds come from a sample that a re-run may draw anew.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = durable(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", _PARTITION_BIT)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # At most `parts` rows, so one task sums them and the broadcast is bounded.
    starts = counts.select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start")
    )
    offset = F.col("_at").bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*df.columns, (F.col("_start") + offset).alias(name))
    )


def group_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "idx", size: str | None = None
) -> DataFrame:
    """0-based row number inside each group, and the group size, with hot groups spread over many tasks.

    The rank is the global row number less the first one of the group; only one row per group is joined back,
    from a broadcast if these rows are few, else apart for the groups that own most rows.
    """

    placed = row_index(df, [*map(F.col, keys), *order], "_row")
    firsts = durable(placed.groupBy(*keys).agg(F.min("_row").alias("_first"), F.count("*").alias("_size")))
    kept = [(F.col("_row") - F.col("_first")).alias(name)]
    if size:
        kept.append(F.col("_size").alias(size))
    return lookup_join(placed, firsts, keys, heavy_keys(firsts, keys, "_size")).select(*df.columns, *kept)


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """First `k` rows of each group by `order`, ranked from 1.

    Up to 1,000 rows Spark trims every map task to k rows per group before the shuffle. Beyond that a first
    rank over slices of the group does the trimming, so the final task sees at most k rows per slice.
    """
    if k > _GROUP_LIMIT:
        # The partition number keeps equal rows of different partitions out of one slice.
        slice_no = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(_SLICES))
        inner = Window.partitionBy(*keys, "_slice").orderBy(*order)
        df = (
            df.withColumn("_slice", slice_no)
            .withColumn("_inner", F.row_number().over(inner))
            .filter(F.col("_inner") <= k)
            .drop("_slice", "_inner")
        )
    outer = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(outer)).filter(F.col(name) <= k)
