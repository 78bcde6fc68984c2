"""Reading corpus tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


#: Tables up to this size are dealt out over the cores; larger ones have row groups enough to be read in parallel.
SMALL_TABLE_BYTES = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deals a small table out over the cores, since a row group is read by one task; a large one stays as it is.

    The size is the optimiser's estimate of what is read, so no file names come to the driver. Rows are dealt
    evenly, not by key.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SMALL_TABLE_BYTES else df
