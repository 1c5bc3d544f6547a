"""Reading the input tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame, key_cols: tuple = (), min_partitions: int | None = None) -> DataFrame:
    """Spread an input whose rows stand in fewer tasks than the cluster has cores.

    A Parquet file is read by as many tasks as it has row groups, however many parts Spark cuts it into: the parts without
    the start of one have no rows. So rows are counted by part (from the files' footers, no column is read). Where a part holds
    more than twice its even share, the rows are hashed on ``key_cols`` (columns that tell most rows apart) or dealt
    round-robin over the default parallelism, at the cost of one shuffle. An input in enough even parts, as any
    table of many row groups is, is returned as it is. The rows are the same either way.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    if parts >= target and not _uneven(df, target):
        return df
    target = max(target, parts)
    if key_cols:
        return df.repartition(target, *[F.col(c) for c in key_cols])
    return df.repartition(target)


def _uneven(df: DataFrame, tasks: int) -> bool:
    """Whether some partition holds more than twice the rows an even share among ``tasks`` would be."""
    by_part = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    most, rows = by_part.agg(F.max("n"), F.sum("n")).first()
    return rows is not None and most * tasks > 2 * rows
