"""Sampling, splitting and latest-rows selection.

Sampling and splitting are deterministic: a row's fate depends only on its
key and the seed through an md5 bucket, so it is the same on every run, on
every executor after a retry, and in any SQL engine with md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 10000


def hash_bucket(key_cols: list[str], seed: int) -> Column:
    """0..9999 from the first 32 bits of md5("k1|k2|..|seed")."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % BUCKETS


def hash_sample(df: DataFrame, fraction: float, key_cols: list[str], seed: int = 0) -> DataFrame:
    """Keep rows whose bucket is below ``fraction * 10000`` (a Bernoulli-like sample)."""
    return df.filter(hash_bucket(key_cols, seed) < int(round(fraction * BUCKETS)))


def bernoulli_sample(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """E1 (random form): Spark's own per-partition Bernoulli sample."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def with_split(df: DataFrame, test_size: float, key_cols: list[str], seed: int = 42,
               col: str = "split") -> DataFrame:
    """Label each row 'test' (bucket below test_size * 10000) or 'train'."""
    is_test = hash_bucket(key_cols, seed) < int(round(test_size * BUCKETS))
    return df.withColumn(col, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def train_test_split(df: DataFrame, test_size: float, key_cols: list[str], seed: int = 42):
    """(train, test) DataFrames."""
    is_test = hash_bucket(key_cols, seed) < int(round(test_size * BUCKETS))
    return df.filter(~is_test), df.filter(is_test)


def latest_rows(df: DataFrame, n: int, ts_col: str = "ts", tie_cols: tuple = ()) -> DataFrame:
    """E5: the ``n`` newest rows (nulls last), ties broken by ``tie_cols``.

    Planned as a TakeOrderedAndProject: each task keeps its own top ``n`` and
    only those reach the final merge, so the cost is O(rows) with O(n) memory.
    """
    return df.orderBy(F.col(ts_col).desc_nulls_last(), *[F.col(c).asc() for c in tie_cols]).limit(n)


def min_rows_guard(window_df: DataFrame, n: int) -> DataFrame:
    """The rows of a bounded window if it has at least ``n`` of them, else no rows.

    Meant for the output of :func:`latest_rows` (at most ``n`` rows), so the
    count over the window is a count over at most ``n`` rows.
    """
    counted = window_df.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy()))
    return counted.filter(F.col("_rows") >= n).drop("_rows")


def guard_status(window_df: DataFrame, n: int) -> DataFrame:
    """E8 as a one-row report: rows found, rows required, passed."""
    return window_df.agg(F.count(F.lit(1)).alias("rows_found")).select(
        "rows_found", F.lit(n).cast("long").alias("rows_required"),
        (F.col("rows_found") >= n).alias("passed"))
