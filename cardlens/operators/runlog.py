"""Run log and model store.

Runs are rows of an append-only Parquet table: ``(run_id, run_name, kind,
key, value, ts, attempt)`` for params/metrics and ``(run_id, run_name, end_time)``
for the run list. The latest run per name follows these rules: no run ->
error; more than one unfinished run (null end time) -> error; exactly one
unfinished -> that run; else the greatest end time (ties: smallest id).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RUN_LOG

RUN_LOG_SCHEMA = RUN_LOG


def log_entries(spark: SparkSession, path: str, run_id: str, run_name: str, kind: str, values: dict, attempt: int = 0) -> None:
    """Append params or metrics of a run (a handful of rows) to the run log table.

    An entry is known by (run, kind, key, attempt). Writers only append, so several may write at once, and a retry that
    appends its entries again changes nothing: readers settle the log first (:func:`settled`).
    """
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(run_id, run_name, kind, str(k), str(v), now, attempt) for k, v in values.items()]
    spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def settled(log: DataFrame) -> DataFrame:
    """One row per (run_id, run_name, kind, key): entries that were appended again count once (the first is kept), and of
    several attempts the last one wins. Entries without an attempt are attempt 0."""
    keys = ["run_id", "run_name", "kind", "key"]
    attempt = F.coalesce("attempt", F.lit(0)).alias("attempt")
    once = log.select(*keys, attempt, "ts", "value").groupBy(*keys, "attempt").agg(F.min(F.struct("ts", "value")).alias("_first"))
    last = once.groupBy(*keys).agg(F.max_by(F.struct("attempt", "_first"), "attempt").alias("_last"))
    return last.select(*keys, "_last.attempt", "_last._first.value", "_last._first.ts")


def run_values(log: DataFrame, kind: str, names: tuple) -> DataFrame:
    """One row per run: run_id, run_name, and one text column per name of the given kind (null if it was not logged)."""
    found = settled(log.filter((F.col("kind") == kind) & F.col("key").isin(*names)))
    return found.groupBy("run_id", "run_name").agg(*[F.max(F.when(F.col("key") == n, F.col("value"))).alias(n) for n in names])


def latest_runs(runs: DataFrame, name_col: str = "run_name", id_col: str = "run_id",
                end_col: str = "end_time") -> DataFrame:
    """G7 for every name at once: (run_name, run_id, status).

    status is 'unfinished' (the single unfinished run), 'finished' (latest
    end time, smallest id on ties) or 'error' (more than one unfinished run;
    run_id null). Hash aggregations only: per name the unfinished count and
    id and the newest end time, then the smallest id among the runs at that
    end time (an equi-join on name and end time).
    """
    unfinished = F.col(end_col).isNull()
    stats = runs.groupBy(name_col).agg(
        F.sum(unfinished.cast("int")).alias("_unfinished"),
        F.min(F.when(unfinished, F.col(id_col))).alias("_open_id"),
        F.max(end_col).alias(end_col))
    newest = runs.join(stats.select(name_col, end_col), [name_col, end_col], "inner") \
        .groupBy(name_col).agg(F.min(id_col).alias("_latest_id"))
    agg = stats.join(newest, name_col, "left")
    status = (F.when(F.col("_unfinished") > 1, F.lit("error"))
              .when(F.col("_unfinished") == 1, F.lit("unfinished")).otherwise(F.lit("finished")))
    run_id = (F.when(F.col("_unfinished") > 1, F.lit(None))
              .when(F.col("_unfinished") == 1, F.col("_open_id")).otherwise(F.col("_latest_id")))
    return agg.select(F.col(name_col), run_id.alias(id_col), status.alias("status"))


def latest_run_id(runs: DataFrame, run_name: str, name_col: str = "run_name", id_col: str = "run_id",
                  end_col: str = "end_time"):
    """G7 for one name: the id, or an error following the rules above (reads one row)."""
    rows = latest_runs(runs.filter(F.col(name_col) == run_name), name_col, id_col, end_col).collect()
    if not rows:
        raise RuntimeError(f"the run log has no run called {run_name!r}")
    if rows[0]["status"] == "error":
        raise RuntimeError(f"{run_name!r} has several open runs; at most one may be open")
    return rows[0][id_col]


def save_model(model, path: str) -> str:
    """Write a fitted Spark ML model (overwrite) to shared storage."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Load a model saved by :func:`save_model`; a missing path raises."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def runs_table(spark: SparkSession, path: str) -> DataFrame:
    """Run list from the run log: one row per run id with its last entry time as end time."""
    log = spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
    return log.groupBy("run_id", "run_name").agg(
        F.max(F.when(F.col("kind") == "end", F.col("ts"))).alias("end_time"))

