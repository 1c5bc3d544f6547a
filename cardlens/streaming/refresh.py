"""Scoring stream whose model and lookup are swapped while it runs (J1 with K4).

A refresh publishes a pair, model run and lookup run, as one run of the run log. Every micro-batch
takes the newest finished pair; the choice is written before the batch is scored and
read again if the batch is repeated, so a batch is scored with one pair whatever was published
in between. Every row carries the version it was scored with. Batches write to a folder of
their own, so a repeated batch replaces its rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import runlog
from ..session import child_folders
from .pipelines import score

REFRESH_RUN = "refresh"


def publish(spark: SparkSession, run_log: str, version: str, model_path: str, lookup_path: str) -> None:
    """Make a pair known: its parts first, its end last, so a reader never sees half of it."""
    runlog.log_entries(spark, run_log, version, REFRESH_RUN, "param", {"model": model_path, "lookup": lookup_path})
    runlog.log_entries(spark, run_log, version, REFRESH_RUN, "end", {"status": "FINISHED"})


def newest_pair(spark: SparkSession, run_log: str) -> tuple[str, str, str]:
    """(version, model folder, lookup folder) of the newest finished refresh; none is an error."""
    log = spark.read.schema(runlog.RUN_LOG_SCHEMA).parquet(run_log).filter(F.col("run_name") == REFRESH_RUN)
    ended = runlog.runs_table(spark, run_log).filter((F.col("run_name") == REFRESH_RUN) & F.col("end_time").isNotNull())
    if ended.isEmpty():
        raise RuntimeError("no refresh was published")
    version = runlog.latest_run_id(ended, REFRESH_RUN)
    params = runlog.run_values(log.filter(F.col("run_id") == version), "param", ("model", "lookup")).first()
    return version, params["model"], params["lookup"]


def scoring_stream_with_refresh(stream: DataFrame, run_log: str, root: str, keep: tuple = (), features=None,
                                available_now: bool = True) -> StreamingQuery:
    """Score a stream of hands into ``root/scored`` with the pair that is newest when a batch starts.

    Output columns: ``keep``, the inputs of the model, ``equity``, ``version``; read it with :func:`scored_rows`.
    """
    from ..config import MODEL_FEATURES

    features = features or MODEL_FEATURES
    loaded: dict = {}

    def pair_of(spark: SparkSession, batch_id: int):
        folder = f"{root}/choices"
        if str(batch_id) not in child_folders(spark, folder):
            chosen = spark.createDataFrame([newest_pair(spark, run_log)], "version string, model string, lookup string")
            chosen.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{batch_id}")
        found = spark.read.parquet(f"{folder}/{batch_id}").first()
        if loaded.get("version") != found["version"]:  # both parts are replaced at once
            loaded.update(version=found["version"], model=runlog.load_model(found["model"]), lookup=spark.read.parquet(found["lookup"]))
        return loaded["version"], loaded["model"], loaded["lookup"]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version, model, lookup = pair_of(spark, batch_id)
        scored = score(batch, model, lookup, features, keep)
        scored.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{root}/scored/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", os.path.join(root, "checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def scored_rows(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/scored")
