"""Structured Streaming forms of scoring, drift and monitoring.

* J1 :func:`scoring_stream` — new hands -> row features -> stream-static
  broadcast joins (rank table, per-rank lookup) -> model -> equity.
* J2 :func:`drift_stream` — ``foreachBatch`` keeps the newest N rows (a table
  of at most N rows on shared storage) and writes one drift report per
  micro-batch, idempotently.
* J3 :func:`monitor_stream` — event-time tumbling windows with a watermark;
  append mode emits each window once, after the watermark passes its end, and
  drops rows that arrive later than that.

All sources are file streams (new files in a folder); every query has its own
checkpoint location so a restarted driver resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import MODEL_FEATURES, TARGET
from ..operators import drift, sampling
from ..operators.features import model_inputs, stateless_features
from ..operators.model import predict
from ..operators.relative import join_lookup
from ..session import write_shared


def read_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def score(hands: DataFrame, model, lookup: DataFrame, features=MODEL_FEATURES, keep: tuple = ()) -> DataFrame:
    """J1 transformation (batch or stream): features, lookup join, inputs, prediction as ``equity``."""
    feats = join_lookup(stateless_features(hands), lookup)
    inputs = model_inputs(feats, features, keep=tuple(keep))
    return predict(model, inputs).withColumnRenamed("prediction", TARGET)


def scoring_stream(spark: SparkSession, source: str, schema, model, lookup: DataFrame, sink: str,
                   checkpoint: str, keep: tuple = (), available_now: bool = True) -> StreamingQuery:
    """Score hands landing in ``source`` into Parquet at ``sink``."""
    stream = read_stream(spark, source, schema)
    out = score(stream, model, lookup, keep=keep)
    writer = out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def drift_stream_from(stream: DataFrame, baseline: DataFrame, n: int, kept_path: str, report_path: str,
                      checkpoint: str, ts_col: str = "ts", tie_cols: tuple = (),
                      available_now: bool = True) -> StreamingQuery:
    """Drift of the newest ``n`` rows, recomputed per micro-batch.

    State is the kept window itself: at most ``n`` rows on shared storage, in
    two alternating folders ``kept_path/slot=<batch_id % 2>`` tagged with the
    batch id. A batch reads the other slot's rows of the previous batch, so a
    restarted driver resumes from storage, a retried batch never reads its own
    half-written output, and the state never grows past two windows. Reports
    go to ``report_path/batch_id=<id>`` (overwrite): a retried batch replaces
    its report instead of duplicating it.
    """
    baseline = write_shared(baseline, "baseline")  # counted once, not once per batch

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        sp = batch.sparkSession
        cols = batch.columns
        kept = batch
        if batch_id > 0:  # every batch writes its slot, so the previous one is there; anything wrong with it is an error
            schema = batch.withColumn("_batch", F.lit(batch_id).cast("long")).schema
            prev = sp.read.schema(schema).parquet(f"{kept_path}/slot={(batch_id - 1) % 2}")
            kept = kept.unionByName(prev.filter(F.col("_batch") == batch_id - 1).select(*cols))
        window = sampling.latest_rows(kept, n, ts_col, tie_cols).withColumn("_batch", F.lit(batch_id).cast("long"))
        slot = f"{kept_path}/slot={batch_id % 2}"
        window.write.mode("overwrite").parquet(slot)
        current = sp.read.parquet(slot).filter(F.col("_batch") == batch_id).drop("_batch")
        report = drift.psi_report(baseline, sampling.min_rows_guard(current, n))
        report.write.mode("overwrite").parquet(f"{report_path}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def drift_stream(spark: SparkSession, source: str, schema, baseline: DataFrame, n: int, kept_path: str,
                 report_path: str, checkpoint: str, ts_col: str = "ts", tie_cols: tuple = (),
                 available_now: bool = True) -> StreamingQuery:
    """J2 over files landing in ``source`` (see :func:`drift_stream_from`)."""
    return drift_stream_from(read_stream(spark, source, schema), baseline, n, kept_path, report_path,
                             checkpoint, ts_col, tie_cols, available_now)


def windowed_counts(events: DataFrame, duration: str, watermark: str, ts_col: str = "ts",
                    status_col: str = "status") -> DataFrame:
    """J3 transformation: per window, predictions and errors (status >= 400)."""
    ev = events.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark)
    agg = ev.groupBy(F.window(ts_col, duration).alias("window")).agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.sum((F.col(status_col) >= 400).cast("long")).alias("n_errors"))
    return agg.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      "n_predictions", "n_errors")


def monitor_stream(spark: SparkSession, source: str, schema, duration: str, watermark: str, sink: str,
                   checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append closed windows of prediction and error counts to Parquet."""
    out = windowed_counts(read_stream(spark, source, schema), duration, watermark)
    writer = out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
