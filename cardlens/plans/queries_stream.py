"""Registered queries that run the streaming pipelines (J2, J3) over a file stream of the inputs.

Each call streams the input table's Parquet file (as a one-file glob) through
the pipeline with an ``availableNow`` trigger into a fresh folder under the
shared checkpoint folder, then returns the written result as a DataFrame.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG
from ..operators import relative as rel
from ..session import scratch_path
from ..sources import derived
from ..sources.tables import table_path
from ..streaming import pipelines as sp
from . import oracle_sql as osql
from .queries import FEATURES_CTE, H, KEYS_SQL, R5, RH, ROW_ID, register
from .queries_ops import BINARY_INPUTS, PL, binary_forest, trained_model, training_parts
from .queries_ops import _BINARY_CTES, _BINARY_SCORES, _score
from .queries_stats import _H_CTES, _baseline, live_part, LIVE_WINDOW


def _stream_glob(sf_dir: str, name: str) -> str:
    """A glob that matches exactly the table's file (a file stream source needs a pattern or folder)."""
    return table_path(sf_dir, f"{name[:-1]}[{name[-1]}]")


def _run_dir(spark, prefix: str) -> str:
    return scratch_path(spark, prefix)


STREAM_FILES = 4


@register("j2_stream_drift", osql.with_ctes(*_H_CTES, body="""
SELECT target, round(psi, 6) AS psi, round(unknown_share, 6) AS unknown_share FROM report"""))
def j2_stream_drift(spark, sf_dir):
    """Streaming drift: the live part arrives in several files, one micro-batch each, so the kept window is carried on."""
    live = derived.live(spark, sf_dir).filter(live_part())
    run = _run_dir(spark, "j2")
    files = os.path.join(run, "in")
    live.repartition(STREAM_FILES, "code").write.option("maxRecordsPerFile", 0).parquet(files)
    stream = sp.read_stream(spark, files, live.schema, max_files_per_trigger=1)
    q = sp.drift_stream_from(stream, _baseline(spark, sf_dir), LIVE_WINDOW, os.path.join(run, "kept"), os.path.join(run, "report"),
                             os.path.join(run, "ckpt"), tie_cols=tuple(ROW_ID))
    q.awaitTermination()
    rep = spark.read.schema("target string, psi double, unknown_share double, batch_id long").parquet(os.path.join(run, "report"))
    last = q.lastProgress["batchId"]
    return rep.filter(F.col("batch_id") == last).select(
        "target", F.round("psi", 6).alias("psi"), F.round("unknown_share", 6).alias("unknown_share"))


@register("j3_stream_windows", osql.with_ctes(PL, """
w AS (SELECT date_trunc('day', ts) AS ws, count(*) AS n_predictions,
             CAST(sum(CASE WHEN status >= 400 THEN 1 ELSE 0 END) AS BIGINT) AS n_errors
      FROM prediction_log GROUP BY 1)""", body=f"""
SELECT {osql.ts_text('ws')} AS window_start, n_predictions, n_errors FROM w
WHERE ws + INTERVAL 1 DAY <= (SELECT max(ts) FROM prediction_log) - INTERVAL 1 DAY"""))
def j3_stream_windows(spark, sf_dir):
    """Watermarked 1-day windows over an event stream; only windows closed by the watermark are emitted."""
    src = _stream_glob(sf_dir, "events")
    schema = spark.read.parquet(table_path(sf_dir, "events")).schema
    run = _run_dir(spark, "j3")
    out = sp.windowed_counts(derived.prediction_log_from_events(sp.read_stream(spark, src, schema)), "1 day", "1 day")
    q = (out.writeStream.format("parquet").option("path", os.path.join(run, "out"))
         .option("checkpointLocation", os.path.join(run, "ckpt")).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    res = spark.read.parquet(os.path.join(run, "out"))
    return res.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "n_predictions", "n_errors")



def _stream_scored(spark, sf_dir, model, features):
    """The hands of the lineitem file as a stream: features, lookup join, forest; read back from the sink."""
    run = _run_dir(spark, "j1")
    rel.stateful_lookup(training_parts(spark, sf_dir)[0]).write.parquet(os.path.join(run, "lookup"))
    lookup = spark.read.parquet(os.path.join(run, "lookup"))
    schema = spark.read.parquet(table_path(sf_dir, "lineitem")).schema
    hands = derived.hands_from_lineitem(sp.read_stream(spark, _stream_glob(sf_dir, "lineitem"), schema))
    scored = sp.score(hands, model, lookup, features, keep=tuple(ROW_ID))
    q = (scored.writeStream.format("parquet").option("path", os.path.join(run, "out"))
         .option("checkpointLocation", os.path.join(run, "ckpt")).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(os.path.join(run, "out"))


@register("j1_stream_score")
def j1_stream_score(spark, sf_dir):
    """Streaming scoring with the full forest; the scores themselves, compared with batch scores in the tests."""
    scored = _stream_scored(spark, sf_dir, trained_model(spark, sf_dir), DEFAULT_CONFIG.model_features)
    return scored.select(*ROW_ID, *DEFAULT_CONFIG.model_features, "equity")


@register("j1_binary_forest", osql.with_ctes(*_BINARY_CTES, body=_BINARY_SCORES.format(name="equity", where="TRUE")))
def j1_binary_forest(spark, sf_dir):
    """Streaming scoring with the forest whose scores SQL can tell."""
    return _stream_scored(spark, sf_dir, binary_forest(spark, sf_dir), BINARY_INPUTS).select(*ROW_ID, *BINARY_INPUTS, _score("equity"))
