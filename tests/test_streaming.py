import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cardlens.operators import drift, model as mdl, relative, sampling
from cardlens.operators.equity import with_win_share
from cardlens.sources import derived
from cardlens.streaming import pipelines as sp
from conftest import SF_SMALL

KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "code"]


def _scratch():
    return tempfile.mkdtemp(prefix="stream-")


def _write_files(df, path, n):
    df.repartition(n).write.mode("overwrite").parquet(path)


@pytest.fixture(scope="module")
def trained(spark):
    hands = derived.hands(spark, SF_SMALL)
    feats = with_win_share(relative.all_features(hands), n=4, seed=0).cache()
    model = mdl.train(feats, num_trees=3)
    # the lookup reaches scoring as a written table, as it does from the feature job
    path = os.path.join(_scratch(), "lookup")
    relative.stateful_lookup(feats).write.parquet(path)
    return hands, model, spark.read.parquet(path)


def test_streaming_scoring_equals_batch(spark, trained):
    hands, model, lookup = trained
    d = _scratch()
    src = os.path.join(d, "in")
    _write_files(hands, src, 3)
    q = sp.scoring_stream(spark, src, hands.schema, model, lookup, os.path.join(d, "out"),
                          os.path.join(d, "ckpt"), keep=tuple(KEYS))
    q.awaitTermination(300)
    streamed = spark.read.parquet(os.path.join(d, "out")).select(*KEYS, F.col("equity").alias("s"))
    batch = sp.score(hands, model, lookup, keep=tuple(KEYS)).select(*KEYS, F.col("equity").alias("b"))
    assert streamed.count() == hands.count()
    diff = streamed.join(batch, KEYS).filter(F.abs(F.col("s") - F.col("b")) > 1e-12).count()
    assert diff == 0


def test_streaming_drift_equals_batch(spark):
    live = derived.live(spark, SF_SMALL)
    baseline = drift.baseline_counts(live)
    d = _scratch()
    src = os.path.join(d, "in")
    _write_files(live, src, 4)
    n = 200
    stream = sp.read_stream(spark, src, live.schema, max_files_per_trigger=1)
    assert stream.isStreaming
    q = sp.drift_stream(spark, src, live.schema, baseline, n, os.path.join(d, "kept"), os.path.join(d, "report"),
                        os.path.join(d, "ckpt"), tie_cols=tuple(KEYS))
    q.awaitTermination(300)
    rep = spark.read.parquet(os.path.join(d, "report"))
    last = rep.agg(F.max("batch_id")).first()[0]
    got = {r["target"]: r["psi"] for r in rep.filter(F.col("batch_id") == last).collect()}
    window = sampling.min_rows_guard(sampling.latest_rows(live, n, "ts", tuple(KEYS)), n)
    exp = {r["target"]: r["psi"] for r in drift.psi_report(baseline, window).collect()}
    assert got.keys() == exp.keys()
    for k in exp:
        assert got[k] == pytest.approx(exp[k], rel=1e-12)


def test_streaming_windows_equal_batch_on_closed_windows(spark):
    log = derived.prediction_log(spark, SF_SMALL)
    d = _scratch()
    src = os.path.join(d, "in")
    _write_files(log, src, 3)
    q = sp.monitor_stream(spark, src, log.schema, "1 day", "1 day", os.path.join(d, "out"), os.path.join(d, "ckpt"))
    q.awaitTermination(300)
    streamed = {str(r["window_start"]): (r["n_predictions"], r["n_errors"])
                for r in spark.read.parquet(os.path.join(d, "out")).collect()}
    batch = {str(r["window_start"]): (r["n_predictions"], r["n_errors"])
             for r in sp.windowed_counts(log, "1 day", "1 day").collect()}
    assert streamed and len(streamed) < len(batch)   # the newest windows are still open
    for k, v in streamed.items():
        assert batch[k] == v


def test_late_rows_are_dropped_after_the_watermark(spark):
    log = derived.prediction_log(spark, SF_SMALL).withColumn("day", F.date_trunc("day", "ts"))
    days = sorted(r["day"] for r in log.select("day").distinct().collect())
    d = _scratch()
    src, out, ckpt = os.path.join(d, "in"), os.path.join(d, "out"), os.path.join(d, "ckpt")
    first = log.filter(F.col("day") <= days[9]).drop("day")
    first.write.parquet(os.path.join(src, "part1"))
    schema = first.schema
    sp.monitor_stream(spark, os.path.join(src, "*"), schema, "1 day", "1 day", out, ckpt).awaitTermination(300)
    emitted = {str(r["window_start"]): r["n_predictions"] for r in spark.read.parquet(out).collect()}
    # a second file: rows of day 1 (late by many days) and the next days
    late = log.filter(F.col("day") == days[0]).drop("day")
    more = log.filter((F.col("day") > days[9]) & (F.col("day") <= days[14])).drop("day")
    late.unionByName(more).write.parquet(os.path.join(src, "part2"))
    sp.monitor_stream(spark, os.path.join(src, "*"), schema, "1 day", "1 day", out, ckpt).awaitTermination(300)
    after = {}
    for r in spark.read.parquet(out).collect():
        after.setdefault(str(r["window_start"]), []).append(r["n_predictions"])
    first_day = str(days[0])
    assert after[first_day] == [emitted[first_day]]          # emitted once, late rows not counted
    assert len(after) > len(emitted)                          # newer windows closed by the new watermark
