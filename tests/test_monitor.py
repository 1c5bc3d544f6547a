import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardlens.config import LATENCY_BUCKET_EDGES
from cardlens.operators import monitor
from cardlens.sources import derived
from conftest import SF_MID, SF_SMALL


def _quantile_from_buckets(values, q, edges):
    """Plain-Python bucket quantile: first bucket reaching q*n, linear inside it."""
    n = len(values)
    if n == 0:
        return None
    cums = [sum(v <= e for v in values) for e in edges] + [n]
    rank = q * n
    b = next(i for i, c in enumerate(cums) if c >= rank)
    if b == len(edges):
        return edges[-1]
    lo = 0.0 if b == 0 else edges[b - 1]
    prev = 0 if b == 0 else cums[b - 1]
    return lo + (edges[b] - lo) * (rank - prev) / (cums[b] - prev)


def test_bucket_quantile_matches_plain_python(spark):
    rnd = random.Random(3)
    rows = []
    for day in range(5):
        for _ in range(rnd.randrange(1, 60)):
            rows.append((f"2024-01-0{day + 1} 12:00:00", rnd.choice([rnd.random() * 3, rnd.random() * 20])))
    df = spark.createDataFrame(rows, "ts string, inference_seconds double").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {str(r["window_start"])[:10]: r["p95_seconds"] for r in monitor.latency_p95(df, "1 day").collect()}
    pdf = pd.DataFrame(rows, columns=["ts", "v"])
    for day, g in pdf.groupby(pdf.ts.str[:10]):
        assert got[day] == pytest.approx(_quantile_from_buckets(list(g.v), 0.95, LATENCY_BUCKET_EDGES))


def test_histogram_is_cumulative(spark):
    log = derived.prediction_log(spark, SF_SMALL)
    h = monitor.equity_histogram(log, "1 day").toPandas()
    for _, g in h.groupby("window_start"):
        counts = list(g.sort_values("cum_count").cum_count)
        assert counts == sorted(counts)
        assert g[g["le"] == "+Inf"].cum_count.iloc[0] == g.cum_count.max()


def test_counter_increase_matches_pandas(spark):
    samples = derived.counter_samples(spark, SF_MID)
    got = {(r["series"], pd.Timestamp(r["window_start"])): r["increase"]
           for r in monitor.counter_increase(samples, "1 day").collect()}
    pdf = samples.toPandas().sort_values(["series", "ts"])
    pdf["prev"] = pdf.groupby("series").cum.shift()
    delta = np.where(pdf.prev.isna(), 0, np.where(pdf.cum >= pdf.prev, pdf.cum - pdf.prev, pdf.cum))
    pdf["d"] = delta
    pdf["w"] = pdf.ts.dt.floor("D")
    exp = pdf.groupby(["series", "w"]).d.sum()
    assert len(exp) == len(got)
    for (s, w), v in exp.items():
        assert got[(s, pd.Timestamp(w))] == v


def test_counter_samples_need_no_shuffle(spark):
    samples = derived.counter_samples(spark, SF_SMALL)
    plan = samples._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert samples.count() == 1000 and samples.agg(F.max("cum")).first()[0] == 99


def test_a_null_series_is_kept(spark):
    rows = [(None, "2024-01-01 01:00:00", 5), (None, "2024-01-01 02:00:00", 9), ("", "2024-01-01 01:00:00", 1), ("", "2024-01-01 03:00:00", 4)]
    df = spark.createDataFrame(rows, "series string, ts string, cum long").withColumn("ts", F.col("ts").cast("timestamp"))
    for parts in (1, 3):
        got = {r["series"]: r["increase"] for r in monitor.counter_increase(df, "1 day", partitions=parts).collect()}
        assert got == {None: 4, "": 3}


def test_sustained_forms_and_last_psi(spark):
    log = derived.prediction_log(spark, SF_SMALL)
    windows = monitor.latency_alert(log, "1 day", 3.0).select("window_start", "window_end")
    assert sorted(monitor.sustained_latency(log, "1 day", 3.0, 2).collect()) == sorted(monitor.sustained(windows, 2).collect())
    reports = spark.createDataFrame([("a", 0.5, 1), ("a", 0.6, 2), ("a", 0.1, 3), ("b", 0.9, 1), ("b", 0.9, 3)], "target string, psi double, window_start int") \
        .withColumn("window_end", F.col("window_start") + 1)
    runs = [(r["target"], r["run_start"], r["n_windows"]) for r in monitor.sustained_drift(reports, 0.2, 2).collect()]
    assert runs == [("a", 1, 2)]
    last = {r["target"]: r["last_psi"] for r in monitor.last_psi(reports, ts="window_start").collect()}
    assert last == {"a": 0.1, "b": 0.9}


def test_sustained_runs(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05", "2024-01-07", "2024-01-08"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(
        F.col("d").cast("timestamp").alias("window_start"),
        (F.col("d").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("window_end"))
    runs = {str(r["run_start"])[:10]: (r["n_windows"], str(r["firing_from"])[:10])
            for r in monitor.sustained(df, 2).collect()}
    assert runs == {"2024-01-01": (3, "2024-01-02"), "2024-01-07": (2, "2024-01-08")}


def test_latest_value_and_rates(spark):
    log = derived.prediction_log(spark, SF_SMALL)
    last = monitor.latest_value(log, "current_hand_rank_value").first()
    pdf = log.toPandas().sort_values(["ts", "request_id"])
    assert last["last_current_hand_rank_value"] == pdf.current_hand_rank_value.iloc[-1]
    rate = monitor.prediction_rate(log, "1 day").agg(F.sum("n_predictions")).first()[0]
    assert rate == len(pdf)
    errs = monitor.errors_by_type(log, "1 hour").agg(F.sum("n_errors")).first()[0]
    assert errs == int((pdf.status >= 400).sum())


def test_counter_increase_one_hot_series_spread_over_partitions(spark):
    """One series holding every sample: the increase still matches a plain sequential pass."""
    rnd = random.Random(5)
    rows, cum = [], 0
    for i in range(5000):
        cum = 0 if rnd.random() < 0.02 else cum + rnd.randrange(0, 5)
        rows.append(("hot", f"2024-01-{1 + i // 1000:02d} {(i // 60) % 24:02d}:{i % 60:02d}:00", cum))
    df = spark.createDataFrame(rows, "series string, ts string, cum long").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {pd.Timestamp(r["window_start"]): r["increase"]
           for r in monitor.counter_increase(df, "1 day", partitions=7).collect()}
    pdf = df.toPandas().sort_values("ts")
    prev = pdf.cum.shift()
    pdf["d"] = np.where(prev.isna(), 0, np.where(pdf.cum >= prev, pdf.cum - prev, pdf.cum))
    exp = pdf.groupby(pdf.ts.dt.floor("D")).d.sum()
    assert {pd.Timestamp(k): int(v) for k, v in exp.items()} == got
