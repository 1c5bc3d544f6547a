import json
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cardlens.operators import drift, sampling

# Baseline counts and live window of the drift job's sample files (fixed values).
BASELINE = {
    "hand_is_pair": {"false": 8500, "true": 1500},
    "hand_is_suited": {"false": 7600, "true": 2400},
    "board_is_paired": {"false": 8800, "true": 1200},
    "equity_bin": {"0.0-0.2": 1200, "0.2-0.4": 2200, "0.4-0.6": 3100, "0.6-0.8": 2300, "0.8-1.0": 1200},
    "current_hand_class_value": {"0": 5, "1": 25, "2": 80, "3": 220, "4": 180, "5": 350, "6": 700,
                                 "7": 1400, "8": 3200, "9": 3840},
}
LIVE = {
    "hand_is_pair": {"0": True, "1": True, "2": True, "3": True, "4": True},
    "hand_is_suited": {"0": True, "1": True, "2": True, "3": False, "4": True},
    "board_is_paired": {"0": True, "1": True, "2": False, "3": True, "4": True},
    "equity": {"0": 0.92, "1": 0.88, "2": 0.95, "3": 0.85, "4": 0.91},
    "current_hand_class_value": {"0": "2", "1": "3", "2": "1", "3": "2", "4": "4"},
    "timestamp": {"0": 1786471200000, "1": 1786471260000, "2": 1786471320000, "3": 1786471380000,
                  "4": 1786471440000},
    "equity_bin": {"0": "0.8-1.0", "1": "0.8-1.0", "2": "0.8-1.0", "3": "0.8-1.0", "4": "0.8-1.0"},
}
EXPECTED = {
    "hand_is_pair": 197.19414380157377,
    "hand_is_suited": 1.4218253677926347,
    "board_is_paired": 2.2975326775508655,
    "equity_bin": 203.20468817243005,
    "current_hand_class_value": 220.54586992970775,
}


@pytest.fixture(scope="module")
def files():
    d = tempfile.mkdtemp(prefix="drift-")
    paths = {}
    for name, obj in (("baseline", BASELINE), ("live", LIVE)):
        paths[name] = os.path.join(d, f"{name}.json")
        with open(paths[name], "w") as f:
            json.dump(obj, f)
    return paths


def test_read_json_files(spark, files):
    base = drift.read_baseline_json(spark, files["baseline"])
    assert base.count() == 2 + 2 + 2 + 5 + 10
    live = drift.read_live_json(spark, files["live"])
    rows = {r["row_index"]: r for r in live.collect()}
    assert len(rows) == 5 and rows[3]["hand_is_suited"] is False
    assert str(rows[0]["ts"]) == "2026-08-11 18:00:00"


def test_report_matches_published_formula(spark, files):
    base = drift.read_baseline_json(spark, files["baseline"])
    live = drift.read_live_json(spark, files["live"])
    window = sampling.min_rows_guard(sampling.latest_rows(live, 5, "ts", ("row_index",)), 5)
    got = {r["target"]: r["psi"] for r in drift.psi_report(base, window).collect()}
    for k, v in EXPECTED.items():
        assert got[k] == pytest.approx(v, rel=1e-12), k


def test_guard_empties_short_window(spark, files):
    base = drift.read_baseline_json(spark, files["baseline"])
    live = drift.read_live_json(spark, files["live"])
    window = sampling.min_rows_guard(sampling.latest_rows(live, 6, "ts"), 6)
    assert window.count() == 0
    assert drift.psi_report(base, window).count() == 0  # no report, not a report of nulls
    assert sampling.guard_status(sampling.latest_rows(live, 6, "ts"), 6).first()["passed"] is False


def _psi(t, l):
    return sum((b - a) * math.log(b / a) for a, b in zip(t, l))


def _counts(spark, rows, feature="f"):
    return spark.createDataFrame([(feature, str(k), n) for k, n in rows], "feature string, label string, n long")


def test_psi_closed_forms(spark):
    eps = 1e-100
    same = drift.distribution_psi(_counts(spark, [("a", 5), ("b", 5)]), _counts(spark, [("a", 5), ("b", 5)]))
    assert same.first()["psi"] == pytest.approx(0.0, abs=1e-12)
    got = drift.distribution_psi(_counts(spark, [("a", 7), ("b", 3)]), _counts(spark, [("a", 4), ("b", 6)])).first()
    assert got["psi"] == pytest.approx(_psi([0.7 + eps, 0.3 + eps], [0.4 + eps, 0.6 + eps]))


def _binary_report(spark, train_true, train_false, live_values):
    base = spark.createDataFrame([("hand_is_pair", "true", train_true), ("hand_is_pair", "false", train_false)],
                                 "feature string, label string, n long")
    live = spark.createDataFrame([(v,) for v in live_values], "hand_is_pair boolean")
    rep = drift.psi_report(base, live, binary=("hand_is_pair",), categorical=())
    return rep.first()["psi"]


def test_binary_cases(spark):
    assert _binary_report(spark, 3, 9, [True, False, False, False] * 3) == pytest.approx(0.0, abs=1e-12)
    eps = 1e-100
    assert _binary_report(spark, 30, 70, [True] * 3 + [False]) == pytest.approx(_psi([0.3, 0.7], [0.75, 0.25]))
    assert _binary_report(spark, 8, 0, [False] * 3) == pytest.approx(_psi([1 + eps, eps], [eps, 1 + eps]))


def test_null_flags_are_rejected_not_counted(spark):
    assert _binary_report(spark, 1, 1, [True, False, None]) == pytest.approx(0.0, abs=1e-12)


def test_reports_of_many_windows_equal_single_reports(spark):
    base = _counts(spark, [("x", 5), ("y", 3), ("z", 2)], "current_hand_class_value")
    rows = [(w, lab) for w, labs in ((1, "xxyz"), (2, "yyyyq")) for lab in labs]
    live = spark.createDataFrame(rows, "w int, current_hand_class_value string")
    counts = drift.long_labels(live, binary=(), categorical=("current_hand_class_value",), keep=("w",)) \
        .groupBy("w", "feature", "label").agg(F.count(F.lit(1)).alias("n_live"))
    got = {r["w"]: r["psi"] for r in drift.psi_by_window(base, counts, "w").collect()}
    for w in (1, 2):
        one = drift.psi_report(base, live.filter(F.col("w") == w), binary=(), categorical=("current_hand_class_value",)).first()
        assert got[w] == pytest.approx(one["psi"])


def test_categorical_ignores_unknown_labels_but_keeps_them_in_total(spark):
    base = _counts(spark, [("x", 50), ("y", 50)], "current_hand_class_value")
    live = spark.createDataFrame([("x",), ("x",), ("z",), ("z",)], "current_hand_class_value string")
    rep = drift.psi_report(base, live, binary=(), categorical=("current_hand_class_value",)).first()
    eps = 1e-100
    assert rep["psi"] == pytest.approx(_psi([0.5 + eps, 0.5 + eps], [0.5 + eps, 0.0 + eps]))
    assert rep["unknown_share"] == pytest.approx(0.5)


def test_integer_live_labels_match_string_baseline(spark):
    base = _counts(spark, [("1", 5), ("2", 5)], "current_hand_class_value")
    live = spark.createDataFrame([(1,), (2,)], "current_hand_class_value int")
    rep = drift.psi_report(base, live, binary=(), categorical=("current_hand_class_value",)).first()
    assert rep["psi"] == pytest.approx(0.0, abs=1e-12)


def test_one_bin_drift(spark):
    base = _counts(spark, [("0.0-0.2", 20), ("0.2-0.4", 20), ("0.4-0.6", 20), ("0.6-0.8", 20), ("0.8-1.0", 20)],
                   "equity_bin")
    live = spark.createDataFrame([(0.9,)] * 5, "equity double")
    rep = drift.psi_report(base, live, binary=(), categorical=("equity_bin",)).first()
    assert rep["psi"] > 0.2


def test_alerts_and_baseline_counts(spark):
    rep = spark.createDataFrame([("a", 0.1), ("b", 0.5)], "target string, psi double")
    assert [r["target"] for r in drift.drift_alerts(rep).collect()] == ["b"]
    feats = spark.createDataFrame([(1, 0, 0, 0.5, 8), (0, 0, 1, 0.1, 9)],
                                  "hand_is_pair int, hand_is_suited int, board_is_paired int, equity double, "
                                  "current_hand_class_value int")
    counts = {(r["feature"], r["label"]): r["n"] for r in drift.baseline_counts(feats).collect()}
    assert counts[("hand_is_pair", "true")] == 1 and counts[("board_is_paired", "false")] == 1
    assert counts[("equity_bin", "0.4-0.6")] == 1 and counts[("current_hand_class_value", "9")] == 1


def test_true_counts_and_value_counts(spark):
    df = spark.createDataFrame([(True, "a"), (False, "a"), (None, "b")], "hand_is_pair boolean, c string")
    tc = drift.true_counts(df, ("hand_is_pair",)).first()
    assert (tc["n_true"], tc["n"], tc["n_null"]) == (1, 3, 1)
    vc = {r["label"]: r["n"] for r in drift.value_counts(df, "c").collect()}
    assert vc == {"a": 2, "b": 1}


def test_latest_rows_orders_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, "2024-01-02"), (3, "2024-01-03"), (4, "2024-01-03")],
                               "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = [r["id"] for r in sampling.latest_rows(df, 3, "ts", ("id",)).collect()]
    assert got == [3, 4, 2]


def test_drift_job_from_the_command_line(spark, files):
    from cardlens.plans import cli
    root = tempfile.mkdtemp(prefix="drift-job-")
    out = cli.main(["drift", "--root", root, "--baseline", files["baseline"], "--live", files["live"]], spark=spark)
    got = {r["target"]: r["psi"] for r in out["report"].collect()}
    for k, v in EXPECTED.items():
        assert got[k] == pytest.approx(v, rel=1e-12)
    assert spark.read.parquet(os.path.join(root, "drift_reports")).count() == 5
    short = cli.main(["drift", "--root", root, "--baseline", files["baseline"], "--live", files["live"], "--rows", "6"], spark=spark)
    assert short["report"].count() == 0 and spark.read.parquet(os.path.join(root, "drift_reports")).count() == 5


def test_json_round_trip(spark, files):
    d = tempfile.mkdtemp(prefix="drift-json-")
    base = drift.read_baseline_json(spark, files["baseline"])
    drift.write_baseline_json(base, os.path.join(d, "b"))
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(drift.read_baseline_json(spark, os.path.join(d, "b"))) == rows(base)
    live = drift.read_live_json(spark, files["live"])
    drift.write_live_json(live, os.path.join(d, "l"))
    assert rows(drift.read_live_json(spark, os.path.join(d, "l")).drop("row_index")) == rows(live.drop("row_index"))
