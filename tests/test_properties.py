"""Property checks against plain-Python restatements of the definitions."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardlens.config import EQUITY_BIN_EDGES, equity_bin_labels
from cardlens.functions import cards
from cardlens.operators import drift


def _bin(x):
    edges, labels = EQUITY_BIN_EDGES, equity_bin_labels()
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return labels[-1]
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        if lo <= x < hi or (i == len(labels) - 1 and x == hi):
            return labels[i]
    return labels[-1]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.floats(allow_nan=True, allow_infinity=True, width=64),
                          st.sampled_from([0.0, 0.2, 0.4, 0.6, 0.8, 1.0, -0.0])), min_size=1, max_size=60))
def test_equity_bin_matches_definition(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, equity double")
    got = {r["i"]: r["b"] for r in df.select("i", cards.equity_bin(F.col("equity")).alias("b")).collect()}
    for i, v in enumerate(values):
        assert got[i] == _bin(v), v


@settings(max_examples=5, deadline=None)
@given(st.dictionaries(st.sampled_from(list("abcdef")), st.integers(1, 50), min_size=1),
       st.lists(st.sampled_from(list("abcdefgh")), min_size=1, max_size=40))
def test_categorical_psi_matches_definition(spark, base, live):
    eps = 1e-100
    bdf = spark.createDataFrame([("current_hand_class_value", k, n) for k, n in base.items()],
                                "feature string, label string, n long")
    ldf = spark.createDataFrame([(v,) for v in live], "current_hand_class_value string")
    got = drift.psi_report(bdf, ldf, binary=(), categorical=("current_hand_class_value",)).first()["psi"]
    total = sum(base.values())
    exp = 0.0
    for k, n in base.items():
        t = n / total + eps
        lv = live.count(k) / len(live) + eps
        exp += (lv - t) * math.log(lv / t)
    assert got == pytest.approx(exp, rel=1e-9, abs=1e-9)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 20000), st.integers(0, 60)),
                min_size=1, max_size=200, unique_by=lambda t: (t[0], t[1])),
       st.integers(1, 7))
def test_counter_increase_matches_sequential_definition(spark, samples, parts):
    import datetime as dt

    import pandas as pd

    from cardlens.operators import monitor
    base = dt.datetime(2024, 1, 1)
    rows = [(s, base + dt.timedelta(minutes=m), v) for s, m, v in samples]
    df = spark.createDataFrame(rows, "series string, ts timestamp, cum long")
    got = {(r["series"], pd.Timestamp(r["window_start"])): r["increase"]
           for r in monitor.counter_increase(df, "1 hour", partitions=parts).collect()}
    pdf = pd.DataFrame(rows, columns=["series", "ts", "cum"]).sort_values(["series", "ts"])
    prev = pdf.groupby("series").cum.shift()
    pdf["d"] = [0 if pd.isna(p) else (c - p if c >= p else c) for c, p in zip(pdf.cum, prev)]
    exp = pdf.groupby(["series", pdf.ts.dt.floor("h")]).d.sum()
    assert {(s, pd.Timestamp(w)): int(v) for (s, w), v in exp.items()} == got
