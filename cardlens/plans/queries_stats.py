"""Registered queries: relative features (D), sampling and counts (E), the
lookup join (F) and drift (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, RANK_VALUE, STATEFUL_FEATURES
from ..operators import drift
from ..operators import ranks
from ..operators import relative as rel
from ..operators import sampling
from ..session import scratch_path, write_shared
from ..sources import derived, io
from ..sources.tables import read_table
from . import oracle_sql as osql
from .queries import _B12_COLS, FEATURES_CTE, H, KEYS_SQL, R5, RH, ROW_ID, register

Z, CDF, GLOBAL = STATEFUL_FEATURES
LIVE_WINDOW = 1000
LIVE = osql.live_cte()
SAMPLE_KEYS = ["l_orderkey", "l_linenumber", "code"]


def _r6(name):
    return F.round(F.col(name), 6).alias(name)


def _ranked(spark, sf_dir):
    return ranks.with_rank_value(derived.hands(spark, sf_dir))


def _live(spark, sf_dir):
    return derived.live(spark, sf_dir)


def latest_live(spark, sf_dir, n):
    """The newest ``n`` live rows: cut from the raw rows, so only ``n`` are decoded and ranked.

    The cut is written (``n`` rows), because Spark moves projections below a limit and then no longer sees a top-N.
    """
    raw = derived.with_deal_code(read_table(spark, sf_dir, "lineitem"))
    newest = sampling.latest_rows(raw, n, "ship_ts", tuple(ROW_ID))
    return derived.live_from_hands(derived.hands_from_code(write_shared(newest, "latest")))


# ---------------------------------------------------------------------------
# D: relative features
# ---------------------------------------------------------------------------

_W = f"PARTITION BY current_hand_class_value"
_Z_SQL = (f"round((current_hand_rank_value - avg(current_hand_rank_value) OVER ({_W})) / "
          f"(stddev_samp(current_hand_rank_value) OVER ({_W}) + 1e-9), 6)")
_CDF_SQL = f"round(cume_dist() OVER ({_W} ORDER BY current_hand_rank_value), 6)"
_G_SQL = "round(percent_rank() OVER (ORDER BY current_hand_rank_value DESC), 6)"


@register("d1_class_z", osql.with_ctes(H, R5, RH, body=f"SELECT {KEYS_SQL}, {_Z_SQL} AS {Z} FROM ranked"))
def d1_class_z(spark, sf_dir):
    return rel.class_z_score(_ranked(spark, sf_dir)).select(*ROW_ID, _r6(Z))


@register("d2_class_cdf", osql.with_ctes(H, R5, RH, body=f"SELECT {KEYS_SQL}, {_CDF_SQL} AS {CDF} FROM ranked"))
def d2_class_cdf(spark, sf_dir):
    return rel.class_cdf(_ranked(spark, sf_dir)).select(*ROW_ID, _r6(CDF))


@register("d3_global_strength", osql.with_ctes(H, R5, RH, body=f"SELECT {KEYS_SQL}, {_G_SQL} AS {GLOBAL} FROM ranked"))
def d3_global_strength(spark, sf_dir):
    return rel.global_rank_strength(_ranked(spark, sf_dir)).select(*ROW_ID, _r6(GLOBAL))


@register("d4_relative_features", osql.with_ctes(H, R5, RH, body=f"""
SELECT {KEYS_SQL}, current_hand_rank_value, {_Z_SQL} AS {Z}, {_CDF_SQL} AS {CDF}, {_G_SQL} AS {GLOBAL} FROM ranked"""))
def d4_relative_features(spark, sf_dir):
    return rel.with_relative_features(_ranked(spark, sf_dir)).select(*ROW_ID, RANK_VALUE, _r6(Z), _r6(CDF), _r6(GLOBAL))


@register("d5_all_features", osql.with_ctes(H, R5, RH, FEATURES_CTE, body=f"""
SELECT {KEYS_SQL}, S1, C1, S2, C2, S3, C3, S4, C4, S5, C5, {', '.join(_B12_COLS)},
       {_Z_SQL} AS {Z}, {_CDF_SQL} AS {CDF}, {_G_SQL} AS {GLOBAL} FROM feats"""))
def d5_all_features(spark, sf_dir):
    cards = [f"{p}{i}" for i in range(1, 6) for p in "SC"]
    return rel.all_features(derived.hands(spark, sf_dir)).select(*ROW_ID, *cards, *_B12_COLS, _r6(Z), _r6(CDF), _r6(GLOBAL))


@register("d4_any_value_and_class", osql.with_ctes("""
t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_orderkey % 20011 END AS v,
             CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS c FROM lineitem)""", body=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(v AS DOUBLE) AS v, CAST(c AS DOUBLE) AS c,
       round((v - avg(v) OVER (PARTITION BY c)) / (stddev_samp(v) OVER (PARTITION BY c) + 1e-9), 6) AS {Z},
       round(cume_dist() OVER (PARTITION BY c ORDER BY v NULLS FIRST), 6) AS {CDF},
       round(percent_rank() OVER (ORDER BY v DESC NULLS LAST), 6) AS {GLOBAL} FROM t"""))
def d4_any_value_and_class(spark, sf_dir):
    """Relative features of other columns: values beyond the rank table that repeat across classes, with nulls in both."""
    t = read_table(spark, sf_dir, "lineitem").select(
        *derived.KEY_COLUMNS, F.when(F.col("l_suppkey") % 9 != 0, F.col("l_orderkey") % 20011).alias("v"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("c"))
    return rel.with_relative_features(t, "v", "c").select(*derived.KEY_COLUMNS, *[F.col(x).cast("double").alias(x) for x in "vc"], _r6(Z), _r6(CDF), _r6(GLOBAL))


# ---------------------------------------------------------------------------
# E: sampling, distinct, counts
# ---------------------------------------------------------------------------

_SAMPLE_PRED = f"{osql.hash_bucket_sql(SAMPLE_KEYS, 0)} < {int(DEFAULT_CONFIG.sample_rate * 10000)}"


@register("e1_hash_sample", osql.with_ctes(H, body=f"SELECT {KEYS_SQL} FROM hands WHERE {_SAMPLE_PRED}"))
def e1_hash_sample(spark, sf_dir):
    h = derived.hands(spark, sf_dir)
    return sampling.hash_sample(h, DEFAULT_CONFIG.sample_rate, SAMPLE_KEYS, seed=0).select(*ROW_ID)


@register("e2_stateful_lookup", osql.with_ctes(H, R5, RH, body=f"""
SELECT DISTINCT current_hand_rank_value, {_Z_SQL} AS {Z}, {_CDF_SQL} AS {CDF}, {_G_SQL} AS {GLOBAL} FROM ranked"""))
def e2_stateful_lookup(spark, sf_dir):
    """One row per rank value with the three relative features, straight from the count table
    (the same rows as de-duplicating a feature table on the rank value, without the join back)."""
    return rel.relative_lookup(_ranked(spark, sf_dir)).select(RANK_VALUE, _r6(Z), _r6(CDF), _r6(GLOBAL))


_FEATURE_COLUMNS = 4 + 2 + 10 + len(_B12_COLS) + len(STATEFUL_FEATURES)  # keys, time and code, cards, row and relative features


@register("e3_table_counts", osql.with_ctes(H, body=f"""
SELECT count(*) AS num_rows, CAST({_FEATURE_COLUMNS} AS INTEGER) AS num_columns FROM hands"""))
def e3_table_counts(spark, sf_dir):
    """Row and column counts of the feature table, which is built, written and read back."""
    path = scratch_path(spark, "e3_features")
    io.write_parquet(rel.all_features(derived.hands(spark, sf_dir)), path)
    feats = io.read_parquet(spark, path)
    return feats.agg(F.count(F.lit(1)).alias("num_rows")).withColumn("num_columns", F.lit(len(feats.columns)))


@register("e4_split", osql.with_ctes(H, body=f"""
SELECT {KEYS_SQL}, CASE WHEN {osql.hash_bucket_sql(SAMPLE_KEYS, DEFAULT_CONFIG.split_seed)} < {int(DEFAULT_CONFIG.test_size * 10000)}
                   THEN 'test' ELSE 'train' END AS split FROM hands"""))
def e4_split(spark, sf_dir):
    h = derived.hands(spark, sf_dir).select(*ROW_ID)
    return sampling.with_split(h, DEFAULT_CONFIG.test_size, SAMPLE_KEYS, DEFAULT_CONFIG.split_seed)


_LIVE_COLS = "hand_is_pair, hand_is_suited, board_is_paired, equity, current_hand_class_value"


@register("e5_latest_rows", osql.with_ctes(H, R5, RH, LIVE, osql.latest_cte(LIVE_WINDOW), body=f"""
SELECT {osql.ts_text('ts')} AS ts, {KEYS_SQL}, {_LIVE_COLS} FROM latest"""))
def e5_latest_rows(spark, sf_dir):
    latest = latest_live(spark, sf_dir, LIVE_WINDOW)
    return latest.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), *ROW_ID,
                         *[c.strip() for c in _LIVE_COLS.split(",")])


@register("e6_value_counts", osql.with_ctes(H, R5, RH, LIVE, body=f"""
SELECT feature, label, count(*) AS n FROM ({osql.live_long_sql('live')})
WHERE feature IN ('equity_bin', 'current_hand_class_value') GROUP BY feature, label"""))
def e6_value_counts(spark, sf_dir):
    live = _live(spark, sf_dir)
    return drift.long_labels(live, binary=(), categorical=("equity_bin", "current_hand_class_value")) \
        .groupBy("feature", "label").agg(F.count(F.lit(1)).alias("n"))


@register("e7_true_counts", osql.with_ctes(H, R5, RH, LIVE, body="""
SELECT feature, CAST(sum(CAST(v AS INTEGER)) AS BIGINT) AS n_true, count(*) AS n,
       CAST(sum(CAST(v IS NULL AS INTEGER)) AS BIGINT) AS n_null
FROM (SELECT 'hand_is_pair' AS feature, hand_is_pair AS v FROM live
      UNION ALL SELECT 'hand_is_suited', hand_is_suited FROM live
      UNION ALL SELECT 'board_is_paired', board_is_paired FROM live)
GROUP BY feature"""))
def e7_true_counts(spark, sf_dir):
    return drift.true_counts(_live(spark, sf_dir))


SHORT_OF = 100_000_000  # rows asked of the whole table


@register("e8_min_rows_guard", osql.with_ctes(H, body=" UNION ALL ".join([f"""
SELECT count(*) AS rows_found, CAST({LIVE_WINDOW} AS BIGINT) AS rows_required, count(*) >= {LIVE_WINDOW} AS passed
FROM (SELECT 1 FROM hands LIMIT {n})""" for n in (LIVE_WINDOW, LIVE_WINDOW - 1)] + [f"""
SELECT count(*) AS rows_found, CAST({SHORT_OF} AS BIGINT) AS rows_required, count(*) >= {SHORT_OF} AS passed
FROM hands"""])))
def e8_min_rows_guard(spark, sf_dir):
    """The guard on two windows of the newest rows, one that is filled and one that is a row short, and on the whole table,
    every hand of which is counted."""
    raw = derived.with_deal_code(read_table(spark, sf_dir, "lineitem"))
    newest = lambda n: sampling.latest_rows(raw, n, "ship_ts", tuple(ROW_ID))
    return sampling.guard_status(newest(LIVE_WINDOW), LIVE_WINDOW) \
        .unionByName(sampling.guard_status(newest(LIVE_WINDOW - 1), LIVE_WINDOW)) \
        .unionByName(sampling.guard_status(derived.hands(spark, sf_dir), SHORT_OF))


@register("e9_baseline_counts", osql.with_ctes(H, R5, RH, LIVE, body=f"""
SELECT feature, label, count(*) AS n FROM ({osql.live_long_sql('live')}) GROUP BY feature, label"""))
def e9_baseline_counts(spark, sf_dir):
    return drift.baseline_counts(_live(spark, sf_dir))


# ---------------------------------------------------------------------------
# F: lookup join
# ---------------------------------------------------------------------------

_SAMPLED = f"""sampled AS (SELECT * FROM ranked WHERE {_SAMPLE_PRED}),
lookup AS (
  SELECT DISTINCT current_hand_rank_value,
         (current_hand_rank_value - avg(current_hand_rank_value) OVER ({_W})) /
           (stddev_samp(current_hand_rank_value) OVER ({_W}) + 1e-9) AS z,
         cume_dist() OVER ({_W} ORDER BY current_hand_rank_value) AS cdf,
         percent_rank() OVER (ORDER BY current_hand_rank_value DESC) AS g
  FROM sampled)"""


@register("f1_lookup_join", osql.with_ctes(H, R5, RH, _SAMPLED, body=f"""
SELECT r.{KEYS_SQL.replace(', ', ', r.')}, r.current_hand_rank_value,
       round(coalesce(l.z, 0), 6) AS {Z}, round(coalesce(l.cdf, 0), 6) AS {CDF}, round(coalesce(l.g, 0), 6) AS {GLOBAL}
FROM ranked r LEFT JOIN lookup l ON l.current_hand_rank_value = r.current_hand_rank_value"""))
def f1_lookup_join(spark, sf_dir):
    """Row features of every hand joined to a lookup built from a 20% sample; misses become 0."""
    ranked = _ranked(spark, sf_dir)
    sample = sampling.hash_sample(ranked, DEFAULT_CONFIG.sample_rate, SAMPLE_KEYS, seed=0)
    lookup = rel.relative_lookup(sample)
    return rel.join_lookup(ranked.select(*ROW_ID, RANK_VALUE), lookup).select(
        *ROW_ID, RANK_VALUE, _r6(Z), _r6(CDF), _r6(GLOBAL))


# ---------------------------------------------------------------------------
# H: drift
# ---------------------------------------------------------------------------

# The live part of the table takes most pairs and few other hands, the baseline has the rest: no row is in both, pairs drift
# and suits do not.
_LIVE_PART = "CASE WHEN hand_is_pair THEN code % 10 < 8 ELSE code % 10 < 2 END"


def live_part():
    """``_LIVE_PART`` from the deal's code alone: the two hole cards are its first two digits, so a filter on it needs no
    decoded hand and stays short wherever Spark moves it."""
    code = F.col("code")
    # the first card is code % 52; the second comes from a deck without it, so a digit from there on means one card later.
    # Equal ranks are 13, 26 or 39 cards apart: this many digits
    apart = F.floor(code / 52) % 51 - code % 52
    return code % 10 < F.when(apart.isin(-39, -26, -13, 12, 25, 38), 8).otherwise(2)


def _newest_live(spark, sf_dir, n):
    """The newest ``n`` rows of the live part, cut before they are decoded and ranked."""
    raw = derived.with_deal_code(read_table(spark, sf_dir, "lineitem")).filter(live_part())
    newest = sampling.latest_rows(raw, n, "ship_ts", tuple(ROW_ID))
    return derived.live_from_hands(derived.hands_from_code(write_shared(newest, "latest")))


def _window(spark, sf_dir, n, required=None):
    return sampling.min_rows_guard(_newest_live(spark, sf_dir, n), required or n)


def _baseline(spark, sf_dir):
    return drift.baseline_counts(_live(spark, sf_dir).filter(~live_part()))


def _report(spark, sf_dir, n=LIVE_WINDOW):
    return drift.psi_report(_baseline(spark, sf_dir), _window(spark, sf_dir, n))


def _report_ctes(n: int, required: int | None = None) -> tuple:
    return (H, R5, RH, LIVE, f"base_part AS (SELECT * FROM live WHERE NOT ({_LIVE_PART}))",
            f"live_part AS (SELECT * FROM live WHERE {_LIVE_PART})", osql.latest_cte(n, "live_part"), f"""
base AS (SELECT feature, label, count(*) AS n FROM ({osql.live_long_sql('base_part')}) GROUP BY 1, 2),
lcounts AS (SELECT feature, label, count(*) AS n_live FROM ({osql.live_long_sql('latest')}) GROUP BY 1, 2),
ltotal AS (SELECT count(*) AS total FROM latest HAVING count(*) >= {required or n}),
terms AS (
  SELECT b.feature, b.label,
         CAST(b.n AS DOUBLE) / sum(b.n) OVER (PARTITION BY b.feature) + 1e-100 AS t,
         CAST(coalesce(c.n_live, 0) AS DOUBLE) / lt.total + 1e-100 AS l,
         coalesce(c.n_live, 0) AS known, lt.total
  FROM base b JOIN ltotal lt ON TRUE LEFT JOIN lcounts c ON c.feature = b.feature AND c.label = b.label),
report AS (
  SELECT feature AS target, sum((l - t) * ln(l / t)) AS psi, 1.0 - sum(known) / max(total) AS unknown_share
  FROM terms GROUP BY feature)""")


_H_CTES = _report_ctes(LIVE_WINDOW)


@register("h2_binary_psi", osql.with_ctes(*_H_CTES, body="""
SELECT target, round(psi, 6) AS psi FROM report WHERE target IN ('hand_is_pair', 'hand_is_suited', 'board_is_paired')"""))
def h2_binary_psi(spark, sf_dir):
    rep = _report(spark, sf_dir)
    return rep.filter(F.col("target").isin(*drift.BINARY_DRIFT_FEATURES)).select("target", _r6("psi"))


@register("h3_categorical_psi", osql.with_ctes(*_H_CTES, body="""
SELECT target, round(psi, 6) AS psi FROM report WHERE target IN ('equity_bin', 'current_hand_class_value')"""))
def h3_categorical_psi(spark, sf_dir):
    rep = _report(spark, sf_dir)
    return rep.filter(F.col("target").isin(*drift.CATEGORICAL_DRIFT_FEATURES)).select("target", _r6("psi"))


@register("h4_drift_report", osql.with_ctes(*_H_CTES, body="""
SELECT target, round(psi, 6) AS psi, round(unknown_share, 6) AS unknown_share FROM report"""))
def h4_drift_report(spark, sf_dir):
    return _report(spark, sf_dir).select("target", _r6("psi"), _r6("unknown_share"))


@register("h5_drift_alert", osql.with_ctes(*_H_CTES, body="""
SELECT target, round(psi, 6) AS psi FROM report WHERE psi > 0.2"""))
def h5_drift_alert(spark, sf_dir):
    return drift.drift_alerts(_report(spark, sf_dir), DEFAULT_CONFIG.psi_alert_threshold).select("target", _r6("psi"))


@register("h4_short_window", osql.with_ctes(*_report_ctes(LIVE_WINDOW - 1, LIVE_WINDOW), body="""
SELECT target, round(psi, 6) AS psi, round(unknown_share, 6) AS unknown_share FROM report"""))
def h4_short_window(spark, sf_dir):
    """The report on a window that is not filled, one row short of the live window: no rows."""
    window = _window(spark, sf_dir, LIVE_WINDOW - 1, LIVE_WINDOW)
    return drift.psi_report(_baseline(spark, sf_dir), window).select("target", _r6("psi"), _r6("unknown_share"))


def _quarterly_reports(spark, sf_dir):
    """A PSI report per ship quarter of the live part, against the one baseline, as rows (target, window, psi)."""
    live = _live(spark, sf_dir).filter(live_part()).withColumn("_quarter", F.date_trunc("quarter", "ts"))
    counts = drift.long_labels(live, keep=("_quarter",)).groupBy("_quarter", "feature", "label").agg(F.count(F.lit(1)).alias("n_live"))
    return drift.psi_by_window(_baseline(spark, sf_dir), counts, "_quarter")


_QUARTER_CTES = (H, R5, RH, LIVE, f"base_part AS (SELECT * FROM live WHERE NOT ({_LIVE_PART}))",
               f"live_part AS (SELECT * FROM live WHERE {_LIVE_PART})", f"""
base AS (SELECT feature, label, count(*) AS n FROM ({osql.live_long_sql('base_part')}) GROUP BY 1, 2),
months AS (SELECT DISTINCT date_trunc('quarter', ts) AS m FROM live_part),
lc AS ({" UNION ALL ".join(f"SELECT date_trunc('quarter', ts) AS m, '{f}' AS feature, CAST({e} AS VARCHAR) AS label FROM live_part"
       for f, e in (("hand_is_pair", "hand_is_pair"), ("hand_is_suited", "hand_is_suited"), ("board_is_paired", "board_is_paired"),
                    ("equity_bin", osql.equity_bin_sql("equity")), ("current_hand_class_value", "current_hand_class_value")))}),
lcounts AS (SELECT m, feature, label, count(*) AS n_live FROM lc GROUP BY 1, 2, 3),
ltotal AS (SELECT m, feature, sum(n_live) AS total FROM lcounts GROUP BY 1, 2),
terms AS (
  SELECT lt.m, b.feature,
         CAST(b.n AS DOUBLE) / (SELECT sum(x.n) FROM base x WHERE x.feature = b.feature) + 1e-100 AS t,
         CAST(coalesce(c.n_live, 0) AS DOUBLE) / lt.total + 1e-100 AS l
  FROM base b JOIN ltotal lt ON lt.feature = b.feature
  LEFT JOIN lcounts c ON c.m = lt.m AND c.feature = b.feature AND c.label = b.label),
reports AS (SELECT m, feature AS target, sum((l - t) * ln(l / t)) AS psi FROM terms GROUP BY 1, 2)""")
SUSTAINED_PSI, SUSTAINED_REPORTS = 0.45, 2


@register("h5_sustained_drift", osql.with_ctes(*_QUARTER_CTES, f"""
hot AS (SELECT target, m, m + INTERVAL 3 MONTH AS e, lag(m + INTERVAL 3 MONTH) OVER (PARTITION BY target ORDER BY m) AS prev
        FROM reports WHERE psi > {SUSTAINED_PSI}),
isl AS (SELECT *, sum(CASE WHEN prev = m THEN 0 ELSE 1 END) OVER (PARTITION BY target ORDER BY m) AS run FROM hot),
pos AS (SELECT *, row_number() OVER (PARTITION BY target, run ORDER BY m) AS k FROM isl)""", body=f"""
SELECT target, {osql.ts_text('min(m)')} AS run_start, {osql.ts_text('max(e)')} AS run_end, count(*) AS n_windows,
       {osql.ts_text(f'min(CASE WHEN k = {SUSTAINED_REPORTS} THEN m END)')} AS firing_from
FROM pos GROUP BY target, run HAVING count(*) >= {SUSTAINED_REPORTS}"""))
def h5_sustained_drift(spark, sf_dir):
    """Targets whose PSI stays above the threshold for some quarterly reports in a row."""
    from ..operators import monitor

    reports = _quarterly_reports(spark, sf_dir).select("target", "psi", F.col("_quarter").alias("window_start"),
                                                   (F.col("_quarter") + F.expr("INTERVAL 3 MONTH")).alias("window_end"))
    runs = monitor.sustained_drift(reports, SUSTAINED_PSI, SUSTAINED_REPORTS)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return runs.select("target", text("run_start"), text("run_end"), "n_windows", text("firing_from"))


@register("i10_last_psi", osql.with_ctes(*_QUARTER_CTES, body=f"""
SELECT target, round(psi, 6) AS last_psi, {osql.ts_text('m')} AS last_ts FROM reports
WHERE m = (SELECT max(m) FROM reports)"""))
def i10_last_psi(spark, sf_dir):
    """The last PSI of every target, from a table of quarterly reports."""
    from ..operators import monitor

    last = monitor.last_psi(_quarterly_reports(spark, sf_dir), ts="_quarter")
    return last.select("target", _r6("last_psi"), F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss").alias("last_ts"))


_SPLIT_PRED = f"{osql.hash_bucket_sql(SAMPLE_KEYS, DEFAULT_CONFIG.split_seed)} < {int(DEFAULT_CONFIG.test_size * 10000)}"


@register("h1_psi", osql.with_ctes(H, R5, RH, LIVE, f"""
tr AS (SELECT * FROM live WHERE NOT ({_SPLIT_PRED})),
te AS (SELECT * FROM live WHERE {_SPLIT_PRED}),
ce AS (SELECT feature, label, count(*) AS n FROM ({osql.live_long_sql('tr')}) GROUP BY 1, 2),
ca AS (SELECT feature, label, count(*) AS n FROM ({osql.live_long_sql('te')}) GROUP BY 1, 2),
j AS (
  SELECT coalesce(ce.feature, ca.feature) AS feature, coalesce(ce.n, 0) AS ne, coalesce(ca.n, 0) AS na
  FROM ce FULL OUTER JOIN ca ON ce.feature = ca.feature AND ce.label = ca.label),
s AS (
  SELECT feature, CAST(ne AS DOUBLE) / sum(ne) OVER (PARTITION BY feature) + 1e-100 AS t,
         CAST(na AS DOUBLE) / sum(na) OVER (PARTITION BY feature) + 1e-100 AS l FROM j)""", body="""
SELECT feature AS target, round(sum((l - t) * ln(l / t)), 6) AS psi FROM s GROUP BY feature"""))
def h1_psi(spark, sf_dir):
    """PSI between the train and test parts of the split, for every drift feature."""
    live = sampling.with_split(_live(spark, sf_dir), DEFAULT_CONFIG.test_size, SAMPLE_KEYS, DEFAULT_CONFIG.split_seed)
    # one pass: label counts per (split, feature, label); both sides read the same aggregate
    counts = drift.long_labels(live, keep=("split",)).groupBy("split", "feature", "label") \
        .agg(F.count(F.lit(1)).alias("n"))
    train = counts.filter(F.col("split") == "train").drop("split")
    test = counts.filter(F.col("split") == "test").drop("split")
    return drift.distribution_psi(train, test).select("target", _r6("psi"))
