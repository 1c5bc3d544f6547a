"""Registered queries: monitoring (I), model and run log (G), sources and sinks (A)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..config import CARD_COLUMNS, DEFAULT_CONFIG, LATENCY_BUCKET_EDGES, RANK_VALUE
from ..operators import model as mdl
from ..operators import monitor as mon
from ..operators import ranks
from ..operators import relative as rel
from ..operators import runlog
from ..operators import sampling
from ..functions import cards
from ..operators import drift
from ..session import scratch_path, write_shared
from ..sources import derived, io
from . import oracle_sql as osql
from .queries import FEATURES_CTE, H, KEYS_SQL, R5, RH, ROW_ID, register
from .queries_stats import LIVE_WINDOW, SAMPLE_KEYS, latest_live

PL = osql.prediction_log_cte()
DAY = "1 day"
ERROR_RATE_THRESHOLD = 0.0008  # errors per second over a day (test data: 50-80 errors a day)
SUSTAIN_WINDOWS = 2


def _text(col: str):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(col)


def _r6(name):
    return F.round(F.col(name), 6).alias(name)


def _log(spark, sf_dir):
    return derived.prediction_log(spark, sf_dir)


_DAY_SQL = osql.ts_text("date_trunc('day', ts)")


# ---------------------------------------------------------------------------
# I: monitoring
# ---------------------------------------------------------------------------

@register("i01_prediction_rate", osql.with_ctes(PL, body=f"""
SELECT {_DAY_SQL} AS window_start, count(*) AS n_predictions, round(count(*) / 86400.0, 6) AS rate_per_sec
FROM prediction_log GROUP BY 1"""))
def i01_prediction_rate(spark, sf_dir):
    r = mon.prediction_rate(_log(spark, sf_dir), DAY)
    return r.select(_text("window_start"), "n_predictions", _r6("rate_per_sec"))


_EQ_EDGES = [str(e) for e in mon.EQUITY_HISTOGRAM_EDGES]


@register("i02_equity_histogram", osql.with_ctes(PL, f"""
hist AS (
  SELECT {_DAY_SQL} AS window_start,
         {', '.join(f"CAST(sum(CASE WHEN equity <= {e} THEN 1 ELSE 0 END) AS BIGINT) AS c{i}" for i, e in enumerate(_EQ_EDGES))},
         count(equity) AS cinf
  FROM prediction_log GROUP BY 1)""", body="\nUNION ALL\n".join(
    [f"SELECT window_start, '{e}' AS le, c{i} AS cum_count FROM hist" for i, e in enumerate(_EQ_EDGES)]
    + ["SELECT window_start, '+Inf' AS le, cinf AS cum_count FROM hist"])))
def i02_equity_histogram(spark, sf_dir):
    h = mon.equity_histogram(_log(spark, sf_dir), DAY)
    return h.select(_text("window_start"), "le", "cum_count")


def _p95_sql(q: float = 0.95) -> str:
    edges = list(LATENCY_BUCKET_EDGES)
    n = len(edges)
    cums = ", ".join(f"CAST(sum(CASE WHEN inference_seconds <= {e} THEN 1 ELSE 0 END) AS BIGINT) AS c{i}"
                     for i, e in enumerate(edges))
    qd = f"CAST({q} AS DOUBLE)"
    b = " + ".join(f"CAST(c{i} < {qd} * total AS INTEGER)" for i in range(n + 1))
    cum_list = "[" + ", ".join(f"c{i}" for i in range(n + 1)) + "]"
    up = "CAST([" + ", ".join(str(float(e)) for e in edges) + "] AS DOUBLE[])"
    lo = "CAST([0.0, " + ", ".join(str(float(e)) for e in edges[:-1]) + "] AS DOUBLE[])"
    return f"""lat AS (
  SELECT {_DAY_SQL} AS window_start, {cums}, count(inference_seconds) AS c{n}, count(inference_seconds) AS total
  FROM prediction_log GROUP BY 1),
lat2 AS (SELECT *, {b} AS b, {cum_list} AS cl FROM lat),
p95 AS (
  SELECT window_start, total AS n,
    CASE WHEN total = 0 THEN NULL
         WHEN b >= {n} THEN CAST({float(edges[-1])} AS DOUBLE)
         ELSE {lo}[b + 1] + ({up}[b + 1] - {lo}[b + 1])
              * (({qd} * total - CASE WHEN b = 0 THEN 0 ELSE cl[b] END)
                 / (cl[b + 1] - CASE WHEN b = 0 THEN 0 ELSE cl[b] END)) END AS p95_seconds
  FROM lat2)"""


@register("i03_latency_p95", osql.with_ctes(PL, _p95_sql(), body="""
SELECT window_start, n, round(p95_seconds, 6) AS p95_seconds FROM p95"""))
def i03_latency_p95(spark, sf_dir):
    p = mon.latency_p95(_log(spark, sf_dir), DAY)
    return p.select(_text("window_start"), "n", _r6("p95_seconds"))


@register("i03_latency_p95_approx", osql.with_ctes(PL, f"""
ordered AS (
  SELECT {_DAY_SQL} AS window_start, inference_seconds AS v,
         row_number() OVER (PARTITION BY {_DAY_SQL} ORDER BY inference_seconds) AS k,
         count(inference_seconds) OVER (PARTITION BY {_DAY_SQL}) AS n FROM prediction_log WHERE inference_seconds IS NOT NULL)""", body="""
SELECT window_start, v AS p95_seconds_approx FROM ordered WHERE k = ceil(0.95 * n)"""))
def i03_latency_p95_approx(spark, sf_dir):
    """The direct quantile beside the bucket estimate: percentile_approx per window (bounded memory; exact while a
    window has fewer rows than its accuracy)."""
    p = mon.approx_quantile(_log(spark, sf_dir), "inference_seconds", 0.95, DAY)
    return p.select(_text("window_start"), F.col("quantile").alias("p95_seconds_approx"))


@register("i04_mean_load_time", osql.with_ctes(PL, body=f"""
SELECT {_DAY_SQL} AS window_start, round(avg(load_seconds), 6) AS mean_load_seconds FROM prediction_log GROUP BY 1"""))
def i04_mean_load_time(spark, sf_dir):
    m = mon.windowed_mean(_log(spark, sf_dir), "load_seconds", DAY, out_col="mean_load_seconds")
    return m.select(_text("window_start"), _r6("mean_load_seconds"))


@register("i05_mean_payload_size", osql.with_ctes(PL, body=f"""
SELECT {_DAY_SQL} AS window_start, round(avg(payload_bytes), 6) AS mean_payload_bytes FROM prediction_log GROUP BY 1"""))
def i05_mean_payload_size(spark, sf_dir):
    m = mon.windowed_mean(_log(spark, sf_dir), "payload_bytes", DAY, out_col="mean_payload_bytes")
    return m.select(_text("window_start"), _r6("mean_payload_bytes"))


@register("i06_errors_by_type", osql.with_ctes(PL, body=f"""
SELECT {osql.ts_text("date_trunc('hour', ts)")} AS window_start, status, count(*) AS n_errors
FROM prediction_log WHERE status >= 400 GROUP BY 1, 2"""))
def i06_errors_by_type(spark, sf_dir):
    e = mon.errors_by_type(_log(spark, sf_dir), "1 hour")
    return e.select(_text("window_start"), "status", "n_errors")


_ERR_SQL = f"""err AS (
  SELECT date_trunc('day', ts) AS ws, count(*) AS n_errors, count(*) / 86400.0 AS errors_per_sec
  FROM prediction_log WHERE status >= 400 GROUP BY 1),
alert AS (SELECT * FROM err WHERE errors_per_sec > {ERROR_RATE_THRESHOLD})"""


@register("i07_error_rate_alert", osql.with_ctes(PL, _ERR_SQL, body=f"""
SELECT {osql.ts_text('ws')} AS window_start, n_errors, round(errors_per_sec, 6) AS errors_per_sec FROM alert"""))
def i07_error_rate_alert(spark, sf_dir):
    a = mon.error_rate_alert(_log(spark, sf_dir), DAY, ERROR_RATE_THRESHOLD)
    return a.select(_text("window_start"), "n_errors", _r6("errors_per_sec"))


@register("i08_sustained_alert", osql.with_ctes(PL, _ERR_SQL, f"""
lagged AS (SELECT ws, ws + INTERVAL 1 DAY AS we, lag(ws + INTERVAL 1 DAY) OVER (ORDER BY ws) AS prev_end FROM alert),
isl AS (
  SELECT ws, we, sum(CASE WHEN prev_end = ws THEN 0 ELSE 1 END) OVER (ORDER BY ws) AS run FROM lagged),
pos AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY ws) AS k FROM isl)""", body=f"""
SELECT {osql.ts_text('min(ws)')} AS run_start, {osql.ts_text('max(we)')} AS run_end, count(*) AS n_windows,
       {osql.ts_text(f'min(CASE WHEN k = {SUSTAIN_WINDOWS} THEN ws END)')} AS firing_from
FROM pos GROUP BY run HAVING count(*) >= {SUSTAIN_WINDOWS}"""))
def i08_sustained_alert(spark, sf_dir):
    a = mon.error_rate_alert(_log(spark, sf_dir), DAY, ERROR_RATE_THRESHOLD)
    s = mon.sustained(a.select("window_start", "window_end"), SUSTAIN_WINDOWS)
    return s.select(_text("run_start"), _text("run_end"), "n_windows", _text("firing_from"))


@register("i07_sustained_error_rate", osql.with_ctes(PL, _ERR_SQL, osql.islands_ctes("alert"), body=osql.islands_body(SUSTAIN_WINDOWS)))
def i07_sustained_error_rate(spark, sf_dir):
    """The error-rate alert with its "for" clause."""
    s = mon.sustained_error_rate(_log(spark, sf_dir), DAY, ERROR_RATE_THRESHOLD, SUSTAIN_WINDOWS)
    return s.select(_text("run_start"), _text("run_end"), "n_windows", _text("firing_from"))


LATENCY_LIMIT = 3.55  # seconds; about half of the test data's days are above it


@register("i09_latency_alert", osql.with_ctes(PL, _p95_sql(), body=f"""
SELECT window_start, round(p95_seconds, 6) AS p95_seconds FROM p95 WHERE p95_seconds > {LATENCY_LIMIT}"""))
def i09_latency_alert(spark, sf_dir):
    a = mon.latency_alert(_log(spark, sf_dir), DAY, LATENCY_LIMIT)
    return a.select(_text("window_start"), _r6("p95_seconds"))


@register("i09_sustained_latency", osql.with_ctes(PL, _p95_sql(), f"""
hot AS (SELECT CAST(window_start AS TIMESTAMP) AS ws FROM p95 WHERE p95_seconds > {LATENCY_LIMIT})""", osql.islands_ctes("hot"),
    body=osql.islands_body(SUSTAIN_WINDOWS)))
def i09_sustained_latency(spark, sf_dir):
    """The latency alert with its "for" clause."""
    s = mon.sustained_latency(_log(spark, sf_dir), DAY, LATENCY_LIMIT, SUSTAIN_WINDOWS)
    return s.select(_text("run_start"), _text("run_end"), "n_windows", _text("firing_from"))


@register("i10_latest_gauge", osql.with_ctes(PL, body=f"""
SELECT status, current_hand_rank_value AS last_current_hand_rank_value, {osql.ts_text('ts')} AS last_ts
FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY ts DESC, request_id DESC) AS rn FROM prediction_log)
WHERE rn = 1"""))
def i10_latest_gauge(spark, sf_dir):
    g = mon.latest_value(_log(spark, sf_dir), RANK_VALUE, keys=("status",))
    return g.select("status", f"last_{RANK_VALUE}", _text("last_ts"))


@register("i11_counter_increase", osql.with_ctes(osql.counter_samples_cte(), """
cs AS (SELECT *, lag(cum) OVER (PARTITION BY series ORDER BY ts, cum) AS prev FROM counter_samples)""", body=f"""
SELECT series, {_DAY_SQL} AS window_start,
       CAST(sum(CASE WHEN prev IS NULL THEN 0 WHEN cum >= prev THEN cum - prev ELSE cum END) AS BIGINT) AS increase
FROM cs GROUP BY 1, 2"""))
def i11_counter_increase(spark, sf_dir):
    c = mon.counter_increase(derived.counter_samples(spark, sf_dir), DAY)
    return c.select("series", _text("window_start"), "increase")


# ---------------------------------------------------------------------------
# G: model metrics and run log
# ---------------------------------------------------------------------------

_SPLIT_PRED = f"{osql.hash_bucket_sql(SAMPLE_KEYS, DEFAULT_CONFIG.split_seed)} < {int(DEFAULT_CONFIG.test_size * 10000)}"


@register("g2_regression_metrics", osql.with_ctes(H, R5, RH, f"""
t AS (SELECT CAST(code % 101 AS DOUBLE) / 100.0 AS y,
             1.0 - (current_hand_rank_value - 1) / 7461.0 AS p FROM ranked WHERE {_SPLIT_PRED})""", body="""
SELECT count(*) AS n, round(sum((y - p) * (y - p)) / count(*), 6) AS mse,
       round(1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2 FROM t"""))
def g2_regression_metrics(spark, sf_dir):
    """MSE and R2 on the test part, for a fixed rank-based prediction column."""
    ranked = ranks.with_rank_value(derived.hands(spark, sf_dir), class_col=None)
    _, test = sampling.train_test_split(ranked, DEFAULT_CONFIG.test_size, SAMPLE_KEYS, DEFAULT_CONFIG.split_seed)
    scored = test.select(((F.col("code") % 101).cast("double") / 100.0).alias("equity"),
                         (1.0 - (F.col(RANK_VALUE) - 1) / 7461.0).alias("prediction"))
    return mdl.evaluate(scored).select("n", _r6("mse"), _r6("r2"))


@register("g7_latest_run", osql.with_ctes(osql.run_log_cte(), """
agg AS (
  SELECT run_name, sum(CAST(end_time IS NULL AS INTEGER)) AS unfinished,
         min(CASE WHEN end_time IS NULL THEN run_id END) AS open_id FROM run_log GROUP BY 1),
fin AS (
  SELECT run_name, run_id AS latest_id FROM (
    SELECT *, row_number() OVER (PARTITION BY run_name ORDER BY end_time DESC NULLS LAST, run_id) AS rn
    FROM run_log WHERE end_time IS NOT NULL) WHERE rn = 1)""", body="""
SELECT a.run_name,
       CAST(CASE WHEN unfinished > 1 THEN NULL WHEN unfinished = 1 THEN open_id ELSE latest_id END AS VARCHAR) AS run_id,
       CASE WHEN unfinished > 1 THEN 'error' WHEN unfinished = 1 THEN 'unfinished' ELSE 'finished' END AS status
FROM agg a LEFT JOIN fin f ON f.run_name = a.run_name"""))
def g7_latest_run(spark, sf_dir):
    latest = runlog.latest_runs(derived.run_log(spark, sf_dir))
    return latest.select("run_name", F.col("run_id").cast("string").alias("run_id"), "status")


_LABELLED: dict = {}
_PART = "_part"


def _labelled(spark, sf_dir):
    """Features of every hand with the table's label and its part, written once per input and application.

    A fit reads its rows several times; the part is stored, as its hash of the row keys costs more than the rest of such a pass.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LABELLED:
        labelled = derived.with_table_label(rel.all_features(derived.hands(spark, sf_dir)))
        parts = sampling.with_split(labelled, DEFAULT_CONFIG.test_size, SAMPLE_KEYS, DEFAULT_CONFIG.split_seed, _PART)
        _LABELLED[key] = (write_shared(parts, "labelled"), {})
    return _LABELLED[key]


def training_parts(spark, sf_dir):
    """(train, test) by the hash of the row keys."""
    table, _ = _labelled(spark, sf_dir)
    return tuple(table.filter(F.col(_PART) == part).drop(_PART) for part in ("train", "test"))


def trained_model(spark, sf_dir):
    """The forest with the configured number of trees, fitted once per input and application."""
    _, models = _labelled(spark, sf_dir)
    if "forest" not in models:
        models["forest"] = mdl.train(training_parts(spark, sf_dir)[0])
    return models["forest"]


# The full forest has no twin in SQL; its numbers are returned and tested against a saved model. A second forest can be told
# exactly: five binary inputs, depth five and all rows for every tree, so a tree has a leaf for every combination that
# occurs, and what it predicts is the mean label of the training rows there.
BINARY_INPUTS = ("hand_is_pair", "hand_is_suited", "hand_is_connected", "board_is_monotone", "board_is_paired")
BINARY_TREES = 3
_LABEL_SQL = "round(0.7 * (1.0 - (current_hand_rank_value - 1) / 7461.0) + 0.3 * (code % 101) / 100.0, 6)"
_BINARY_CTES = (H, R5, RH, FEATURES_CTE, f"""
leaves AS (SELECT {', '.join(BINARY_INPUTS)}, avg({_LABEL_SQL}) AS p FROM feats WHERE NOT ({_SPLIT_PRED}) GROUP BY ALL),
told AS (SELECT feats.*, {_LABEL_SQL} AS y, p FROM feats LEFT JOIN leaves USING ({', '.join(BINARY_INPUTS)}))""")
_BINARY_SCORES = f"SELECT {KEYS_SQL}, {', '.join(BINARY_INPUTS)}, round(p + 1e-9, 6) AS {{name}} FROM told WHERE {{where}}"


def _score(name):
    """Six places. Means of two rows often lie half way between two numbers of six places; the small shift sends them the same
    way on both sides."""
    return F.round(F.col(name) + 1e-9, 6).alias(name)


def binary_forest(spark, sf_dir):
    """The forest on ``BINARY_INPUTS``, fitted once per input and application."""
    _, models = _labelled(spark, sf_dir)
    if "binary" not in models:
        cfg = replace(DEFAULT_CONFIG, max_depth=len(BINARY_INPUTS))
        models["binary"] = mdl.train(training_parts(spark, sf_dir)[0], cfg, BINARY_INPUTS, num_trees=BINARY_TREES, bootstrap=False)
    return models["binary"]


def _requests(spark, sf_dir):
    """Every hand as a request. The cards are computed, so they are written: the range tests of the validation then stay tests
    of stored columns."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _REQUESTS:
        _REQUESTS[key] = write_shared(derived.hands(spark, sf_dir).select(*ROW_ID, *CARD_COLUMNS), "requests")
    return _REQUESTS[key]


_REQUESTS: dict = {}


def _metrics(spark, sf_dir, model):
    _, test = training_parts(spark, sf_dir)
    return mdl.evaluate(mdl.predict(model, test)).select("n", _r6("mse"), _r6("r2"))


@register("g1_train_metrics")
def g1_train_metrics(spark, sf_dir):
    """Train the full forest on the train part; rows of the test part and its metrics there."""
    return _metrics(spark, sf_dir, trained_model(spark, sf_dir))


@register("g1_binary_forest", osql.with_ctes(*_BINARY_CTES, body=f"""
SELECT count(*) AS n, round(avg((y - p) * (y - p)), 6) AS mse, round(1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
FROM told WHERE {_SPLIT_PRED}"""))
def g1_binary_forest(spark, sf_dir):
    """Training and metrics, with a forest whose leaves SQL can tell."""
    return _metrics(spark, sf_dir, binary_forest(spark, sf_dir))


@register("g3_predict")
def g3_predict(spark, sf_dir):
    """Predictions of the full forest for the test part."""
    _, test = training_parts(spark, sf_dir)
    return mdl.predict(trained_model(spark, sf_dir), test).select(*ROW_ID, *DEFAULT_CONFIG.model_features, "prediction")


@register("g3_binary_forest", osql.with_ctes(*_BINARY_CTES, body=_BINARY_SCORES.format(name="prediction", where=_SPLIT_PRED)))
def g3_binary_forest(spark, sf_dir):
    """Predictions that SQL can tell, for the test part."""
    _, test = training_parts(spark, sf_dir)
    return mdl.predict(binary_forest(spark, sf_dir), test).select(*ROW_ID, *BINARY_INPUTS, _score("prediction"))


def _batch_scores(spark, sf_dir, model, features):
    lookup = write_shared(rel.stateful_lookup(training_parts(spark, sf_dir)[0]), "lookup")
    return mdl.batch_score(model, lookup, _requests(spark, sf_dir), features, keep=tuple(ROW_ID))[0]


@register("g4_batch_score")
def g4_batch_score(spark, sf_dir):
    """Score every hand as a request: validate, features, lookup join, inputs, predict."""
    scored = _batch_scores(spark, sf_dir, trained_model(spark, sf_dir), DEFAULT_CONFIG.model_features)
    return scored.select(*ROW_ID, *DEFAULT_CONFIG.model_features, "equity")


@register("g4_binary_forest", osql.with_ctes(*_BINARY_CTES, body=_BINARY_SCORES.format(name="equity", where="TRUE")))
def g4_binary_forest(spark, sf_dir):
    """Batch scoring with scores that SQL can tell."""
    return _batch_scores(spark, sf_dir, binary_forest(spark, sf_dir), BINARY_INPUTS).select(*ROW_ID, *BINARY_INPUTS, _score("equity"))


# ---------------------------------------------------------------------------
# A: sources and sinks
# ---------------------------------------------------------------------------

@register("a4_read_features", osql.with_ctes(H, R5, RH, body=f"""
SELECT {KEYS_SQL}, current_hand_rank_value, current_hand_class_value FROM ranked"""))
def a4_read_features(spark, sf_dir):
    """Write ranked hands as Parquet to a folder of their own, then read them back."""
    path = scratch_path(spark, "a4_features")
    ranked = ranks.with_rank_value(derived.hands(spark, sf_dir))
    io.write_parquet(ranked.select(*ROW_ID, RANK_VALUE, "current_hand_class_value"), path)
    return io.read_parquet(spark, path)


@register("a5_overwrite", osql.with_ctes(H, body=f"SELECT {KEYS_SQL} FROM hands WHERE S1 = 2"))
def a5_overwrite(spark, sf_dir):
    """Write twice to one folder, partitioned: the second write replaces the first."""
    path = scratch_path(spark, "a5_hands")
    hands = derived.hands(spark, sf_dir).select(*ROW_ID, "S1")
    io.write_parquet(hands, path, partition_by=("S1",))
    io.write_parquet(hands.filter("S1 = 2"), path, partition_by=("S1",))
    return io.read_parquet(spark, path).select(*ROW_ID)


@register("a6_baseline_json", osql.with_ctes(H, R5, RH, osql.live_cte(), body=f"""
SELECT feature, label, count(*) AS n FROM ({osql.live_long_sql('live')}) GROUP BY feature, label"""))
def a6_baseline_json(spark, sf_dir):
    """The baseline counts of the live rows written as feature -> label -> count JSON, and read back."""
    counts = drift.baseline_counts(derived.live(spark, sf_dir))
    path = scratch_path(spark, "a6_baseline")
    drift.write_baseline_json(counts, path)
    return drift.read_baseline_json(spark, path)


@register("a7_live_json", osql.with_ctes(H, R5, RH, osql.live_cte(), osql.latest_cte(LIVE_WINDOW), body=f"""
SELECT hand_is_pair, hand_is_suited, board_is_paired, equity, current_hand_class_value, {osql.equity_bin_sql('equity')} AS equity_bin,
       {osql.ts_text('ts')} AS ts FROM latest"""))
def a7_live_json(spark, sf_dir):
    """The newest live rows written as column -> row -> value JSON and read back (a window's worth of rows: the
    format holds a whole file in one row)."""
    window = latest_live(spark, sf_dir, LIVE_WINDOW)
    path = scratch_path(spark, "a7_live")
    drift.write_live_json(cards.with_equity_bin(window), path)
    return drift.read_live_json(spark, path).drop("row_index").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@register("b17_add_equity_bin", osql.with_ctes(H, body=f"""
SELECT {KEYS_SQL}, {osql.equity_bin_sql('CAST(code % 101 AS DOUBLE) / 100.0')} AS added, 'kept' AS present, FALSE AS without
FROM hands"""))
def b17_add_equity_bin(spark, sf_dir):
    """The bin is added where it is absent, kept where it is there, and not made up without an equity."""
    hands = derived.hands(spark, sf_dir).select(*ROW_ID)
    equity = ((F.col("code") % 101).cast("double") / 100.0).alias("equity")
    added = cards.with_equity_bin(hands.select("*", equity)).withColumnRenamed("equity_bin", "added")
    present = cards.with_equity_bin(added.withColumn("equity_bin", F.lit("kept"))).withColumnRenamed("equity_bin", "present")
    return present.select(*ROW_ID, "added", "present", F.lit("equity_bin" in cards.with_equity_bin(hands).columns).alias("without"))


@register("a8_attach_target", osql.with_ctes(PL, body="""
SELECT request_id, status, payload_bytes, current_hand_rank_value, equity AS target FROM prediction_log"""))
def a8_attach_target(spark, sf_dir):
    """Features and target arrive as two tables sharing a unique row id; attach one to one by key."""
    log = derived.prediction_log(spark, sf_dir)
    return io.attach_target(log.select("request_id", "status", "payload_bytes", RANK_VALUE),
                            log.select("request_id", F.col("equity").alias("target")), "request_id")


_FIRST_HAND = " || ',' || ".join(f"""'"{c}":' || {c}""" if c != "ship_ts" else """'"ship_ts":"' || strftime(ship_ts, '%Y-%m-%dT%H:%M:%S.000Z') || '"'"""
                                for c in [*derived.KEY_COLUMNS, "ship_ts", "code", *CARD_COLUMNS])


@register("a9_audit", osql.with_ctes(H, body=f"""
SELECT 'hands' AS table_name, count(*) AS rows_written, count(*) AS rows_read, TRUE AS ok,
       (SELECT '{{' || {_FIRST_HAND} || '}}' FROM hands ORDER BY {KEYS_SQL} LIMIT 1) AS first_row
FROM hands"""))
def a9_audit(spark, sf_dir):
    """Write the hands table, re-read it and report both row counts and the first row by its keys."""
    return io.write_and_audit(derived.hands(spark, sf_dir), scratch_path(spark, "a9_hands"), "hands", tuple(ROW_ID))
