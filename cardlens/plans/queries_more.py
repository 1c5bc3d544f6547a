"""Registered queries: positional attach (A8), sliding windows (I1, I4 - I6), quantile roll-up (I3), streaming alerts and counters
(I8, I11), incremental lookup (K2 / E2), scoring with refresh (J1 / K4), restartable steps (K6), run log with retries (G6)."""

from __future__ import annotations

import os
from dataclasses import replace

from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, RANK_VALUE
from ..operators import model as mdl
from ..operators import ranks
from ..operators import relative as rel
from ..operators import rollup, runlog, sliding
from ..operators.rank_counts import CountStore
from ..session import scratch_path, write_shared
from ..sources import derived
from ..sources.positional import attach_by_position
from ..sources.tables import read_table, table_path
from ..streaming import alerts, refresh
from ..streaming.pipelines import read_stream
from . import oracle_sql as osql
from .ledger import Ledger, version_of
from .queries import FEATURES_CTE, H, KEYS_SQL, R5, RH, ROW_ID, register
from .queries_ops import _LABEL_SQL, BINARY_INPUTS, BINARY_TREES, DAY, ERROR_RATE_THRESHOLD, PL, SUSTAIN_WINDOWS, _log, _r6, _score, _text
from .queries_stats import CDF, GLOBAL, Z

# ---------------------------------------------------------------------------
# Attach by position
# ---------------------------------------------------------------------------


@register("a8_positional_attach", osql.with_ctes(body="""
SELECT event_id, event_type, value, CAST((event_id * 37) % 101 AS DOUBLE) / 100.0 AS target FROM events""").removeprefix("WITH \n"))
def a8_positional_attach(spark, sf_dir):
    """The event table as it is stored, and a target table without any key, written in the same order into several files of
    other lengths."""
    path = table_path(sf_dir, "events")
    rows = spark.read.parquet(path).select("event_id", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    target = rows.repartitionByRange(5, "f", "i").sortWithinPartitions("f", "i") \
        .select((((F.col("event_id") * 37) % 101).cast("double") / 100.0).alias("target"))
    other = scratch_path(spark, "a8_target")
    target.write.option("maxRecordsPerFile", 777).parquet(other)
    return attach_by_position(spark, path, other).select("event_id", "event_type", "value", "target")


# ---------------------------------------------------------------------------
# I: sliding windows and roll-up
# ---------------------------------------------------------------------------

def _asked(minutes: int, step: int, extra: str = "", where: str = "TRUE") -> str:
    """One row per log row and window that holds it: windows of ``minutes`` that end at every ``step`` minutes."""
    start = f"time_bucket(INTERVAL {step} MINUTE, ts)"
    return f"""asked AS (
  SELECT unnest(range({start} + INTERVAL {step} MINUTE, {start} + INTERVAL {step + minutes} MINUTE, INTERVAL {step} MINUTE)) AS window_end{extra}
  FROM prediction_log WHERE {where})"""


@register("i01_sliding_rate", osql.with_ctes(PL, _asked(5, 1), body=f"""
SELECT {osql.ts_text('window_end')} AS window_end, count(*) AS n_predictions, round(count(*) / 300.0, 6) AS rate_per_sec
FROM asked GROUP BY 1"""))
def i01_sliding_rate(spark, sf_dir):
    """Predictions of the last five minutes, every minute."""
    r = sliding.sliding_rate(_log(spark, sf_dir), "5 minutes", "1 minute")
    return r.select(_text("window_end"), "n_predictions", _r6("rate_per_sec"))


@register("i04_sliding_load_time", osql.with_ctes(PL, _asked(5, 1, ", load_seconds"), body=f"""
SELECT {osql.ts_text('window_end')} AS window_end, round(avg(load_seconds) + 1e-9, 6) AS mean_load_seconds FROM asked GROUP BY 1"""))
def i04_sliding_load_time(spark, sf_dir):
    m = sliding.sliding_mean(_log(spark, sf_dir), "load_seconds", "5 minutes", "1 minute", out_col="mean_load_seconds")
    return m.select(_text("window_end"), _score("mean_load_seconds"))


@register("i05_sliding_payload", osql.with_ctes(PL, _asked(5, 1, ", payload_bytes"), body=f"""
SELECT {osql.ts_text('window_end')} AS window_end, round(avg(payload_bytes) + 1e-9, 6) AS mean_payload_bytes FROM asked GROUP BY 1"""))
def i05_sliding_payload(spark, sf_dir):
    m = sliding.sliding_mean(_log(spark, sf_dir), "payload_bytes", "5 minutes", "1 minute", out_col="mean_payload_bytes")
    return m.select(_text("window_end"), _score("mean_payload_bytes"))


@register("i06_sliding_errors", osql.with_ctes(PL, _asked(60, 5, ", status", "status >= 400"), body=f"""
SELECT {osql.ts_text('window_end')} AS window_end, status, count(*) AS n_errors FROM asked GROUP BY 1, 2"""))
def i06_sliding_errors(spark, sf_dir):
    """Errors per status of the last hour, every five minutes."""
    e = sliding.sliding_errors(_log(spark, sf_dir), "1 hour", "5 minutes")
    return e.select(_text("window_end"), "status", "n_errors")


ROLLUP_K = 60_000  # windows of up to this many rows are exact


def _exact_quantile(unit: str, by: str = "") -> str:
    keys = f"date_trunc('{unit}', ts){by}"
    return f"""SELECT '{unit}' AS level, {osql.ts_text(f"date_trunc('{unit}', ts)")} AS window_start, {'CAST(status AS VARCHAR)' if by else repr('all')} AS status,
       inference_seconds AS v, row_number() OVER (PARTITION BY {keys} ORDER BY inference_seconds) AS k, count(*) OVER (PARTITION BY {keys}) AS n
FROM prediction_log WHERE inference_seconds IS NOT NULL"""


@register("i03_rollup_p95", osql.with_ctes(PL, f"""
ordered AS ({_exact_quantile('hour')} UNION ALL {_exact_quantile('day')} UNION ALL {_exact_quantile('day', ', status')})""", body="""
SELECT level, window_start, status, n, v AS p95_seconds FROM ordered WHERE k = ceil(0.95 * n)"""))
def i03_rollup_p95(spark, sf_dir):
    """P95 per hour, per day, and per day and status, all merged from one stored table of sketches per minute and status."""
    sketches = write_shared(rollup.quantile_sketches(_log(spark, sf_dir), "inference_seconds", "1 minute", ("status",), k=ROLLUP_K), "sketches")
    out = None
    for level, duration, keys in (("hour", "1 hour", ()), ("day", DAY, ()), ("day", DAY, ("status",))):
        found = rollup.merged_quantiles(sketches, duration, 0.95, keys, "p95_seconds")
        status = F.col("status").cast("string") if keys else F.lit("all")
        found = found.select(F.lit(level).alias("level"), _text("window_start"), status.alias("status"), "n", "p95_seconds")
        out = found if out is None else out.unionByName(found)
    return out


# ---------------------------------------------------------------------------
# I8, I11 in a stream
# ---------------------------------------------------------------------------

STREAM_FILES = 4


def _write_by_time(df, path: str, ts: str, first: int, last: int) -> None:
    """Files ``first`` .. ``last`` - 1 of ``STREAM_FILES``, each with the rows of its part of the time, one after the other."""
    ends = df.agg(F.percentile_approx(F.unix_millis(ts), [i / STREAM_FILES for i in range(1, STREAM_FILES)], 10_000)).first()[0]
    bounds = [None, *ends, None]
    for i in range(first, last):
        part = df
        if bounds[i] is not None:
            part = part.filter(F.unix_millis(ts) > bounds[i])
        if bounds[i + 1] is not None:
            part = part.filter(F.unix_millis(ts) <= bounds[i + 1])
        part.coalesce(1).write.mode("append").parquet(path)


def _run_in_two(spark, rows, ts: str, make, name: str):
    """The rows as a stream of files by time: half of the files, a stop, a restart from the checkpoint, the other files."""
    run = scratch_path(spark, name)
    files, out, checkpoint = (os.path.join(run, x) for x in ("in", "out", "checkpoint"))
    for first, last in ((0, STREAM_FILES // 2), (STREAM_FILES // 2, STREAM_FILES)):
        _write_by_time(rows, files, ts, first, last)
        stream = make(read_stream(spark, files, rows.schema, max_files_per_trigger=1))
        alerts.start_stateful(stream, out, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


_CLOSED = "(SELECT max(ts) - INTERVAL 1 DAY FROM prediction_log)"  # where the watermark ends


@register("i08_stream_alert", osql.with_ctes(PL, f"""
err AS (SELECT date_trunc('day', ts) AS ws, count(*) / 86400.0 AS rate FROM prediction_log WHERE status >= 400 GROUP BY 1),
hot AS (SELECT ws FROM err WHERE rate > {ERROR_RATE_THRESHOLD} AND ws + INTERVAL 1 DAY <= {_CLOSED})""", osql.islands_ctes("hot"), f"""
runs_done AS ({osql.islands_body(SUSTAIN_WINDOWS)} AND max(ws) + INTERVAL 2 DAY < {_CLOSED})""", body="SELECT * FROM runs_done"))
def i08_stream_alert(spark, sf_dir):
    """The sustained error-rate alert over a stream with a restart: runs that ended before the watermark."""
    events = _run_in_two(spark, _log(spark, sf_dir).select("ts", "status"), "ts",
                         lambda s: alerts.error_rate_alerts(s, DAY, DAY, ERROR_RATE_THRESHOLD, SUSTAIN_WINDOWS), "i08_stream")
    return events.filter("state = 'resolved'").select(_text("run_start"), _text("run_end"), "n_windows", _text("firing_from"))


@register("i11_stream_increase", osql.with_ctes(osql.counter_samples_cte(), """
cs AS (SELECT *, lag(cum) OVER (PARTITION BY series ORDER BY ts, cum) AS prev FROM counter_samples)""", body=f"""
SELECT series, {osql.ts_text("date_trunc('day', ts)")} AS window_start,
       CAST(sum(CASE WHEN prev IS NULL THEN 0 WHEN cum >= prev THEN cum - prev ELSE cum END) AS BIGINT) AS increase
FROM cs WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM counter_samples) GROUP BY 1, 2"""))
def i11_stream_increase(spark, sf_dir):
    """Counter increase per series and day from a stream with a restart: hours closed by the watermark."""
    panes = _run_in_two(spark, derived.counter_samples(spark, sf_dir), "ts",
                        lambda s: alerts.counter_increase_stream(s, "1 hour", "1 hour"), "i11_stream")
    days = panes.groupBy("series", F.window("pane_start", DAY).getField("start").alias("window_start")).agg(F.sum("increase").alias("increase"))
    return days.select("series", _text("window_start"), "increase")


# ---------------------------------------------------------------------------
# Incremental lookup
# ---------------------------------------------------------------------------

_W = "PARTITION BY current_hand_class_value"


def _lookup_sql(source: str) -> str:
    """One row per rank value with the relative features of ``source``."""
    return f"""
SELECT DISTINCT current_hand_rank_value,
       (current_hand_rank_value - avg(current_hand_rank_value) OVER ({_W})) / (stddev_samp(current_hand_rank_value) OVER ({_W}) + 1e-9) AS z,
       cume_dist() OVER ({_W} ORDER BY current_hand_rank_value) AS cdf,
       percent_rank() OVER (ORDER BY current_hand_rank_value DESC) AS g FROM {source}"""


@register("e2_incremental_lookup", osql.with_ctes(H, R5, RH, f"lookup AS ({_lookup_sql('ranked')})", body=f"""
SELECT current_hand_rank_value, round(z, 6) AS {Z}, round(cdf, 6) AS {CDF}, round(g, 6) AS {GLOBAL} FROM lookup"""))
def e2_incremental_lookup(spark, sf_dir):
    """Three batches of hands add their counts, one of them twice, with a merge in between; the lookup comes from the store."""
    ranked = ranks.with_rank_value(derived.hands(spark, sf_dir))
    store = CountStore(spark, scratch_path(spark, "count_store"))
    for i in (0, 1):
        store.add(ranked.filter(F.col("code") % 3 == i), f"part-{i}")
    store.merge()
    store.add(ranked.filter(F.col("code") % 3 == 1), "part-1")  # merged already: left alone
    store.add(ranked.filter(F.col("code") % 3 == 2), "part-2")
    return store.lookup().select(RANK_VALUE, _r6(Z), _r6(CDF), _r6(GLOBAL))


# ---------------------------------------------------------------------------
# Scoring while the model is replaced
# ---------------------------------------------------------------------------

_KNOWN = {"v1": "code % 2 = 0", "v2": "TRUE"}  # the hands a version was made from
_GIVEN = {"v1": "code % 2 = 0", "v2": "code % 2 = 1"}  # the hands that arrive while it is the newest


@register("j1_refresh_stream", osql.with_ctes(H, R5, RH, FEATURES_CTE, *[f"""
leaves_{v} AS (SELECT {', '.join(BINARY_INPUTS)}, avg({_LABEL_SQL}) AS p FROM feats WHERE {known} GROUP BY ALL),
known_{v} AS (SELECT * FROM feats WHERE {known}), lookup_{v} AS ({_lookup_sql(f'known_{v}')})""" for v, known in _KNOWN.items()],
    body=" UNION ALL ".join(f"""
SELECT {KEYS_SQL}, '{v}' AS version, round(p + 1e-9, 6) AS equity, round(coalesce(z, 0), 6) AS {Z}, round(coalesce(cdf, 0), 6) AS {CDF},
       round(coalesce(g, 0), 6) AS {GLOBAL}
FROM feats LEFT JOIN leaves_{v} USING ({', '.join(BINARY_INPUTS)}) LEFT JOIN lookup_{v} USING (current_hand_rank_value) WHERE {given}"""
                            for v, given in _GIVEN.items())))
def j1_refresh_stream(spark, sf_dir):
    """Two batches of hands, each written by many tasks, with a refresh of model and lookup between them: each is scored with its
    version."""
    root = scratch_path(spark, "j1_refresh")
    hands = write_shared(derived.hands(spark, sf_dir), "hands")
    feats = write_shared(derived.with_table_label(rel.all_features(hands)).drop(Z, CDF, GLOBAL), "refresh-features")
    cfg = replace(DEFAULT_CONFIG, max_depth=len(BINARY_INPUTS))
    for version in _GIVEN:
        known = feats.filter(_KNOWN[version])
        model = runlog.save_model(mdl.train(known, cfg, BINARY_INPUTS, num_trees=BINARY_TREES, bootstrap=False), f"{root}/models/{version}")
        rel.relative_lookup(known).drop("current_hand_class_value").write.parquet(f"{root}/lookups/{version}")
        refresh.publish(spark, f"{root}/run_log", version, model, f"{root}/lookups/{version}")
        hands.filter(_GIVEN[version]).write.mode("append").parquet(f"{root}/in")
        stream = read_stream(spark, f"{root}/in", hands.schema)
        refresh.scoring_stream_with_refresh(stream, f"{root}/run_log", f"{root}/out", (*ROW_ID, Z, CDF, GLOBAL), BINARY_INPUTS).awaitTermination()
    rows = refresh.scored_rows(spark, f"{root}/out")
    return rows.select(*ROW_ID, "version", _score("equity"), _r6(Z), _r6(CDF), _r6(GLOBAL))


# ---------------------------------------------------------------------------
# K6: restart; G6: run log with retries
# ---------------------------------------------------------------------------

@register("k6_restart_ledger", osql.with_ctes(H, R5, RH, body="""
SELECT 'ranked' AS step, count(*) AS n_rows, CAST(1 AS BIGINT) AS folders, CAST(1 AS BIGINT) AS runs FROM ranked
UNION ALL SELECT 'lookup', count(DISTINCT current_hand_rank_value), 1, 2 FROM ranked
UNION ALL SELECT 'joined', count(*), 1, 1 FROM ranked"""))
def k6_restart_ledger(spark, sf_dir):
    """A job of three steps that breaks in its second one, after half of the output is there, and is run again: what the ledger
    says, how many folders are left of each step and how often each was begun."""
    from ..session import child_folders

    root, begun = scratch_path(spark, "k6_job"), {}

    def job(broken: bool):
        ledger = Ledger(spark, root)

        def step(name, version, make):
            def write(path):
                begun[name] = begun.get(name, 0) + 1
                if name == "lookup" and broken:
                    make().limit(1).write.parquet(f"{path}/half")
                    raise RuntimeError("broken off")
                make().write.parquet(path)
            return ledger.run(name, version, write, lambda path: spark.read.parquet(path).count())

        ranked = step("ranked", version_of(sf_dir), lambda: ranks.with_rank_value(derived.hands(spark, sf_dir)))
        lookup = step("lookup", version_of(ranked), lambda: rel.relative_lookup(spark.read.parquet(ranked)))
        step("joined", version_of(ranked, lookup),
             lambda: rel.join_lookup(spark.read.parquet(ranked).select(*ROW_ID, RANK_VALUE), spark.read.parquet(lookup)))
        return ledger

    try:
        job(broken=True)
    except RuntimeError:
        pass
    ledger = job(broken=False)
    job(broken=False)  # all is there: nothing runs
    told = spark.createDataFrame([(s, len(child_folders(spark, f"{root}/{s}")), n) for s, n in begun.items()], "step string, folders long, runs long")
    return ledger.rows().select("step", "n_rows").join(told, "step")


@register("g6_run_log", """
SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS run_name,
       CASE WHEN o_orderkey % 3 = 0 THEN 'retried' ELSE o_orderstatus END AS state, CAST(o_custkey AS VARCHAR) AS customer
FROM orders""")
def g6_run_log(spark, sf_dir):
    """Every order as a run that logs two metrics: two writers append them, one of them twice, and every third run is tried
    again; one row per run comes back."""
    o = read_table(spark, sf_dir, "orders")
    base = o.select(F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("run_name"), F.lit("metric").alias("kind"),
                    F.col("o_orderdate").cast("timestamp").alias("ts"), "o_orderstatus", "o_custkey", "o_orderkey")

    def entries(rows, key, value, attempt):
        return rows.select("run_id", "run_name", "kind", F.lit(key).alias("key"), value.cast("string").alias("value"), "ts", F.lit(attempt).alias("attempt"))

    path = scratch_path(spark, "g6_log")
    status, customer = entries(base, "state", F.col("o_orderstatus"), 0), entries(base, "customer", F.col("o_custkey"), 0)
    again = entries(base.filter("o_orderkey % 3 = 0"), "state", F.lit("retried"), 1)
    for part in (status, customer, again, customer):
        part.write.mode("append").parquet(path)
    log = spark.read.schema(runlog.RUN_LOG_SCHEMA).parquet(path)
    return runlog.run_values(log, "metric", ("state", "customer"))
