"""Service-monitoring aggregates over a prediction log.

The log has one row per served prediction (``ts``, ``status``, timings,
payload size, predicted equity, rank value). Dashboard and alert expressions
become exact event-time aggregates over tumbling windows: every window is a
``groupBy(window(ts, d))`` with partial aggregation, so a window's rows never
travel together; only one small row per window and bucket is shuffled. The
one order-dependent metric (reset-aware counter increase) runs over range
partitions with per-partition carries instead of a per-series window.
Window length and thresholds are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (EQUITY_HISTOGRAM_EDGES, ERROR_RATE_ALERT, LATENCY_BUCKET_EDGES,
                      P95_LATENCY_ALERT_SECONDS)
from ..session import ship_package


def _win(ts: str, duration: str) -> Column:
    return F.window(F.col(ts), duration).alias("window")


def _bounds(df: DataFrame) -> DataFrame:
    """Flatten the window struct into start/end plus its length in seconds."""
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                     (F.unix_timestamp("window.end") - F.unix_timestamp("window.start")).alias("_seconds"),
                     *[c for c in df.columns if c != "window"])


def prediction_rate(log: DataFrame, duration: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Predictions per window and per second."""
    agg = log.groupBy(_win(ts, duration)).agg(F.count(F.lit(1)).alias("n_predictions"))
    out = _bounds(agg)
    return out.withColumn("rate_per_sec", F.col("n_predictions") / F.col("_seconds")).drop("_seconds")


def _le_label(edge: float) -> str:
    return str(edge)


def cumulative_histogram(log: DataFrame, value_col: str, edges, duration: str, ts: str = "ts") -> DataFrame:
    """Cumulative count per upper edge (and +Inf) per window, in long form (window, le, cum_count).

    One aggregate computes every edge's count as a conditional sum; the
    unpivot happens on the aggregated rows (no join with an edge table).
    """
    v = F.col(value_col)
    aggs = [F.sum((v <= e).cast("long")).alias(f"_le{i}") for i, e in enumerate(edges)]
    aggs.append(F.count(v).alias("_inf"))
    agg = _bounds(log.groupBy(_win(ts, duration)).agg(*aggs))
    pairs = [F.struct(F.lit(_le_label(e)).alias("le"), F.coalesce(F.col(f"_le{i}"), F.lit(0)).alias("cum_count"))
             for i, e in enumerate(edges)]
    pairs.append(F.struct(F.lit("+Inf").alias("le"), F.col("_inf").alias("cum_count")))
    return agg.select("window_start", "window_end", F.inline(F.array(*pairs)))


def equity_histogram(log: DataFrame, duration: str = "5 minutes", ts: str = "ts",
                     edges=EQUITY_HISTOGRAM_EDGES) -> DataFrame:
    """Cumulative equity histogram per window."""
    return cumulative_histogram(log, "equity", edges, duration, ts)


def bucket_quantile(log: DataFrame, value_col: str, q: float, edges, duration: str,
                    ts: str = "ts", out_col: str = "quantile") -> DataFrame:
    """Quantile estimated from cumulative buckets by linear interpolation.

    Rule: rank = q * total; take the first bucket whose cumulative count
    reaches rank; if that is the +Inf bucket return the last finite edge;
    else interpolate between the previous edge (0 for the first bucket) and
    this edge by the rank's position inside the bucket. No rows -> null.
    """
    v = F.col(value_col)
    n = len(edges)
    aggs = [F.sum((v <= e).cast("long")).alias(f"_c{i}") for i, e in enumerate(edges)]
    aggs.append(F.count(v).alias(f"_c{n}"))
    agg = _bounds(log.groupBy(_win(ts, duration)).agg(*aggs))
    cums = [F.coalesce(F.col(f"_c{i}"), F.lit(0)) for i in range(n + 1)]
    total = cums[n]
    rank = F.lit(q) * total
    b = sum(((c < rank).cast("int") for c in cums), F.lit(0))
    cum_arr = F.array(*cums)
    upper = F.array(*[F.lit(float(e)) for e in edges])
    lower = F.array(F.lit(0.0), *[F.lit(float(e)) for e in edges[:-1]])
    prev_cum = F.when(b == 0, F.lit(0)).otherwise(F.get(cum_arr, b - 1))
    in_bucket = F.get(cum_arr, b) - prev_cum
    interp = F.get(lower, b) + (F.get(upper, b) - F.get(lower, b)) * ((rank - prev_cum) / in_bucket)
    value = (F.when(total == 0, F.lit(None).cast("double"))
             .when(b >= n, F.lit(float(edges[-1])))
             .when((b == 0) & (F.lit(float(edges[0])) <= 0), F.lit(float(edges[0])))
             .otherwise(interp))
    return agg.select("window_start", "window_end", total.alias("n"), value.alias(out_col))


def latency_p95(log: DataFrame, duration: str = "5 minutes", ts: str = "ts",
                edges=LATENCY_BUCKET_EDGES, value_col: str = "inference_seconds") -> DataFrame:
    """P95 inference latency per window from the latency buckets."""
    return bucket_quantile(log, value_col, 0.95, edges, duration, ts, "p95_seconds")


def approx_quantile(log: DataFrame, value_col: str, q: float, duration: str, ts: str = "ts",
                    accuracy: int = 10000) -> DataFrame:
    """I3 (beside): a direct per-window quantile with bounded memory per window."""
    agg = log.groupBy(_win(ts, duration)).agg(F.percentile_approx(value_col, q, accuracy).alias("quantile"))
    return _bounds(agg).drop("_seconds")


def windowed_mean(log: DataFrame, value_col: str, duration: str = "5 minutes", ts: str = "ts",
                  out_col: str | None = None) -> DataFrame:
    """Sum / count per window (nulls skipped)."""
    agg = log.groupBy(_win(ts, duration)).agg(F.avg(value_col).alias(out_col or f"mean_{value_col}"))
    return _bounds(agg).drop("_seconds")


def errors_by_type(log: DataFrame, duration: str = "1 hour", ts: str = "ts", status_col: str = "status") -> DataFrame:
    """Error responses (status >= 400) per window and status."""
    errs = log.filter(F.col(status_col) >= 400)
    agg = errs.groupBy(_win(ts, duration), F.col(status_col)).agg(F.count(F.lit(1)).alias("n_errors"))
    return _bounds(agg).drop("_seconds")


def error_rate(log: DataFrame, duration: str = "1 minute", ts: str = "ts", status_col: str = "status") -> DataFrame:
    """Errors per window and per second (the I7 condition's input)."""
    errs = log.filter(F.col(status_col) >= 400)
    agg = _bounds(errs.groupBy(_win(ts, duration)).agg(F.count(F.lit(1)).alias("n_errors")))
    return agg.withColumn("errors_per_sec", F.col("n_errors") / F.col("_seconds")).drop("_seconds")


def error_rate_alert(log: DataFrame, duration: str = "1 minute", threshold: float = ERROR_RATE_ALERT,
                     ts: str = "ts") -> DataFrame:
    """Windows whose error rate is above the threshold."""
    return error_rate(log, duration, ts).filter(F.col("errors_per_sec") > threshold)


def sustained(windows: DataFrame, k: int, keys: tuple = ()) -> DataFrame:
    """I8: runs of >= k back-to-back windows (a window starting where the last ended).

    ``windows`` holds only windows where the condition held (window_start,
    window_end, optional keys). Gaps-and-islands with ``lag`` and a running
    sum; the windows table has one row per window, so it is small.
    Output: keys, run_start, run_end, n_windows, firing_from (start of the
    k-th window of the run, when the alert would fire).
    """
    w = Window.partitionBy(*keys).orderBy("window_start")
    gap = F.coalesce(F.lag("window_end").over(w) != F.col("window_start"), F.lit(True))
    runs = windows.withColumn("_new", gap.cast("int")).withColumn("_run", F.sum("_new").over(w))
    runs = runs.withColumn("_pos", F.row_number().over(Window.partitionBy(*keys, "_run").orderBy("window_start")))
    return runs.groupBy(*keys, "_run").agg(
        F.min("window_start").alias("run_start"), F.max("window_end").alias("run_end"),
        F.count(F.lit(1)).alias("n_windows"),
        F.min(F.when(F.col("_pos") == k, F.col("window_start"))).alias("firing_from"),
    ).filter(F.col("n_windows") >= k).drop("_run")


def latency_alert(log: DataFrame, duration: str = "5 minutes", threshold: float = P95_LATENCY_ALERT_SECONDS,
                  ts: str = "ts") -> DataFrame:
    """Windows whose P95 latency is above the threshold."""
    return latency_p95(log, duration, ts).filter(F.col("p95_seconds") > threshold)


def sustained_error_rate(log: DataFrame, duration: str = "1 minute", threshold: float = ERROR_RATE_ALERT, k: int = 1,
                         ts: str = "ts") -> DataFrame:
    """I7 with its "for" clause: runs of ``k`` or more windows in a row above the error rate."""
    return sustained(error_rate_alert(log, duration, threshold, ts).select("window_start", "window_end"), k)


def sustained_latency(log: DataFrame, duration: str = "1 minute", threshold: float = P95_LATENCY_ALERT_SECONDS, k: int = 2,
                      ts: str = "ts") -> DataFrame:
    """I9 with its "for" clause: runs of ``k`` or more windows in a row above the P95 latency."""
    return sustained(latency_alert(log, duration, threshold, ts).select("window_start", "window_end"), k)


def sustained_drift(reports: DataFrame, threshold: float, k: int = 1) -> DataFrame:
    """H5 with its "for" clause: per target, runs of ``k`` or more reports in a row whose PSI is above the threshold.

    ``reports`` has (target, psi, window_start, window_end), one row per target and report.
    """
    return sustained(reports.filter(F.col("psi") > threshold).select("target", "window_start", "window_end"), k, ("target",))


def last_psi(reports: DataFrame, ts: str = "computed_at", tie_col: str = "psi") -> DataFrame:
    """I10 for the drift gauge: the last PSI of each target in a table of reports (equal times: the larger value)."""
    return latest_value(reports, "psi", ("target",), ts, tie_col)


def latest_value(log: DataFrame, value_col: str, keys: tuple = (), ts: str = "ts",
                 tie_col: str = "request_id") -> DataFrame:
    """The last value of a gauge per key (by time, then by the larger id); null times come last.

    One pass: the rows of a key are reduced to one per task, then across tasks, by
    the largest (time, id, value).
    """
    k = list(keys)
    newest = F.max(F.struct(F.col(ts), F.col(tie_col), F.col(value_col).alias("_value"))).alias("_last")
    agg = (log.groupBy(*k) if k else log.groupBy()).agg(newest)
    return agg.select(*k, F.col("_last._value").alias(f"last_{value_col}"), F.col(f"_last.{ts}").alias("last_ts"))


def _local_increase(batches):
    """mapInPandas body: per range partition, reset-aware deltas summed per (series, window),
    plus one boundary row per series with its first value/window and last value.

    Rows arrive sorted by (series, ts), so a series' rows form one run per
    partition; the first row of each run gets delta 0 here and is fixed from
    the previous partition's last value by the caller.
    """
    import numpy as np
    import pandas as pd
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    partial, firsts, lasts = [], {}, {}
    carry_key, carry_val = None, None
    for pdf in batches:
        if pdf.empty:
            continue
        keys = pdf["_s"].to_numpy(dtype=object)
        vals = pdf["_v"].to_numpy(dtype="int64")
        prev_keys = np.empty(len(keys), dtype=object)
        prev_keys[0] = carry_key
        prev_keys[1:] = keys[:-1]
        prev_vals = np.empty(len(vals), dtype="int64")
        prev_vals[0] = carry_val if carry_val is not None else 0
        prev_vals[1:] = vals[:-1]
        same = keys == prev_keys
        delta = np.where(~same, 0, np.where(vals >= prev_vals, vals - prev_vals, vals))
        partial.append(pd.DataFrame({"_s": keys, "_w": pdf["_w"], "amount": delta})
                       .groupby(["_s", "_w"], sort=False, as_index=False)["amount"].sum())
        for i in np.flatnonzero(~same):
            firsts[keys[i]] = (int(vals[i]), pdf["_w"].iloc[i])
        ends = np.flatnonzero(np.append(keys[1:] != keys[:-1], True))
        for i in ends:
            lasts[keys[i]] = int(vals[i])
        carry_key, carry_val = keys[-1], int(vals[-1])
    if partial:
        sums = pd.concat(partial).groupby(["_s", "_w"], sort=False, as_index=False)["amount"].sum()
        yield pd.DataFrame({"kind": "sum", "_s": sums["_s"], "_w": sums["_w"], "amount": sums["amount"].astype("int64"),
                            "pid": pid, "first_v": None, "last_v": None})
    if firsts:
        ks = list(firsts)
        yield pd.DataFrame({"kind": "bound", "_s": ks, "_w": [firsts[k][1] for k in ks], "amount": 0,
                            "pid": pid, "first_v": [firsts[k][0] for k in ks], "last_v": [lasts[k] for k in ks]})


_INCREASE_SCHEMA = ("kind string, _s string, _w timestamp, amount long, pid int, first_v long, last_v long")


def counter_increase(samples: DataFrame, duration: str = "1 hour", series: str = "series", ts: str = "ts",
                     value: str = "cum", partitions: int | None = None) -> DataFrame:
    """Reset-aware increase of a sampled cumulative counter per series and window.

    delta = value - previous value of the series; a drop means the counter
    restarted, so the delta is the new value; the first sample adds 0.

    A series may hold a third of all samples, so ``lag`` over the series is
    never run in one task: samples are range-partitioned on (series, ts) —
    Spark samples the boundaries, splitting a busy series over many tasks —
    and each partition sums its deltas per (series, window) in pandas
    (Arrow batches, one pass). Each partition also reports, per series, its
    first value and last value; one window over these small partial rows (the
    last value of the nearest earlier partition) supplies the delta of every
    partition's first sample. Output: series, window_start, window_end, increase.
    """
    spark = samples.sparkSession
    ship_package(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a null series is a series: '0' stands for it, '1' leads every other name
    named = F.coalesce(F.concat(F.lit("1"), F.col(series).cast("string")), F.lit("0"))
    s = samples.select(named.alias("_s"), F.col(ts).alias("_ts"),
                       F.col(value).cast("long").alias("_v"),
                       F.window(F.col(ts), duration).getField("start").alias("_w"))
    # equal (series, ts) keys land in one range partition; the value breaks ts ties so a
    # recomputed partition is processed in the same order
    ranged = s.repartitionByRange(n, "_s", "_ts").sortWithinPartitions("_s", "_ts", "_v")
    part = ranged.mapInPandas(_local_increase, _INCREASE_SCHEMA)
    # one window over the small partial rows (sums and boundary rows) of each series: a boundary
    # row takes the last value of the series' boundary row in the nearest earlier partition
    order = Window.partitionBy("_s").orderBy("pid", "kind").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.last("last_v", ignorenulls=True).over(order)
    first_delta = (F.when(carry.isNull(), F.lit(0)).when(F.col("first_v") >= carry, F.col("first_v") - carry)
                   .otherwise(F.col("first_v")))
    amount = F.when(F.col("kind") == "bound", first_delta).otherwise(F.col("amount"))
    total = part.select("_s", "_w", amount.cast("long").alias("amount")) \
        .groupBy("_s", "_w").agg(F.sum("amount").cast("long").alias("increase"))
    name = F.when(F.startswith("_s", F.lit("1")), F.substring(F.col("_s"), F.lit(2), F.length("_s")))
    return total.select(name.alias(series), F.col("_w").alias("window_start"),
                        (F.col("_w") + F.expr(f"INTERVAL {duration}")).alias("window_end"), "increase")
