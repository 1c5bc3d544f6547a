"""Streaming alerts with a "for" clause (I8) and reset-aware counters.

Both are two stateful steps. The first is a watermarked aggregation, so a busy key is
spread over its windows or panes and only one small row each goes on; the second keeps a
few values per key (``transformWithStateInPandas``, state in RocksDB) and sees closed windows only, in order.

* Alerts: a key is idle, pending (fewer than k windows in a row meet the condition) or
  firing. An event-time timer ends a run when the watermark passes the window
  that would have continued it, so a run ends even if no row ever comes again.
* Counters: the last value of a series is the state. Panes bring their first and last value and
  the increase between their own samples; the step from pane to pane is added here. Samples
  later than the watermark are dropped by the first step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..session import ship_package

EVENTS = "key string, state string, at long, run_start long, run_end long, n_windows long, firing_from long"  # times in milliseconds
TIMES = ("at", "run_start", "run_end", "firing_from")
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_RUN = "run_start long, run_end long, n_windows long, firing_from long"


class _Runs(StatefulProcessor):
    """State machine over one key's windows (times in milliseconds)."""

    def __init__(self, k: int, length: int):
        self.k, self.length = k, length

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", _RUN)

    def _ended(self, key, run) -> tuple:
        return key[0], "resolved" if run[2] >= self.k else "cleared", run[1] + self.length, *run

    def handleInputRows(self, key, rows, timerValues):
        current = list(self.state.get()) if self.state.exists() else None
        if current is not None:
            self.handle.deleteTimer(current[1] + self.length)
        out = []
        for start in sorted(int(t) for frame in rows for t in frame["start_ms"]):
            if current is not None and start == current[1]:
                current[1], current[2] = start + self.length, current[2] + 1
            else:
                if current is not None:
                    out.append(self._ended(key, current))
                current = [start, start + self.length, 1, None]
                out.append((key[0], "pending", start + self.length, *current))
            if current[2] == self.k:
                current[3] = start
                out.append((key[0], "firing", start + self.length, *current))
        if current[1] + self.length <= timerValues.getCurrentWatermarkInMs():  # the next window is closed, and was not among these
            out.append(self._ended(key, current))
            self.state.clear()
        else:
            self.state.update(tuple(current))
            self.handle.registerTimer(current[1] + self.length)
        yield _frame(out, EVENTS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        out = [self._ended(key, self.state.get())]
        self.state.clear()
        yield _frame(out, EVENTS)

    def close(self) -> None:
        pass


def _frame(rows: list, schema: str):
    """Rows as a pandas frame with nullable integers."""
    import pandas as pd

    fields = [f.split() for f in schema.split(", ")]
    frame = pd.DataFrame(rows, columns=[f[0] for f in fields])
    return frame.astype({n: "Int64" for n, kind in fields if kind == "long"})


def start_stateful(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream of this module to Parquet. Its state lives in RocksDB, which the session is set to while the query starts."""
    spark = stream.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def sustained_stream(windows: DataFrame, k: int, length_seconds: int, key: Column | None = None) -> DataFrame:
    """I8 on a stream: state changes (``EVENTS``) of every key.

    ``windows`` is a streaming, watermarked window aggregation (column ``window``) filtered to the windows in which the
    condition holds. ``pending`` comes with the first window of a run, ``firing`` with the k-th, ``resolved`` (``cleared``, if
    it never fired) when the window after the run is closed.
    """
    ship_package(windows.sparkSession)
    name = F.lit("") if key is None else F.coalesce(key.cast("string"), F.lit(""))
    rows = windows.select(name.alias("key"), F.unix_millis(F.col("window.start")).alias("start_ms"), F.window_time("window").alias("closed"))
    events = rows.groupBy("key").transformWithStateInPandas(_Runs(k, 1000 * length_seconds), EVENTS, "Append", "EventTime")
    return events.select(*[F.timestamp_millis(c).alias(c) if c in TIMES else F.col(c) for c in events.columns])


def error_rate_alerts(log: DataFrame, duration: str, watermark: str, threshold: float, k: int, ts: str = "ts", status_col: str = "status") -> DataFrame:
    """I7 with its "for" clause on a stream: error rate above ``threshold`` in ``k`` windows in a row."""
    from ..operators.sliding import seconds_of

    length = seconds_of(duration)
    # every row moves the watermark, errors or not, so the errors are counted rather than filtered
    rows = log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    counts = rows.groupBy(F.window(ts, duration).alias("window")).agg(F.sum((F.col(status_col) >= 400).cast("long")).alias("n_errors"))
    return sustained_stream(counts.filter(F.col("n_errors") / F.lit(length) > threshold), k, length)


PANES = "series string, pane_ms long, increase long"


class _Panes(StatefulProcessor):
    """Increase of one series' panes, with the step from the pane before."""

    def init(self, handle) -> None:
        self.state = handle.getValueState("last", "last long")

    def handleInputRows(self, key, rows, timerValues):
        last = self.state.get()[0] if self.state.exists() else None
        out = []
        for start, first, end, inner in sorted(r for frame in rows for r in frame[["pane_ms", "first", "last", "inner"]].itertuples(index=False, name=None)):
            out.append((key[0], int(start), int(inner) + (0 if last is None else int(first - last if first >= last else first))))
            last = int(end)
        self.state.update((last,))
        yield _frame(out, PANES)

    def close(self) -> None:
        pass


def counter_increase_stream(samples: DataFrame, pane: str, watermark: str, series: str = "series", ts: str = "ts", value: str = "cum") -> DataFrame:
    """I11 on a stream: (series, pane_start, increase) of every closed pane; sums over panes are the increase of longer windows.

    Samples of a series are taken by time, equal times by value, as in the batch operator: a value below the one before means
    the counter began anew, so the value itself is what was added; the first sample of a series adds nothing. Panes
    bound what one group holds. A null series is a series of its own.
    """
    ship_package(samples.sparkSession)
    named = F.coalesce(F.concat(F.lit("1"), F.col(series).cast("string")), F.lit("0"))
    rows = samples.select(named.alias("_s"), F.col(ts).cast("timestamp").alias("_ts"), F.col(value).cast("long").alias("_v")).withWatermark("_ts", watermark)
    grouped = rows.groupBy("_s", F.window("_ts", pane).alias("window")).agg(F.collect_list(F.struct("_ts", "_v")).alias("_samples"))
    ordered = F.transform(F.array_sort("_samples"), lambda x: x["_v"])
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.get("_o", F.lit(0)).alias("at"))
    walked = F.aggregate("_o", start, lambda a, v: F.struct((a["sum"] + F.when(v >= a["at"], v - a["at"]).otherwise(v)).alias("sum"), v.alias("at")))
    panes = grouped.withColumn("_o", ordered).withColumn("_w", walked)
    panes = panes.select(F.col("_s"), F.unix_millis(F.col("window.start")).alias("pane_ms"), F.get("_o", F.lit(0)).alias("first"),
                         F.col("_w.at").alias("last"), F.col("_w.sum").alias("inner"))
    joined = panes.groupBy("_s").transformWithStateInPandas(_Panes(), PANES, "Append", "None")
    name = F.when(F.startswith("series", F.lit("1")), F.substring(F.col("series"), F.lit(2), F.length("series")))
    return joined.select(name.alias("series"), F.timestamp_millis("pane_ms").alias("pane_start"), "increase")
