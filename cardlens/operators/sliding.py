"""Sliding windows over a prediction log (I1, I4 - I6 as a dashboard evaluates them).

A dashboard asks for the last five minutes at every scrape. A row would belong to many
such windows; here it is aggregated once, into a pane of the step's length, and a
window is the sum of the panes in an interval-bounded ``RANGE`` frame. Windows are
evaluated at the end of every step in which they hold a row.

Frames run over panes, not rows, and over cells of many panes: the last panes of a
cell are given to the next one as context, so no task gets the whole of time.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL_PANES = 4096
_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(duration: str) -> int:
    """'5 minutes' -> 300."""
    found = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", duration)
    if not found or int(found[1]) < 1:
        raise ValueError(f"not a duration of whole seconds, minutes, hours or days: {duration!r}")
    return int(found[1]) * _UNITS[found[2]]


def sliding_sums(log: DataFrame, duration: str, step: str, sums: dict[str, Column], keys: tuple = (), ts: str = "ts") -> DataFrame:
    """Sums of ``sums`` (name: numeric column, null counts nothing) over the last ``duration`` at every ``step``.

    Output: keys, window_start, window_end, the sums (null if no value stood in the window), and only windows with at
    least one row. Rows without a time are in no window.
    """
    width, each = seconds_of(duration), seconds_of(step)
    if width % each:
        raise ValueError("the window must be a whole number of steps")
    n, names = width // each, list(sums)
    log = log.filter(F.col(ts).isNotNull())
    panes = log.groupBy(*keys, F.floor(F.unix_seconds(F.col(ts)) / each).alias("_pane")) \
        .agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(name) for name, c in sums.items()])
    # a pane asks for the n windows that hold it; its sums are its own place's only
    asked = panes.withColumn("_later", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    own = F.col("_later") == 0
    grid = asked.groupBy(*keys, (F.col("_pane") + F.col("_later")).alias("_pane")) \
        .agg(*[F.sum(F.when(own, F.col(c))).alias(c) for c in ("_rows", *names)])
    size = max(CELL_PANES, n)
    cell, place = F.floor(F.col("_pane") / size), F.pmod("_pane", F.lit(size))
    context = F.when(place > size - n, F.array(cell, cell + 1)).otherwise(F.array(cell))
    grid = grid.withColumn("_cell", F.explode(context))
    frame = Window.partitionBy(*keys, "_cell").orderBy("_pane").rangeBetween(-(n - 1), 0)
    out = grid.select(*keys, "_pane", "_cell", *[F.sum(c).over(frame).alias(c) for c in names])
    out = out.filter(F.floor(F.col("_pane") / size) == F.col("_cell"))
    end = (F.col("_pane") + 1) * each
    return out.select(*keys, F.timestamp_seconds(end - width).alias("window_start"), F.timestamp_seconds(end).alias("window_end"), *names)


def sliding_rate(log: DataFrame, duration: str = "5 minutes", step: str = "1 minute", ts: str = "ts") -> DataFrame:
    """Predictions and rate per second of the last ``duration``, at every step."""
    out = sliding_sums(log, duration, step, {"n_predictions": F.lit(1)}, ts=ts)
    return out.withColumn("rate_per_sec", F.col("n_predictions") / F.lit(seconds_of(duration)))


def sliding_mean(log: DataFrame, value_col: str, duration: str = "5 minutes", step: str = "1 minute", ts: str = "ts",
                 out_col: str | None = None) -> DataFrame:
    """Sum / count of the last ``duration`` at every step (nulls skipped; null if there is none)."""
    v = F.col(value_col)
    out = sliding_sums(log, duration, step, {"_sum": v, "_n": v.isNotNull().cast("long")}, ts=ts)
    return out.select("window_start", "window_end", (F.col("_sum") / F.nullif("_n", F.lit(0))).alias(out_col or f"mean_{value_col}"))


def sliding_errors(log: DataFrame, duration: str = "1 hour", step: str = "1 minute", ts: str = "ts", status_col: str = "status") -> DataFrame:
    """Errors (status >= 400) per status of the last ``duration``, at every step."""
    errors = log.filter(F.col(status_col) >= 400)
    return sliding_sums(errors, duration, step, {"n_errors": F.lit(1)}, (status_col,), ts)
