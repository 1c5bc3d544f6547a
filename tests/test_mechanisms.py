"""Positional attach, sliding windows, quantile roll-up, streaming alerts and counters, incremental lookup, refresh, ledger, run log
with retries, scratch folders."""

import datetime as dt
import os
import random
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from cardlens.operators import monitor, relative, rollup, runlog, sliding
from cardlens.operators.rank_counts import CountStore
from cardlens.plans.ledger import Ledger, version_of
from cardlens.session import child_folders, scratch_path, write_shared
from cardlens.sources import derived
from cardlens.sources.positional import attach_by_position
from cardlens.streaming import alerts, refresh
from cardlens.streaming.pipelines import read_stream
from conftest import ROOT, SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


# ---- A8 --------------------------------------------------------------------

def _write(df, path, files, per_file):
    df.repartitionByRange(files, "i").sortWithinPartitions("i").write.option("maxRecordsPerFile", per_file).parquet(path)


@pytest.mark.parametrize("n, files, per_file", [(0, 1, 10), (1, 1, 10), (1000, 3, 77), (1000, 12, 1000)])
def test_rows_meet_by_position(spark, n, files, per_file):
    d = tempfile.mkdtemp(prefix="position-")
    rows = spark.range(n).select(F.col("id").alias("i"), (F.col("id") * 7 % 13).alias("same"))
    _write(rows, f"{d}/features", 2, 400)
    target = spark.range(n).select((F.col("id") * 7 % 13).alias("y"), F.col("id").alias("i"))
    _write(target, f"{d}/target", files, per_file)
    got = attach_by_position(spark, f"{d}/features", _without(spark, f"{d}/target"))
    assert got.columns == ["i", "same", "y"] and got.count() == n and got.filter("same <> y").count() == 0


def _without(spark, path):
    """The same files without their order column, file by file."""
    out = path + "-bare"
    for k, name in enumerate(sorted(f for f in os.listdir(path) if f.startswith("part-"))):
        spark.read.parquet(f"{path}/{name}").select("y").coalesce(1).write.mode("append").parquet(f"{out}/x{k}")
    os.makedirs(out + "-all", exist_ok=True)
    for k in range(len(os.listdir(out))) if os.path.isdir(out) else ():
        for name in os.listdir(f"{out}/x{k}"):
            if name.startswith("part-"):
                os.link(f"{out}/x{k}/{name}", f"{out}-all/part-{k}.parquet")  # numbers without leading zeros: 2 comes before 10
    return out + "-all"


def test_unequal_tables_are_an_error(spark):
    d = tempfile.mkdtemp(prefix="position-")
    spark.range(10).write.parquet(f"{d}/a")
    spark.range(9).select(F.col("id").alias("y")).write.parquet(f"{d}/b")
    spark.range(10).select(F.col("id").alias("ID")).write.parquet(f"{d}/c")
    with pytest.raises(ValueError, match="10 rows, the target has 9"):
        attach_by_position(spark, f"{d}/a", f"{d}/b")
    with pytest.raises(ValueError, match="both tables"):
        attach_by_position(spark, f"{d}/a", f"{d}/c")


# ---- sliding windows and roll-up -------------------------------------------

@pytest.mark.parametrize("cell", [4096, 7])
def test_sliding_windows_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(sliding, "CELL_PANES", cell)
    r = random.Random(1)
    rows = [(at(r.choice((0, 3000, 90_000)) + r.randrange(2000)), r.choice((200, 404, 500)), r.choice((None, 1.0, 2.5))) for _ in range(400)] + [(None, 404, 1.0)]
    log = spark.createDataFrame(rows, "ts timestamp, status int, load double")
    ends = lambda t, width, step: [e for e in (T0 + dt.timedelta(seconds=step * (int((t - T0).total_seconds()) // step + 1 + k)) for k in range(width // step))]
    want = {}
    for t, _, load in rows[:-1]:
        for e in ends(t, 300, 60):
            want.setdefault(e, []).append(load)
    got = {x.window_end: (x.n_predictions, x.rate_per_sec) for x in sliding.sliding_rate(log).collect()}
    assert got == {e: (len(v), len(v) / 300) for e, v in want.items()}
    means = {x.window_end: x.mean_load for x in sliding.sliding_mean(log, "load").collect()}
    for e, v in want.items():
        known = [x for x in v if x is not None]
        assert means[e] == (pytest.approx(sum(known) / len(known)) if known else None)
    errors = {}
    for t, s, _ in rows[:-1]:
        for e in ends(t, 600, 120) if s >= 400 else ():
            errors[s, e] = errors.get((s, e), 0) + 1
    assert {(x.status, x.window_end): x.n_errors for x in sliding.sliding_errors(log, "10 minutes", "2 minutes").collect()} == errors
    assert sliding.sliding_rate(log.limit(0)).count() == 0


def test_odd_durations():
    assert sliding.seconds_of("5 minutes") == 300 and sliding.seconds_of(" 1 day") == 86400
    for bad in ("", "0 seconds", "1 month", "1.5 hours"):
        with pytest.raises(ValueError):
            sliding.seconds_of(bad)
    with pytest.raises(ValueError):
        sliding.sliding_sums(None, "5 minutes", "2 minutes", {})


def test_a_log_row_is_aggregated_once(spark):
    log = derived.prediction_log(spark, SF_SMALL)
    plan = sliding.sliding_rate(log)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.rindex("Aggregate")  # what is exploded is the panes, above the aggregate of the log


def test_merged_quantiles_keep_their_rank_error(spark):
    k, n = 200, 60_000
    rows = spark.range(n).select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 7200).alias("ts"), (F.col("id") % 3).cast("int").alias("status"),
                                 F.when(F.col("id") % 50 != 0, F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double")).alias("v"))
    sketches = write_shared(rollup.quantile_sketches(rows, "v", "1 minute", ("status",), k=k), "sketches")
    assert sketches.count() <= 3 * 121 and sketches.agg(F.sum("n")).first()[0] == rows.filter("v is not null").count()
    values = sorted(r.v for r in rows.filter("v is not null").collect())
    for q in (0.05, 0.5, 0.95):
        got = rollup.merged_quantiles(sketches, "365 days", q).first()
        rank = sum(v <= got["quantile"] for v in values) / len(values)
        assert got["n"] == len(values) and abs(rank - q) <= rollup.rank_error(k)
    by_status = rollup.merged_quantiles(sketches, "365 days", 0.5, ("status",)).collect()
    assert len(by_status) == 3 and rollup.merged_quantiles(sketches.limit(0), "1 hour", 0.5).count() == 0


# ---- alerts and counters in a stream ---------------------------------------

def _stream(spark, batches, schema, make):
    """Each batch as a file of its own, with a restart after every one."""
    root = tempfile.mkdtemp(prefix="stream-")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = make(read_stream(spark, f"{root}/in", spark.createDataFrame([], schema).schema, max_files_per_trigger=1))
        alerts.start_stateful(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination(300)
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def test_alert_states_over_restarts(spark):
    minute = lambda m, errors, fine=1: [(at(60 * m + i), 500) for i in range(errors)] + [(at(60 * m + 50), 200)] * fine
    first = minute(0, 3) + minute(1, 0) + minute(2, 3) + minute(3, 3)          # one minute; then a run begins
    second = minute(4, 3) + minute(5, 3) + minute(6, 0) + minute(7, 3)        # the run goes on over the restart, and ends
    third = minute(20, 0)                                                     # time goes on without any error
    make = lambda s: alerts.error_rate_alerts(s, "1 minute", "1 minute", 0.04, 3)
    events = _stream(spark, [first, second, third], "ts timestamp, status int", make).collect()
    told = sorted((e.state, e.run_start, e.n_windows, e.firing_from) for e in events)
    assert told == sorted([
        ("pending", at(0), 1, None), ("cleared", at(0), 1, None),
        ("pending", at(120), 1, None), ("firing", at(120), 3, at(240)), ("resolved", at(120), 4, at(240)),
        ("pending", at(420), 1, None), ("cleared", at(420), 1, None)], key=lambda x: (x[0], x[1]))
    assert next(e.at for e in events if e.state == "firing") == at(300) and next(e.run_end for e in events if e.state == "resolved") == at(360)


def test_counter_resets_inside_and_across_batches_and_late_samples(spark):
    a = [("a", at(s), v) for s, v in ((0, 5), (10, 7), (20, 2), (70, 9), (130, 4))]  # a reset at 20 and at 130
    b = [("a", at(s), v) for s, v in ((200, 1), (260, 3))] + [("a", at(15), 100), (None, at(200), 8), (None, at(210), 9)]  # at(15) is late
    c = [("a", at(900), 4), (None, at(905), 1)]
    panes = _stream(spark, [a, b, c], "series string, ts timestamp, cum long",
                    lambda s: alerts.counter_increase_stream(s, "1 minute", "1 minute")).collect()
    got = {(p.series, p.pane_start): p.increase for p in panes}
    assert got == {("a", at(0)): 4, ("a", at(60)): 7, ("a", at(120)): 4, ("a", at(180)): 1, ("a", at(240)): 2, (None, at(180)): 1}
    on_time = spark.createDataFrame(a + b[:2] + b[3:], "series string, ts timestamp, cum long")
    batch = {(r.series, r.window_start): r.increase for r in monitor.counter_increase(on_time, "1 minute").collect()}
    assert got == batch


# ---- incremental lookup ----------------------------------------------------

def _same_lookup(a, b):
    rows = lambda d: sorted((tuple(None if x is None else round(x, 9) for x in r) for r in d.collect()), key=str)
    assert rows(a) == rows(b) and a.columns == b.columns


@pytest.fixture(scope="module")
def valued(spark):
    r = random.Random(2)
    rows = [(r.choice([None, *range(40)]), r.choice([None, 1, 2, 3])) for _ in range(600)] + [(99, 7)]
    return spark.createDataFrame(rows, "current_hand_rank_value int, current_hand_class_value int").withColumn("i", F.monotonically_increasing_id()).cache()


def test_both_ways_of_running_totals_agree(spark, valued):
    counts = write_shared(relative.rank_counts(valued), "counts")
    _same_lookup(relative.lookup_from_counts(counts), relative.lookup_from_counts(counts, small=0))
    for n in (0, 1):
        few = write_shared(counts.limit(n), "counts")
        _same_lookup(relative.lookup_from_counts(few), relative.lookup_from_counts(few, small=0))


def test_batches_add_up_to_the_whole(spark, valued):
    store = CountStore(spark, scratch_path(spark, "store"))
    with pytest.raises(ValueError):
        store.counts()
    with pytest.raises(ValueError):
        store.add(valued, "../x")
    store.add(valued.filter("i % 3 = 0"), "a")
    store.add(valued.filter("i % 3 = 1"), "b")
    store.add(valued.filter("i % 3 = 1"), "b")  # again: replaces itself
    assert store.merge() == 1 and store.merge() == 1
    store.add(valued, "a")  # held by the merge already
    store.add(valued.filter("i % 3 = 2"), "c")
    whole = relative.relative_lookup(valued)
    _same_lookup(store.lookup(), whole)
    store.counts().write.parquet(f"{store.path}/merged/2/counts")  # a merge that was broken off before its list was written
    _same_lookup(store.lookup(), whole)
    assert store.merge() == 2 and sorted(store._merged()[1]) == ["a", "b", "c"]
    _same_lookup(CountStore(spark, store.path).lookup(), whole)


# ---- refresh, ledger, run log ----------------------------------------------

def test_run_log_settles_retries_and_writers(spark):
    path = scratch_path(spark, "log")
    for _ in range(2):  # the whole log is appended twice
        runlog.log_entries(spark, path, "r1", "train", "metric", {"mse": 0.5, "r2": 0.1})
        runlog.log_entries(spark, path, "r1", "train", "metric", {"mse": 0.25}, attempt=2)
        runlog.log_entries(spark, path, "r1", "train", "metric", {"mse": 0.4}, attempt=1)
        runlog.log_entries(spark, path, "r2", "train", "metric", {"r2": 0.9})
    log = spark.read.schema(runlog.RUN_LOG_SCHEMA).parquet(path)
    assert log.count() == 10 and runlog.settled(log).count() == 3
    rows = {r.run_id: (r.mse, r.r2) for r in runlog.run_values(log, "metric", ("mse", "r2")).collect()}
    assert rows == {"r1": ("0.25", "0.1"), "r2": (None, "0.9")}
    old = log.drop("attempt").withColumn("attempt", F.lit(None).cast("int"))
    assert runlog.settled(old.filter("run_id = 'r2'")).first().attempt == 0


def test_newest_pair_is_whole(spark):
    path = scratch_path(spark, "log")
    runlog.log_entries(spark, path, "x", "other", "end", {"status": "FINISHED"})
    with pytest.raises(RuntimeError):
        refresh.newest_pair(spark, path)
    refresh.publish(spark, path, "v1", "m1", "l1")
    runlog.log_entries(spark, path, "v2", refresh.REFRESH_RUN, "param", {"model": "m2", "lookup": "l2"})  # not ended yet
    assert refresh.newest_pair(spark, path) == ("v1", "m1", "l1")
    runlog.log_entries(spark, path, "v2", refresh.REFRESH_RUN, "end", {"status": "FINISHED"})
    assert refresh.newest_pair(spark, path) == ("v2", "m2", "l2")


def test_ledger_resumes_and_keeps_one_output(spark):
    root, begun = scratch_path(spark, "job"), []

    def step(ledger, name, version, broken=False):
        def write(path):
            begun.append(name)
            spark.range(5).write.parquet(f"{path}/half" if broken else path)
            if broken:
                raise RuntimeError("broken off")
        return ledger.run(name, version, write, lambda p: spark.read.parquet(p).count())

    first = step(Ledger(spark, root), "a", version_of("in", 1))
    with pytest.raises(RuntimeError):
        step(Ledger(spark, root), "b", version_of(first), broken=True)
    assert len(child_folders(spark, f"{root}/b")) == 1
    again = Ledger(spark, root)
    assert step(again, "a", version_of("in", 1)) == first
    second = step(again, "b", version_of(first))
    assert begun == ["a", "b", "b"] and [f"{root}/b/{x}" for x in child_folders(spark, f"{root}/b")] == [second]
    assert step(again, "a", version_of("in", 2)) != first and len(child_folders(spark, f"{root}/a")) == 2  # another input: another output
    assert sorted((r.step, r.n_rows) for r in again.rows().collect()) == [("a", 5), ("a", 5), ("b", 5)]
    assert Ledger(spark, root, "other job").rows().count() == 0


# ---- scratch folders -------------------------------------------------------

_SESSION = """
import os, sys, time
sys.path.insert(0, {root!r})
from cardlens.session import build_session, child_folders, write_shared
spark = build_session("local[1]", shuffle_partitions=1, extra_conf={{"spark.checkpoint.dir": {folder!r}, "spark.cardlens.lease.seconds": "{lease}"}})
write_shared(spark.range(3), "t")
print(len([f for f in os.listdir({folder!r}) if f.startswith("cardlens-scratch-")]), flush=True)
{end}
"""


def _session(folder, lease, end):
    run = subprocess.run([sys.executable, "-c", _SESSION.format(root=ROOT, folder=folder, lease=lease, end=end)], capture_output=True, text=True, timeout=200)
    return int(run.stdout.split()[-1]), sum(f.startswith("cardlens-scratch-") for f in os.listdir(folder))


def test_scratch_folders_go_with_their_session_or_their_lease():
    folder = tempfile.mkdtemp(prefix="shared-")
    assert _session(folder, 600, "") == (1, 0)                        # removed at the end
    assert _session(folder, 600, "spark.stop()") == (1, 0)            # also after the session was stopped
    assert _session(folder, 1, "os._exit(1)") == (1, 1)               # a crash leaves it, with a lease of a second
    assert _session(folder, 600, "os._exit(1)") == (1, 1)             # the next session removes that one, and crashes too
    assert _session(folder, 600, "") == (2, 1)                        # a lease that holds is respected
