import json
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from cardlens.config import EngineConfig
from cardlens.operators import model as mdl, runlog
from cardlens.plans import jobs
from cardlens.sources import derived, io
from conftest import SF_SMALL

KEYS = ["row_id"]
CARDS = ["S1", "C1", "S2", "C2", "S3", "C3", "S4", "C4", "S5", "C5"]


def _raw(spark):
    """A raw hand table: a row id, the ten card columns and an old class label."""
    row_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id")
    return derived.hands(spark, SF_SMALL).select(row_id, *CARDS, (F.col("code") % 10).cast("int").alias("CLASS"))


def test_jdbc_round_trip_partitioned(spark):
    url = f"jdbc:derby:memory:db{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    raw = _raw(spark).withColumn("ID", F.monotonically_increasing_id())
    io.write_jdbc(raw, url, "RAW_DATA", props)
    back = io.read_jdbc(spark, url, "RAW_DATA", props, partition_column="ID", lower_bound=0,
                        upper_bound=raw.agg(F.max("ID")).first()[0] + 1, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == raw.count()
    sampled = io.read_sampled(spark, url, "RAW_DATA", 0.5, seed=1, properties=props)
    assert 0 < sampled.count() < raw.count()


def test_parquet_round_trip_and_audit(spark):
    d = tempfile.mkdtemp(prefix="io-")
    raw = _raw(spark)
    audit = io.write_and_audit(raw, os.path.join(d, "raw"), "raw", ("row_id",)).first()
    assert json.loads(audit["first_row"])["row_id"] == raw.agg(F.min("row_id")).first()[0]
    assert audit["ok"] and audit["rows_written"] == audit["rows_read"] == raw.count()
    io.write_parquet(raw, os.path.join(d, "p"), partition_by=("S1",))
    assert io.read_parquet(spark, os.path.join(d, "p")).count() == raw.count()


def test_materialize_cuts_lineage(spark):
    df = io.materialize(_raw(spark).filter(F.col("S1") == 1))
    assert df.inputFiles() and all("/materialized-" in f for f in df.inputFiles())
    ck = io.materialize(_raw(spark).filter(F.col("S1") == 1), use_checkpoint=True)
    plan = ck._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "lineitem" not in plan
    assert df.count() == ck.count()
    other = io.materialize(_raw(spark))
    folder = other.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(folder)
    io.drop_materialized(other)
    assert not os.path.exists(folder) and df.count() == ck.count()
    assert io.repartition_by_cores(df, 2).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 2


def test_pipeline_end_to_end(spark):
    paths = jobs.JobPaths(tempfile.mkdtemp(prefix="jobs-"))
    cfg = EngineConfig(simulation_count=4, sample_rate=0.5, max_depth=5)
    out = jobs.run_pipeline(spark, paths, raw=_raw(spark), cfg=cfg, num_trees=3, key_cols=KEYS)
    pre = out["preprocessed"]
    assert "CLASS" not in pre.columns and "equity" in pre.columns
    assert pre.filter(F.col("equity").isNull()).count() == 0
    model, lookup = out["model"], out["lookup"]
    feats = io.read_parquet(spark, paths.features)
    assert {"relative_rank_z", "global_rank_strenght"} <= set(feats.columns)
    scored, rejected = mdl.batch_score(model, lookup, _raw(spark).drop("CLASS"))
    assert scored.count() == 6000 - rejected.count()
    assert scored.filter(F.col("equity").isNull()).count() == 0
    log = spark.read.parquet(paths.run_log)
    assert log.filter((F.col("kind") == "metric") & (F.col("key") == "r2")).count() == 1
    # fast variant: features + training + refresh only
    out2 = jobs.run_pipeline(spark, paths, steps=("features", "training", "refresh"), cfg=cfg, num_trees=3, key_cols=KEYS)
    assert out2["training_run"] != out["training_run"]
    base = spark.read.parquet(paths.features)
    report = jobs.run_drift(spark, paths, jobs.drift.baseline_counts(base),
                            base.withColumn("ts", F.current_timestamp()), cfg, tie_cols=tuple(CARDS))
    assert report.count() == 5
    # two feature runs: each keeps its own lookup, and refresh takes the latest run's
    assert {out["feature_run"], out2["feature_run"]} <= set(os.listdir(paths.lookups))
    assert all(f"/{out2['feature_run']}/" in f for f in out2["lookup"].inputFiles())
    before = spark.read.parquet(paths.drift_reports).count()
    assert jobs.run_drift(spark, paths, jobs.drift.baseline_counts(base), base.limit(3).withColumn("ts", F.current_timestamp()), cfg).count() == 0
    assert spark.read.parquet(paths.drift_reports).count() == before


def test_sampling_and_split_decide_row_by_row(spark):
    """One hand holds a third of the rows: it is sampled and split like all others, not kept or dropped as a whole."""
    hands = _raw(spark).limit(2000).withColumn("equity", F.lit(0.5))
    hot = hands.limit(1).crossJoin(spark.range(1000)).withColumn("row_id", F.concat(F.lit("hot-"), "id")).drop("id")
    table = hands.unionByName(hot.select(hands.columns))
    kept = jobs.sampling.hash_sample(table, 0.2, jobs._row_keys(table, KEYS), seed=0)
    assert 150 < kept.filter(F.startswith("row_id", F.lit("hot-"))).count() < 250
    train, test = jobs.sampling.train_test_split(table, 0.2, jobs._row_keys(table, KEYS), 42)
    assert 150 < test.filter(F.startswith("row_id", F.lit("hot-"))).count() < 250
    for keys in (None, [], CARDS, ["no_such_column"]):
        with pytest.raises(ValueError):
            jobs.build_features(table, key_cols=keys)


def test_attach_target_is_one_to_one(spark):
    f = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    assert sorted(map(tuple, io.attach_target(f, spark.createDataFrame([(2, 20), (1, None)], "id int, y int"), "id").collect())) == [(1, "a", None), (2, "b", 20)]
    for bad in ([(1, 10), (1, 11), (2, 20)], [(1, 10)], [(1, 10), (2, 20), (3, 30)], [(None, 1), (1, 1), (2, 2)]):
        with pytest.raises(Exception, match="features|target"):
            io.attach_target(f, spark.createDataFrame(bad, "id int, y int"), "id").collect()


def test_latest_run_rules(spark):
    runs = spark.createDataFrame([
        ("a", 1, "2024-01-01"), ("a", 2, "2024-01-03"), ("a", 3, "2024-01-03"),
        ("b", 4, None), ("b", 5, "2024-01-09"),
        ("c", 6, None), ("c", 7, None),
    ], "run_name string, run_id long, end_time string").withColumn("end_time", F.col("end_time").cast("timestamp"))
    assert runlog.latest_run_id(runs, "a") == 2
    assert runlog.latest_run_id(runs, "b") == 4
    with pytest.raises(RuntimeError, match="several open runs"):
        runlog.latest_run_id(runs, "c")
    with pytest.raises(RuntimeError, match="no run called"):
        runlog.latest_run_id(runs, "zzz")


def test_model_save_load_and_untrained(spark):
    with pytest.raises(ValueError, match="fitted model"):
        mdl.predict(None, _raw(spark))
    with pytest.raises(Exception):
        runlog.load_model(os.path.join(tempfile.mkdtemp(), "missing"))


def test_spread_only_when_input_is_narrow(spark):
    from cardlens.sources.tables import spread
    narrow = spark.range(1000).coalesce(1)
    wide = spark.range(0, 1000, 1, 32)
    assert spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(wide) is wide
    assert spread(narrow, ("id",)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_training_steps_from_the_command_line(spark):
    from cardlens.plans import cli
    root = tempfile.mkdtemp(prefix="cli-")
    raw_path = os.path.join(root, "raw_in")
    _raw(spark).write.parquet(raw_path)
    out = cli.main(["train", "--root", root, "--raw", raw_path, "--preprocess", "--feature-engineering",
                    "--training", "--refresh", "--trees", "2", "--keys", "row_id"], spark=spark)
    assert {"preprocessed", "feature_run", "training_run", "model", "lookup"} <= set(out)
    assert out["lookup"].count() > 0


def test_a_broken_run_goes_on_where_it_was(spark, monkeypatch):
    """Broken off in training: the next run takes preprocessing, features and lookup as they are, and leaves one set of outputs."""
    from cardlens.session import child_folders
    from cardlens.streaming.refresh import newest_pair

    paths = jobs.JobPaths(tempfile.mkdtemp(prefix="restart-"))
    cfg = EngineConfig(simulation_count=1, sample_rate=0.9)
    raw, real, calls = _raw(spark), (jobs.preprocess, mdl.train), []
    monkeypatch.setattr(jobs, "preprocess", lambda *a, **k: calls.append("preprocess") or real[0](*a, **k))
    run = lambda: jobs.run_restartable(spark, paths, raw, "v1", cfg, num_trees=2, key_cols=KEYS)

    def broken(*a, **k):
        raise RuntimeError("broken off")

    monkeypatch.setattr(mdl, "train", broken)
    with pytest.raises(RuntimeError, match="broken off"):
        run()
    monkeypatch.setattr(mdl, "train", lambda *a, **k: calls.append("training") or real[1](*a, **k))
    done = run()
    assert calls == ["preprocess", "training"] and run() == done and calls == ["preprocess", "training"]
    root = f"{paths.root}/restartable"
    assert {s: len(child_folders(spark, f"{root}/{s}")) for s in ("preprocess", "features", "lookup", "training")} == \
        {"preprocess": 1, "features": 1, "lookup": 1, "training": 1}
    assert newest_pair(spark, paths.run_log) == (done["version"], done["model"], done["lookup"])
    assert spark.read.parquet(done["features"]).count() > 0 and runlog.load_model(done["model"]) is not None
