"""User-level jobs (K1 - K6): preprocess, feature build, training, refresh, drift.

Each job is a function of a session and a :class:`JobPaths` layout on shared
storage; each step's core is a DataFrame -> DataFrame function that tests
call directly. Steps hand over through written tables, so a later step never
re-runs an earlier one and a lost executor only repeats its own tasks.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CARD_COLUMNS, DEFAULT_CONFIG, EngineConfig
from ..operators import drift, model as mdl, relative, runlog, sampling
from ..operators.equity import with_win_share
from ..operators.features import drop_label
from ..session import apply_runtime_conf, ensure_checkpoint_dir, write_shared
from ..sources import io
from ..streaming.refresh import publish
from .ledger import Ledger, version_of

FEATURE_RUN = "feature_engineering"
TRAINING_RUN = "training"


@dataclass(frozen=True)
class JobPaths:
    """Table locations under one shared root folder."""

    root: str

    def _p(self, name: str) -> str:
        return os.path.join(self.root, name)

    @property
    def raw(self) -> str: return self._p("raw")
    @property
    def preprocessed(self) -> str: return self._p("preprocessed")
    @property
    def features(self) -> str: return self._p("features")
    @property
    def lookups(self) -> str: return self._p("stateful_lookup")
    @property
    def models(self) -> str: return self._p("models")
    @property
    def run_log(self) -> str: return self._p("run_log")
    @property
    def drift_reports(self) -> str: return self._p("drift_reports")


def default_paths(spark: SparkSession) -> JobPaths:
    return JobPaths(os.path.join(ensure_checkpoint_dir(spark), "jobs"))


# ---- K1 --------------------------------------------------------------------

def preprocess(raw: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG, repartition: bool = False) -> DataFrame:
    """K1 core: drop the old label, add the simulated equity label."""
    df = io.repartition_by_cores(raw) if repartition else raw
    return with_win_share(drop_label(df), n=cfg.simulation_count, seed=cfg.equity_seed,
                          partitions=cfg.simulation_partitions)


@dataclass(frozen=True)
class JdbcTables:
    """The SQL tables of K1 and K2, for callers who keep them in a database instead of the job folder."""

    url: str
    properties: dict
    raw: str = "raw_data"
    preprocessed: str = "preprocessed_data"


def run_preprocess(spark: SparkSession, paths: JobPaths, raw: DataFrame | None = None,
                   cfg: EngineConfig = DEFAULT_CONFIG, jdbc: JdbcTables | None = None) -> DataFrame:
    """K1: raw table -> labelled table, written once to its final place."""
    if raw is None:
        raw = io.read_jdbc(spark, jdbc.url, jdbc.raw, jdbc.properties) if jdbc else io.read_parquet(spark, paths.raw)
    labelled = preprocess(raw, cfg)
    if jdbc:
        io.write_jdbc(labelled, jdbc.url, jdbc.preprocessed, jdbc.properties)
    else:
        io.write_parquet(labelled, paths.preprocessed)
    return _preprocessed(spark, paths, jdbc)


def _preprocessed(spark: SparkSession, paths: JobPaths, jdbc: JdbcTables | None) -> DataFrame:
    if jdbc:
        return io.read_jdbc(spark, jdbc.url, jdbc.preprocessed, jdbc.properties)
    return io.read_parquet(spark, paths.preprocessed)


# ---- K2 --------------------------------------------------------------------

def _row_keys(df: DataFrame, key_cols: list[str] | None) -> list[str]:
    """Columns that tell rows apart. Samples and splits decide row by row; the cards alone would decide for all rows
    of a hand at once, so the key must name something else."""
    if not key_cols or set(key_cols) <= set(CARD_COLUMNS):
        raise ValueError("key_cols must name a row id; card columns do not tell equal hands apart")
    missing = [c for c in key_cols if c not in df.columns]
    if missing:
        raise ValueError(f"key columns {missing} are not in the table")
    return list(key_cols)


def build_features(preprocessed: DataFrame, cfg: EngineConfig = DEFAULT_CONFIG, sample: bool = True,
                   key_cols: list[str] | None = None) -> DataFrame:
    """K2 core: optional hash sample of rows, then row + relative features."""
    df = preprocessed
    if sample:
        df = sampling.hash_sample(df, cfg.sample_rate, _row_keys(df, key_cols), seed=0)
    return relative.all_features(df)


def run_features(spark: SparkSession, paths: JobPaths, cfg: EngineConfig = DEFAULT_CONFIG,
                 key_cols: list[str] | None = None, jdbc: JdbcTables | None = None) -> str:
    """K2: features and the per-rank lookup of this run written as Parquet; counts logged. Returns the run id."""
    run_id = uuid.uuid4().hex
    feats = build_features(_preprocessed(spark, paths, jdbc), cfg, key_cols=key_cols)
    io.write_parquet(feats, paths.features)
    written = io.read_parquet(spark, paths.features)
    io.write_parquet(relative.stateful_lookup(written), os.path.join(paths.lookups, run_id))
    counts = written.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    runlog.log_entries(spark, paths.run_log, run_id, FEATURE_RUN, "metric",
                       {"num_rows": counts, "num_columns": len(written.columns)})
    runlog.log_entries(spark, paths.run_log, run_id, FEATURE_RUN, "param", {"sample_rate": cfg.sample_rate})
    runlog.log_entries(spark, paths.run_log, run_id, FEATURE_RUN, "end", {"status": "FINISHED"})
    return run_id


# ---- K3 --------------------------------------------------------------------

def run_training(spark: SparkSession, paths: JobPaths, cfg: EngineConfig = DEFAULT_CONFIG,
                 key_cols: list[str] | None = None, num_trees: int | None = None) -> str:
    """K3: split by row, train, evaluate on the test part, save the model, log metrics. Returns the run id."""
    feats = io.read_parquet(spark, paths.features)
    train, test = sampling.train_test_split(feats, cfg.test_size, _row_keys(feats, key_cols), cfg.split_seed)
    model = mdl.train(train, cfg, num_trees=num_trees)
    metrics = mdl.evaluate(mdl.predict(model, test)).first()
    run_id = uuid.uuid4().hex
    runlog.save_model(model, os.path.join(paths.models, run_id))
    runlog.log_entries(spark, paths.run_log, run_id, TRAINING_RUN, "param",
                       {"max_depth": cfg.max_depth, "num_trees": num_trees or cfg.num_trees})
    runlog.log_entries(spark, paths.run_log, run_id, TRAINING_RUN, "metric",
                       {"mse": metrics["mse"], "r2": metrics["r2"]})
    runlog.log_entries(spark, paths.run_log, run_id, TRAINING_RUN, "end", {"status": "FINISHED"})
    return run_id


# ---- K4 --------------------------------------------------------------------

def refresh(spark: SparkSession, paths: JobPaths):
    """K4: latest training and feature runs -> (model, lookup)."""
    runs = runlog.runs_table(spark, paths.run_log)
    model_run = runlog.latest_run_id(runs, TRAINING_RUN)
    feature_run = runlog.latest_run_id(runs, FEATURE_RUN)
    model = runlog.load_model(os.path.join(paths.models, model_run))
    return model, io.read_parquet(spark, os.path.join(paths.lookups, feature_run))


# ---- K5 --------------------------------------------------------------------

def run_drift(spark: SparkSession, paths: JobPaths, baseline: DataFrame, live: DataFrame,
              cfg: EngineConfig = DEFAULT_CONFIG, tie_cols: tuple = ()) -> DataFrame:
    """K5: latest-N guard, PSI per target, appended to the drift report table."""
    window = sampling.min_rows_guard(sampling.latest_rows(live, cfg.live_window_rows, "ts", tie_cols),
                                     cfg.live_window_rows)
    report = write_shared(drift.psi_report(baseline, window, epsilon=cfg.psi_epsilon)
                          .withColumn("computed_at", F.current_timestamp()), "drift-report")
    if report.limit(1).count():  # a short window has no report, and nothing is appended
        io.write_parquet(report, paths.drift_reports, mode="append")
    return report


# ---- K6 --------------------------------------------------------------------

STEPS = ("preprocess", "features", "training", "refresh")


def run_pipeline(spark: SparkSession, paths: JobPaths, steps=STEPS, raw: DataFrame | None = None,
                 cfg: EngineConfig = DEFAULT_CONFIG, num_trees: int | None = None,
                 key_cols: list[str] | None = None, jdbc: JdbcTables | None = None) -> dict:
    """K6: run the steps in order (the fast variant leaves out ``preprocess``)."""
    apply_runtime_conf(spark)
    out: dict = {}
    for step in STEPS:
        if step not in steps:
            continue
        if step == "preprocess":
            out["preprocessed"] = run_preprocess(spark, paths, raw, cfg, jdbc)
        elif step == "features":
            out["feature_run"] = run_features(spark, paths, cfg, key_cols, jdbc)
        elif step == "training":
            out["training_run"] = run_training(spark, paths, cfg, key_cols, num_trees)
        elif step == "refresh":
            out["model"], out["lookup"] = refresh(spark, paths)
    return out


def run_restartable(spark: SparkSession, paths: JobPaths, raw: DataFrame, input_version: str, cfg: EngineConfig = DEFAULT_CONFIG,
                    num_trees: int | None = None, key_cols: list[str] | None = None) -> dict:
    """K6 that can be broken off anywhere: every step is committed to a ledger, and a later run with the same input version goes
    on at the first step that was not. Ends by publishing model and lookup as a pair (which may be repeated).

    Returns the folders of ``preprocessed``, ``features``, ``lookup`` and ``model``, and the pair's ``version``.
    """
    apply_runtime_conf(spark)
    ledger = Ledger(spark, os.path.join(paths.root, "restartable"), TRAINING_RUN)
    rows = lambda path: spark.read.parquet(path).count()
    pre = ledger.run("preprocess", version_of(input_version, cfg), lambda p: io.write_parquet(preprocess(raw, cfg), p), rows)
    feats = ledger.run("features", version_of(pre, key_cols),
                       lambda p: io.write_parquet(build_features(io.read_parquet(spark, pre), cfg, key_cols=key_cols), p), rows)
    table = io.read_parquet(spark, feats)
    lookup = ledger.run("lookup", version_of(feats), lambda p: io.write_parquet(relative.stateful_lookup(table), p), rows)
    train, _ = sampling.train_test_split(table, cfg.test_size, _row_keys(table, key_cols), cfg.split_seed)
    model = ledger.run("training", version_of(feats, num_trees), lambda p: runlog.save_model(mdl.train(train, cfg, num_trees=num_trees), p))
    version = version_of(model, lookup)
    publish(spark, paths.run_log, version, model, lookup)
    return {"preprocessed": pre, "features": feats, "lookup": lookup, "model": model, "version": version}
