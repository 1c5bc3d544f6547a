"""Command line for the jobs (K1 - K6).

    python -m cardlens.plans.cli train --root <shared folder> [--raw <parquet>] \
        [--preprocess] [--feature-engineering] [--training] [--refresh]
    python -m cardlens.plans.cli drift --root <shared folder> --baseline <json> --live <json>

The session comes from the launcher (``spark-submit`` sets master and
resources); only the engine's SQL options are applied on top.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ..config import DEFAULT_CONFIG
from ..operators import drift
from ..session import apply_runtime_conf, ensure_checkpoint_dir
from ..sources import io
from . import jobs


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cardlens")
    sub = p.add_subparsers(dest="command", required=True)
    t = sub.add_parser("train", help="preprocess / feature engineering / training / refresh")
    t.add_argument("--root", required=True, help="shared folder for all job tables")
    t.add_argument("--raw", help="Parquet path of the raw hand table (default: <root>/raw)")
    t.add_argument("--preprocess", action="store_true")
    t.add_argument("--feature-engineering", action="store_true")
    t.add_argument("--training", action="store_true")
    t.add_argument("--refresh", action="store_true")
    t.add_argument("--keys", default="", help="comma-separated row id columns (for sampling and splitting)")
    t.add_argument("--trees", type=int, default=None, help="number of trees (default: config)")
    d = sub.add_parser("drift", help="PSI report of the newest live rows against a baseline")
    d.add_argument("--root", required=True)
    d.add_argument("--baseline", required=True, help="baseline JSON: feature -> label -> count")
    d.add_argument("--live", required=True, help="live JSON: column -> {row index -> value}")
    d.add_argument("--rows", type=int, default=DEFAULT_CONFIG.live_window_rows)
    return p


def main(argv=None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("cardlens").getOrCreate()
    apply_runtime_conf(spark)
    ensure_checkpoint_dir(spark)
    paths = jobs.JobPaths(args.root)
    if args.command == "train":
        steps = [s for s, on in (("preprocess", args.preprocess), ("features", args.feature_engineering),
                                 ("training", args.training), ("refresh", args.refresh)) if on]
        raw = io.read_parquet(spark, args.raw) if args.raw else None
        return jobs.run_pipeline(spark, paths, steps=steps, raw=raw, num_trees=args.trees,
                                 key_cols=[k for k in args.keys.split(",") if k] or None)
    baseline = drift.read_baseline_json(spark, args.baseline)
    live = drift.read_live_json(spark, args.live)
    cfg = DEFAULT_CONFIG.__class__(live_window_rows=args.rows)
    report = jobs.run_drift(spark, paths, baseline, live, cfg, tie_cols=("row_index",))
    return {"report": report}


if __name__ == "__main__":
    main(sys.argv[1:])
