"""Restartable steps (K6): a ledger of what was committed, read before every step.

A step has a name, an input version and a function that writes a folder. Its output goes to a folder
of its own attempt; only when that is written does the ledger get a row (one small Parquet file, so
it is there or not). A later run finds the row and takes the output; a run that was broken off finds
none and does the step again in a new folder, and what the broken attempt left is removed. The output of a
step is part of the next one's input version, so a step whose input changed runs again.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import child_folders, delete_folder

LEDGER = "job string, step string, input_version string, output string, n_rows long, committed_at timestamp"


def version_of(*parts) -> str:
    """A short version of anything with a stable text."""
    return hashlib.sha256("\x1f".join(map(str, parts)).encode()).hexdigest()[:16]


class Ledger:
    """Committed steps of one job under the folder ``root``."""

    def __init__(self, spark: SparkSession, root: str, job: str = "job"):
        self.spark, self.root, self.job = spark, root.rstrip("/"), job

    def rows(self) -> DataFrame:
        """(job, step, input_version, output, n_rows, committed_at), one row per committed step and input version."""
        if "ledger" not in child_folders(self.spark, self.root):
            return self.spark.createDataFrame([], LEDGER)
        log = self.spark.read.schema(LEDGER).parquet(f"{self.root}/ledger").filter(F.col("job") == self.job)
        first = F.min_by(F.struct("output", "n_rows", "committed_at"), F.struct("committed_at", "output")).alias("_first")
        return log.groupBy("job", "step", "input_version").agg(first).select("job", "step", "input_version", "_first.*")  # two writers: the first counts

    def committed(self, step: str, input_version: str) -> str | None:
        found = self.rows().filter((F.col("step") == step) & (F.col("input_version") == input_version)).first()
        return found["output"] if found else None

    def run(self, step: str, input_version: str, write: Callable[[str], None], count: Callable[[str], int] | None = None) -> str:
        """The folder of the step's output; ``write`` fills it if the step was not committed for this input version."""
        done = self.committed(step, input_version)
        if done:
            return done
        base = f"{self.root}/{step}"
        kept = {r["output"] for r in self.rows().filter(F.col("step") == step).select("output").collect()}  # one row per version of one step
        for folder in child_folders(self.spark, base):
            if f"{base}/{folder}" not in kept and folder.startswith(f"{input_version}-"):
                delete_folder(self.spark, f"{base}/{folder}")  # left by an attempt that was broken off
        output = f"{base}/{input_version}-{uuid.uuid4().hex}"
        write(output)
        n = count(output) if count else None
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = self.spark.createDataFrame([(self.job, step, input_version, output, n, now)], LEDGER)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/ledger")
        return self.committed(step, input_version) or output
