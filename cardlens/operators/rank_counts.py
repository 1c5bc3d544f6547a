"""Incremental lookup (K2 / E2): a stored, mergeable count table per (value, class).

The relative features depend on counts only, so new hands need not bring the old ones back:
each batch of hands adds its own counts, and the lookup is made from the sum.

Layout of a store: ``batches/<id>`` holds the counts of one batch, ``merged/<version>/counts`` the sum of the
batches listed in ``merged/<version>/batches``. The list is written last, so a merge that was broken
off is not seen. Batches are written under their id, so a batch that is added again replaces itself; one
that a merge holds already is left alone. Readers take the newest merged version and the batches it does not list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RANK_CLASS, RANK_VALUE, STATEFUL_FEATURES
from ..session import child_folders
from .relative import lookup_from_counts, rank_counts


class CountStore:
    """Counts per (value, class) of all batches added to the folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, value_col: str = RANK_VALUE, class_col: str = RANK_CLASS):
        self.spark, self.path, self.columns = spark, path.rstrip("/"), [value_col, class_col]

    def _merged(self) -> tuple[int, set]:
        """(newest complete merge or 0, ids of the batches in it)."""
        for version in sorted((int(v) for v in child_folders(self.spark, f"{self.path}/merged")), reverse=True):
            if "batches" in child_folders(self.spark, f"{self.path}/merged/{version}"):
                rows = self.spark.read.schema("batch string").parquet(f"{self.path}/merged/{version}/batches").collect()  # one row per batch
                return version, {r["batch"] for r in rows}
        return 0, set()

    def _open(self, held: set) -> list:
        return [b for b in sorted(child_folders(self.spark, f"{self.path}/batches")) if b not in held]

    def add(self, hands: DataFrame, batch: str) -> None:
        """Add the counts of new rows under a batch id (letters, digits, - and _)."""
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"not a batch id: {batch!r}")
        if batch not in self._merged()[1]:
            rank_counts(hands, *self.columns).write.mode("overwrite").parquet(f"{self.path}/batches/{batch}")

    def counts(self) -> DataFrame:
        """(value, class, _n) over all batches; an empty store is an error."""
        version, held = self._merged()
        parts = ([f"{self.path}/merged/{version}/counts"] if version else []) + [f"{self.path}/batches/{b}" for b in self._open(held)]
        if not parts:
            raise ValueError(f"no batch was added to {self.path}")
        return self.spark.read.parquet(*parts).groupBy(*self.columns).agg(F.sum("_n").alias("_n"))

    def merge(self) -> int:
        """Sum all batches into a new version; returns its number (the current one if nothing is new)."""
        version, held = self._merged()
        new = self._open(held)
        if not new:
            return version
        target = f"{self.path}/merged/{version + 1}"
        self.counts().write.mode("overwrite").parquet(f"{target}/counts")
        self.spark.createDataFrame([(b,) for b in sorted(held | set(new))], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{target}/batches")
        return version + 1

    def lookup(self, features=STATEFUL_FEATURES) -> DataFrame:
        """E2 from the stored counts: the relative features of all rows added so far."""
        from ..session import write_shared

        return lookup_from_counts(write_shared(self.counts(), "rank-counts"), *self.columns, features)
