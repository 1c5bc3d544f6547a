"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import threading
import time
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# SQL settings the operators rely on; all can be set on a running session.
# * UTC: tumbling windows and timestamp text agree with naive event times.
# * hugeMethodLimit 8000: a generated method above HotSpot's 8,000-byte JIT
#   limit runs interpreted; the wide simulation stage crosses it and is ~10x
#   slower unless Spark splits such stages (the documented HotSpot setting).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the SQL options above on an existing session (e.g. one made by a launcher)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def compile_long_stages(spark: SparkSession) -> None:
    """Keep stages whose generated method is too long for the JIT out of whole-stage code (on any session, before they are planned).

    Decoding, ranking and features stand in one stage. As one method they ran interpreted, more than ten times
    slower; operator by operator Spark splits the code, and every part is compiled.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > int(RUNTIME_CONF[key]):
        spark.conf.set(key, RUNTIME_CONF[key])


def build_session(master: str | None = None, app_name: str = "cardlens",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the engine's defaults.

    On a cluster, ``master`` and the partition count come from the launcher
    and should be left ``None``; the defaults here only add what every job
    relies on: UTC session time, ANSI mode, adaptive execution with skew
    handling, and no web UI.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    conf.update(RUNTIME_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset, a scratch folder
    is made for a single-machine session (``local[...]``: tests, a laptop) only;
    on any other master this fails, because a folder of the driver's own
    machine is not visible to the executors.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share (master is {master})")
        path = tempfile.mkdtemp(prefix="cardlens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder of any file system Spark reads; none if it is not there."""
    system, target = _folder(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory()) if system.exists(target) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library made."""
    system, target = _folder(spark, path)
    system.delete(target, True)


SCRATCH_PREFIX = "cardlens-scratch-"
LEASE_CONF = "spark.cardlens.lease.seconds"
LEASE_SECONDS = 24 * 3600
_LEASE = "_lease-"


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for written tables, below the shared folder.

    It is leased: a sub-folder names the time until which it is in use, and is renewed while the application
    lives. It is removed when the application ends (:func:`release_scratch`); what an application that crashed left behind
    is removed by the next one that finds its lease run out.
    """
    shared = ensure_checkpoint_dir(spark).rstrip("/")
    root = f"{shared}/{SCRATCH_PREFIX}{spark.sparkContext.applicationId}"
    if root not in _leases:
        _leases[root] = _Lease(spark, root)
        remove_expired(spark, shared)
    return root


class _Lease:
    """Keeps a scratch folder in use until it is released or the process is gone."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.process = root, os.getpid()
        self.seconds = float(spark.conf.get(LEASE_CONF, None) or spark.sparkContext.getConf().get(LEASE_CONF, None) or LEASE_SECONDS)
        self.paths = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self.paths(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.mark, self.ended = None, threading.Event()
        self.renew()
        threading.Thread(target=self._keep, daemon=True).start()
        atexit.register(self.release)

    def renew(self) -> None:
        mark = self.paths(f"{self.root}/{_LEASE}{int((time.time() + self.seconds) * 1000)}")
        self.system.mkdirs(mark)
        if self.mark is not None and self.mark.getName() != mark.getName():
            self.system.delete(self.mark, True)
        self.mark = mark

    def _keep(self) -> None:
        while not self.ended.wait(self.seconds / 4):
            try:
                self.renew()
            except Exception:  # the next turn, or the end of the lease, settles it
                continue

    def release(self) -> None:
        if self.ended.is_set() or os.getpid() != self.process:
            return
        self.ended.set()
        try:
            self.system.delete(self.paths(self.root), True)
        except Exception:  # without a driver JVM the folder stays until its lease has run out
            pass


_leases: dict = {}


def release_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch folder now; nothing that was read from it can be read any more."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{SCRATCH_PREFIX}{spark.sparkContext.applicationId}"
    lease = _leases.pop(root, None)
    if lease is not None:
        lease.release()


def remove_expired(spark: SparkSession, shared: str) -> list[str]:
    """Remove scratch folders in ``shared`` whose lease has run out; returns their names."""
    gone = []
    for name in child_folders(spark, shared):
        if name.startswith(SCRATCH_PREFIX):
            ends = [int(c[len(_LEASE):]) for c in child_folders(spark, f"{shared}/{name}") if c.startswith(_LEASE)]
            if ends and max(ends) < time.time() * 1000:
                delete_folder(spark, f"{shared}/{name}")
                gone.append(name)
    return gone


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the application's scratch folder for one written table; no two calls share one."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` once to a fresh folder all executors share, and read it back.

    The plan runs once (``checkpoint()`` would run it twice) and a lost
    executor never makes it run again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per application), wherever Python was started."""
    context = spark.sparkContext
    if _shipped.get("application") == context.applicationId:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="cardlens-package-"), "cardlens_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)
    _shipped["application"] = context.applicationId


_shipped: dict = {}
