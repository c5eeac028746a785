"""Session settings the job relies on, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Settings applied by :func:`configure`; each is set only if the session does
# not carry a value already, so a cluster's own tuning wins.
JOB_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when a later operator (the member
    # distinct, a second join on the same key) then needs a new shuffle: the
    # extra shuffle appears only when skew is actually detected.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "buyerlens", extra: dict[str, str] | None = None) -> SparkSession:
    """A session for local runs and tests (the UI stays off)."""
    b = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`JOB_CONF` to a running session where a key is unset."""
    for k, v in JOB_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder for lineage cuts.

    Read from the session (``spark.checkpoint.dir``); only a local session
    that has none gets a fresh scratch folder, a cluster must name a shared one. A Spark
    Connect session has no driver-side context here: its server's setting
    applies and ``None`` is returned.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        return spark.conf.get("spark.checkpoint.dir", None)
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="buyerlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_SCRATCH: set[str] = set()  # folders that go when this process ends


def scratch_dir(spark: SparkSession) -> str | None:
    """This application's folder for intermediate tables, below the shared checkpoint folder; it is deleted when
    the driver's process ends. None where the checkpoint folder is not known here."""
    root = checkpoint_dir(spark)
    if not root:
        return None
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's application outlives this process
        return root
    folder = f"{root}/run-{sc.applicationId}"
    if folder not in _SCRATCH:
        _SCRATCH.add(folder)
        atexit.register(_delete, sc._jvm, sc._jsc.hadoopConfiguration(), folder)
    return folder


def _delete(jvm, hadoop_conf, folder: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop_conf).delete(path, True)
    except Exception:  # the JVM is gone: the folder's name tells whose it was
        pass


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, as a Parquet table below the shared checkpoint folder, and read it back.

    It cuts the lineage (a lost executor re-reads the table instead of
    recomputing from the raw inputs) and lets several consumers share one
    computation, each with its own columns and filters pushed into the scan. A
    Spark Connect session whose folder is not known here gets a reliable
    ``checkpoint()``.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark)
    if not folder:
        return df.checkpoint(eager=True)
    path = f"{folder}/tables-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_concurrently(spark: SparkSession, tasks: dict[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent driver-side steps that each submit Spark jobs at the
    same time, from threads that inherit the caller's job group and
    properties (cancelling the caller's group cancels them too)."""
    if len(tasks) < 2:
        return {k: f() for k, f in tasks.items()}
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    wrap = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = {k: pool.submit(wrap(f)) for k, f in tasks.items()}
        return {k: f.result() for k, f in futures.items()}

