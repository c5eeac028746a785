"""What the operators share: table access, lineage cuts, batch sizes."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.session import checkpoint_dir

BATCH_ROWS = 512  # rows of an Arrow batch that goes to Python: bounds a worker's memory


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches and send this package to executors that lack it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if not getattr(sc, "_buyerlens_sent", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="buyerlens-py-"), "buyerlens_pkg.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(root):
                for n in names:
                    if n.endswith(".py"):
                        p = os.path.join(folder, n)
                        z.write(p, os.path.relpath(p, os.path.dirname(root)))
        sc.addPyFile(archive)
        sc._buyerlens_sent = True


def release_memory() -> None:
    """Give freed memory of a driver-side fit back to the system, where the C library can (glibc)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of it (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder; its lineage ends there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def forget(spark: SparkSession) -> None:
    """Free the disk of shuffles and cuts that nothing refers to any more now, not when the driver's heap happens to fill."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def salt_of(*cols: str, n: int) -> Column:
    """0..n-1 by hash: the same for a retried task."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def valid_vector(c: str, dim: int | None = None) -> Column:
    """Not null, no null or non-finite component, not zero (and ``dim`` long, where given)."""
    v = F.col(c)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)
    return F.coalesce(ok & (F.size(v) == dim) if dim else ok, F.lit(False))


def matrix(arrays) -> np.ndarray:
    """Rows of equal length as a double matrix."""
    return np.array([np.asarray(a, dtype=np.float64) for a in arrays], dtype=np.float64)


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """``k`` centres of a bounded sample (fewer, if it has fewer distinct rows)."""
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        square = np.square(c).sum(1)[None, :]
        near = np.concatenate([np.argmin(square - 2 * x[i:i + 2048] @ c.T, axis=1) for i in range(0, len(x), 2048)])
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c
