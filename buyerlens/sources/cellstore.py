"""The stored cells (S7-S9): versioned folders behind a manifest.

A store is a folder with ``versions/<id>`` (the cells, one folder per family
and bucket, sorted files) and ``manifests`` (one small row per finished write).
A write goes to a fresh version; only when its cells are counted in the files
does it get its manifest row, which is added and never rewritten. Readers take
the version of the highest manifest row, so a run that dies at any point, or is
writing now, leaves the former cells as they are. Versions that no reader can
reach any more go after the switch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from buyerlens.operators.cells import sorted_cells

CELLS = "rowkey string, qualifier string, value string, family string, bucket int"
MANIFEST = "version long, folder string, n_cells long"
OPEN_FILES = 256  # files a sink task may have open; it needs one per family, or two where its range crosses a bucket


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def _manifests(spark: SparkSession, path: str) -> DataFrame | None:
    """The store's manifest rows, or None where there is no store yet."""
    from pyspark.errors import AnalysisException

    try:
        # A write that died before its commit leaves an empty folder: the schema is given, not inferred.
        return spark.read.schema(MANIFEST).json(f"{path}/manifests")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def current_version(spark: SparkSession, path: str) -> tuple[int, str, int] | None:
    """``(version, folder, n_cells)`` that readers follow, None before the first finished write."""
    rows = _manifests(spark, path)
    top = None if rows is None else rows.orderBy(F.desc("version"), F.desc("folder")).first()
    return None if top is None else (top["version"], top["folder"], top["n_cells"])


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """The stored cells. A filter on ``family`` or ``bucket`` reads those folders alone."""
    now = current_version(spark, path)
    if now is None:
        raise FileNotFoundError(f"no finished cells below {path}")
    return spark.read.schema(CELLS).parquet(f"{path}/{now[1]}")


RUNS = ("family string, bucket int, file string, first_at long, last_at long, n long, first struct<k:string,q:string>,"
        " last struct<k:string,q:string>, low string, high string, falls long")


def order_report(spark: SparkSession, path: str) -> DataFrame:
    """Per family and bucket of the current version: ``(n_cells, first_key, last_key, codec, out_of_order)``, the last one
    the neighbours within a file whose keys (rowkey, family, qualifier) do not ascend.

    Files are read in order, so neighbours are compared where they are read: the cells do not move, only the ends of the
    runs that a batch holds meet by file. A file has one family.
    """
    def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each batch as runs of neighbouring rows of one file: their ends, and how often a key is not above the one before it."""
        types = pa.schema([("family", pa.string()), ("bucket", pa.int32()), ("file", pa.string()), ("first_at", pa.int64()), ("last_at", pa.int64()),
                           ("n", pa.int64()), *[(c, pa.struct([("k", pa.string()), ("q", pa.string())])) for c in ("first", "last")],
                           ("low", pa.string()), ("high", pa.string()), ("falls", pa.int64())])
        for b in batches:
            if not b.num_rows:
                continue
            family, bucket, file, at, key, qualifier = b.columns
            place = at.to_numpy()
            near = pc.equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False) & (np.diff(place) == 1)
            near &= np.diff(bucket.to_numpy()) == 0
            near &= pc.equal(family[1:], family[:-1]).to_numpy(zero_copy_only=False)
            less, same = pc.less(key[1:], key[:-1]), pc.equal(key[1:], key[:-1])
            fall = pc.or_(less, pc.and_(same, pc.less_equal(qualifier[1:], qualifier[:-1]))).to_numpy(zero_copy_only=False) & near
            starts = np.r_[0, np.flatnonzero(~near) + 1]
            rows = []
            for i, j in zip(starts.tolist(), [*starts[1:].tolist(), b.num_rows]):
                ends = pc.min_max(key[i:j].filter(pc.not_equal(key[i:j], "")))
                rows.append({"family": family[i].as_py(), "bucket": bucket[i].as_py(), "file": file[i].as_py(),
                             "first_at": int(place[i]), "last_at": int(place[j - 1]), "n": j - i,
                             "first": {"k": key[i].as_py(), "q": qualifier[i].as_py()}, "last": {"k": key[j - 1].as_py(), "q": qualifier[j - 1].as_py()},
                             "low": ends["min"].as_py(), "high": ends["max"].as_py(), "falls": int(fall[i:j - 1].sum())})
            yield pa.RecordBatch.from_pylist(rows, types)

    # A null rowkey goes before all others.
    key = F.coalesce(F.concat(F.lit("!"), "rowkey"), F.lit(""))
    back = read_cells(spark, path).select("family", "bucket", F.col("_metadata.file_name").alias("file"),
                                          F.col("_metadata.row_index").alias("at"), key.alias("k"), "qualifier")
    by_file = Window.partitionBy("family", "bucket", "file").orderBy("first_at")
    met = (F.lead("first_at").over(by_file) == F.col("last_at") + 1) & (F.lead("first").over(by_file) <= F.col("last"))
    runs = back.mapInArrow(runs_of, RUNS).withColumn("met", F.coalesce(met, F.lit(False)).cast("long"))
    codec = F.regexp_extract("file", r"\.([a-z0-9]+)\.parquet$", 1)
    return runs.groupBy("family", "bucket").agg(
        F.sum("n").alias("n_cells"), F.substring(F.min("low"), 2, 1 << 30).alias("first_key"), F.substring(F.max("high"), 2, 1 << 30).alias("last_key"),
        F.max(codec).alias("codec"), F.sum(F.col("falls") + F.col("met")).alias("out_of_order"))


def write_cells(cell_df: DataFrame, path: str, compression: str = "snappy", in_order: bool = True, keep: int = 2) -> int:
    """Store ``cell_df`` as the next version of ``path`` and return its number.

    ``in_order`` cells (those of :func:`buyerlens.operators.cells.cells`) are
    in key order within each partition and are written as they come: a task
    holds its few files open instead of sorting the cells by folder. Others are
    sorted first. The files' count must be that of the rows written. ``keep``
    versions stay, so that a reader of the former one can finish.
    """
    spark = cell_df.sparkSession
    before = current_version(spark, path)
    version = 1 + (before[0] if before else 0)
    folder = f"versions/{version:08d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    rows = cell_df if in_order else sorted_cells(cell_df)
    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES if in_order else 0)):
        (rows.observe(seen, F.count(F.lit(1)).alias("n")).write.option("compression", compression)
         .partitionBy("family", "bucket").parquet(f"{path}/{folder}"))
    sent, stored = seen.get["n"], spark.read.schema(CELLS).parquet(f"{path}/{folder}").count()
    if sent != stored:
        raise RuntimeError(f"{sent} cells were sent to {folder}, {stored} are stored: the former version stays")
    spark.createDataFrame([(version, folder, stored)], MANIFEST).coalesce(1).write.mode("append").json(f"{path}/manifests")
    _drop_versions(spark, path, keep)
    return version


def _drop_versions(spark: SparkSession, path: str, keep: int) -> None:
    """Delete the folders of versions below the ``keep`` newest finished ones, and of unfinished older writes."""
    rows = _manifests(spark, path).orderBy(F.desc("version"), F.desc("folder")).limit(keep).collect()
    kept = {r["folder"].rsplit("/", 1)[1] for r in rows}
    oldest = min(r["version"] for r in rows)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{path}/versions")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name not in kept and int(name.split("-")[0]) < oldest:
            fs.delete(status.getPath(), True)
