"""Cell layout: rendering, families, rowkey, buckets, sort order, writer."""

import glob
import hashlib
import os
import tempfile

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from buyerlens.functions.scalars import default_rowkey
from buyerlens.operators.cells import PREFIX_SPACE, bucket_of, cell_values, cells, range_of
from buyerlens.sources.cellstore import current_version, order_report, read_cells, write_cells


def keyed(df):
    return df.withColumn("rowkey", default_rowkey())


def test_rendering_and_sparsity(spark):
    df = spark.createDataFrame(
        [("k", [1, None, 3], {"a": 1, "b": None}, "", None, 7)],
        "id string, Arr array<int>, M map<string,int>, Empty string, Missing string, N int")
    got = {r.qualifier: r.value for r in cell_values(df, ["id"]).collect()}
    assert got == {"arr": "[1,null,3]", "m": '{"a":1,"b":null}', "empty": "", "n": "7"}


def test_unmapped_column_fails_early(spark):
    df = spark.createDataFrame([("u", "1", 1, "x")], "user_id string, merchant_num string, is_member int, extra string")
    with pytest.raises(ValueError, match="extra"):
        cells(keyed(df), 15, {"user_id": "base", "merchant_num": "base", "is_member": "base"})


def test_case_collision_fails(spark):
    df = spark.createDataFrame([("u", "1", 1, "x")], "user_id string, merchant_num string, is_member int, User_Id string")
    with pytest.raises(ValueError):
        cells(df.withColumn("rowkey", F.lit("k")), 15, {"user_id": "base", "merchant_num": "base", "is_member": "base"})


def test_rowkey_matches_python_md5(spark):
    users = ["u1", "😀user", "", None, "中文", "\\N"]
    df = spark.createDataFrame([(u, "7") for u in users], "user_id string, merchant_num string")
    got = [r.k for r in df.select(default_rowkey().alias("k")).collect()]
    for u, k in zip(users, got):
        uu = "\\N" if u is None else u.replace("\\", "\\\\")
        want = hashlib.md5(f"{uu}_7".encode("utf-8")).hexdigest()[:8] + f"_7_{uu}"
        assert k == want


def test_rowkeys_are_distinct(spark):
    pairs = [("A1", "u"), ("B2", "u"), ("1", ""), ("1", None), (None, "u"), ("", "u"), ("a_b", "c"), ("a", "b_c"), ("\\N", "u"), ("7", "u"), ("07", "u")]
    df = spark.createDataFrame(pairs, "merchant_num string, user_id string")
    assert df.select(default_rowkey()).distinct().count() == len(pairs)


def test_every_tenant_text_keeps_its_cells(spark):
    """Tenants that are no numbers, and empty and NULL users, are rows of their own."""
    from buyerlens.operators.profile import user_profile
    from buyerlens.params import ProfileParams
    from frames import make_inputs, member

    inp = make_inputs(spark, members=[member("A1", "u"), member("B2", "u"), member("1", ""), member("1", None)])
    p = ProfileParams(as_of="2024-01-30")
    prof = user_profile(inp, p, final_distinct=False, materialize=False, keyed=True)
    assert cells(prof, 4).select("rowkey").distinct().count() == 4


def test_codec_is_snappy(spark):
    out = tempfile.mkdtemp(prefix="cells-codec-") + "/cells"
    df = keyed(spark.createDataFrame([("u", "1", 1, "x")], "user_id string, merchant_num string, is_member int, note string"))
    write_cells(cells(df, 2, {"user_id": "base", "merchant_num": "base", "is_member": "base", "note": "model"}), out)
    f, *_ = glob.glob(os.path.join(out, "versions", "*", "family=*", "bucket=*", "*.parquet"))
    assert pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "SNAPPY"


def test_mixed_buyer_keeps_both_rows_columns(spark):
    """Per column the member's value, else the other row's; arrays and maps come as JSON, mixed-case names in lower case."""
    df = keyed(spark.createDataFrame(
        [("u", "1", 1, "m", None, [1, 2], None), ("u", "1", 0, "n", "only", None, {"k": 1}), ("u", "1", 1, "a", None, None, None)],
        "user_id string, merchant_num string, is_member int, Note string, other string, Arr array<int>, Map map<string,int>"))
    fam = {c.lower(): "base" for c in df.columns}
    got = {r.qualifier: r.value for r in cells(df, 4, fam).collect()}
    assert got == {"user_id": "u", "merchant_num": "1", "is_member": "1", "note": "m", "other": "only", "arr": "[1,2]", "map": '{"k":1}'}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=PREFIX_SPACE - 1), min_size=1, max_size=30),
       st.integers(min_value=1, max_value=40))
def test_bucket_monotone_and_in_range(spark, prefixes, n):
    keys = [f"{p:08x}_x" for p in prefixes]
    df = spark.createDataFrame([(k,) for k in keys], "rowkey string")
    got = {r.rowkey: r.b for r in df.select("rowkey", bucket_of(F.col("rowkey"), n).alias("b")).collect()}
    width = PREFIX_SPACE // n
    for k in keys:
        assert got[k] == min(int(k[:8], 16) // width, n - 1)
        assert 0 <= got[k] < n
    ordered = sorted(keys)
    assert [got[k] for k in ordered] == sorted(got[k] for k in ordered)


def test_one_row_per_rowkey_member_first(spark):
    df = spark.createDataFrame(
        [("u", "1", 0, "nonmember"), ("u", "1", 1, "member"), ("v", "1", 0, None), ("v", "1", 0, None)],
        "user_id string, merchant_num string, is_member int, note string")
    fam = {"user_id": "base", "merchant_num": "base", "is_member": "base", "note": "model"}
    c = cells(keyed(df), 4, fam).collect()
    notes = {(r.rowkey.split("_")[-1], r.qualifier): r.value for r in c}
    assert notes[("u", "note")] == "member"
    assert ("v", "note") not in notes                # NULL cell dropped
    assert len([r for r in c if r.rowkey.endswith("_v")]) == 3
    assert {r.family for r in c if r.qualifier == "note"} == {"model"}


def test_written_cells_sorted_and_rerun_replaces(spark):
    def frame(n):
        return spark.createDataFrame([(f"user{i}", str(i % 3), i % 2, f"v{i}") for i in range(n)],
                                     "user_id string, merchant_num string, is_member int, note string")

    fam = {"user_id": "base", "merchant_num": "base", "is_member": "base", "note": "model"}
    out = tempfile.mkdtemp(prefix="cells-test-") + "/cells"
    write_cells(cells(keyed(frame(300)), 5, fam), out)
    write_cells(cells(keyed(frame(50)), 5, fam), out)   # rerun with fewer rows replaces what readers see
    assert read_cells(spark, out).count() == 50 * 4 and current_version(spark, out)[0] == 2
    files = glob.glob(os.path.join(out, "versions", "*", "family=*", "bucket=*", "*.parquet"))
    assert files
    # Each task writes one contiguous key range: one file per family, range and version.
    assert len(files) <= 2 * 2 * 5
    for f in files:
        t = pq.read_table(f, columns=["rowkey", "family", "qualifier"]).to_pylist()
        keys = [(r["rowkey"].encode(), r["family"].encode(), r["qualifier"].encode()) for r in t]
        assert keys == sorted(keys)
        b = int(os.path.basename(os.path.dirname(f)).split("=")[1])
        width = PREFIX_SPACE // 5
        assert all(min(int(k[0][:8], 16) // width, 4) == b for k in keys)


def test_sort_is_utf8_byte_order(spark):
    """U+E000 sorts before U+1F600 in UTF-8 bytes (UTF-16 code units would
    put the surrogate pair first)."""
    users = ["\ue000", "\U0001f600", "a", "\u00e9"]
    df = spark.createDataFrame([(u, "1", 1) for u in users], "user_id string, merchant_num string, is_member int")
    fam = {"user_id": "base", "merchant_num": "base", "is_member": "base"}
    out = tempfile.mkdtemp(prefix="cells-utf8-") + "/cells"
    # One bucket and one range: every cell in one sorted file.
    write_cells(cells(keyed(df), 1, fam, per_bucket=1), out)
    files = glob.glob(os.path.join(out, "versions", "*", "family=*", "bucket=*", "*.parquet"))
    assert len(files) == 1
    keys = [(r["rowkey"], r["family"], r["qualifier"]) for r in
            pq.read_table(files[0], columns=["rowkey", "family", "qualifier"]).to_pylist()]
    assert keys == sorted(keys, key=lambda k: tuple(x.encode("utf-8") for x in k))
    # Both orders differ for this pair, so the check is not vacuous.
    a, b = "x\ue000", "x\U0001f600"
    assert (a.encode("utf-8") < b.encode("utf-8")) != (a.encode("utf-16-be") < b.encode("utf-16-be"))


FAM = {"user_id": "base", "merchant_num": "base", "is_member": "base", "note": "model"}


def users(spark, n, note="v"):
    return keyed(spark.createDataFrame([(f"user{i}", str(i % 3), i % 2, f"{note}{i}") for i in range(n)],
                                       "user_id string, merchant_num string, is_member int, note string"))


def stored(spark, out):
    return sorted(tuple(r) for r in read_cells(spark, out).select("rowkey", "family", "qualifier", "value", "bucket").collect())


def test_a_run_that_dies_leaves_the_former_cells(spark):
    out = tempfile.mkdtemp(prefix="cells-crash-") + "/cells"
    with pytest.raises(FileNotFoundError):
        read_cells(spark, out)
    write_cells(cells(users(spark, 200), 4, FAM), out)
    before = stored(spark, out)
    # Some tasks finish their files, one fails: the write dies after files are there.
    bad = cells(users(spark, 200, "new"), 4, FAM).withColumn(
        "value", F.when(F.col("value") == "new77", F.raise_error(F.lit("lost"))).otherwise(F.col("value")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        write_cells(bad, out)
    assert len(os.listdir(os.path.join(out, "versions"))) == 2
    assert stored(spark, out) == before and current_version(spark, out)[0] == 1
    write_cells(cells(users(spark, 30, "new"), 4, FAM), out)
    assert len(stored(spark, out)) == 120 and current_version(spark, out)[0] == 2


def test_a_run_that_dies_before_its_manifest(spark, monkeypatch):
    from buyerlens.sources import cellstore

    out = tempfile.mkdtemp(prefix="cells-crash-") + "/cells"
    write_cells(cells(users(spark, 50), 4, FAM), out)
    before = stored(spark, out)
    monkeypatch.setattr(cellstore, "MANIFEST", "no such schema")
    with pytest.raises(Exception):
        write_cells(cells(users(spark, 60, "new"), 4, FAM), out)
    monkeypatch.undo()
    assert stored(spark, out) == before


def test_old_versions_go_after_the_switch(spark):
    out = tempfile.mkdtemp(prefix="cells-keep-") + "/cells"
    for n in (5, 6, 7, 8):
        write_cells(cells(users(spark, n), 2, FAM), out)
    assert len(os.listdir(os.path.join(out, "versions"))) == 2
    assert read_cells(spark, out).select("rowkey").distinct().count() == 8


def test_a_store_without_cells(spark):
    out = tempfile.mkdtemp(prefix="cells-none-") + "/cells"
    write_cells(cells(users(spark, 3).limit(0), 2, FAM), out)
    assert read_cells(spark, out).count() == 0


def test_one_family_reads_its_own_files(spark):
    out = tempfile.mkdtemp(prefix="cells-family-") + "/cells"
    write_cells(cells(users(spark, 100), 3, FAM), out)
    one = read_cells(spark, out).where("family = 'model'")
    files = {r.f for r in one.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    assert one.count() == 100 and files and all("family=model" in f for f in files)
    assert "PartitionFilters: [isnotnull(family" in one._jdf.queryExecution().executedPlan().toString()


def test_cells_of_any_order_are_sorted_for_the_store(spark):
    out = tempfile.mkdtemp(prefix="cells-any-") + "/cells"
    write_cells(cells(users(spark, 80), 3, FAM).repartition(5, "value"), out, in_order=False)
    for f in glob.glob(os.path.join(out, "versions", "*", "family=*", "bucket=*", "*.parquet")):
        keys = [(r["rowkey"], r["qualifier"]) for r in pq.read_table(f, columns=["rowkey", "qualifier"]).to_pylist()]
        assert keys == sorted(keys)


def test_order_report_counts_every_fall_without_moving_cells(spark):
    """Neighbours in files of several batches, in and out of order, null keys too, are those of a plain reading."""
    out = tempfile.mkdtemp(prefix="cells-report-") + "/cells"
    rows = cells(users(spark, 300), 3, FAM).union(spark.createDataFrame([(None, "basic", "q", "v", 0)] * 2, "rowkey string, family string, qualifier string, value string, bucket int"))
    write_cells(rows.repartition(2, F.xxhash64("value", "rowkey")), out)  # said to be in order, but is not
    want = {}
    for f in glob.glob(os.path.join(out, "versions", "*", "family=*", "bucket=*", "*.parquet")):
        keys = [(r["rowkey"], r["qualifier"]) for r in pq.ParquetFile(f).read(["rowkey", "qualifier"]).to_pylist()]
        family, bucket = (x.split("=")[1] for x in f.split("/")[-3:-1])
        w = want.setdefault((family, int(bucket)), [0, [], 0])
        w[0] += len(keys)
        w[1] += [k for k, _ in keys if k is not None]
        w[2] += sum((b[0] or "", b[1]) <= (a[0] or "", a[1]) for a, b in zip(keys, keys[1:]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        report = order_report(spark, out)
        got = {(r.family, r.bucket): (r.n_cells, r.first_key, r.last_key, r.out_of_order, r.codec) for r in report.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {k: (n, min(keys, default=None), max(keys, default=None), falls, "snappy") for k, (n, keys, falls) in want.items()}
    assert sum(r[3] for r in got.values()) > 0
    assert "Join" not in report._jdf.queryExecution().executedPlan().toString()


def test_partitions_are_key_ranges_in_cell_order(spark):
    c = cells(users(spark, 500), 5, FAM, per_bucket=3).withColumn("part", F.spark_partition_id())
    rows = c.collect()
    assert len({r.part for r in rows}) == 15
    keys = [tuple(x.encode() for x in (r.rowkey, r.family, r.qualifier)) for r in rows]
    assert keys == sorted(keys)  # ranges ascend with the partition's number, cells within


def test_given_splits(spark):
    splits = ["20000000_x", "20000000_y", "9abcdef0_"]
    df = users(spark, 400)
    rows = cells(df, 99, FAM, splits=splits, per_bucket=2).collect()
    assert all(r.bucket == sum(r.rowkey >= s for s in splits) for r in rows) and len(rows) == 1600
    keys = [r.rowkey.encode() for r in rows]
    assert keys == sorted(keys)
    for bad in (["b0000000", "a0000000"], ["a0000000", "a0000000"], ["xyz"]):
        with pytest.raises(ValueError):
            cells(df, 1, FAM, splits=bad)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=PREFIX_SPACE - 1), min_size=1, max_size=30),
       st.integers(min_value=1, max_value=20), st.integers(min_value=1, max_value=9))
def test_ranges_ascend_and_refine_the_buckets(spark, prefixes, n, per):
    df = spark.createDataFrame([(f"{p:08x}_x",) for p in sorted(prefixes)], "rowkey string")
    key = F.col("rowkey")
    got = df.select(bucket_of(key, n).alias("b"), range_of(key, n, per).alias("r")).collect()
    assert all(x.r // per == x.b and 0 <= x.r < n * per for x in got)
    assert [x.r for x in got] == sorted(x.r for x in got)


@pytest.mark.parametrize("bound", [64 << 20, 0])
def test_tenant_lists_are_attached_after_the_exchange(spark, monkeypatch, bound):
    """By broadcast, and beyond the bound by key range: the cells are those of rows that hold the texts."""
    from buyerlens.operators import cells as module

    monkeypatch.setattr(module, "LISTS_BROADCAST_BYTES", bound)
    long_ = "x" * 5000
    texts = {"0": long_, "1": "", "2": None}
    rows = [(f"u{i}", str(i % 4), i % 3 == 0, "own" if i % 3 == 0 else None) for i in range(120)]
    rows += [("u1", "1", True, None), ("u4", "0", True, "own")]  # buyers of both kinds
    schema = "user_id string, merchant_num string, is_member int, note string"
    apart = keyed(spark.createDataFrame([(u, m, int(k), t) for u, m, k, t in rows], schema)).withColumn(
        "_tenant", F.when(F.col("is_member") == 0, F.col("merchant_num")))
    whole = keyed(spark.createDataFrame([(u, m, int(k), t if k else texts.get(m)) for u, m, k, t in rows], schema))
    lists = spark.createDataFrame(list(texts.items()), "_tenant string, note string")
    got, want = (sorted(tuple(r) for r in c.collect()) for c in (cells(apart, 4, FAM, tenant_lists=lists), cells(whole, 4, FAM)))
    assert got == want and any(r[3] == long_ for r in got) and any(r[2] == "note" and r[3] == "" for r in got)
