"""The daily job end to end through its command line."""

import tempfile

from buyerlens.plans.catalog import QUERIES
from buyerlens.plans.job import INPUT_NAMES, main
from buyerlens.sources.fixtures import fixture_inputs
from buyerlens.sources.cellstore import read_cells
from conftest import SF_SMALL


def test_job_cli_writes_the_cells(spark):
    scratch = tempfile.mkdtemp(prefix="job-test-")
    args = ["--as-of", "2024-01-30", "--activity-days", "10", "--out", f"{scratch}/cells"]
    for name, df in fixture_inputs(spark, SF_SMALL).items():
        df.write.parquet(f"{scratch}/in/{name}")
        args += ["--table", f"{name}={scratch}/in/{name}"]
    assert {a.split("=")[0] for a in args if "=" in a} >= set(INPUT_NAMES)
    main(args)
    written = read_cells(spark, f"{scratch}/cells")
    expected = QUERIES["cells"](spark, SF_SMALL)
    cols = ["rowkey", "family", "qualifier", "value", "bucket"]
    assert written.select(*cols).exceptAll(expected.select(*cols)).count() == 0
    assert expected.select(*cols).exceptAll(written.select(*cols)).count() == 0


def test_job_cli_tenant_scope(spark):
    scratch = tempfile.mkdtemp(prefix="job-test-")
    args = ["--as-of", "2024-01-30", "--activity-days", "10", "--out", f"{scratch}/cells",
            "--tenant", "2"]
    for name, df in fixture_inputs(spark, SF_SMALL).items():
        df.write.parquet(f"{scratch}/in/{name}")
        args += ["--table", f"{name}={scratch}/in/{name}"]
    main(args)
    merchants = {r.value for r in read_cells(spark, f"{scratch}/cells").where("qualifier = 'merchant_num'")
                 .select("value").distinct().collect()}
    assert merchants == {"2"}


def test_job_cli_takes_own_rules_rowkey_and_families(spark):
    scratch = tempfile.mkdtemp(prefix="job-test-")
    args = ["--as-of", "2024-01-30", "--activity-days", "10", "--out", f"{scratch}/cells", "--buy-charact", "cast(7 as int)",
            "--buy-subdivision", "cast(member_id % 2 as int)", "--family", "nick=names",
            "--rowkey", "concat(substring(md5(user_id), 1, 8), '|', merchant_num, '|', user_id)"]
    for name, df in fixture_inputs(spark, SF_SMALL).items():
        df.write.parquet(f"{scratch}/in/{name}")
        args += ["--table", f"{name}={scratch}/in/{name}"]
    main(args)
    written = read_cells(spark, f"{scratch}/cells")
    assert {r.value for r in written.where("qualifier = 'buy_charact'").collect()} == {"7"}
    assert {r.value for r in written.where("qualifier = 'buy_subdivision'").collect()} == {"0", "1"}
    assert {r.family for r in written.where("qualifier = 'nick'").collect()} == {"names"}
    assert written.where("rowkey not rlike '^[0-9a-f]{8}[|]'").count() == 0
