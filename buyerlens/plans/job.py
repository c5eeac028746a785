"""The daily job: inputs -> labelled profile -> stored cells.

Usage (tables by catalog name, or parquet paths when the value has a '/')::

    python -m buyerlens.plans.job --as-of 2024-01-30 --out /shared/cells \\
        --table member_base_info_day=db.members \\
        --table user_orders=db.orders \\
        --table hd_join_log=db.activity \\
        --table right_change_log=db.points \\
        --table city_level=db.cities

Stages and their shuffles:

1. three aggregates (buyer facts, activity, points), written to the
   checkpoint folder (restart point after executor loss);
2. profile: member rows meet the buyer facts, then activity and points;
   non-member rows meet the ``member_id = 0`` figures by a size-checked
   broadcast, or beyond the bound by a salted join;
3. cells: one shuffle by computed key range, a sort of whole rows by key, then
   unpivot and a write of sorted files per family and bucket, as a new version.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.operators.cells import cells
from buyerlens.operators.profile import Rules, sink_profile
from buyerlens.schema import DEFAULT_FAMILIES
from buyerlens.params import ProfileParams
from buyerlens.session import configure
from buyerlens.sources.cellstore import write_cells
from buyerlens.sources.tables import scan_inputs

INPUT_NAMES = ("member_base_info_day", "user_orders", "hd_join_log", "right_change_log", "city_level")


def read_table(spark: SparkSession, ref: str) -> DataFrame:
    """A catalog table by name, or a parquet dataset when ``ref`` is a path."""
    return spark.read.parquet(ref) if "/" in ref else spark.table(ref)


def build_cells(raw: Mapping[str, DataFrame], params: ProfileParams, families: Mapping[str, str] | None = None,
                rules: Rules = Rules(), splits: Sequence[str] | None = None) -> DataFrame:
    """The cell DataFrame of one run (lazy except for the aggregate tables)."""
    inputs = scan_inputs(dict(raw), params)
    profile, lists = sink_profile(inputs, params, rules=rules)
    return cells(profile, params.n_buckets, families, splits=splits, tenant_lists=lists)


def run_job(spark: SparkSession, raw: Mapping[str, DataFrame], params: ProfileParams, out_path: str,
            families: Mapping[str, str] | None = None, compression: str = "snappy", rules: Rules = Rules(),
            splits: Sequence[str] | None = None) -> int:
    """Build the cells of one day and store them as the next version of ``out_path``; a run that fails leaves the
    former one. ``rules``, ``families`` and ``splits`` are the user's own labels, rowkey, column families and
    region boundaries."""
    configure(spark)
    return write_cells(build_cells(raw, params, families, rules, splits), out_path, compression)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--as-of", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--table", action="append", default=[], help="name=table-or-path")
    ap.add_argument("--tenant", action="append", default=None)
    ap.add_argument("--order-days", type=int, default=360)
    ap.add_argument("--activity-days", type=int, default=90)
    ap.add_argument("--buckets", type=int, default=15)
    ap.add_argument("--family", action="append", default=[], help="column=family, where it is not the default")
    ap.add_argument("--buy-charact", help="SQL expression of the label, over the joined profile")
    ap.add_argument("--buy-subdivision", help="SQL expression of the label")
    ap.add_argument("--rowkey", help="SQL expression; it starts with eight hex digits")
    ap.add_argument("--split", action="append", help="region boundary (a rowkey); repeated, ascending, instead of --buckets")
    ap.add_argument("--checkpoint-dir", help="shared folder, unless spark.checkpoint.dir names one")
    args = ap.parse_args(argv)
    refs = dict(t.split("=", 1) for t in args.table)
    missing = [n for n in INPUT_NAMES if n not in refs]
    if missing:
        ap.error(f"missing --table for {missing}")
    spark = configure(SparkSession.builder.getOrCreate())
    params = ProfileParams(as_of=args.as_of, order_days=args.order_days, activity_days=args.activity_days,
                           tenants=tuple(args.tenant) if args.tenant else None, n_buckets=args.buckets)
    if args.checkpoint_dir:
        spark.sparkContext.setCheckpointDir(args.checkpoint_dir)
    rules = Rules(*[F.expr(x) if x else None for x in (args.buy_charact, args.buy_subdivision, args.rowkey)])
    families = {**DEFAULT_FAMILIES, **dict(f.split("=", 1) for f in args.family)}
    run_job(spark, {n: read_table(spark, refs[n]) for n in INPUT_NAMES}, params, args.out, families, rules=rules,
            splits=args.split)


if __name__ == "__main__":
    main()
