"""Order-insensitive comparison of query results."""

from __future__ import annotations

import decimal


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def assert_same_rows(spark_df, duck_rel):
    scols = spark_df.columns
    dcols = duck_rel.columns
    assert sorted(scols) == sorted(dcols), (set(scols) ^ set(dcols))
    s = canon([tuple(r) for r in spark_df.collect()], scols)
    d = canon(duck_rel.fetchall(), dcols)
    assert len(s) == len(d), (len(s), len(d))
    assert s == d


def assert_df_equal(a, b):
    """Same multiset of rows (``exceptAll`` both ways is empty)."""
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0
