"""The filter audit against its SQL and a walk through every order, row by row."""

import re
from collections import Counter
from itertools import permutations

from conftest import SF_SMALL, register
from helpers import assert_same_rows
from pyspark.sql import functions as F

from buyerlens.llm import filter_audit
from buyerlens.llm.catalog import ORACLES, QUERIES

DOCS = "doc_id long, text string, lang string, key string, filter string, n long, part string"


def fails(rows):
    """The letters each row fails, from the definitions."""
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = "A" if len(words) < 200 else ""
        bad += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        bad += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
        bad += "D" if re.search(r"[#$%&*|]", text) else ""
        bad += "E" if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows) else ""
        out.append(bad)
    return out


def walked(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    bad = fails(rows)
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [k for k, r in enumerate(rows) if (r[2] or "") == part]
        unique = Counter(bad[k] for k in mine)
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            alive = set(mine)
            for step, f in enumerate(order, 1):
                gone = {k for k in alive if f in bad[k]}
                redundant = sum(f in bad[k] for k in mine) - len(gone)
                alive -= gone
                shapley[f] += len(gone)
                out[part, order, step] = [len(alive), len(gone), redundant, unique[f],
                                          sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def audit(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, "k", "f", 7, "p") for i, t, p in rows], DOCS)
    marks = spark.createDataFrame([(*m, 1) for m in labels], "doc_id long, quality int, toxic int, n int")
    return {(r.part, r.filter_order, r.step): list(r)[3:] for r in filter_audit.audit(docs, marks).collect()}


def test_every_order_on_odd_rows(spark):
    long_ = " ".join(f"w{i}" for i in range(400))
    rows = [(1, long_, "en"), (2, long_, "de"), (3, long_, "en"), (3, long_, "en"), (4, "", "en"), (5, None, None), (6, "", ""),
            (None, long_, "en"), (None, None, "en"), (7, "a b " * 300, "en"), (8, "UP " * 300, "en"), (9, long_ + " $5", "fr"),
            (9, "x\x1cy z " + "q\x0br " * 150, "fr"), (10, " \t\n", None), (11, "W" * 50_000 + " |" * 4000, "de"), (2, "b" * 9, "en")]
    labels = [(1, 1, 0), (3, 1, 1), (3, 0, None), (9, 1, 0), (9, 1, 1), (7, 0, 1), (None, 1, 1), (99, 1, 1), (8, None, None), (4, 1, 0)]
    assert audit(spark, rows, labels) == walked(rows, [m for m in labels if m[0] is not None])


def test_a_text_that_most_rows_hold(spark):
    rows = [(i, "same text", "en") for i in range(300)] + [(i, f"own {i}", "en") for i in range(300, 330)]
    got = audit(spark, rows, [(0, 1, 0), (5, 1, 0)])
    assert got == walked(rows, [(0, 1, 0), (5, 1, 0)])
    assert got["en", "EABCD", 1][:2] == [31, 299]


def test_empty_table(spark):
    assert audit(spark, [], []) == {}


def test_equals_sql(spark, duck):
    register(duck, SF_SMALL)
    got = QUERIES["op13_filter_audit"](spark, SF_SMALL)
    assert_same_rows(got, duck.sql(ORACLES["op13_filter_audit"]))
    assert got.where(F.col("step") == 5).groupBy("part").agg(F.countDistinct("kept").alias("k")).where("k > 1").count() == 0
