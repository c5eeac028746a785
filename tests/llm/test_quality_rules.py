"""Risk-controlled rules: signals, binomial bounds, cutoffs and the whole query against its SQL."""

import re
from collections import Counter
from fractions import Fraction
from math import comb

import numpy as np
import pytest
from conftest import SF_MID, SF_SMALL, register
from helpers import assert_same_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from buyerlens.llm import quality_rules as qr
from buyerlens.llm.catalog import ORACLES, QUERIES

DOCS = "doc_id long, text string, lang string, stratum string, kept string, __symbols long, good int"


def brute_signals(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab#|é \t\n\x0b\x1c ", max_size=80))
def test_signals_equal_definition(text):
    assert qr.signals_of(text) == brute_signals(text)


def test_tail_is_the_exact_binomial():
    for n in (1, 7, 60, 300):
        for k in (0, 1, n // 10, n // 3):
            rate = Fraction(1, 50)
            exact = sum(comb(n, i) * rate**i * (1 - rate)**(n - i) for i in range(k + 1))
            assert qr.tail(k, n, 0.02) == pytest.approx(float(exact), rel=1e-9)
    assert qr.tail(0, 0, 0.02) == 1.0 and qr.tail(3, 500_000, 0.0) == 1.0


def test_choose_stops_at_the_first_failure():
    good_poor = np.array([(0, 0), (1, 5), (2, 5), (90, 50), (1, 99)])
    assert qr.choose(good_poor, 5000, 0.004, 0.01) == 1  # a later cutoff of a failed one is not tried, of equal ones the first
    assert qr.choose(good_poor, 100, 0.004, 0.01) is None  # too few rows certify nothing
    assert qr.choose(np.zeros((3, 2)), 5000, 0.004, 0.01) is None  # no use, no cutoff


def test_false_rejections_stay_within_the_rate():
    """Draws of holdouts whose cutoffs have true rates 0.1 %, 0.9 %, 1.1 % and 5 %: at most ``level`` of them pass 1 %."""
    rng = np.random.default_rng(3)
    rates = np.array([0.001, 0.009, 0.011, 0.05])
    draws = 1500
    above = sum((qr.choose(np.stack([np.maximum.accumulate(rng.binomial(3000, rates)), [1, 2, 3, 4]], 1), 3000, 0.01, 0.05) or 0) > 1
                for _ in range(draws))
    assert above <= draws * 0.05 + 3 * (draws * 0.05 * 0.95) ** 0.5


def texts(n, junk_every):
    rng = np.random.default_rng(1)
    words = [f"wo{i}rd" for i in range(500)]
    for i in range(n):
        w = list(rng.choice(words, 70))
        yield i, " ".join(x + "###" if junk_every and i % junk_every == 0 else x for x in w), i % junk_every != 0 if junk_every else True


def test_junk_goes_where_labels_certify_it_and_nothing_else(spark):
    rows = [(i, t, "en", ok) for i, t, ok in texts(3000, 10)] + [(10_000 + i, t, "xx", ok) for i, t, ok in texts(60, 10)]
    docs = spark.createDataFrame([(i, t, lang, "s", "k", 1, 0) for i, t, lang, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, int(ok), 5) for i, _, _, ok in rows], "doc_id long, quality int, n_words int")
    got = {r.doc_id: r for r in qr.filtered(docs, labels).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept == ok for i, _, lang, ok in rows if lang == "en")
    assert all(got[i].kept for i, _, lang, _ in rows if lang == "xx")  # too few labels: only the base rejects
    # Beyond the bound of the broadcast the same by the salted join.
    small = qr.RiskParams(broadcast_rows=0, salts=3)
    assert {r.doc_id: r for r in qr.filtered(docs, labels, small).collect()} == got


def test_odd_rows(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None, "en"), (2, "", None), (None, words, "en"), (3, words, "en"), (3, words, "en"), (4, words + " " + words, None),
            (5, " \t\n\x0b ", "de"), (6, "x" * 300_000, "de"), (7, "r e p " * 60_000, "de")]
    docs = spark.createDataFrame([(*r, "s", "k", 1, 0) for r in rows], DOCS)
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (4, 0, 1), (4, 1, 1), (None, 1, 0), (6, None, 1), (99, 1, 1)],
                                   "doc_id long, quality int, n_words int")
    got = sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in qr.filtered(docs, labels).collect())
    assert got == [(0, 60, False, True), (1, 0, True, False), (2, 0, True, False), (3, 60, False, True), (3, 60, False, True),
                   (4, 120, True, False), (5, 0, True, False), (6, 1, True, False), (7, 180_000, True, False)]
    assert qr.filtered(docs.limit(0), labels).count() == 0
    assert qr.filtered(docs, labels.limit(0)).where("kept").count() == 3


def test_equals_sql(spark, duck):
    for sf in (SF_SMALL, SF_MID):
        register(duck, sf)
        assert_same_rows(QUERIES["op11_risk_rules"](spark, sf), duck.sql(ORACLES["op11_risk_rules"]))


def test_certified_cutoffs_equal_sql(spark, duck):
    """Enough labels for the method to reject, in SQL too."""
    rows = [(i, t, lang, int(ok)) for k, lang in enumerate(("en", "de")) for i, t, ok in
            ((i + 5000 * k, t, ok) for i, t, ok in texts(2600, 7))]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, quality int")
    duck.register("d_", docs.toPandas())
    duck.register("l_", labels.toPandas())
    duck.sql("create or replace view documents as select * from d_")
    duck.sql("create or replace view labels as select * from l_")
    got = qr.filtered(docs, labels)
    assert got.where(~F.col("kept")).count() == sum(1 - r[3] for r in rows)
    assert_same_rows(got, duck.sql(qr.oracle()))
