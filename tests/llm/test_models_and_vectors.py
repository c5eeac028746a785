"""Classifiers by held-out accuracy; pages by cases; vectors by brute force; the pipeline by its stages."""

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from buyerlens.llm import flatgraph, pages, quality, toxicity, training, vptree
from buyerlens.llm.catalog import QUERIES

SF, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- classifiers -----------------------------------------------------------

def auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    return (s[y == 1][:, None] > s[y == 0][None, :]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0][None, :]).mean()


def held_out_rows(spark, query, target):
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    rows = QUERIES[query](spark, MID)
    assert rows.count() == spark.read.parquet(f"{MID}/documents.parquet").count()
    got = rows.join(labels, "doc_id").where("held_out").select("doc_id", "score", "predicted", target).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in got)
    return [r[target] for r in got], [r.score for r in got], [r.predicted for r in got]


def test_quality_on_held_out_rows(spark):
    y, s, predicted = held_out_rows(spark, "op5_quality_gam", "quality")
    assert auc(y, s) > 0.97 and np.mean(np.array(y) == predicted) > 0.95
    assert all(p == (x >= 0.5) for p, x in zip(predicted, s))


def test_quality_model_uses_pairs_and_edge_texts():
    rng = np.random.default_rng(2)
    x = rng.random((3000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(int)  # only a pair tells
    m = quality.fit(x, y)
    assert (0, 1) in m.pairs and auc(y, m.scores(x)) > 0.9
    one = quality.fit(x[:5], np.ones(5, int))
    assert (one.scores(x) > 0.5).all() and (quality.fit(x[:0], y[:0]).scores(x) == 0.5).all()
    f = quality.feature_matrix([None, "", " ", "\n", "a", "é" * 100_000, float("nan")])
    assert f.shape == (7, len(quality.FEATURES)) and np.isfinite(f).all()


def test_toxicity_learns_stems_and_whole_texts():
    rng = np.random.default_rng(3)
    syll = "ba be bi bo bu da de di do du ka ke ki ko ku".split()
    word = lambda: "".join(rng.choice(syll, 3))
    texts, y = [], []
    for i in range(900):
        words = [word() for _ in range(80)]
        if i % 4 == 0:
            for at in rng.integers(0, 80, 3):
                words[at] = "vexor" + word()
        texts.append(" ".join(words))
        y.append(int(i % 4 == 0))
    m = toxicity.fit(texts[:600], np.array(y[:600]), ["en"] * 600, toxicity.ToxicityParams(buckets=1 << 14, epochs=6))
    s = toxicity.Scorer(m).scores(texts[600:])
    assert np.mean((s >= 0.7) == np.array(y[600:])) > 0.97 and 0 < m.thresholds["en"] < 1
    clean = " ".join(word() for _ in range(120_000))
    far = toxicity.Scorer(m).scores([clean, clean + " vexorbada vexorkuku", "", " "])
    assert far[1] >= far[0] and far[1] >= 0.7 and far[2] < 0.7 and far[2] == far[3]
    many = toxicity.Scorer(m)
    many.CACHE = 50
    assert np.allclose(many.scores(texts[600:650]), s[:50])


def test_toxicity_scores_every_row(spark):
    y, s, predicted = held_out_rows(spark, "op6_toxicity_cnn", "toxic")
    assert all(0 <= x <= 1 for x in s) and all(p == (x >= 0.7) for p, x in zip(predicted, s))
    assert auc(y, s) > 0.6


def test_classifiers_take_empty_tables_and_odd_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "en"), (None, None, None), (1, "a b", "en"), (2, "", "x")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, None), (None, 1, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    for op, label in ((quality, "quality"), (toxicity, "toxic")):
        model = op.train(docs, labels.where("false"), label_col=label)
        assert op.with_score(docs, model).where("score between 0 and 1").count() == 4
        model = op.train(docs, labels, label_col=label)
        assert op.with_score(docs.limit(0), model).count() == 0
    assert training.labelled_sample(docs, labels, "quality", 10).count() == 0  # the only id has both marks


def test_long_texts_alone_are_learned_and_kept_whole(spark):
    """Labelled texts of thousands of words: none is left out, marks anywhere in them count."""
    rng = np.random.default_rng(4)
    words = [f"wo{i}rd" for i in range(800)]

    def text(toxic):
        w = list(rng.choice(words, 4000))
        for at in rng.integers(0, 4000, 3) if toxic else []:
            w[at] = "vexorbad"
        return " ".join(w)

    rows = [(i, text(i % 4 == 0), "en", int(i % 4 == 0)) for i in range(240)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    p = toxicity.ToxicityParams(buckets=1 << 14, epochs=20, max_words=600_000)
    model = toxicity.train(docs, labels, p)
    got = {r.doc_id: r.score >= p.threshold for r in toxicity.with_score(docs, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert np.mean([got[r[0]] == bool(r[3]) for r in held]) > 0.9


def test_sample_is_bounded_by_words_and_repeats(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b c " * 10, "en") for i in range(60)] + [(3, "zz", "en"), (3, "aa", "de"), (None, "n", "en")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "_fit", lambda seqs, feats, y, langs, p: seen.append((sum(map(len, seqs)), len(y))))
    toxicity.train(docs, labels, toxicity.ToxicityParams(max_train=30, max_words=100))
    (words, n), = seen
    assert 100 <= words < 100 + 31 and n == 4  # the last text counts whole
    # Labels of absent documents use up nothing; an id on several rows counts once, with its smallest text.
    rows = training.labelled_sample(docs, labels, "toxic", 1000).collect()
    assert len(rows) == len({r["__id"] for r in rows}) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(60))
    assert [r.text for r in rows if r["__id"] == 3] in ([], ["a b c " * 10])


def test_all_labelled_rows_are_learned(spark):
    """What makes a text toxic stands only in rows beyond the first 8,000 labelled ones (by the hash of their ids)."""
    ids = spark.range(13_500).where(~training.held_out("id")).orderBy(F.xxhash64("id")).select("id").collect()
    late = {r.id for r in ids[8_000:]}
    held = {r.id for r in spark.range(13_500).where(training.held_out("id")).collect()}
    rng = np.random.default_rng(5)
    words = [f"wo{i}rd" for i in range(300)]

    def text(i):
        w = list(rng.choice(words, 12))
        if (i in late or i in held) and i % 2:
            w[i % 12] = "vexorbad"
        return " ".join(w)

    rows = [(i, text(i), "en") for i in range(13_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, int("vexor" in t)) for i, t, _ in rows], "doc_id long, toxic int")
    p = toxicity.ToxicityParams(buckets=1 << 14)
    model = toxicity.train(docs, labels, p)
    got = toxicity.with_score(docs.where(training.held_out()), model).collect()
    assert len(got) == len(held) and np.mean([(r.score >= p.threshold) == ("vexor" in r.text) for r in got]) > 0.97
    assert 0 < model.thresholds["en"] < 1


def test_units_hold_every_labelled_row_once(spark):
    docs = spark.createDataFrame([(i, f"Word{'x' * i} b\nc", "en") for i in range(90)] + [(4, "aa", "de"), (5, None, None), (None, "x", "en")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(6, 1), (7, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity._unit_table(docs, labels, toxicity.ToxicityParams(), "doc_id", "toxic", ("lang",), 3).collect()
    want = {i for i in range(90) if zlib.crc32(str(i).encode()) % 3 != 1 and i != 6}
    got = sorted(zlib.decompress(r.words).decode() for r in rows)
    assert len(got) == len(want) and {r.unit for r in rows} == {0, 1, 2}
    assert set(got) - {"", "aa"} <= {f"word{'x' * i} b c" for i in want} and len(set(got)) == len(got)
    assert all(r.target == (len(zlib.decompress(r.words)) - 8) % 2 for r in rows if r.words and zlib.decompress(r.words) not in (b"", b"aa"))


def test_halves_together_score_their_mean():
    p = toxicity.ToxicityParams(buckets=1 << 10)
    texts = ["one two three four", "five", "", "six one two seven eight nine"]
    halves = [toxicity._fresh(toxicity.ToxicityParams(buckets=1 << 10, seed=k)) for k in (1, 2)]
    halves[0].out_bias = 0.5
    logit = lambda m: np.log(s := toxicity.Scorer(m).scores(texts)) - np.log1p(-s)
    assert np.allclose(logit(toxicity._together(halves)), (logit(halves[0]) + logit(halves[1])) / 2, atol=1e-5) and p.dim == 8


def test_language_decisions(spark):
    m = toxicity._fresh(toxicity.ToxicityParams(buckets=64))
    m.thresholds = {"de": 0.2}
    scored = spark.createDataFrame([(1, "de", 0.3), (2, "en", 0.3), (3, None, 0.9), (4, "de", 0.1)], "doc_id long, lang string, score double")
    got = {r.doc_id: (r.lang_threshold, r.lang_predicted) for r in toxicity.with_language_decision(scored, m).collect()}
    assert got == {1: (0.2, 1), 2: (0.7, 0), 3: (0.7, 1), 4: (0.2, 0)}
    m.thresholds = {}
    assert {r.lang_threshold for r in toxicity.with_language_decision(scored, m).collect()} == {0.7}


# --- pages -----------------------------------------------------------------

MARKUP = [
    ('<nav>menu</nav><article><header><h1>T &amp; t</h1></header><p>a  b<br>c<p>d<section class="comments"><p>bad</section><p>e</article><footer>f',
     "T & t\na b c\nd\ne"),
    ('<main><div class="sidebar-left">x</div><p>one &lt;b&gt; <b>two</b>three</p><form><p>mail?</p></form></main>', "one <b> twothree"),
    ('<article>x<script>if (a<b) "</p>"</script>y<!-- <p>no</p> -->z<style>p{}</style></article>', "xyz"),
    ('<article><p>kept</p><div id="cookieNotice">we</div><ul><li>l1<li>l2</ul></article><p>outside</p>', "kept\nl1\nl2"),
    ("<article><p>cut off &am", "cut off &am"), ("<article><p>tag <b", "tag"), (None, ""), ("", ""),
    ("<p hidden>no</p><p>yes</p>", "yes"), ("plain", "plain")]


def test_blocks_by_markup(spark):
    df = spark.createDataFrame([(i, f"http://h{i}.example/x", h, "c", 1) for i, (h, _) in enumerate(MARKUP)],
                               "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: (r.text, r.n_chars) for r in pages.main_text(df).collect()}
    assert got == {i: (t, len(t)) for i, (_, t) in enumerate(MARKUP)}
    assert pages.main_text(df.limit(0)).count() == 0


SIGNED = [
    ('<div class="content-sidebar-wrap"><p>menu</p><article><p>body</p></article></div>', "body"),
    ('<div class="has-sidebar"><main><p>body</p><div class="share">no</div></main><div id="comments"><article>nor</article></div></div>', "body"),
    ('<article class="post comment-open"><p>body</p></article>', "body"),
    ('<article><h2 id="discussion">Talk</h2><p>a</p><section id="search">b</section><h3 id="related-work">Work</h3><div class="related">no</div></article>',
     "Talk\na\nb\nWork"),
    ('<article>body</article><div class="comments"><article class="comment">no</article></div>', "body"),
    ('<div><p>body</p></div><div class="related"><article>next</article></div>', "body\nnext"),
    ('<nav class="x"><article>no</article></nav><p>body</p>', "body")]


def test_names_of_wrappers_and_headings_lose_no_article():
    assert ["\n".join(pages.blocks(h)[0]) for h, _ in SIGNED] == [t for _, t in SIGNED]


def test_runs_of_a_host_go_and_copies_stay(spark):
    menu = "home news sport weather travel jobs cars homes about contact"
    rows = [(i, "https://a.example/%d" % i, f"<div>{menu}</div><p>story number {i} tells of {i * 7} things</p><p>{menu} last{i}</p>") for i in range(600)]
    rows += [(1000, "https://b.example/", f"<div>{menu}</div>"), (1001, None, "<p>x</p>"), (None, None, "<p>y</p>")]
    rows += [(2000 + i, "https://c.example/same", "<p>one two three four five six seven eight nine</p>") for i in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.main_text(df, pages.PageParams(shard_pages=50)).collect()}
    assert all(got[i] == f"story number {i} tells of {i * 7} things\nlast{i}" for i in range(600))
    assert got[1000] == menu and got[1001] == "x" and got[None] == "y"
    assert got[2000] == got[2001] == "one two three four five six seven eight nine"


def story(i, n=30):
    return " ".join(f"w{i}x{j}" for j in range(n))


@pytest.mark.parametrize("shard_pages", [16, 256])
def test_short_blocks_and_rare_runs_go_from_open_pages(spark, shard_pages):
    rows = [(i, "http://a.example/%d" % i, "<ul><li>home<li>world news<li>sport</ul><p>Share this</p>"
             + ("<p>this section is made by the readers of the town</p>" if i < 4 else "") + f"<p>{story(i)}</p>") for i in range(60)]
    rows += [(100, "http://a.example/x", "<ul><li>home<li>world news<li>sport</ul><p>Share this</p>")]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"),
                                                      pages.PageParams(shard_pages=shard_pages)).collect()}
    assert got == {**{i: story(i) for i in range(60)}, 100: ""}


@pytest.mark.parametrize("shard_pages", [16, 256])
def test_boilerplate_within_articles_goes_and_copies_stay(spark, shard_pages):
    note = "<p>Share this</p><div>This story may be read by all members of the house</div>"
    rows = [(i, "http://a.example/%d" % i, f"<article><h2>Part one</h2><p>{story(i)}</p>{note}</article>") for i in range(40)]
    copy = [story(1000, 60).replace(f"x{7 + 3 * k} ", f"y{k} ") for k in range(12)]  # near copies of one another
    rows += [(100 + k, "http://a.example/c%d" % k, f"<article><p>{c}</p>{note}</article>") for k, c in enumerate(copy)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"),
                                                      pages.PageParams(shard_pages=shard_pages)).collect()}
    assert got == {**{i: f"Part one\n{story(i)}\nShare this" for i in range(40)}, **{100 + k: f"{c}\nShare this" for k, c in enumerate(copy)}}


@pytest.mark.parametrize("shard_pages", [1, 2, 5, 256])
def test_notices_go_from_copies_whatever_shard_holds_them(spark, shard_pages):
    note = "<div>This story may be read by all members of the house</div>"
    rows = [(i, "http://a.example/%d" % i, f"<article><p>{story(i)}</p>{note}</article>") for i in range(20)]
    rows += [(100 + k, "http://a.example/c%d" % k, f"<article><p>{story(1000)}</p>{note}</article>") for k in range(30)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"),
                                                      pages.PageParams(shard_pages=shard_pages)).collect()}
    assert got == {**{i: story(i) for i in range(20)}, **{100 + k: story(1000) for k in range(30)}}


@pytest.mark.parametrize("shard_pages", [2, 256])
def test_articles_keep_what_they_share_but_notices_at_their_ends(spark, shard_pages):
    quote = "To be or not to be that is the question whether it is nobler"
    note = "All stories of this paper may be read by its members for free"
    rows = [(i, "http://a.example/%d" % i, f"<article><h1>Soup</h1><p>{note} today</p><p>{story(i)}</p><ul><li>Salt<li>Two eggs</ul><p>{quote}</p>"
             f"<p>{story(i + 50)}</p><p>Serve hot.</p><div>{note}</div></article>") for i in range(3)]
    rows += [(10 + i, "http://b.example/%d" % i, f"<article><p>{story(i)}</p><p>{note}</p></article>") for i in range(2)]
    rows += [(20 + i, "http://c.example/%d" % i, "<p>No.</p>" + f"<p>{story(200 + i)}</p>") for i in range(1)]
    rows += [(30, "http://d.example/", f"<article><p>{story(1)}</p><p>{note}</p></article>")]  # a host's only page
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.main_text(df, pages.PageParams(shard_pages=shard_pages)).collect()}
    assert got == {**{i: f"Soup\n{story(i)}\nSalt\nTwo eggs\n{quote}\n{story(i + 50)}\nServe hot." for i in range(3)},
                   **{10 + i: story(i) for i in range(2)}, 20: f"No.\n{story(200)}", 30: f"{story(1)}\n{note}"}


def shuffled_bytes(plan):
    """What the exchanges of a plan that has run have written."""
    name, total = plan.getClass().getSimpleName(), 0
    if name == "AdaptiveSparkPlanExec":
        return shuffled_bytes(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return shuffled_bytes(plan.plan())
    if name == "ShuffleExchangeExec":
        total = plan.metrics().apply("shuffleBytesWritten").value()
    children = plan.children()
    return total + sum(shuffled_bytes(children.apply(i)) for i in range(children.size()))


def test_shards_exchange_less_than_whole_hashes_of_runs(spark):
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1000, (400, 400))
    note = "this paper may be read by all of the members of the house"
    rows = [(i, "http://a.example/%d" % i, f"<article><p>{' '.join(map(str, w))}</p><p>{note}</p></article>") for i, w in enumerate(words.tolist())]
    got = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), pages.PageParams(shard_pages=25))
    assert {r.page_id: r.text for r in got.collect()} == {i: " ".join(map(str, w)) for i, w in enumerate(words.tolist())}
    text = sum(len(zlib.compress(" ".join(map(str, w)).encode(), 1)) for w in words.tolist())
    assert text < shuffled_bytes(got._jdf.queryExecution().executedPlan()) < text + 4 * words.size


def test_words_of_any_length_and_place_keep_their_hashes_apart():
    texts = ["a" * k for k in range(1, 200)] + ["ab", "ba", "é", "e\u0301", "x" * 64 + "a" * 64 + "b" * 64, "x" * 64 + "b" * 64 + "a" * 64]
    shard = pages.Shard([" ".join(texts).encode(), b"", " ".join(reversed(texts)).encode()], [b"\1\0", b"\0", b"\0\0"], 8)
    assert shard.real.sum() == 2 * len(texts) and len(np.unique(shard.word[shard.real])) == len(texts)
    assert (shard.word[:len(texts)] == shard.word[-2:-2 - len(texts):-1]).all()
    assert shard.texts(np.zeros(0, np.int64)) == [" ".join(texts), "", " ".join(reversed(texts))]


def test_ranks_order_suffixes():
    rng = np.random.default_rng(0)
    t = rng.integers(0, 3, 200)
    rank = pages.run_ranks(t, 8)
    keys = [tuple(t[i:i + 8]) for i in range(200)]
    want = {k: i for i, k in enumerate(sorted(set(keys)))}
    assert [want[k] for k in keys] == rank.tolist()


def test_every_page_comes_out(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    got = QUERIES["op3_html_text"](spark, SF)
    assert got.count() == df.count() and got.where("n_chars != char_length(text) or text is null").count() == 0
    r = got.join(df.select("page_id", "html"), "page_id").where(F.col("html").contains("<article>")).first()
    assert "<" not in r.text.split("\n")[0] and r.text.split("\n")[0] in r.html.replace("&amp;", "&").replace("&quot;", '"')


# --- vectors ---------------------------------------------------------------

def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<float>, label int, score double")


def cloud(seed, n=700, dim=12):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[100:300] = x[0] + 0.02 * rng.normal(size=(200, dim))  # a hot group
    x[300:340] = x[300]  # equal rows
    return x


ODD = [(9000, None), (9001, [0.0] * 12), (9002, [float("nan")] + [1.0] * 11), (9003, [None] + [1.0] * 11), (9004, [1.0, 2.0]), (9005, [float("inf")] * 12), (9006, [])]


@pytest.mark.parametrize("factor", [1.0, 1.1])
def test_nearest_neighbours_equal_brute_force(spark, factor):
    x = cloud(1)
    ids = np.arange(len(x)) * 5
    df = frame(spark, [*zip(ids.tolist(), x.tolist()), *ODD, (None, x[3].tolist())])
    p = vptree.SearchParams(factor=factor, shard_rows=64, query_rows=10, leaf=8)
    got = {}
    for r in vptree.search(df, df.where("vec_id % 50 = 0 or vec_id >= 9000"), p).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    d = vptree.distances(x.astype(np.float64), x.astype(np.float64))
    assert set(got) == {i for i in ids.tolist() if i % 50 == 0}
    hits = 0
    for q, found in got.items():
        own = d[q // 5].copy()
        own[q // 5] = np.inf
        best = np.lexsort((ids, own))[:10]
        assert all(s == pytest.approx(own[i // 5], abs=0) for i, s in found) and len(found) == 10
        hits += len(set(ids[best].tolist()) & {i for i, _ in found})
        if factor == 1.0:
            assert [i for i, _ in found] == ids[best].tolist()
    assert hits >= 0.9 * 10 * len(got)


def test_search_in_small_tables(spark):
    df = frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])])
    assert [(r.query_id, r.rank, r.vec_id) for r in vptree.search(df, df).orderBy("query_id").collect()] == [(1, 1, 2), (2, 1, 1)]
    assert vptree.search(df.limit(0), df.limit(0)).count() == 0 and vptree.search(df.where("vec_id = 1"), df).where("query_id = 1").count() == 0


def test_embedding_groups_equal_brute_force(spark):
    x = cloud(2)
    x[500:520] = 3 * x[499]  # the same direction
    rng = np.random.default_rng(4)
    for i in range(400, 460):  # chains just within the threshold
        v = x[i - 1] / np.linalg.norm(x[i - 1]) + 0.28 / np.sqrt(12) * rng.normal(size=12)
        x[i] = v
    ids = np.arange(len(x)) * 3 + 1
    df = frame(spark, [*zip(ids.tolist(), x.tolist()), *ODD, (None, x[5].tolist())])
    p = flatgraph.GraphParams(cluster_rows=64, shard_rows=128, margin=4.0)
    rows = flatgraph.dedup(df, p).collect()
    assert len(rows) == len(ids) + len(ODD) + 1
    got = {r.vec_id: r for r in rows}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(link, label[None, :], 1 << 60).min(1))
        if (new == label).all():
            break
        label = new
    found = sum(got[i].n_links for i in ids.tolist())
    assert 0.98 * link.sum() <= found <= link.sum()
    assert all(got[i].n_links <= n for i, n in zip(ids.tolist(), link.sum(1).tolist()))
    assert np.mean([got[i].component_id == c for i, c in zip(ids.tolist(), label.tolist())]) > 0.98
    assert all(got[i].kept == (got[i].component_id == i) for i in ids.tolist())
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in ODD)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert flatgraph.dedup(df.limit(0), p).count() == 0


def test_given_embeddings(spark):
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op9_embedding_dedup"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, u = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    n = (u @ u.T >= 0.95).sum(1) - 1
    assert {i: got[i][0] for i in ids} == dict(zip(ids, n.tolist()))


def border_links(seed, n=2400, dim=64, flat=5):
    """Vectors that lie near a flat of few dimensions: links go along the directions between centres."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, flat)) @ np.linalg.qr(rng.normal(size=(dim, flat)))[0].T
    return x / np.linalg.norm(x, axis=1, keepdims=True) + 0.005 * rng.normal(size=(n, dim))


def test_links_across_borders_with_production_parameters(spark):
    x = border_links(6)
    got = {r.vec_id: (r.n_links, r.kept) for r in flatgraph.dedup(frame(spark, list(enumerate(x.tolist())))).collect()}
    u = x.astype(np.float32).astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    n = (u @ u.T >= 0.95).sum(1) - 1
    lost = sum(abs(got[i][0] - k) for i, k in enumerate(n.tolist()))
    assert lost <= 0.001 * n.sum()


def test_only_vectors_that_can_have_links_search_a_shard(monkeypatch):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1200, 64))
    x[1000:1100] = x[:100] + 0.03 * rng.normal(size=(100, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    p, searched, in_range = flatgraph.GraphParams(), [], flatgraph.Graph.in_range

    def counted(self, q, *args):
        searched.append(len(q))
        return in_range(self, q, *args)

    monkeypatch.setattr(flatgraph.Graph, "in_range", counted)
    near = [np.array(a) for a in flatgraph.robust_prune(x[:1000], p.candidates, p.degree, p.alpha)]
    shard = pd.DataFrame({"id": range(1000), "u": list(x[:1000]), "weight": 1, "near": near, "home": True, "asks": [[0]] * 1000, "cluster": 0})
    queries = pd.DataFrame({"q_id": range(1200), "q": list(x), "q_weight": 1, "q_home": 0})
    got = flatgraph.links_of_shard(shard, queries, p)
    link = x @ x[:1000].T >= p.cosine
    link[np.arange(1000), np.arange(1000)] = False
    assert link.sum() == 100
    assert dict(zip(got["id"], got["links"])) == {**dict.fromkeys(range(1000, 1100), 1), **dict.fromkeys(range(100), 0)}
    assert 100 <= sum(searched) <= 150
    assert len(flatgraph.links_of_shard(shard, queries[:1000], p)) == 0


@pytest.mark.parametrize("dim, flat", [(1, 1), (3, 3), (64, 2), (64, 64)])
def test_no_vector_with_a_link_is_out_of_sight(dim, flat):
    rng = np.random.default_rng(dim + flat)
    x = rng.normal(size=(900, flat)) @ np.linalg.qr(rng.normal(size=(dim, flat)))[0].T
    x[300:600] = x[:300] + np.linspace(0, 0.5, 300)[:, None] * np.linalg.norm(x[:300], axis=1, keepdims=True) * rng.normal(size=(300, dim)) / np.sqrt(dim)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    start = np.r_[np.arange(450), np.full(450, -1)]
    link = x @ x[:450].T >= 0.95
    link[np.arange(450), np.arange(450)] = False
    seen = flatgraph.in_sight(x, x[:450], start, 0.95)
    assert link.any() and not (link.any(axis=1) & ~seen).any()


@pytest.mark.parametrize("dim, flat", [(1, 1), (3, 3), (40, 2), (64, 5), (64, 64)])
def test_codes_leave_no_link_out(dim, flat):
    rng = np.random.default_rng(dim + flat)
    x = rng.normal(size=(900, flat)) @ np.linalg.qr(rng.normal(size=(dim, flat)))[0].T
    x[300:600] = x[:300] + np.linspace(0, 0.5, 300)[:, None] * np.linalg.norm(x[:300], axis=1, keepdims=True) * rng.normal(size=(300, dim)) / np.sqrt(dim)
    x[600:650] = 3 * x[599] + 1e-3 * rng.normal(size=(50, dim))
    u = flatgraph.unit(x)
    code = flatgraph.Code.fit(u[100:500], 12, 13)  # the others may lie beyond its range
    codes, moved = code.encode(u)
    reach, found = float(np.sqrt(0.1) + 2 * moved.max() + 1e-4), set()
    for view, cells in enumerate(code.cells(codes)):
        pieces = [np.flatnonzero((cells == c) & (np.arange(900) % 2 == half)) for c in range(12) for half in (0, 1)]
        rows = [(k, w.astype(np.int64).tobytes(), w.astype(np.int32).tobytes(), codes[w].tobytes()) for k, w in enumerate(w for w in pieces if len(w))]
        some = [flatgraph.Pieces(rows[i:i + 7], code, view) for i in range(0, len(rows), 7)]
        for row in rows:  # each row as a cluster of its own
            for b in some:
                found |= {t for i, c in flatgraph.within_reach(flatgraph.Pieces([row], code, view), b, code, reach) for t in zip(i.tolist(), c.tolist())}
    one, two = np.nonzero((u @ u.T >= 0.95) & ~np.eye(900, dtype=bool))
    near = np.square(u[:, None] - u[None]).sum(axis=2) <= (reach + 2 * moved.max() + 2e-4) ** 2
    assert len(one) and set(zip(one.tolist(), two.tolist())) <= found
    assert all(i != j for i, j in found) and (dim < 64 or flat < 64 or all(near[i, j] for i, j in found))


def test_vectors_without_links_are_neither_placed_nor_ask(spark, monkeypatch):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 64))
    x[2900:] = x[:100] + 0.03 * rng.normal(size=(100, 64))
    held, cut = [], flatgraph.cut

    def counted(df):
        out = cut(df)
        held.append(out.count() if "array<" in str(out.dtypes) else 0)
        return out

    monkeypatch.setattr(flatgraph, "cut", counted)
    got = {r.vec_id: (r.n_links, r.component_id) for r in flatgraph.dedup(frame(spark, list(enumerate(x.tolist())))).collect()}
    assert got == {i: (int(i < 100 or i >= 2900), i - 2900 if i >= 2900 else i) for i in range(3000)}
    assert sum(held) <= 1.2 * 3000  # once in all, and those with links in the graph


def test_small_pieces_and_passes_find_the_same(spark):
    x = border_links(7, n=900)
    df = frame(spark, list(enumerate(x.tolist())))
    rows = lambda p: sorted(tuple(r) for r in flatgraph.dedup(df, p).collect())
    assert rows(flatgraph.GraphParams(piece_rows=50, pass_bytes=12_000)) == rows(flatgraph.GraphParams())


@pytest.mark.parametrize("kind", ["float", "double"])
def test_equal_vectors_of_either_precision(spark, kind):
    rows = [(1, [0.0, 1.0, 0.1]), (2, [-0.0, 1.0, 0.1]), (2, [-0.0, 1.0, 0.1]), (3, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    got = sorted(tuple(r) for r in flatgraph.dedup(df).collect())
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True)]


def test_audit_counts_vectors_that_have_links(spark):
    rng = np.random.default_rng(8)
    hot = np.eye(32)[0] + 0.01 * rng.normal(size=(400, 32))
    pairs = np.repeat(rng.normal(size=(300, 32)), 2, axis=0) + 0.01 * rng.normal(size=(600, 32))
    alone = rng.normal(size=(200, 32))
    x = np.concatenate([hot, pairs, alone])
    classes = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "id long, v array<double>, weight long")
    p = flatgraph.GraphParams()
    hot_only = spark.createDataFrame([(i, 399, 399, 0) for i in range(400)], flatgraph.STARS)
    assert flatgraph._recall(classes, hot_only, len(x), 32, p)[0] < 0.1
    every = hot_only.unionByName(spark.createDataFrame([(i, 1, 1, i - i % 2) for i in range(400, 1000)], flatgraph.STARS))
    assert flatgraph._recall(classes, every, len(x), 32, p)[0] == 1.0
    assert flatgraph._recall(classes.where("id >= 1000"), every, 200, 32, p) == (None, 200)
    share, audited = flatgraph._recall(classes, every, len(x), 32, p, classes.where("id < 1000"))
    assert share == 1.0 and audited >= p.audit


# --- pipeline --------------------------------------------------------------

def test_pipeline_stages(spark):
    start = spark.read.parquet(f"{MID}/documents.parquet")
    folder = spark.sparkContext.getCheckpointDir() + "/pipeline-test"
    docs, ids = start, None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, MID).write.mode("overwrite").parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        now = {r.doc_id for r in out.select("doc_id").distinct().collect()}
        assert ids is None or now <= ids
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == start.columns and out.count() == len(now)
        if name == "near_copies":
            from buyerlens.llm import simhash

            assert simhash.components(out).where("doc_id != component_id").count() == 0
            keepers = {r.component_id for r in simhash.components(docs).collect()}
            assert now == keepers
        if name == "pii":
            assert out.where("n_chars != char_length(text)").count() == 0 and now == ids
        if name == "packing":
            assert now == ids
        docs, ids = out, now
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    poor = labels.where("quality = 0").join(docs.select("doc_id").distinct(), "doc_id").count()
    assert poor <= 0.05 * labels.where("quality = 0").count()


def test_stages_take_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "en", "s", 0), (2, "", None, None, None), (None, "a b c d", "en", "s", 7), (1, None, "en", "s", 0),
                                (4, "jo.81@mail3.example.com", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for frame_ in (df, df.limit(0)):
        docs = frame_
        for _, stage in corpus_pipeline.STAGES[2:]:
            docs = stage(spark, docs, SF).cache()
            docs.count()
        assert docs.columns[-2:] == ["sequence_id", "offset"]
