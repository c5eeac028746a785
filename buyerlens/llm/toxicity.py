"""Toxicity by a convolutional text classifier, trained in numpy.

A word is the sum of hashed embeddings: its own and those of its prefixes of
four to six letters, so that an unseen form of a known stem is not unknown.
Filters of several widths run over the word sequence, each keeps its largest
activation over the whole text (max pooling), and one logistic layer scores
the pooled row. The threshold of each language is calibrated on labelled rows
that the weights have not seen.

All labelled rows are learned from. What one process can fit is fitted at once;
more are dealt to units, which Spark's tasks descend through side by side from
common weights, round by round, and the units' weights are averaged.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.llm.base import prepare, release_memory
from buyerlens.llm.training import folds, held_out, labelled_sample, one_mark, texts_of
from buyerlens.session import materialize

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class ToxicityParams:
    max_train: int | None = None  # labelled rows the weights may be fitted on, whatever their length,
    max_words: int | None = None  # up to so many words in all (the last text counts whole); neither: all labelled rows
    at_once_rows: int = 8_000  # all labelled rows are fitted in the driver if they are no more than so many
    at_once_bytes: int = 36 << 20  # and their texts no longer than this in all; else in units
    unit_rows: int = 16_384  # rows, about, that one descent of a round goes through
    unit_bytes: int = 72 << 20  # and bytes of their texts
    block_rows: int = 512  # rows of a unit that a task holds at once
    block_words: int = 1 << 20
    buckets: int = 1 << 18
    dim: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    epochs: int = 4
    batch: int = 32
    batch_words: int = 1 << 16
    rate: float = 0.02
    threshold: float = 0.7
    miss_cost: float = 2.0  # a toxic row that passes, in clean rows rejected
    seed: int = 7


@dataclass
class ToxicityModel:
    table: np.ndarray  # buckets x dim
    conv: list[np.ndarray]  # per width: (width * dim) x filters
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    scale: float = 1.0  # logits are scaled and shifted by the calibration
    shift: float = 0.0
    widths: tuple[int, ...] = (1, 2, 3)
    thresholds: dict[str, float] = field(default_factory=dict)

    @property
    def dim(self) -> int:
        return self.table.shape[1]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def feature_ids(word: str, buckets: int) -> list[int]:
    """Buckets of a word and of its prefixes; the first bucket is no word's."""
    own = [zlib.crc32(word.encode("utf-8", "surrogatepass"))]
    own += [zlib.crc32(f"{n}^{word[:n]}".encode("utf-8", "surrogatepass")) for n in PREFIXES if len(word) >= n]
    return [1 + h % (buckets - 1) for h in own]


# --- scoring ---------------------------------------------------------------

class _Vocabulary(dict):
    """Word -> row; a new word gets the next row and waits for its projection."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = row = len(self) + 1
        return row


class Scorer:
    """A model and its cache of projected words (bounded), one per task."""

    CACHE_BYTES = 40_000_000
    STEP = 1 << 14  # words that are convolved at once

    def __init__(self, m: ToxicityModel):
        self.m = m
        d = m.dim
        self.parts = np.concatenate([w[i * d:(i + 1) * d] for w, width in zip(m.conv, m.widths) for i in range(width)],
                                    axis=1).astype(np.float32)
        self.table = m.table.astype(np.float32, copy=False)
        self.CACHE = self.CACHE_BYTES // (4 * self.parts.shape[1])
        self.reset()

    def reset(self) -> None:
        self.vocabulary = _Vocabulary()
        self.rows = np.zeros((1 << 12, self.parts.shape[1]), np.float32)  # row 0: no word

    def project(self) -> None:
        """The filters' parts of every word seen for the first time."""
        fresh = self.vocabulary.fresh
        if not fresh:
            return
        need = len(self.vocabulary) + 1
        if need > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(need, 2 * len(self.rows)) - len(self.rows), self.rows.shape[1]), np.float32)])
        ids = [feature_ids(w, len(self.table)) for w in fresh]
        starts = np.cumsum([0] + [len(i) for i in ids])[:-1]
        emb = np.add.reduceat(self.table[np.fromiter(chain.from_iterable(ids), np.int64)], starts, axis=0)
        self.rows[need - len(fresh):need] = emb @ self.parts
        fresh.clear()

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Largest activation of each filter over each whole text; long texts go in overlapping steps."""
        reach = max(self.m.widths) - 1
        out = np.zeros((len(texts), sum(b.size for b in self.m.bias)), np.float32)
        rows: list[int] = []
        seqs: list[np.ndarray] = []
        held = 0
        for k, t in enumerate(texts):
            words = words_of(t)
            for i in range(0, max(1, len(words)), self.STEP):
                part = words[i:i + self.STEP + reach] if len(words) > self.STEP else words
                if rows and held + len(part) > self.STEP:
                    np.maximum.at(out, rows, self._convolve(seqs, reach))
                    rows, seqs, held = [], [], 0
                    if len(self.vocabulary) > self.CACHE:
                        self.reset()
                rows.append(k)
                seqs.append(np.fromiter(map(self.vocabulary.__getitem__, part), np.int64, len(part)))
                held += len(part)
        if rows:
            np.maximum.at(out, rows, self._convolve(seqs, reach))
        if len(self.vocabulary) > self.CACHE:
            self.reset()
        return out

    def _convolve(self, seqs: list[np.ndarray], reach: int) -> np.ndarray:
        self.project()
        pad = np.zeros(reach + 1, np.int64)
        x = self.rows[np.concatenate([y for s in seqs for y in (s, pad)] + [pad])]
        starts = np.cumsum([0] + [len(s) + reach + 1 for s in seqs])[:-1]
        n = len(x) - reach
        out, at = [], 0
        for width, bias in zip(self.m.widths, self.m.bias):
            f = bias.size
            h = x[:n, at:at + f]
            for i in range(1, width):
                h = h + x[i:n + i, at + i * f:at + (i + 1) * f]
            at += width * f
            out.append(np.maximum(np.maximum.reduceat(h, starts, axis=0) + bias.astype(np.float32), 0))
        return np.concatenate(out, axis=1)

    def scores(self, texts: list[str]) -> np.ndarray:
        z = self.pooled(texts).astype(np.float64) @ self.m.out + self.m.out_bias
        return 1 / (1 + np.exp(-np.clip(z * self.m.scale + self.m.shift, -30, 30)))


# --- training --------------------------------------------------------------

def fit(texts: list[str], y: np.ndarray, langs: list[str], p: ToxicityParams) -> ToxicityModel:
    """Weights, and a calibration on rows that the calibrated weights have not seen.

    Two fits on half of the rows each give every row a logit by weights that
    have not seen it; a last fit on all rows is calibrated by those. The same
    at every size. No labelled row, or only one class: a model that scores
    every text near the only mark (0 if none).
    """
    seqs, feats = _sequences(texts, p.buckets)
    return _fit(seqs, feats, y, langs, p)


def _fit(seqs: list[np.ndarray], feats: np.ndarray, y: np.ndarray, langs: list[str], p: ToxicityParams) -> ToxicityModel:
    if len(y) == 0 or y.min() == y.max():
        return _one_mark_model(p, int(len(y) > 0 and y[0] != 0))
    fold = _halves(y, p.seed)
    z = np.full(len(y), np.nan)
    for k in range(2):
        rows, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        if len(rows) and len(rest) and y[rest].min() != y[rest].max():
            m = _descend(_fresh(p), seqs, feats, y, rest, p)
            z[rows] = _logits(m, seqs, feats, rows, p)
    m = _descend(_fresh(p), seqs, feats, y, np.arange(len(y)), p)
    known = np.flatnonzero(~np.isnan(z))
    if not len(known):
        known = np.arange(len(y))
        z = _logits(m, seqs, feats, known, p)
    _calibrate(m, z[known], y[known], [langs[i] for i in known], p)
    return m


def _halves(y: np.ndarray, seed: int) -> np.ndarray:
    """0 or 1 per row, each class dealt alike."""
    out = np.zeros(len(y), np.int64)
    for mark in (0, 1):
        own = np.flatnonzero(y == mark)
        out[own] = folds(len(own), 2, seed)
    return out


def _fresh(p: ToxicityParams) -> ToxicityModel:
    rng = np.random.default_rng(p.seed)
    d = p.dim
    m = ToxicityModel(rng.normal(0, 0.1, (p.buckets, d)).astype(np.float32),
                      [rng.normal(0, 0.5 / np.sqrt(w * d), (w * d, p.filters)).astype(np.float32) for w in p.widths],
                      [np.zeros(p.filters, np.float32) for _ in p.widths],
                      rng.normal(0, 0.1, p.filters * len(p.widths)).astype(np.float32), 0.0, widths=p.widths)
    m.table[0] = 0
    return m


def _empty(table: np.ndarray, p: ToxicityParams) -> ToxicityModel:
    """A model of these embeddings whose filters are still to be set."""
    return ToxicityModel(table, [np.zeros((w * p.dim, p.filters), np.float32) for w in p.widths],
                         [np.zeros(p.filters, np.float32) for _ in p.widths], np.zeros(p.filters * len(p.widths)), 0.0, widths=p.widths)


def _logits(m: ToxicityModel, seqs: list[np.ndarray], feats: np.ndarray, rows: np.ndarray, p: ToxicityParams) -> np.ndarray:
    out = []
    for part in _batches(rows, seqs, p):
        q, _, _ = _forward(m, *_flat(seqs, part, max(p.widths) - 1), feats)
        out.append(q.astype(np.float64) @ m.out + m.out_bias)
    return np.concatenate(out)


def _forward(m: ToxicityModel, flat: np.ndarray, starts: np.ndarray, feats: np.ndarray) -> tuple[np.ndarray, list, list]:
    """Pooled activations of a batch; per width where each filter has its largest one, and the windows."""
    x = m.table[feats[flat]].sum(1)
    n = len(flat) - max(m.widths) + 1
    pooled, where, windows = [], [], []
    for w, conv, bias in zip(m.widths, m.conv, m.bias):
        win = np.concatenate([x[j:n + j] for j in range(w)], axis=1)
        h = win @ conv
        at = np.stack([s + np.argmax(h[s:e], axis=0) for s, e in zip(starts, np.r_[starts[1:], n])])
        pooled.append(np.maximum(np.take_along_axis(h, at, 0) + bias, 0))
        where.append(at)
        windows.append(win)
    return np.concatenate(pooled, axis=1), where, windows


def _sequences(texts: list[str], buckets: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per text the row numbers of its words, and per row the buckets of the word (0 beyond its last; row 0: no word).
    A word takes four bytes of the texts, which are held whole."""
    return _word_rows(map(words_of, texts), buckets)


def _word_rows(texts: Iterable[list[str]], buckets: int) -> tuple[list[np.ndarray], np.ndarray]:
    rows: dict[str, int] = {}
    seqs = [np.fromiter((rows.setdefault(w, len(rows) + 1) for w in words), np.int32, len(words)) for words in texts]
    feats = np.zeros((len(rows) + 1, 1 + len(PREFIXES)), np.int32)
    for w, r in rows.items():
        ids = feature_ids(w, buckets)
        feats[r, :len(ids)] = ids
    return seqs, feats


def _batches(order: np.ndarray, seqs: list[np.ndarray], p: ToxicityParams) -> Iterator[np.ndarray]:
    """Rows in the given order, at most ``p.batch`` and about ``p.batch_words`` words at once."""
    sizes = np.array([len(seqs[r]) for r in order])
    first, words = 0, 0
    for i, n in enumerate(sizes):
        if i > first and (i - first == p.batch or words + n > p.batch_words):
            yield order[first:i]
            first, words = i, 0
        words += n
    yield order[first:]


def _flat(seqs: list[np.ndarray], rows: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of a batch, one text after the other, each with ``reach`` + 1 empty places behind it, and the texts' starts."""
    sizes = np.array([len(seqs[r]) + reach + 1 for r in rows])
    starts = np.cumsum(sizes) - sizes
    flat = np.zeros(int(sizes.sum()) + reach, np.int32)
    for r, at in zip(rows, starts):
        flat[at:at + len(seqs[r])] = seqs[r]
    return flat, starts


class _Descent:
    """Adam over small batches of logistic loss; the embedding rows of a batch alone are touched."""

    def __init__(self, m: ToxicityModel, share: float, p: ToxicityParams):
        """``share``: of toxic rows, by which both classes weigh alike."""
        self.m, self.p = m, p
        self.toxic, self.clean = 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6)
        self.dense = [*m.conv, *m.bias, m.out]
        self.first, self.second = [np.zeros_like(a) for a in self.dense], [np.zeros_like(a) for a in self.dense]
        self.sq_table, self.step, self.m_bias = np.full(len(m.table), 1e-8, np.float32), 0, 0.0

    def through(self, order: np.ndarray, seqs: list[np.ndarray], feats: np.ndarray, y: np.ndarray) -> None:
        """One pass over rows ``order``."""
        m, p = self.m, self.p
        reach, d = max(p.widths) - 1, p.dim
        weight = np.where(y == 1, self.toxic, self.clean)
        for rows in _batches(order, seqs, p):
            flat, starts = _flat(seqs, rows, reach)
            q, where, windows = _forward(m, flat, starts, feats)
            prob = 1 / (1 + np.exp(-np.clip(q @ m.out + m.out_bias, -30, 30)))
            err = ((prob - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
            dq = err[:, None] * m.out[None, :] * (q > 0)
            g_conv, g_bias, spots, backs = [], [], [], []
            for k, w in enumerate(p.widths):
                dk = dq[:, k * p.filters:(k + 1) * p.filters]
                g = np.zeros_like(m.conv[k])
                for f in range(p.filters):
                    g[:, f] = windows[k][where[k][:, f]].T @ dk[:, f]
                    back = dk[:, f:f + 1] * m.conv[k][:, f][None, :]
                    for j in range(w):
                        spots.append(where[k][:, f] + j)
                        backs.append(back[:, j * d:(j + 1) * d])
                g_conv.append(g)
                g_bias.append(dk.sum(0))
            self.step += 1
            grads = [*g_conv, *g_bias, q.T @ err + 1e-4 * m.out]
            for a, g, f1, f2 in zip(self.dense, grads, self.first, self.second):
                f1 += 0.1 * (g - f1)
                f2 += 0.001 * (g * g - f2)
                a -= p.rate / 2 * (f1 / (1 - 0.9 ** self.step)) / (np.sqrt(f2 / (1 - 0.999 ** self.step)) + 1e-8)
            self.m_bias = 0.9 * self.m_bias + float(err.sum())
            m.out_bias -= p.rate * self.m_bias
            hit, back = feats[flat[np.concatenate(spots)]], np.concatenate(backs)
            used = hit > 0
            uniq, inv = np.unique(hit[used], return_inverse=True)
            g = np.zeros((len(uniq), d), np.float32)
            np.add.at(g, inv, np.broadcast_to(back[:, None, :], (*hit.shape, d))[used])
            self.sq_table[uniq] += (g * g).mean(1)
            m.table[uniq] -= 2 * p.rate * g / np.sqrt(self.sq_table[uniq])[:, None]

    def vector(self) -> np.ndarray:
        """All but the embeddings, in one row of numbers."""
        parts = [*self.dense, *self.first, *self.second]
        return np.concatenate([*[a.ravel() for a in parts], [self.m.out_bias, self.m_bias, self.step]]).astype(np.float64)

    def set_vector(self, v: np.ndarray) -> None:
        at = 0
        for a in [*self.dense, *self.first, *self.second]:
            a[...] = v[at:at + a.size].reshape(a.shape)
            at += a.size
        self.m.out_bias, self.m_bias, self.step = float(v[at]), float(v[at + 1]), round(float(v[at + 2]))


def _descend(m: ToxicityModel, seqs: list[np.ndarray], feats: np.ndarray, y: np.ndarray, train: np.ndarray,
             p: ToxicityParams) -> ToxicityModel:
    """``p.epochs`` passes over rows ``train``, each in an order of its own."""
    rng = np.random.default_rng(p.seed + 1)
    descent = _Descent(m, y[train].mean(), p)
    for _ in range(p.epochs):
        descent.through(rng.permutation(train), seqs, feats, y)
    return m


def _calibrate(m: ToxicityModel, z: np.ndarray, y: np.ndarray, langs: list[str], p: ToxicityParams, n: np.ndarray | None = None) -> None:
    """Put the decision ``p.threshold`` at the best cut of the logits; then one threshold per language with enough of
    both classes. ``n``: how many rows each logit stands for, one if not given."""
    n = np.ones(len(y), np.int64) if n is None else n
    at = _best_cut(z, y, p.miss_cost, n)
    spread = max(1e-3, min(np.average(np.abs(z[y == k] - at), weights=n[y == k]) if (y == k).any() else 1 for k in (1, 0)))
    m.scale = 3.0 / spread
    m.shift = np.log(p.threshold / (1 - p.threshold)) - at * m.scale
    prob = 1 / (1 + np.exp(-np.clip(z * m.scale + m.shift, -30, 30)))
    lang = np.array(langs, dtype=object)
    for name in sorted({x for x in langs if x}):
        own = lang == name
        if min((n * y)[own].sum(), (n * (1 - y))[own].sum()) >= 10:
            m.thresholds[name] = float(_best_cut(prob[own], y[own], p.miss_cost, n[own]))


def _best_cut(z: np.ndarray, y: np.ndarray, miss_cost: float = 1.0, n: np.ndarray | None = None) -> float:
    """The cut with the least cost of errors; of a gap of equally good cuts, its middle."""
    order = np.argsort(z, kind="stable")
    zs, ys, ns = z[order], y[order], np.ones(len(z), np.int64) if n is None else n[order]
    below0 = np.r_[0, np.cumsum(ns * (ys == 0))]
    below1 = np.r_[0, np.cumsum(ns * (ys == 1))]
    score = below0 + miss_cost * (below1[-1] - below1)
    edge = np.r_[True, zs[1:] != zs[:-1], True]
    score[~edge] = -1
    best = np.flatnonzero(score >= score.max())
    k = best[len(best) // 2]
    lo = zs[k - 1] if k > 0 else zs[0] - 1
    hi = zs[k] if k < len(zs) else zs[-1] + 1
    return float((lo + hi) / 2)


# --- Spark -----------------------------------------------------------------

def train(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(), id_col: str = "doc_id",
          label_col: str = "toxic") -> ToxicityModel:
    """A model of all labelled rows that are not held out; where ``max_train`` or ``max_words`` is given, of at most so many.

    A bounded number is fitted in the driver, more in units by Spark's tasks
    (:func:`_train_in_units`). A limit takes rows in the order of a hash of
    their id, long texts and short ones alike. Null texts count as empty; see
    :func:`buyerlens.llm.training.labelled_sample` for null and repeated ids.
    """
    extra = ("lang",) if "lang" in docs.columns else ()
    max_train, max_words = params.max_train, params.max_words
    if max_train is None and max_words is None:
        marks = one_mark(labels, label_col, id_col)
        met = docs.select(F.col(id_col).alias("__id"), F.octet_length(F.coalesce("text", F.lit(""))).alias("b")).join(marks, "__id")
        n, size = met.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("b").cast("long")), F.lit(0))).first()
        if n > params.at_once_rows or size > params.at_once_bytes:
            return _train_in_units(docs, labels, params, id_col, label_col, extra, n, size)
        max_train = max(1, n)
    limit = max_train if max_train is not None else 2 ** 31 - 1
    rows = labelled_sample(docs, labels, label_col, limit, id_col, extra)
    if max_words is not None:
        rows = materialize(rows.withColumn("__n", F.size(F.split("text", r"\s+"))))
        # At most max_train numbers, not texts, meet in one task.
        before = F.sum("__n").over(Window.orderBy(F.xxhash64("__id"), "__id")) - F.col("__n")
        taken = rows.select("__id", before.alias("__before")).where(F.col("__before") < max_words).select("__id")
        rows = rows.join(F.broadcast(taken), "__id").orderBy(F.xxhash64("__id"), "__id").drop("__n")
    got = rows.drop("__id").toPandas()
    langs = [x if isinstance(x, str) else "" for x in got["lang"]] if "lang" in got else [""] * len(got)
    texts, y = texts_of(got["text"]), got["target"].to_numpy(np.int64)
    del got
    seqs, feats = _sequences(texts, params.buckets)
    del texts
    model = _fit(seqs, feats, y, langs, params)
    del seqs, feats
    release_memory()
    return model


RANGES = 8  # parts of the embedding table that are summed apart
BINS = 1024  # logits of the calibration are counted to this fraction of one


def _unit_table(docs: DataFrame, labels: DataFrame, p: ToxicityParams, id_col: str, label_col: str, extra: tuple[str, ...],
                n_units: int) -> DataFrame:
    """``(unit, fold, target, lang, words)``, one row per labelled id that is not held out; a unit is one file.

    Texts become their words, packed, before they move, and move once, beside
    their labels. An id on several rows counts once, with one of its texts.
    """
    @F.pandas_udf("binary")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([zlib.compress(" ".join(words_of(t)).encode("utf-8", "surrogatepass"), 1) for t in texts_of(b)])

    key = F.col(id_col)
    lang = F.col(extra[0]) if extra else F.lit(None).cast("string")
    texts = (docs.where(key.isNotNull() & ~held_out(id_col))
             .select(key.alias("__id"), F.struct(packed("text").alias("words"), lang.alias("lang")).alias("__row"),
                     F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi")))
    marks = one_mark(labels, label_col, id_col).select("__id", F.lit(None).cast(texts.schema["__row"].dataType).alias("__row"),
                                                       F.col("target").alias("lo"), F.col("target").alias("hi"))
    unit = F.pmod(F.xxhash64("__id", F.lit(p.seed)), F.lit(n_units)).cast("int")
    met = (texts.unionByName(marks).withColumn("unit", unit).repartitionById(n_units, F.col("unit"))
           .groupBy("unit", "__id").agg(F.min("__row").alias("__row"), F.min("lo").alias("target"))
           .where(F.col("__row").isNotNull() & F.col("target").isNotNull()))
    fold = F.pmod(F.xxhash64("__id", F.lit(p.seed + 1)), F.lit(2)).cast("int")
    return met.sortWithinPartitions("unit", F.xxhash64("__id"), "__id").select(
        "unit", fold.alias("fold"), "target", F.coalesce("__row.lang", F.lit("")).alias("lang"), "__row.words")


BLOCK = "unit int, fold binary, target binary, lang array<string>, sizes binary, words binary, feats binary, n_toxic array<long>"


def _encoded(table: DataFrame, p: ToxicityParams) -> DataFrame:
    """The units' rows as numbers, a block a row, so that no round reads words again; ``n_toxic``: clean and toxic rows
    of fold 0, then of fold 1."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def block() -> pd.DataFrame:
            seqs, feats = _word_rows(words, p.buckets)
            fold, target = np.array(folds_, np.int8), np.array(targets, np.int8)
            return pd.DataFrame({
                "unit": [unit], "fold": [fold.tobytes()], "target": [target.tobytes()], "lang": [langs],
                "sizes": [np.array([len(x) for x in seqs], np.int32).tobytes()],
                "words": [zlib.compress(np.concatenate(seqs).astype(np.int32).tobytes(), 1)], "feats": [zlib.compress(feats.tobytes(), 1)],
                "n_toxic": [np.bincount(2 * fold + target, minlength=4).tolist()]})

        unit, n, folds_, targets, langs, words = -1, 0, [], [], [], []
        for b in batches:
            for u, fold, target, lang, packed in zip(b["unit"], b["fold"], b["target"], b["lang"], b["words"]):
                if words and (u != unit or len(words) == p.block_rows or n > p.block_words):
                    yield block()
                    n, folds_, targets, langs, words = 0, [], [], [], []
                own = zlib.decompress(packed).decode("utf-8", "surrogatepass").split()
                unit, n = int(u), n + len(own)
                for held, x in ((folds_, fold), (targets, int(target != 0)), (langs, lang), (words, own)):
                    held.append(x)
        if words:
            yield block()
        words = langs = []
        release_memory()

    return table.mapInPandas(run, BLOCK)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame, list[np.ndarray], np.ndarray]]:
    """``(unit, rows, sequences, features)`` of each block."""
    for b in batches:
        for unit, fold, target, lang, sizes, words, feats in zip(*(b[c] for c in ("unit", "fold", "target", "lang", "sizes", "words", "feats"))):
            rows = pd.DataFrame({"fold": np.frombuffer(fold, np.int8).astype(np.int64), "target": np.frombuffer(target, np.int8).astype(np.int64), "lang": list(lang)})
            seqs = np.split(np.frombuffer(zlib.decompress(words), np.int32), np.cumsum(np.frombuffer(sizes, np.int32))[:-1])
            yield int(unit), rows, seqs, np.frombuffer(zlib.decompress(feats), np.int32).reshape(-1, 1 + len(PREFIXES))


def _train_in_units(docs: DataFrame, labels: DataFrame, p: ToxicityParams, id_col: str, label_col: str, extra: tuple[str, ...],
                    n: int, size: int) -> ToxicityModel:
    """All labelled rows, by two halves: each half's weights descend through the units of the other one, and the model
    is both together, its logit their mean.

    A round is one pass: every unit starts at the common weights, and the
    weights after it are the units' mean, an embedding's mean that of the units
    that touched it. Sums are made in Spark; weights alone, of a fixed size,
    reach the driver. Every row's logit by the half that has not seen it is
    counted for the calibration.
    """
    spark = docs.sparkSession
    prepare(spark)
    units = _unit_table(docs, labels, p, id_col, label_col, extra, max(-(-n // p.unit_rows), -(-size // p.unit_bytes)))
    table = materialize(_encoded(units, p))
    counts = [x or 0 for x in table.agg(*[F.sum(F.col("n_toxic")[i]) for i in range(4)]).first()]
    if 0 in (counts[0] + counts[2], counts[1] + counts[3]):
        return _one_mark_model(p, int(counts[1] + counts[3] > 0))
    shares = []
    for k in range(2):  # half k is fitted on the rows of the other fold
        seen = counts[2 - 2 * k:4 - 2 * k]
        shares.append(seen[1] / max(1, sum(seen)))
    states = [_Descent(_fresh(replace(p, seed=p.seed + k)), shares[k], p) for k in range(2)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")  # blocks
    for _ in range(p.epochs):
        _round(table, states, shares, p)
    halves = [s.m for s in states]
    model = _together(halves)
    hist = _held_logits(table, halves, p)
    prepare(spark)
    z, y, m = (hist[c].to_numpy() for c in ("z", "target", "n"))
    _calibrate(model, z.astype(np.float64) / BINS, y.astype(np.int64), hist["lang"].tolist(), p, m.astype(np.int64))
    return model


def _one_mark_model(p: ToxicityParams, mark: int) -> ToxicityModel:
    m = _fresh(p)
    m.out_bias = 10.0 if mark else -10.0
    return m


def _round(table: DataFrame, states: list[_Descent], shares: list[float], p: ToxicityParams) -> None:
    """One pass of both halves over the units; ``states`` become the units' means."""
    held = table.sparkSession.sparkContext.broadcast([(s.m.table, s.sq_table, s.vector()) for s in states])
    width, step = p.dim + 2, -(-p.buckets // RANGES)

    def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [np.zeros((p.buckets, width), np.float32) for _ in held.value]  # of a task's units: changes, and how many made one
        dense, units, now, own = [0.0, 0.0], 0, None, []

        def close() -> None:
            for k, d in enumerate(own):
                base, sq, _ = held.value[k]
                at = np.flatnonzero(d.sq_table != sq)
                sums[k][at] += np.concatenate([d.m.table[at] - base[at], (d.sq_table - sq)[at, None], np.ones((len(at), 1), np.float32)], axis=1)
                dense[k] = dense[k] + d.vector()

        for unit, rows, seqs, feats in _blocks(batches):
            if unit != now:
                close()
                now, units, own = unit, units + 1, []
                for k, (base, sq, vector) in enumerate(held.value):
                    d = _Descent(_empty(base.copy(), p), shares[k], p)
                    d.sq_table = sq.copy()
                    d.set_vector(vector)
                    own.append(d)
            fold, y = rows["fold"].to_numpy(), rows["target"].to_numpy()
            for k, d in enumerate(own):
                if (fold != k).any():
                    d.through(np.flatnonzero(fold != k), seqs, feats, y)
        close()
        for k in range(len(held.value) if units else 0):
            yield pd.DataFrame({"half": [k], "part": [-1], "at": [b""], "sums": [np.r_[dense[k], units].tobytes()]})
            for r in range(RANGES):
                piece = sums[k][r * step:(r + 1) * step]
                at = np.flatnonzero(piece[:, -1]).astype(np.int32)
                yield pd.DataFrame({"half": [k], "part": [r], "at": [at.tobytes()], "sums": [piece[at].tobytes()]})
        del sums, own
        release_memory()  # a worker goes on to other tasks

    def add(key: tuple, got: pd.DataFrame) -> pd.DataFrame:
        if key[1] < 0:
            total = sum(np.frombuffer(s, np.float64) for s in got["sums"])
            return pd.DataFrame({"half": [key[0]], "part": [-1], "at": [b""], "sums": [total.tobytes()]})
        total = np.zeros((step, width), np.float32)
        for a, s in zip(got["at"], got["sums"]):
            total[np.frombuffer(a, np.int32)] += np.frombuffer(s, np.float32).reshape(-1, width)
        at = np.flatnonzero(total[:, -1]).astype(np.int32)
        return pd.DataFrame({"half": [key[0]], "part": [key[1]], "at": [at.tobytes()], "sums": [total[at].tobytes()]})

    schema = "half int, part int, at binary, sums binary"
    for r in table.mapInPandas(descend, schema).groupBy("half", "part").applyInPandas(add, schema).collect():  # weights: a fixed size
        s = states[r["half"]]
        if r["part"] < 0:
            total = np.frombuffer(bytes(r["sums"]), np.float64)
            s.set_vector(total[:-1] / total[-1])
        else:
            at = np.frombuffer(bytes(r["at"]), np.int32) + r["part"] * step
            total = np.frombuffer(bytes(r["sums"]), np.float32).reshape(-1, width)
            mean = total[:, :-1] / total[:, -1:]
            s.m.table[at] += mean[:, :-1]
            s.sq_table[at] += mean[:, -1]
    held.destroy()


def _held_logits(table: DataFrame, halves: list[ToxicityModel], p: ToxicityParams) -> pd.DataFrame:
    """``(z, target, lang, n)``: the rows' logits by the half that has not seen them, in parts of one by ``BINS``, counted."""
    held = table.sparkSession.sparkContext.broadcast(halves)

    def logits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, rows, seqs, feats in _blocks(batches):
            z, fold = np.zeros(len(rows)), rows["fold"].to_numpy()
            for k, m in enumerate(held.value):
                if (own := np.flatnonzero(fold == k)).size:
                    z[own] = _logits(m, seqs, feats, own, p)
            rows["z"] = np.rint(np.clip(z, -64, 64) * BINS).astype(np.int32)
            yield rows[["z", "target", "lang"]]
        release_memory()

    return (table.mapInPandas(logits, "z int, target int, lang string").groupBy("z", "target", "lang")
            .agg(F.count(F.lit(1)).alias("n")).toPandas())


def _together(halves: list[ToxicityModel]) -> ToxicityModel:
    """One model whose logit is the mean of theirs: their embeddings and filters side by side."""
    d, n = halves[0].dim, len(halves)
    conv, bias, out = [], [], []
    at = 0
    for k, width in enumerate(halves[0].widths):
        f = halves[0].bias[k].size
        both = np.zeros((width * d * n, f * n), np.float32)
        for h, m in enumerate(halves):
            for j in range(width):
                both[(j * n + h) * d:(j * n + h + 1) * d, h * f:(h + 1) * f] = m.conv[k][j * d:(j + 1) * d]
        conv.append(both)
        bias.append(np.concatenate([m.bias[k] for m in halves]))
        out.append(np.concatenate([m.out[at:at + f] for m in halves]) / n)
        at += f
    return ToxicityModel(np.concatenate([m.table for m in halves], axis=1), conv, bias, np.concatenate(out),
                         float(np.mean([m.out_bias for m in halves])), widths=halves[0].widths)


def with_score(docs: DataFrame, model: ToxicityModel, out: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` and the score of each whole text in column ``out``; a null text is an empty one."""
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)  # buckets x dim: a fixed size

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        s = Scorer(held.value)
        for b in batches:
            yield pd.Series(s.scores(texts_of(b)))
        del s
        release_memory()

    return docs.withColumn(out, score(F.col(text_col)))


def with_language_decision(scored: DataFrame, model: ToxicityModel, params: ToxicityParams = ToxicityParams(), score_col: str = "score",
                           lang_col: str = "lang") -> DataFrame:
    """``scored`` with the threshold that was calibrated for the row's language, ``lang_threshold`` (a language
    without enough labelled rows, or none: the common one), and ``lang_predicted``, 1 where the score reaches it."""
    common = F.lit(params.threshold)
    own = F.create_map(*[F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair]) if model.thresholds else None
    at = common if own is None else F.coalesce(F.element_at(own, F.coalesce(F.col(lang_col), F.lit(""))), common)
    return (scored.withColumn("lang_threshold", at)
            .withColumn("lang_predicted", (F.col(score_col) >= F.col("lang_threshold")).cast("int")))
