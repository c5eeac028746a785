"""Quality by a generalised additive model with pairwise interactions.

Cyclic boosting: each round fits one shallow tree per feature to the current
gradient, on the feature's bins, and adds it to that feature's lookup table;
then the feature pairs that explain most of what is left get two-way tables
the same way. A score is the sum of table cells, looked up for a whole batch
at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.base import prepare
from buyerlens.llm.training import labelled_sample

FEATURES = ("log_chars", "log_words", "word_length", "upper", "digits", "punctuation", "symbols", "exclamations", "spaces",
            "distinct_words", "top_word", "repeated_neighbours", "repeated_lines", "words_per_line", "symbol_ends",
            "long_words", "short_words", "stops_per_word", "top_pair", "lower_starts")
SYMBOLS = b"#$%&*+<=>@^_`{|}~\\/[]"


@dataclass(frozen=True)
class QualityParams:
    max_train: int = 20_000  # labelled rows the tables are fitted on: the bound of what reaches the driver
    bins: int = 24
    pair_bins: int = 8
    rounds: int = 120
    pair_rounds: int = 60
    pairs: int = 10
    leaves: int = 3
    rate: float = 0.1
    smooth: float = 2.0
    threshold: float = 0.5


@dataclass
class QualityModel:
    edges: list[np.ndarray]  # per feature: inner bin edges
    tables: list[np.ndarray]  # per feature: one value per bin
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for f, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, f], side="right")]
        if self.pairs:
            at = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.pair_edges)]
            for (a, b), t in zip(self.pairs, self.pair_tables):
                z += t[at[a], at[b]]
        return z

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


# --- features --------------------------------------------------------------

_CLASS = np.zeros(256, np.int64)  # 1 upper, 2 digit, 3 punctuation, 4 symbol, 5 white space, 6 lower, 7 beyond ASCII
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 6, 2, 7
_CLASS[list(b"!\"'(),-.:;?")] = 3
_CLASS[list(SYMBOLS)] = 4
_CLASS[list(b" \t\n\r\x0b\x0c")] = 5


def features(text: bytes) -> list[float]:
    """Shape of a whole text; an empty one is all zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, weights=raw, minlength=8)
    n = float(len(text))
    letters = max(1.0, kinds[1] + kinds[6] + kinds[7])
    words = text.split()
    w = max(1, len(words))
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(x, len(index)) for x in words), np.int64, len(words))
    counts = np.bincount(ids) if len(ids) else np.zeros(1)
    lens = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    same = float((ids[1:] == ids[:-1]).mean()) if len(ids) > 1 else 0.0
    if len(ids) > 1:
        pair = np.unique(ids[1:] * len(index) + ids[:-1], return_counts=True)[1].max() / (len(ids) - 1)
    else:
        pair = 0.0
    lines = [x for x in text.split(b"\n") if x.strip()]
    ends = sum(1 for x in index if x[-1] in SYMBOLS)
    lower = sum(counts[i] for x, i in index.items() if 97 <= x[0] <= 122)
    return [np.log1p(n), np.log1p(len(words)), float(lens.mean()), kinds[1] / letters, kinds[2] / n, kinds[3] / n, kinds[4] / n,
            raw[33] / n, kinds[5] / n, len(index) / w, float(counts.max()) / w, same,
            1 - len(set(lines)) / max(1, len(lines)), w / max(1, len(lines)), ends / max(1, len(index)),
            float((lens > 20).mean()), float((lens < 3).mean()), (raw[46] + raw[33] + raw[63]) / w, float(pair), float(lower) / w]


def feature_matrix(texts) -> np.ndarray:
    return np.array([features(t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"") for t in texts],
                    np.float64).reshape(-1, len(FEATURES))


# --- fitting ---------------------------------------------------------------

def _edges(col: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, smooth: float) -> np.ndarray:
    """Newton steps of a tree of at most ``leaves`` leaves over ordered bins."""
    parts = [(0, len(g))]
    gain_of = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + smooth)
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for k, (a, b) in enumerate(parts):
            if b - a > 1:
                gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
                gain = gl ** 2 / (hl + smooth) + (g[a:b].sum() - gl) ** 2 / (h[a:b].sum() - hl + smooth) - gain_of(a, b)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (gain[i], k, a + i + 1)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + smooth)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[float, np.ndarray]:
    """The best tree that cuts both features once: its gain and its table of Newton steps."""
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)

    def four(c):
        q = c[:-1, :-1]
        return q, c[-1:, :-1] - q, c[:-1, -1:] - q, c[-1, -1] - c[-1:, :-1] - c[:-1, -1:] + q

    gq, hq = four(gc), four(hc)
    gain = sum(a ** 2 / (b + smooth) for a, b in zip(gq, hq)) - gc[-1, -1] ** 2 / (hc[-1, -1] + smooth)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros_like(g)
    for (rows, cols), a, b in zip(((slice(None, i + 1), slice(None, j + 1)), (slice(i + 1, None), slice(None, j + 1)),
                                   (slice(None, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(j + 1, None))), gq, hq):
        out[rows, cols] = a[i, j] / (b[i, j] + smooth)
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, p: QualityParams = QualityParams()) -> QualityModel:
    """No labelled row: every score is one half; one class only: near its mark."""
    n_f = len(FEATURES)
    if len(y) == 0 or y.min() == y.max():
        return QualityModel([np.zeros(0)] * n_f, [np.zeros(1)] * n_f, base=0.0 if len(y) == 0 else (4.0 if y[0] else -4.0))
    m = QualityModel([_edges(x[:, f], p.bins) for f in range(n_f)], [], [_edges(x[:, f], p.pair_bins) for f in range(n_f)])
    share = np.clip(y.mean(), 0.01, 0.99)
    m.base = float(np.log(share / (1 - share)))
    at = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(m.edges)]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    z = np.full(len(y), m.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-z))
        return y - q, q * (1 - q)

    for _ in range(p.rounds):
        for f in range(n_f):
            g, h = slopes()
            size = len(m.tables[f])
            step = p.rate * _tree(np.bincount(at[f], g, size), np.bincount(at[f], h, size), p.leaves, p.smooth)
            m.tables[f] += step
            z += step[at[f]]
    pat = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(m.pair_edges)]
    size = [len(e) + 1 for e in m.pair_edges]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        cell = pat[a] * size[b] + pat[b]
        return tuple(np.bincount(cell, v, size[a] * size[b]).reshape(size[a], size[b]) for v in (g, h))

    ranked = sorted(((_quadrants(*grid(a, b), p.smooth)[0], a, b) for a in range(n_f) for b in range(a + 1, n_f)), reverse=True)
    m.pairs = [(a, b) for gain, a, b in ranked[:p.pairs] if gain > 0]
    m.pair_tables = [np.zeros((size[a], size[b])) for a, b in m.pairs]
    for _ in range(p.pair_rounds):
        for k, (a, b) in enumerate(m.pairs):
            step = p.rate * _quadrants(*grid(a, b), p.smooth)[1]
            m.pair_tables[k] += step
            z += step[pat[a], pat[b]]
    return m


# --- Spark -----------------------------------------------------------------

def train(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams(), id_col: str = "doc_id",
          label_col: str = "quality") -> QualityModel:
    """A model of at most ``max_train`` labelled rows that are not held out. Only their features reach the driver."""
    prepare(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def shape(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(list(feature_matrix(b)))

    got = labelled_sample(docs, labels, label_col, params.max_train, id_col).select("target", shape("text").alias("x")).toPandas()
    x = np.array(got["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, got["target"].to_numpy(np.int64), params)


def with_score(docs: DataFrame, model: QualityModel, out: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` and the score of each whole text in column ``out``; a null text is an empty one."""
    prepare(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(model.scores(feature_matrix(b)))

    return docs.withColumn(out, score(F.col(text_col)))
