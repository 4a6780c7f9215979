"""Operator 6: quality classifier, a generalised additive model with pairwise interactions.

Features of a whole text (lengths, shares of symbols, capitals, digits, repeats, lines) are cut into
quantile bins. Boosting goes round the features in turn; each step fits a tree of three leaves over
one feature's bins (gradient and curvature summed by bin) and adds its small step to that feature's
lookup table. The pairs that still explain most are then boosted the same way with trees of one cut
on either feature. A score is the sum of table entries, looked up for a whole Arrow batch at once.

The model is fitted on a bounded sample (``per_class`` rows of each class, see training.py): tasks
compute the features, the driver gets only those numbers. Classes are weighted to their natural
odds over all labels outside of the held-out fold, one a document. Scoring reads every row once and
never shuffles.

Edge cases: null and empty texts have all features zero and get a score like any other; without
labelled rows of both classes every score is 0.5. Repeated rows score alike. Empty table: empty
result. Labels, lang, source and doc_id are no features. Extra columns pass through.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from castwright.llm.common import add_arrow_columns, clashless, utf8
from castwright.llm.training import label_odds, labelled_sample, one_per_document

FEATURES = ["log_words", "word_bytes", "symbols", "capitals", "digits", "exclaims", "stops", "distinct", "log_distinct", "adjacent", "repeat_lines", "line_words", "non_ascii", "pipes", "longest_word"]
PER_CLASS = 3000
MOD, HELD_OUT = 3, 1
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 300, 150, 0.1

_SYMBOLS, _DIGITS, _STOPS = b"#*$%&<>{}[]~^_=+@\\", b"0123456789", b".,;:"
_CAPITALS = bytes(range(65, 91))
_HIGH = bytes(range(128, 256))


def features(text: str | None) -> list[float]:
    """The features of one whole text, in the order of FEATURES."""
    data = utf8(text)
    words = data.split()
    n, size = len(words), len(data)
    if not n:
        return [0.0] * len(FEATURES)

    def share(chars: bytes) -> float:
        return (size - len(data.translate(None, chars))) / size

    kinds = len(set(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return [
        np.log1p(n), sum(map(len, words)) / n, share(_SYMBOLS), share(_CAPITALS), share(_DIGITS), share(b"!?"), share(_STOPS),
        kinds / n, np.log1p(kinds), sum(map(eq, words, words[1:])) / n, 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        share(_HIGH), data.count(b"|") / n, np.log1p(max(map(len, words))),
    ]


def feature_matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def _best_cut(g: np.ndarray, h: np.ndarray, reg: float) -> tuple[int, float]:
    """Bin before which to cut a histogram, and the gain of it."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    whole = g.sum() ** 2 / (h.sum() + reg)
    gain = left_g**2 / (left_h + reg) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + reg) - whole
    at = int(np.argmax(gain)) if len(gain) else -1
    return at + 1, float(gain[at]) if len(gain) else 0.0


def _tree(g: np.ndarray, h: np.ndarray, reg: float) -> np.ndarray:
    """Leaf value by bin of a tree of at most three leaves."""
    out, (cut, gain) = np.zeros(len(g)), _best_cut(g, h, reg)
    parts = [(0, len(g))]
    if gain > 0:
        parts = [(0, cut), (cut, len(g))]
        more = [(*_best_cut(g[a:b], h[a:b], reg), a, b) for a, b in parts]
        cut2, gain2, a, b = max(more, key=lambda x: x[1])
        if gain2 > 0:
            parts = [p for p in parts if p != (a, b)] + [(a, a + cut2), (a + cut2, b)]
    for a, b in parts:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + reg)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, reg: float) -> tuple[np.ndarray, float]:
    """Leaf value by cell of the best tree with one cut on either axis, and its gain."""
    def corners(x):
        c = x.cumsum(0).cumsum(1)
        low, across, down, whole = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        return [low, across - low, down - low, whole - across - down + low]

    gs, hs = corners(g), corners(h)
    gain = sum(a**2 / (b + reg) for a, b in zip(gs, hs)) - g.sum() ** 2 / (h.sum() + reg)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    value = [-a[i, j] / (b[i, j] + reg) for a, b in zip(gs, hs)]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return out, float(gain[i, j])


class Gam:
    """Bin edges and lookup tables of features and pairs of features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, odds: float, reg: float = 1.0):
        n = len(y)
        share = np.array([(1 / (1 + odds)), odds / (1 + odds)])
        weight = np.array([share[v] / max(1, (y == v).sum()) * n for v in (0, 1)])[y]
        cuts = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
        self.edges = cuts
        self.pair_edges = [c[:: max(1, -(-len(c) // (PAIR_BINS - 1)))] for c in cuts]
        self.tables = [np.zeros(len(c) + 1) for c in cuts]
        self.base = float(np.log(odds))
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        bins, pair_bins = self._bins(x, self.edges), self._bins(x, self.pair_edges)
        logit = np.full(n, self.base)

        def slopes():
            p = 1 / (1 + np.exp(-logit))
            return weight * (p - y), weight * p * (1 - p)

        for _ in range(ROUNDS):
            for f, b in enumerate(bins):
                g, h = slopes()
                size = len(self.tables[f])
                step = RATE * _tree(np.bincount(b, g, size), np.bincount(b, h, size), reg)
                self.tables[f] += step
                logit += step[b]

        def cells(i, j):
            shape = len(self.pair_edges[i]) + 1, len(self.pair_edges[j]) + 1
            return pair_bins[i] * shape[1] + pair_bins[j], shape

        def pair_step(i, j):
            (cell, shape), (g, h) = cells(i, j), slopes()
            sums = [np.bincount(cell, s, shape[0] * shape[1]).reshape(shape) for s in (g, h)]
            return *_quadrants(*sums, reg), cell

        wide = [f for f, e in enumerate(self.pair_edges) if len(e)]
        gains = sorted(((pair_step(i, j)[1], i, j) for i in wide for j in wide if i < j), reverse=True)
        self.pairs = [(i, j) for _, i, j in gains[:PAIRS]]
        self.pair_tables = [np.zeros(cells(i, j)[1]) for i, j in self.pairs]
        for _ in range(PAIR_ROUNDS):
            for k, (i, j) in enumerate(self.pairs):
                value, _, cell = pair_step(i, j)
                self.pair_tables[k] += RATE * value
                logit += RATE * value.ravel()[cell]

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, col, "right") for e, col in zip(edges, x.T)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1: sums of table entries."""
        total = np.full(len(x), self.base)
        for table, b in zip(self.tables, self._bins(x, self.edges)):
            total += table[b]
        pair_bins = self._bins(x, self.pair_edges)
        for table, (i, j) in zip(self.pair_tables, self.pairs):
            total += table[pair_bins[i], pair_bins[j]]
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Gam | None:
    """Model of ``labels.quality``; None without rows of both classes."""
    sample = labelled_sample(docs, labels, "quality", per_class, MOD, HELD_OUT)
    made = add_arrow_columns(sample, "text", "x array<double>", lambda texts: [pa.array([features(t) for t in texts], pa.list_(pa.float64()))])
    rows = one_per_document(made, "label").orderBy("doc_id").collect()
    y = np.array([r["label"] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return None
    return Gam(np.array([r["x"] for r in rows]), y, label_odds(labels, "quality", MOD, HELD_OUT))


def score(docs: DataFrame, model: Gam | None, column: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is of good quality."""
    def run(texts):
        return [pa.array(model.scores(feature_matrix(texts)) if model else np.full(len(texts), 0.5), pa.float64())]

    return add_arrow_columns(docs, "text", f"`{column}` double", run)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    (name,) = clashless(docs, "quality_score")
    return score(docs, fit(docs, labels), name).where(F.col(name) >= threshold).drop(name)
