"""Quality rules learned as gradient-boosted trees over document statistics.

Trees are grown on histograms of quantile bins with logistic loss. On the features named in
``FALLING`` a higher value never raises the score: a split that would do so is not taken, and the
bounds that a split sets hold for the whole branch below it. The fitted trees are flattened into
numpy arrays of nodes and all rows of a batch walk all trees at once.

A document also fails the base rules by itself: fewer than 50 words, or more than half of them in
three-word windows that occur twice. Null and empty texts have no words and fail. Without any
labelled document of either class nothing is learned and the base rules decide alone. Rows are
judged one by one, so repeated rows get equal verdicts; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ratesheet.llm.common import importable, over_texts
from ratesheet.llm.statistics import COUNTS, FEATURES, described, labelled_sample

#: Labelled documents to learn from, at most.
TRAIN_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST_ROWS, RIDGE = 60, 3, 0.2, 32, 20, 1.0
FALLING = ["symbols_a_char", "repeat_words", "upper_share", "stops_a_word", "same_as_next"]
#: Documents below this chance of being good are rejected.
KEEP_FROM = 0.5


@dataclass
class Forest:
    """Nodes of all trees. A leaf is its own child, so that a walk of fixed length ends there."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of being good for each row of ``x``."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            low = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(low, self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def _weight(g: float, h: float) -> float:
    return -g / (h + RIDGE)


def _best_split(bins: np.ndarray, g: np.ndarray, h: np.ndarray, falling: np.ndarray):
    """(gain, feature, bin) of the best allowed split of these rows, or None."""
    best = None
    for f in range(bins.shape[1]):
        gs = np.cumsum(np.bincount(bins[:, f], g, BINS))
        hs = np.cumsum(np.bincount(bins[:, f], h, BINS))
        ns = np.cumsum(np.bincount(bins[:, f], minlength=BINS))
        gl, hl, gr, hr = gs[:-1], hs[:-1], gs[-1] - gs[:-1], hs[-1] - hs[:-1]
        gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - gs[-1] ** 2 / (hs[-1] + RIDGE)
        ok = (ns[:-1] >= LEAST_ROWS) & (ns[-1] - ns[:-1] >= LEAST_ROWS)
        if falling[f]:
            ok &= -gl / (hl + RIDGE) >= -gr / (hr + RIDGE)
        gain = np.where(ok, gain, 0)
        k = int(gain.argmax())
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = gain[k], f, k
    return best


def fit(x: np.ndarray, good: np.ndarray, falling: np.ndarray) -> Forest:
    """Trees for ``good`` (0/1) from the rows of ``x``."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    mean = float(np.clip(good.mean(), 1e-3, 1 - 1e-3))
    score = np.full(len(x), np.log(mean / (1 - mean)))
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []

    def grow(rows: np.ndarray, depth: int, low: float, high: float) -> int:
        at = len(nodes)
        value = float(np.clip(_weight(g[rows].sum(), h[rows].sum()), low, high))
        nodes.append([0, np.inf, at, at, value * RATE])
        split = _best_split(bins[rows], g[rows], h[rows], falling) if depth < DEPTH else None
        if split is None:
            score[rows] += value * RATE
            return at
        _, f, k = split
        goes = bins[rows, f] <= k
        left, right = rows[goes], rows[~goes]
        low_l, high_r = low, high
        if falling[f]:
            a, b = (np.clip(_weight(g[r].sum(), h[r].sum()), low, high) for r in (left, right))
            low_l = high_r = (a + b) / 2
        nodes[at][:2] = f, float(edges[f][k])
        nodes[at][2] = grow(left, depth + 1, low_l, high)
        nodes[at][3] = grow(right, depth + 1, low, high_r)
        return at

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = p - good, p * (1 - p)
        roots.append(grow(np.arange(len(x)), 0, -np.inf, np.inf))
    feature, threshold, left, right, value = map(np.array, zip(*nodes))
    return Forest(np.array(roots), feature, threshold, left, right, value, float(np.log(mean / (1 - mean))))


def train(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, rows: int = TRAIN_ROWS) -> Forest | None:
    sample = labelled_sample(docs, labels, "quality", F.lit(True) if allowed is None else allowed, rows)
    if sample["target"].nunique() < 2:
        return None
    falling = np.isin(FEATURES, FALLING)
    return fit(sample[FEATURES].to_numpy(), sample["target"].to_numpy(dtype=float), falling)


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _verdicts(texts: pd.Series, forest: Forest | None, keep_from: float) -> pd.DataFrame:
    out = described(texts)
    score = forest.score(out[FEATURES].to_numpy(dtype=float)) if forest else np.ones(len(out))
    failed = base_failed(out["n_words"].to_numpy(), out["n_repeat_words"].to_numpy())
    return out[COUNTS].assign(base_failed=failed, kept=~failed & (score >= keep_from), score=score)


def judged(docs: DataFrame, forest: Forest | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """(doc_id, counts, base_failed, kept, score) of every row."""

    def judge(batch: pd.DataFrame) -> pd.DataFrame:
        out = _verdicts(batch["text"], forest, keep_from)
        return out.assign(doc_id=batch["doc_id"].astype("Int64").to_numpy())

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    schema = f"doc_id bigint, {counts}, base_failed boolean, kept boolean, score double"
    return over_texts(docs, ["doc_id", "text"], schema, judge)


def keep_good(docs: DataFrame, forest: Forest | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` with all their columns, without the rejected ones."""

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        return _verdicts(texts, forest, keep_from)["kept"]

    return importable(docs).where(good("text"))
