"""Quality by a regularised quadratic discriminant over document statistics.

Statistics are transformed (shares by the arc sine of their root), standardised, and each class
gets a Gaussian whose covariance is shrunk towards the pooled one and towards a multiple of the
identity. The Cholesky factors are kept, so a row costs two triangular solves; its score is the
difference of the classes' Mahalanobis log-densities, brought to a chance by a logistic curve
fitted on the training rows.

Learned from labelled rows that the caller allows, at most ``TRAIN_ROWS``. Without both classes
every score is the share of label 1 seen (0.5 without labels). Null and empty texts are scored
from their zeros like any other text. Only doc_id and text of a document are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ratesheet.llm.common import bucket_of, over_texts
from ratesheet.llm.statistics import FEATURES, described, labelled_sample

TRAIN_ROWS = 20_000
#: Shrinkage towards the pooled covariance, then towards the mean variance.
TO_POOLED, TO_SPHERE = 0.1, 0.05
PREDICT_FROM = 0.3
HELD_OUT_OF = 5
_PLAIN = {"log_words", "word_length", "words_a_line"}


def transformed(features: pd.DataFrame) -> np.ndarray:
    x = features[FEATURES].to_numpy(dtype=float)
    out = np.arcsin(np.sqrt(np.clip(x, 0, 1)))
    plain = np.isin(FEATURES, list(_PLAIN))
    out[:, plain] = np.log1p(x[:, plain])
    return out


@dataclass
class Discriminant:
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray  # the classes' inverse Cholesky factors
    log_dets: np.ndarray
    slope: float
    offset: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density under label 1 minus that under label 0."""
        z = (x - self.centre) / self.scale
        logs = [
            -0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) - d
            for m, f, d in zip(self.means, self.factors, self.log_dets)
        ]
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _chance(self.slope * np.arcsinh(self.difference(x)) + self.offset)


def _chance(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -500, 500)))


def _logistic(v: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton steps, with a small ridge that keeps separable data finite."""
    design, w = np.stack([v, np.ones_like(v)], axis=1), np.zeros(2)
    for _ in range(50):
        p = _chance(design @ w)
        gradient = design.T @ (p - y) + 1e-2 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(x: np.ndarray, y: np.ndarray) -> Discriminant:
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = (x - centre) / scale
    groups = [z[y == c] for c in (0, 1)]
    means = np.stack([g.mean(axis=0) for g in groups])
    own = [(g - m).T @ (g - m) / len(g) for g, m in zip(groups, means)]
    pooled = sum(c * len(g) for c, g in zip(own, groups)) / len(z)
    factors, log_dets = [], []
    for c in own:
        c = (1 - TO_POOLED) * c + TO_POOLED * pooled
        c = (1 - TO_SPHERE) * c + TO_SPHERE * np.trace(c) / len(c) * np.eye(len(c))
        lower = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(lower))
        log_dets.append(np.log(np.diag(lower)).sum())
    model = Discriminant(centre, scale, means, np.stack(factors), np.array(log_dets), 1.0, 0.0)
    model.slope, model.offset = _logistic(np.arcsinh(model.difference(x)), y)
    return model


def train(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, rows: int = TRAIN_ROWS):
    """The fitted model, or the share of label 1 where there is only one class or none."""
    sample = labelled_sample(docs, labels, "quality", F.lit(True) if allowed is None else allowed, rows)
    if sample["target"].nunique() < 2:
        return float(sample["target"].mean()) if len(sample) else 0.5
    return fit(transformed(sample), sample["target"].to_numpy(dtype=float))


def scored(docs: DataFrame, model: Discriminant | float, predict_from: float = PREDICT_FROM) -> DataFrame:
    """(doc_id, score, predicted) of every row."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        if isinstance(model, float):
            score = np.full(len(batch), model)
        else:
            score = model.score(transformed(described(batch["text"])))
        return pd.DataFrame(
            {
                "doc_id": batch["doc_id"].astype("Int64").to_numpy(),
                "score": score,
                "predicted": (score >= predict_from).astype("int32"),
            }
        )

    return over_texts(docs, ["doc_id", "text"], "doc_id bigint, score double, predicted int", run)


def held_out() -> Column:
    return F.coalesce(bucket_of("doc_id", HELD_OUT_OF) == 0, F.lit(False))
