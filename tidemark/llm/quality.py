"""Quality: support vectors over n-gram indicators scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import ngrams
from tidemark.llm.common import with_arrow
from tidemark.session import stage

GRAMS = ngrams.Grams(2, 4, lower=False)
#: Bounds of what the fit sees: labelled rows, and features kept of each.
SAMPLE_ROWS = 6000
MAX_FEATURES = 8192
FOLDS = 3


@dataclass(frozen=True)
class Model:
    """score = 1 / (1 + exp(-(slope * margin + shift))), margin the sum of a text's weights + bias."""

    grams: ngrams.Grams
    index: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float


def held_out(doc_id):
    """Rows that are never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 1


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, features: int = MAX_FEATURES) -> Model:
    """Learn from at most ``rows`` labelled texts outside the held-out fold.

    Labels other than 0 and 1, and ids without a text, are left out. Without any labelled text the
    model gives every text 0.5; with one class only, that class's smoothed share.
    """
    rule = (docs, labels, "quality", lambda i: ~held_out(i))
    sample = stage(ngrams.labelled_sample(*rule, rows), "quality-sample")
    found = ngrams.select(ngrams.class_counts(sample, GRAMS), GRAMS, features)
    starts, columns, y = ngrams.rows_of(sample, found)
    if not (found.positives and found.negatives):
        prior = float(np.log((found.positives + 1) / (found.negatives + 1)))
        return Model(GRAMS, found.index, np.zeros(len(found.ratio)), 0.0, 0.0, prior)
    weight, bias = dual_descent(starts, columns, y, found.ratio)
    row = np.repeat(np.arange(len(y)), np.diff(starts))
    margin = np.bincount(row, weights=(weight * found.ratio)[columns], minlength=len(y)) + bias
    slope, shift = _sigmoid(margin, y)
    shift += ngrams.prior_shift(*rule, found.positives, found.negatives)
    return Model(GRAMS, found.index, weight * found.ratio, bias, slope, shift)


def dual_descent(starts, columns, y, ratio, cost: float = 0.01, epochs: int = 20, seed: int = 3):
    """Hinge loss with an L2 penalty, one dual variable at a time in a random order.

    The bias is the weight of a constant feature. Each step solves its variable exactly, clipped to
    [0, cost]; it stops when no projected gradient of an epoch exceeds 0.01.
    """
    sign, n = np.where(y == 1, 1.0, -1.0), len(y)
    values = ratio[columns]
    square = np.add.reduceat(np.append(values**2, 0), starts[:-1]) * (np.diff(starts) > 0) + 1
    dual, weight, bias = np.zeros(n), np.zeros(len(ratio)), 0.0
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in draw.permutation(n):
            at = columns[starts[i] : starts[i + 1]]
            x = values[starts[i] : starts[i + 1]]
            slope = sign[i] * (weight[at] @ x + bias) - 1
            if dual[i] == 0:
                projected = min(slope, 0)
            elif dual[i] == cost:
                projected = max(slope, 0)
            else:
                projected = slope
            worst = max(worst, abs(projected))
            if projected:
                new = min(max(dual[i] - slope / square[i], 0), cost)
                weight[at] += (new - dual[i]) * sign[i] * x
                bias += (new - dual[i]) * sign[i]
                dual[i] = new
        if worst < 0.01:
            break
    return weight, bias


def _sigmoid(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities, by Newton steps on smoothed targets."""
    up, down = (y == 1).sum(), (y == 0).sum()
    goal = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([margin, np.ones(len(y))], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (goal - p))
        theta = theta + np.clip(step, -2, 2)
    return max(float(theta[0]), 1e-3), float(theta[1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more likely of quality 1) and ``predicted``.

    Whole texts count. A null or empty text holds no feature and scores by the bias alone. Columns
    that are called score or predicted already are replaced. One pass without a shuffle.
    """

    def make(texts: pa.Array) -> list[pa.Array]:
        z = ngrams.margins(model.weight, model.grams, model.index, texts.to_pylist())
        p = 1 / (1 + np.exp(-np.clip((z + model.bias) * model.slope + model.shift, -40, 40)))
        return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return with_arrow(docs, "text", make, fields)
