"""Toxicity: a logistic model over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import ngrams
from tidemark.llm.common import quoted, with_arrow
from tidemark.session import stage

GRAMS = ngrams.Grams(3, 5, lower=True)
#: Bounds of what the fit sees: labelled rows, and features kept of each.
SAMPLE_ROWS = 6000
MAX_FEATURES = 4096
FOLDS = 5


@dataclass(frozen=True)
class Model:
    """P(toxic) = 1 / (1 + exp(-(bias + sum of the weights of the text's features)))."""

    grams: ngrams.Grams
    index: np.ndarray
    weight: np.ndarray
    bias: float


def held_out(doc_id):
    """Rows that are never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, features: int = MAX_FEATURES) -> Model:
    """Learn from at most ``rows`` labelled texts outside the held-out fold.

    Labels other than 0 and 1, and ids without a text, are left out. Without any labelled text the
    model gives every text 0.5; with one class only, that class's smoothed share.
    """
    rule = (docs, labels, "toxic", lambda i: ~held_out(i))
    sample = stage(ngrams.labelled_sample(*rule, rows), "toxicity-sample")
    found = ngrams.select(ngrams.class_counts(sample, GRAMS), GRAMS, features)
    starts, columns, y = ngrams.rows_of(sample, found)
    prior = float(np.log((found.positives + 1) / (found.negatives + 1)))
    if not (found.positives and found.negatives):
        return Model(GRAMS, found.index, np.zeros(len(found.ratio)), prior)
    weight, bias = _logistic(starts, columns, y, found.ratio, prior)
    bias += ngrams.prior_shift(*rule, found.positives, found.negatives)
    return Model(GRAMS, found.index, weight * found.ratio, bias)


def _logistic(starts, columns, y, ratio, prior, penalty: float = 1.0, steps: int = 300):
    """Accelerated gradient descent on the penalised log-loss of the scaled indicators."""
    n, row = len(y), np.repeat(np.arange(len(y)), np.diff(starts))
    scale = ratio[columns]
    length = np.bincount(row, weights=scale**2, minlength=n)
    rate = 4 / (float(np.quantile(length, 0.99)) + 1) / n * 8
    theta = past = np.zeros(len(ratio) + 1)
    theta[-1] = prior

    def loss_and_slope(t):
        z = np.bincount(row, weights=scale * t[columns], minlength=n) + t[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        loss = np.logaddexp(0, np.where(y == 1, -z, z)).sum() + penalty / 2 * (t[:-1] ** 2).sum()
        g = np.bincount(columns, weights=scale * (p - y)[row], minlength=len(ratio)) + penalty * t[:-1]
        return loss, np.append(g, (p - y).sum())

    look, momentum, best = theta, 1.0, np.inf
    for _ in range(steps):
        loss, slope = loss_and_slope(look)
        if loss > best:  # too long a step: start the momentum again, with a shorter one
            rate, look, momentum, best = rate / 2, theta, 1.0, np.inf
            continue
        best, past, theta = loss, theta, look - rate * slope
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        look, momentum = theta + (momentum - 1) / after * (theta - past), after
    return theta[:-1], float(theta[-1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more likely toxic) and ``predicted`` (score >= 0.5).

    Whole texts count. A null or empty text holds no feature and scores by the bias alone. Columns
    that are called score or predicted already are replaced. One pass without a shuffle.
    """

    def make(texts: pa.Array) -> list[pa.Array]:
        z = ngrams.margins(model.weight, model.grams, model.index, texts.to_pylist())
        p = 1 / (1 + np.exp(-np.clip(z + model.bias, -40, 40)))
        return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return with_arrow(docs, "text", make, fields)


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model doesn't call toxic, with their own columns."""
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), "text")
    return score(rows, model).where("predicted = 0").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
