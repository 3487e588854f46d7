"""Character n-grams as hashed features, and their naive Bayes log-count ratios.

Both linear classifiers of this subpackage are built on it. Texts are arrays of code points, a whole
batch at a time; an n-gram is a 20-bit hash of its code points. Counts for the ratios are summed by Spark
over the training sample; the driver sees one row per feature and, for the fit, the selected
features of each sample row, both bounded by documented parameters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import groups

BITS = 20
#: Code points that are hashed at a time. A longer text is cut into overlapping runs, none is shortened.
RUN = 1 << 17
#: What a short text counts for at least, so that a run holds at most RUN / LEAST rows.
LEAST = 2048


@dataclass(frozen=True)
class Grams:
    """Which n-grams are taken: lengths ``least`` to ``most``, of lower-cased text or text as it is."""

    least: int
    most: int
    lower: bool

    def runs(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
        """(code points, end of each text, first row, last row + 1) for runs of rows.

        Every text gets a space on each side, so that word borders count at its ends as well.
        """
        padded = [" " + (t.lower() if self.lower else t) + " " if t else " " for t in texts]
        for a, b in groups([max(len(t), LEAST) for t in padded], RUN):
            if b - a == 1 and len(padded[a]) > RUN:
                for at in range(0, len(padded[a]) - self.most + 1, RUN):
                    part = padded[a][at : at + RUN + self.most - 1]
                    yield _points(part), np.array([len(part)]), a, b
            else:
                part = padded[a:b]
                yield _points("".join(part)), np.cumsum([*map(len, part)]), a, b

    def hashes(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(n, feature of the n-gram at each position) for each n."""
        h = points.copy()
        for n in range(2, self.most + 1):
            h = h[:-1] * np.uint32(0x01000193) + points[n - 1 :] if len(h) > 1 else h[:0]
            if n >= self.least:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(n)
                yield n, (mixed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)

    def present(self, texts: list[str | None], index: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of every feature that a text holds, once, sorted by row.

        ``index`` gives each hash its feature number, or -1 to leave it out; None keeps the hash.
        """
        used = None if index is None else index >= 0
        width = 1 << BITS if index is None else max(int(index.max()) + 1, 1)
        found: list[np.ndarray] = []
        for points, ends, a, b in self.runs(texts):
            size = np.diff(ends, prepend=0)
            owner = np.repeat(np.arange(b - a), size)
            last = np.repeat(ends, size)
            keys = []
            for n, h in self.hashes(points):
                at = np.arange(len(h)) if used is None else np.flatnonzero(used[h])
                at = at[at + n <= last[at]]
                keys.append(owner[at] * width + (h[at] if index is None else index[h[at]]))
            every = np.concatenate([*keys, np.empty(0, np.int64)]).astype(np.int64)
            if used is None:
                every = np.unique(every)
            else:  # a run has few rows, so a bitmap of (row, feature) is small
                seen = np.zeros((b - a) * width, bool)
                seen[every] = True
                every = np.flatnonzero(seen)
            if found and len(ends) == 1 and found[-1][1] == a:  # the next part of the same text
                found[-1] = (np.unique(np.concatenate([found[-1][0], every])), a)
            else:
                found.append((every, a))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        row = np.concatenate([keys // width + a for keys, a in found])
        return row, np.concatenate([keys % width for keys, _ in found])


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _labelled(docs: DataFrame, labels: DataFrame, label: str, train) -> DataFrame:
    """doc_id, y of the labelled training ids that ``docs`` has a text of."""
    there = docs.where(F.col("text").isNotNull()).select("doc_id")
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).join(there, "doc_id", "left_semi")


def prior_shift(docs: DataFrame, labels: DataFrame, label: str, train, positives: int, negatives: int) -> float:
    """What to add to the log-odds learnt from an evenly filled sample, for the classes' shares of all labels."""
    counts = {r["y"]: r["count"] for r in _labelled(docs, labels, label, train).groupBy("y").count().collect()}
    return float(np.log(counts[1] / counts[0]) - np.log(positives / negatives))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train, most: int) -> DataFrame:
    """At most ``most`` labelled training rows as (text, y), the same ones on every run.

    Only ids that ``docs`` holds are chosen from. Each class fills half of the rows, or the other class what
    it leaves free. Rows are chosen by a hash of their id, so the choice doesn't depend on order or layout; of
    rows that repeat an id the smallest text counts. The chosen ids are at most ``most`` and may be broadcast.
    """
    ids = _labelled(docs, labels, label, train).withColumn("draw", F.xxhash64("doc_id", F.lit(17)))
    one, zero = (ids.where(F.col("y") == y).orderBy("draw", "doc_id").limit(most) for y in (1, 0))
    turn = F.row_number().over(Window.partitionBy("y").orderBy("draw", "doc_id"))  # over 2 * most rows at most
    chosen = one.unionByName(zero).withColumn("turn", turn).orderBy("turn", "y").limit(most).select("doc_id", "y")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")).select("text", "y")


def class_counts(sample: DataFrame, grams: Grams) -> pd.DataFrame:
    """feature, pos, neg: sample texts of each class that hold the feature; -1 counts the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, (1 << BITS) + 1), np.int64)
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            row, feature = grams.present(batch.column("text").to_pylist(), None)
            for c in (0, 1):
                total[c, 1:] += np.bincount(feature[y[row] == c], minlength=1 << BITS)
                total[c, 0] += int((y == c).sum())
        at = np.flatnonzero(total.sum(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at - 1), pa.array(total[1, at]), pa.array(total[0, at])], ["feature", "pos", "neg"]
        )

    counts = sample.mapInArrow(count, "feature long, pos long, neg long")
    summed = counts.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return summed.where("feature < 0 OR pos + neg >= 3").toPandas()


@dataclass
class Features:
    """Selected features: ``index`` maps a hash to a feature number, ``ratio`` is its log-count ratio."""

    grams: Grams
    index: np.ndarray
    ratio: np.ndarray
    positives: int
    negatives: int


def select(counts: pd.DataFrame, grams: Grams, most: int, alpha: float = 1.0) -> Features:
    """The ``most`` features whose log-count ratio stands out furthest from its standard error."""
    texts = counts[counts.feature < 0]
    pos, neg = int(texts.pos.sum()), int(texts.neg.sum())
    rest = counts[counts.feature >= 0]
    p, q = rest.pos.to_numpy(float) + alpha, rest.neg.to_numpy(float) + alpha
    ratio = np.log(p / (pos + 2 * alpha)) - np.log(q / (neg + 2 * alpha))
    error = np.sqrt(1 / p - 1 / (pos + 2 * alpha) + 1 / q - 1 / (neg + 2 * alpha))
    order = np.lexsort((rest.feature.to_numpy(), -np.abs(ratio) / np.maximum(error, 1e-9)))[:most]
    index = np.full(1 << BITS, -1, np.int32)
    index[rest.feature.to_numpy()[order]] = np.arange(len(order))
    return Features(grams, index, ratio[order], pos, neg)


def rows_of(sample: DataFrame, features: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sample as (start of each row, features, y), for the fit. Rows in a fixed order."""
    grams, index = features.grams, features.index

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature = grams.present(batch.column("text").to_pylist(), index)
            cut = np.searchsorted(row, np.arange(len(batch) + 1))
            packed = [feature[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(packed, pa.binary()), batch.column("y")], ["x", "y"]
            )

    got = sample.mapInArrow(make, "x binary, y int").toPandas()
    got["x"] = got["x"].map(bytes)
    got = got.sort_values(["y", "x"], kind="stable").reset_index(drop=True)
    got = got.iloc[np.random.default_rng(5).permutation(len(got))]
    each = [np.frombuffer(x, np.int32) for x in got["x"]]
    starts = np.cumsum([0, *map(len, each)])
    return starts, np.concatenate([*each, np.empty(0, np.int32)]), got["y"].to_numpy()


def margins(weight: np.ndarray, grams: Grams, index: np.ndarray, texts: list[str | None]) -> np.ndarray:
    """Sum of the weights of the features that each text holds."""
    row, feature = grams.present(texts, index)
    return np.bincount(row, weights=weight[feature], minlength=len(texts))
