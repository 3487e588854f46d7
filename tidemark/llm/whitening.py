"""Embedding whitening: principal components by rank-one updates of an eigendecomposition.

Each partition keeps the spectrum (mean, eigenvalues and vectors of the scatter matrix) of the vectors that it has
seen and updates it by one centred rank-one term a vector, whose new eigenvalues are the roots of a secular
equation. Spectra of partitions are combined in levels of bounded groups, again by rank-one
terms. The result spans all components; a distributed Rayleigh-Ritz step over the exactly centred vectors then
gives them to double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Entries whose scaled value is beyond it would not be exact; such vectors take no part.
LARGEST = 2.0**40
#: Spectra that one task combines.
FAN_IN = 32
EPS = np.finfo(float).eps


@dataclass
class Spectrum:
    """n vectors with their mean; the scatter matrix is vectors @ diag(values) @ vectors.T, values rising."""

    n: float
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(dims: int) -> Spectrum:
        return Spectrum(0.0, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def add(self, x: np.ndarray, times: float = 1.0) -> None:
        """Take in ``times`` copies of a vector."""
        away, total = x - self.mean, self.n + times
        weight = self.n * times / total
        self.mean = self.mean + away * (times / total)
        self.n = total
        self._update(weight, away)

    def merge(self, other: Spectrum) -> None:
        """Take in another spectrum: one term for each of its components, one for the distance of the means."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self._update(value, vector)
        total, away = self.n + other.n, other.mean - self.mean
        self._update(self.n * other.n / total, away)
        self.mean = self.mean + away * (other.n / total)
        self.n = total

    def _update(self, weight: float, vector: np.ndarray) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, weight, vector)


def rank_one(values: np.ndarray, vectors: np.ndarray, weight: float, vector: np.ndarray):
    """Eigenvalues (rising) and vectors of vectors @ diag(values) @ vectors.T + weight * outer(vector, vector).

    Components that the term hardly touches, and all but one of each set of equal ones, are deflated: the first
    keep value and vector, the others after a rotation. The rest are the roots of the secular equation, with
    the term recomputed from the roots so that the new vectors are orthogonal.
    """
    z = vectors.T @ vector
    length = np.sqrt(z @ z)
    rho = weight * length * length
    if not rho > 0:
        return values, vectors
    z = z / length
    least = 8 * EPS * max(values[-1], rho)
    live = np.flatnonzero(rho * np.abs(z) > least)
    if not len(live):
        return values, vectors
    d = values[live]
    if len(live) > 1 and _alike(d[:-1], d[1:], z[live[:-1]], z[live[1:]], least).any():
        values, vectors, z, live = _deflate_equal(values.copy(), vectors.copy(), z, live, least)
        d = values[live]
    roots, gap = secular_roots(d, z[live] ** 2, rho)
    # gap[i, j] = d[i] - roots[j]
    u = _recomputed(d, gap, rho)[:, None] * np.where(z[live] < 0, -1.0, 1.0)[:, None] / gap
    u /= np.sqrt((u * u).sum(0))
    new_values, new_vectors = values.copy(), vectors.copy()
    new_values[live] = roots
    new_vectors[:, live] = vectors[:, live] @ u
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


def _alike(low, high, z_low, z_high, least):
    """Whether a rotation that moves one component's share into its neighbour's changes less than ``least``."""
    return (high - low) * np.abs(z_low * z_high) <= least * (z_low**2 + z_high**2)


def _deflate_equal(values, vectors, z, live, least):
    kept, z = [], z.copy()
    for j in live:
        if kept:
            i = kept[-1]
            if _alike(values[i], values[j], z[i], z[j], least):
                r = np.hypot(z[i], z[j])
                c, s = z[j] / r, z[i] / r
                low, high = vectors[:, i].copy(), vectors[:, j].copy()
                vectors[:, i], vectors[:, j] = c * low - s * high, s * low + c * high
                a, b = values[i], values[j]
                values[i], values[j] = a * c * c + b * s * s, a * s * s + b * c * c
                z[i], z[j] = 0.0, r
                kept.pop()
        kept.append(j)
    return values, vectors, z, np.array(kept)


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float):
    """The roots of 1 + rho * sum(z2 / (d - x)), one above each of the rising ``d``, and gap[i, j] = d[i] - root[j].

    All roots at once: each is sought as an offset from the nearer pole, by an iteration that fits both
    neighbouring poles and is kept inside its bracket.
    """
    k = len(d)
    z2 = rho * z2
    width = np.append(np.diff(d), z2.sum())
    # the sign at the middle of the interval tells the nearer pole
    middle = d + width / 2
    upper = np.zeros(k, bool)
    if k > 1:
        at_middle = 1 + (z2[:, None] / (d[:, None] - middle)).sum(0)
        upper[:-1] = at_middle[:-1] < 0
    origin = np.where(upper, np.append(d[1:], d[-1]), d)
    apart = d[:, None] - origin
    low = np.where(upper, -width / 2, 0.0)
    high = np.where(upper, 0.0, np.where(np.arange(k) == k - 1, width, width / 2))
    x = (low + high) / 2
    below = np.arange(k)[:, None] <= np.arange(k)  # poles at or below each root
    right = np.minimum(np.arange(k) + 1, k - 1)
    columns = np.arange(k)
    last = columns == k - 1
    active = np.ones(k, bool)
    for _ in range(80):
        gap = apart - x
        term = z2[:, None] / gap
        slope = term / gap
        f = 1 + term.sum(0)
        psi, psi_slope = (np.where(below, t, 0).sum(0) for t in (term, slope))
        phi_slope = slope.sum(0) - psi_slope
        small = np.abs(f) <= EPS * k * (1 + np.abs(psi) + np.abs(f - 1 - psi))
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        active &= ~small & (high - low > EPS * np.abs(x))
        if not active.any():
            break
        near, far = gap[columns, columns], gap[right, columns]
        # f is fitted by c + s / (near - step) + t / (far - step)
        c = f - near * psi_slope - np.where(last, 0, far * phi_slope)
        a = (near + far) * f - near * far * (psi_slope + phi_slope)
        b = near * far * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(last, near + near * near * psi_slope / c, step)
        new = x + step
        inside = (new > low) & (new < high)
        x = np.where(active, np.where(inside, new, (low + high) / 2), x)
    x = np.where(x == 0, np.where(upper, low, high), x)  # never on a pole
    gap = apart - x
    return origin + x, gap


def _recomputed(d: np.ndarray, gap: np.ndarray, rho: float) -> np.ndarray:
    """|z| for which the roots found are exact."""
    k = len(d)
    poles = d[:, None] - d
    ratio = -gap  # roots[j] - d[i]
    span = np.empty_like(gap)
    span[:, :-1] = np.where(np.arange(k)[:, None] > np.arange(k - 1), -poles[:, :-1], -poles[:, 1:])
    span[:, -1] = rho
    return np.sqrt(np.abs((ratio / span).prod(1)))


# ------------------------------------------------------------------------------------------------ Spark


def usable(vector: Column) -> Column:
    """Neither null nor empty, without null or non-finite entries or entries too large to stay exact."""
    fits = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) <= LARGEST, F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & fits  # NaN is beyond any bound


def whole_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``rows`` with a usable vector, its entries c as floor(64 * c) + 1000000, called ``x``.

    Dropped are rows whose vector is null, empty or holds null or non-finite entries, or entries of 2^34 and
    more, whose products would not be exact.
    """
    kept = rows.where(usable(F.col(vector)))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)
    return kept.select("vec_id", whole.alias("x"))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


SPECTRUM = "part long, n double, mean array<double>, vals array<double>, vecs array<double>"


def _pack(part: int, s: Spectrum) -> tuple:
    return part, s.n, s.mean, s.values, s.vectors.ravel()


def partition_spectra(vectors: DataFrame, dims: int) -> DataFrame:
    """One spectrum for each partition that has vectors. Copies in a batch are one weighted term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Spectrum.empty(dims)
        for batch in batches:
            x, times = np.unique(_matrix(batch.column("x"), dims), axis=0, return_counts=True)
            for row, n in zip(x.astype(float), times.tolist()):
                s.add(row, n)
        if s.n:
            packed = _pack(TaskContext.get().partitionId(), s)
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in packed], ["part", "n", "mean", "vals", "vecs"])

    return vectors.select("x").mapInArrow(run, SPECTRUM)


def combined(spectra: DataFrame, dims: int) -> Spectrum:
    """All spectra as one: levels of groups of FAN_IN, so neither a task nor the driver gets more than that."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        total = Spectrum.empty(dims)
        for r in rows.sort_values("part").itertuples():
            total.merge(Spectrum(r.n, r.mean, r.vals, r.vecs.reshape(dims, dims)))
        return pd.DataFrame([_pack(int(rows["part"].min()) // FAN_IN, total)], columns=["part", "n", "mean", "vals", "vecs"])

    spectra = stage(spectra, "spectra")
    parts = spectra.agg(F.max("part")).first()[0] or 0
    while parts:
        spectra = stage(spectra.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(merge, SPECTRUM), "spectra")
        parts //= FAN_IN
    row = spectra.first()
    return Spectrum(row["n"], np.array(row["mean"]), np.array(row["vals"]), np.array(row["vecs"]).reshape(dims, dims))


def _scatter(frame: DataFrame, column: str, dims: int, made) -> np.ndarray:
    """Sum over all rows of the products of ``made(batch of the column)`` with itself, dims x dims.

    A partition passes on one number for each entry; the driver gets dims^2.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            y = made(batch.column(column))
            total += y.T @ y
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], ["at", "v"])

    summed = frame.select(column).mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(dims * dims)
    out[summed["at"].to_numpy(np.int64)] = summed["v"]
    return out.reshape(dims, dims)


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums per dimension; components (rows, falling eigenvalue) with their eigenvalues."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float

    def centred(self, column: pa.ListArray) -> np.ndarray:
        """x - S / n as (n * x - S) / n, whose numerator is exact."""
        return self.scaled(column).astype(float) / self.n

    def scaled(self, column: pa.ListArray) -> np.ndarray:
        """n * x - S, in Python's integers where 64 bits might not do."""
        x = _matrix(column, len(self.sums))
        most = int(np.abs(x).max(initial=0)) * self.n + int(max(abs(int(s)) for s in self.sums))
        if most >= 1 << 63:
            return x.astype(object) * self.n - self.sums.astype(object)
        return x * self.n - self.sums.astype(np.int64)


def fit(vectors: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """The components of all vectors (``x`` of ``dims`` whole entries); None without any.

    Components without variance (up to rounding) are left out: nothing can be divided by it.
    """
    sums = vectors.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    found = {r["at"]: int(r["s"]) for r in sums.collect()}  # one row a dimension
    n = vectors.count()
    if not n:
        return None
    total = np.array([found[i] for i in range(dims)], object)
    rough = combined(partition_spectra(vectors, dims), dims)
    basis = np.linalg.qr(rough.vectors[:, ::-1])[0]
    start = Whitening(n, total, rough.values[::-1], basis.T, 1.0)
    projected = _scatter(vectors, "x", dims, lambda column: start.centred(column) @ basis) / n
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    values, vectors_of = values[::-1], (basis @ turn)[:, ::-1]
    kept = int((values > dims * EPS * max(values[0], 0)).sum()) if values[0] > 0 else 0
    kept = min(kept, components)
    found_components = vectors_of[:, :kept].T
    sign = np.sign(found_components[np.arange(kept), np.abs(found_components).argmax(1)])
    return Whitening(n, total, values[:kept], found_components * sign[:, None], float(values.clip(0).sum()))


def project(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (exact; null beyond a long), w: the whitened entries of each vector."""
    scale = model.components.T / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = model.scaled(batch.column("x"))
            most = int(np.abs(away).max(initial=0))
            if most**2 * len(model.sums) >= 1 << 63:
                exact = (away.astype(object) ** 2).sum(1).tolist()
                deviation = [d if d < 1 << 63 else None for d in exact]
            else:
                deviation = (away**2).sum(1)
            w = (away.astype(float) / model.n) @ scale
            lists = pa.ListArray.from_arrays(np.arange(0, w.size + 1, max(w.shape[1], 1), dtype=np.int32)[: len(w) + 1], w.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviation, pa.int64()), lists], ["vec_id", "deviation", "w"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation long, w array<double>")


def identity_error(projected: DataFrame, k: int, n: int) -> float:
    """Largest absolute entry of the covariance of ``w`` less the identity; centred before multiplying."""
    means = projected.select(F.posexplode("w").alias("at", "v")).groupBy("at").agg(F.avg("v").alias("m")).collect()
    mean = np.array([r["m"] for r in sorted(means, key=lambda r: r["at"])])
    covariance = _scatter(projected, "w", k, lambda column: _matrix(column, k) - mean) / n
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for each vector and component.

    ``vectors`` has vec_id and ``x``, whole entries (``whole_vectors``). Each row counts, also repeats and rows
    without an id. Vectors of different lengths can't share a covariance: each length is a fit of its own,
    with its own n. Components without variance, and so all of a single vector or of equal ones, are
    left out. deviation is the sum of (n * x - S)^2, exact, or null if a long can't hold it.
    """
    spark = vectors.sparkSession
    vectors = stage(vectors, "whole-vectors")
    empty = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    out = spark.createDataFrame([], empty.format(vectors.schema["vec_id"].dataType.simpleString()))
    for dims in sorted(r[0] for r in vectors.select(F.size("x")).distinct().collect()):
        same = vectors.where(F.size("x") == dims)
        model = fit(same, dims, components)
        if model is None or not len(model.values):
            continue
        projected = stage(project(same, model), "whitened")
        error = identity_error(projected, len(model.values), model.n)
        explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
        each = projected.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
        out = out.unionByName(
            each.select(
                "vec_id",
                (F.col("at") + 1).cast("int").alias("component"),
                F.lit(model.n).cast("long").alias("n"),
                "deviation",
                "whitened",
                F.element_at(explained, F.col("at") + 1).alias("explained"),
                F.lit(error).alias("identity_error"),
            )
        )
    return out
