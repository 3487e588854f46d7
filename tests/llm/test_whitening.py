"""Whitening against a plain eigendecomposition."""

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.common import table


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def whole(rows):
    return np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in rows], object)


def check(rows, vectors, most=32):
    """rows: result; vectors: {vec_id: list of float}."""
    ids = sorted(vectors)
    x = whole([vectors[i] for i in ids])
    n, s = len(ids), x.sum(0)
    centred = np.array((n * x - s) / n, float)
    v = centred.T @ centred / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    got = {(r["vec_id"], r["component"]): r for r in rows}
    k = max(c for _, c in got)
    assert len(got) == len(rows) == n * k and k <= most
    w = np.array([[got[i, c]["whitened"] for c in range(1, k + 1)] for i in ids])
    away = w - w.mean(0)
    error = np.abs(away.T @ away / n - np.eye(k)).max()
    assert error <= 1e-10 and abs(rows[0]["identity_error"] - error) < 1e-9
    for c in range(k):
        share = {got[i, c + 1]["explained"] for i in ids}
        assert len(share) == 1 and share.pop() == pytest.approx(values[c] / np.trace(v), rel=1e-9)
        unit = centred.T @ w[:, c] / n / np.sqrt(values[c])  # V q / e is q
        assert np.abs(v @ unit - values[c] * unit).max() <= 1e-10 * values[0]
    assert all(got[i, 1]["deviation"] == int(((n * x[j] - s) ** 2).sum()) for j, i in enumerate(ids))
    assert {r["n"] for r in rows} == {n}
    return k


def test_whole_table(spark):
    rows = table(spark, "/root/testdata/sf0.01", "embeddings").collect()
    vectors = whitening.whole_vectors(table(spark, "/root/testdata/sf0.01", "embeddings"))
    got = whitening.whiten(vectors.repartition(5)).collect()
    assert check(got, {r["vec_id"]: r["embedding"] for r in rows}) == 32


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_partitions_combine(spark, parts):
    """More partitions than one level combines, copies, equal and missing directions."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(300, 6)).astype(np.float32)
    x[:, 3] = x[:, 2]
    x[100:200] = x[0]
    vectors = {i: [float(c) for c in v] for i, v in enumerate(x)}
    whole_x = whitening.whole_vectors(frame(spark, list(vectors.items())))
    assert check(whitening.whiten(whole_x.repartition(parts)).collect(), vectors) == 5


def test_rows_that_take_no_part(spark):
    draw = np.random.default_rng(5)
    vectors = {i: [float(c) for c in draw.normal(size=3).astype(np.float32)] for i in range(30)}
    bad = [(91, None), (92, [1.0, None, 0.0]), (93, [float("nan"), 0.0, 1.0]), (94, [float("inf"), 0.0, 1.0])]
    bad += [(95, []), (96, [3e38, 0.0, 0.0])]
    got = whitening.whiten(whitening.whole_vectors(frame(spark, [*vectors.items(), *bad]))).collect()
    assert check(got, vectors) == 3


def test_nothing_to_divide_by(spark):
    """Empty tables, one vector, equal vectors: no component."""
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])]):
        assert whitening.whiten(whitening.whole_vectors(frame(spark, rows))).collect() == []


def test_each_length_is_a_fit(spark):
    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(20)] + [(100 + i, [float(i)]) for i in range(10)]
    got = whitening.whiten(whitening.whole_vectors(frame(spark, rows))).collect()
    assert check([r for r in got if r["vec_id"] < 100], dict(rows[:20])) == 2
    assert check([r for r in got if r["vec_id"] >= 100], dict(rows[20:])) == 1


def test_deviation_beyond_a_long(spark):
    """Entries are exact up to 2^34; a deviation that a long can't hold is null."""
    rows = [(1, [2.0**33]), (2, [0.0]), (3, [1.0])]
    got = {r["vec_id"]: r for r in whitening.whiten(whitening.whole_vectors(frame(spark, rows))).collect()}
    assert all(r["deviation"] is None for r in got.values()) and got[1]["whitened"] == pytest.approx(2**0.5)


def test_rank_one_against_eigh():
    draw = np.random.default_rng(6)
    for dims in (1, 2, 9):
        s, total = whitening.Spectrum.empty(dims), np.zeros((dims, dims))
        for step in range(60):
            v = draw.normal(size=dims) * 10.0 ** draw.integers(-6, 6)
            if step % 7 == 0:
                v[:] = 0
            if step % 5 == 0:
                v = np.eye(dims)[step % dims]
            s._update(2.0, v)
            total += 2.0 * np.outer(v, v)
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - total).max() <= 1e-12 * np.abs(total).max()
        assert np.abs(s.vectors.T @ s.vectors - np.eye(dims)).max() < 1e-12
        assert (np.diff(s.values) >= 0).all()
