"""Exact and approximate search against brute force."""

import numpy as np
import pytest

from tidemark.llm import ann, queries, topk
from tidemark.llm.common import table
from pyspark.sql import functions as F

BAD = [(901, None), (902, [1.0, None, 0.0]), (903, [float("nan"), 0.0, 1.0]), (904, [float("inf"), 0.0, 1.0])]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def whole(df):
    rows = df.where(topk.usable(F.col("embedding")))
    return rows.select("vec_id", topk.whole_components(F.col("embedding")).alias("vector"))


def best(rows, query, own, k, score, sign):
    found = [(sign * score(v, query), i) for i, v in rows if i != own]
    return [(i, sign * s) for s, i in sorted(found)[:k]]


@pytest.mark.parametrize("shard_rows, query_rows", [(1 << 14, 1 << 14), (40, 5)])
def test_top_k_is_exact_with_ties(spark, shard_rows, query_rows):
    draw = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in draw.integers(-3, 4, 3) / 4]) for i in range(300)]
    rows += [(300, [0.0, 0.0, 0.0]), (305, rows[5][1]), (305, rows[5][1]), (None, [1.0, 1.0, 1.0])]
    df = whole(vectors(spark, rows + BAD))
    got = topk.top_k(df, df.where("vec_id % 25 = 0"), 5, shard_rows, query_rows).collect()
    plain = {i: tuple(int(np.floor(256 * x)) for x in v) for i, v in rows if i is not None}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for q in [i for i in plain if i % 25 == 0]:
        mine = [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert mine == best(plain.items(), plain[q], q, 5, dot, -1), q
    assert {r["query_id"] for r in got} == {i for i in plain if i % 25 == 0}


def test_top_k_with_huge_components_and_few_candidates(spark):
    rows = [(50, [1e9, -1e9]), (51, [1e9, 1e9]), (52, [5.0]), (53, [])]
    df = whole(vectors(spark, rows))
    got = topk.top_k(df, df.where("vec_id = 50"), 5).collect()
    assert [(r["vec_id"], r["rank"], r["score"]) for r in got] == [(51, 1, 0)]
    none = whole(vectors(spark, []))
    assert topk.top_k(none, none, 5).collect() == []


def test_graph_search_finds_nine_in_ten(spark):
    got = queries.op9_ann(spark, "/root/testdata/sf0.1").toPandas()
    e = table(spark, "/root/testdata/sf0.1", "embeddings").toPandas()
    x, name = np.stack(e["embedding"]).astype(float), e["vec_id"].to_numpy()
    hits = total = 0
    for q in np.flatnonzero(name % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((name, d)) if i != q][:10]
        mine = got[got["query_id"] == name[q]].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11)) and mine["score"].is_monotonic_increasing
        near = dict(zip(name, d))
        assert all(abs(near[i] - s) < 1e-9 for i, s in zip(mine["vec_id"], mine["score"]))
        hits, total = hits + len(set(mine["vec_id"]) & set(name[want])), total + 10
    assert hits / total >= 0.9


def test_copies_ties_and_awkward_vectors(spark):
    same = [float(x) for x in (1, 0, 0)]
    rows = [(i, same) for i in range(0, 60)] + [(500, [0.0, 1.0, 0.0]), (500, [0.0, 1.0, 0.0]), (600, [0.0, 0.0, 0.0])]
    df = ann.as_vectors(vectors(spark, rows + BAD + [(None, same)]))
    index = ann.build_index(df, 10)
    assert index.groupBy().agg(F.sum("copies")).first()[0] == 62
    got = ann.search_index(index, df.where("vec_id % 100 = 0").distinct(), 10).collect()
    of = lambda q: [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
    assert of(0) == [(i, 0.0) for i in range(1, 11)]
    assert of(500) == [(i, pytest.approx(2**0.5)) for i in range(10)]
    assert {r["query_id"] for r in got} == {0, 500}


@pytest.mark.parametrize("shard_rows", [1 << 14, 40])
def test_ids_with_several_vectors(spark, shard_rows):
    draw = np.random.default_rng(5)
    rows = [(0, [1.0, 0.0, 0.0]), (0, [0.0, 1.0, 0.5])]
    rows += [(7, [4.0 + i / 64, 0.0, 0.0]) for i in range(100)] + [(8, [3.0, i / 64, 3.0]) for i in range(100)]
    rows += [(int(i), [float(x) for x in draw.integers(-64, 65, 3) / 64]) for i in draw.integers(10, 60, 150)]
    df = whole(vectors(spark, rows))
    got = topk.top_k(df, df.where("vec_id = 0"), 5, shard_rows, 5).collect()
    score: dict[int, float] = {}
    for i, v in rows[2:]:
        score[i] = max([score.get(i, -1e9), *[sum(int(256 * a) * int(256 * b) for a, b in zip(v, q)) for _, q in rows[:2]]])
    want = sorted((-s, i) for i, s in score.items())[:5]
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(i, -s) for s, i in want]

    near = [(0, [4.0, 0.0, 0.0]), *rows[2:]]
    df = ann.as_vectors(vectors(spark, near))
    index = ann.build_index(df, 5, shard_rows)
    got = ann.search_index(index, df.where("vec_id = 0"), 5).collect()
    far: dict[int, float] = {}
    for i, v in near[1:]:
        far[i] = min(far.get(i, 1e9), float(np.linalg.norm(np.subtract(v, near[0][1]))))
    want = sorted((d, i) for i, d in far.items())[:5]
    mine = sorted(got, key=lambda r: r["rank"])
    assert [r["vec_id"] for r in mine] == [i for _, i in want]
    assert [r["score"] for r in mine] == pytest.approx([d for d, _ in want])


def test_index_of_an_empty_table(spark):
    none = ann.as_vectors(vectors(spark, BAD))
    assert ann.search_index(ann.build_index(none, 10), none, 10).collect() == []


def test_pruning_keeps_diverse_edges():
    points = np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 3]], np.float32)
    got = ann.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 3, -1, 0]]), 3, 1.2)
    assert got.tolist() == [[1, 3, -1]]


def clustered(n, dims, clusters, spread, draw):
    centres = draw.normal(size=(clusters, dims))
    return (centres[draw.integers(0, clusters, n)] + spread * draw.normal(size=(n, dims))).astype(np.float32)


def recall(spark, x, shard_rows, step=40, k=10):
    df = ann.as_vectors(vectors(spark, [(i, [float(c) for c in v]) for i, v in enumerate(x)]))
    got = ann.search_index(ann.build_index(df, k, shard_rows), df.where(f"vec_id % {step} = 0"), k).toPandas()
    exact, hits, total = x.astype(float), 0, 0
    size = np.abs(exact).max()
    for q in range(0, len(x), step):
        d = ((exact / size - exact[q] / size) ** 2).sum(1)
        d[q] = np.inf
        mine = got[got["query_id"] == q]
        assert len(mine) == min(k, len(x) - 1)
        worst = np.sort(d)[:k][-1] * (1 + 1e-9)
        hits, total = hits + int((d[mine["vec_id"]] <= worst).sum()), total + k
    return hits / total


@pytest.mark.parametrize("clusters", [1, 10, 40, 100, 1000])
def test_recall_on_clusters(spark, clusters):
    x = clustered(6000, 32, clusters, 0.05, np.random.default_rng(clusters))
    assert recall(spark, x, 2500) >= 0.9


@pytest.mark.parametrize("change", [lambda x: x + 1000, lambda x: x * 0.1 + 100, lambda x: x * 1e20, lambda x: x * 1e-30])
def test_recall_with_offsets_and_sizes(spark, change):
    x = change(clustered(1500, 16, 20, 0.3, np.random.default_rng(3)).astype(float)).astype(np.float32)
    assert recall(spark, x, 800) >= 0.9


def test_doubles_that_square_beyond_a_double():
    far = ann.exact_distances(np.array([[[1e200, 0.0], [0.0, 0.0], [3e-200, 4e-200]]]), np.zeros((1, 2)))
    assert far.tolist()[0] == pytest.approx([1e200, 0.0, 5e-200])


def test_scores_beyond_a_long(spark):
    rows = [(50, [2e7, 2e7, 1.0]), (51, [3e7, 1e7, 0.0]), (52, [1e10, 0.0, 0.0]), (53, [-1e15, 0.0, 0.0]), (54, [1e30, 1e30, 0.0])]
    df = whole(vectors(spark, rows))
    got = {r["vec_id"]: (r["rank"], r["score"]) for r in topk.top_k(df, df.where("vec_id = 50"), 5).collect()}
    plain = lambda v: [min(int(np.floor(256 * float(np.float32(c)))), 2**63) for c in v]
    score = {i: sum(a * b for a, b in zip(plain(rows[0][1]), plain(v))) for i, v in rows[1:]}
    limit = 2**63 - 1
    score = {i: min(max(s, -limit), limit) for i, s in score.items()}
    order = sorted(score, key=lambda i: (-score[i], i))
    assert {i: (order.index(i) + 1, score[i]) for i in score} == got
