"""Approximate nearest neighbours: a robust-pruned directed graph for each shard, searched with a beam.

A shard's graph is built in batches: greedy searches over the graph so far propose neighbours, pruning
keeps a candidate unless a kept one is closer to it by the factor ALPHA than the node is, and links
are returned by the neighbours, which prune again when full. Candidates are all nodes that the search went through,
not only the nearest, and each node has some random links that are never pruned, so a search leaves a cluster that
it got into by chance. All searches and prunings of a batch run in step as array operations. Every block of
queries searches every shard from several nodes. Identical vectors are one node.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.topk import usable
from tidemark.session import stage

SHARD_ROWS = 4096
QUERY_ROWS = 1 << 14
DEGREE, BEAM, ALPHA = 24, 48, 1.2
#: Random links of each node, and nodes that a search starts from.
LONG, ENTRIES = 8, 8
BATCH = 256


def levelled(points: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as float32, moved to the points' mean and scaled to their largest entry.

    So neither a common offset nor the size of entries costs digits or overflows. Distances for the
    results are worked out from the vectors themselves, in doubles.
    """
    size = np.abs(points).max(initial=0) or 1.0
    middle = (points / size).mean(0)
    spread = np.abs(points / size - middle).max(initial=0) or 1.0
    return tuple(((x / size - middle) / spread).astype(np.float32) for x in (points, others))


def _distances(points: np.ndarray, queries: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of queries (b, d) to the points (b, m); -1 stands for none."""
    away = points[at] - queries[:, None, :]
    return np.where(at < 0, np.inf, np.einsum("bmd,bmd->bm", away, away))


def entries(entry: int, n: int) -> np.ndarray:
    """Where searches start: ``entry`` and others spread over the nodes."""
    return np.unique(np.append(np.linspace(0, n - 1, ENTRIES).astype(np.int64), entry))


def beam_search(points, links, entry: int, queries, beam: int):
    """(ids, squared distances) of the ``beam`` best nodes a greedy search finds, nearest first, and the nodes it went through."""
    b, rows = len(queries), np.arange(len(queries))
    starts = entries(entry, len(points))[:beam]
    ids = np.full((b, beam), -1)
    dist = np.full((b, beam), np.inf)
    ids[:, : len(starts)] = starts
    dist[:, : len(starts)] = _distances(points, queries, ids[:, : len(starts)])
    done = np.zeros((b, beam), bool)
    seen = np.zeros((b, len(points) + 1), bool)  # the last column takes the missing links
    seen[:, starts] = seen[:, -1] = True
    through: list[np.ndarray] = []
    while True:
        todo = np.where(done, np.inf, dist)
        nearest = todo.argmin(1)
        active = rows[todo[rows, nearest] < np.inf]
        if not len(active):
            return ids, dist, np.stack(through, 1) if through else ids[:, :0]
        done[active, nearest[active]] = True
        step = np.full(b, -1)
        step[active] = ids[active, nearest[active]]
        through.append(step)
        next_ = links[step[active]]
        new = np.where(seen[active[:, None], next_], -1, next_)
        seen[active[:, None], next_] = True
        d = _distances(points, queries[active], new)
        every = np.concatenate([dist[active], d], 1)
        best = np.argsort(every, 1, kind="stable")[:, :beam]
        dist[active] = np.take_along_axis(every, best, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], new], 1), best, 1)
        old = np.concatenate([done[active], np.zeros(new.shape, bool)], 1)
        done[active] = np.take_along_axis(old, best, 1)


def robust_prune(points, nodes: np.ndarray, pool: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node up to ``degree`` of its candidates (b, m), nearest first; -1 fills the rest.

    The nearest one left is kept, and those are struck out to which it is closer than the node by the
    factor ``alpha`` (in distances, so its square here).
    """
    pool = np.where(pool == nodes[:, None], -1, pool)
    pool = np.sort(pool, 1)
    pool[:, 1:][pool[:, 1:] == pool[:, :-1]] = -1
    dist = _distances(points, points[nodes], pool)
    order = np.argsort(dist, 1, kind="stable")
    pool, dist = np.take_along_axis(pool, order, 1), np.take_along_axis(dist, order, 1)
    used = int((pool >= 0).sum(1).max(initial=1))  # none is left beyond
    pool, dist = pool[:, :used], dist[:, :used]
    away = points[pool] - points[nodes][:, None, :]  # seen from the node, so that near ones keep their digits
    norms = np.einsum("bmd,bmd->bm", away, away)
    between = norms[:, :, None] + norms[:, None, :] - 2 * away @ away.transpose(0, 2, 1)
    struck = ~np.isfinite(dist)
    out = np.full((len(nodes), degree), -1)
    rows = np.arange(len(nodes))
    for k in range(degree):
        first = struck.argmin(1)
        live = ~struck[rows, first]
        if not live.any():
            break
        out[live, k] = pool[live, first[live]]
        close = alpha**2 * between[rows, first] <= dist
        struck |= close & live[:, None]
        struck[rows, first] = True
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 9):
    """(links, entry): for each point up to ``degree`` neighbours and LONG random links, -1 where there are fewer.

    It passes over the points twice, first with factor 1 and then with ``alpha``. Searches start at the
    point nearest to the mean and at some others.
    """
    points, _ = levelled(points, points[:0])
    n, draw = len(points), np.random.default_rng(seed)
    entry = int(np.argmin((points**2).sum(1)))
    links = np.full((n, degree + LONG), -1)
    if n > 1:
        links[:, degree:] = draw.integers(0, n, (n, LONG))
        links[links == np.arange(n)[:, None]] = -1
    near = links[:, :degree]
    for factor in (1.0, alpha):
        for batch in np.array_split(draw.permutation(n), -(-n // BATCH)):
            found, _, through = beam_search(points, links, entry, points[batch], beam)
            near[batch] = robust_prune(points, batch, np.concatenate([found, through, near[batch]], 1), degree, factor)
            to, back = near[batch].ravel(), np.repeat(batch, degree)
            order = np.argsort(to, kind="stable")
            to, back = to[order], back[order]
            to, back = to[to >= 0], back[to >= 0]
            nodes, at, count = np.unique(to, return_index=True, return_counts=True)
            nth = np.arange(len(to)) - np.repeat(at, count)
            # at most 2 * degree newcomers at a time, however many name the same node
            for turn in range(0, int(count.max(initial=0)), 2 * degree):
                now = (nth >= turn) & (nth < turn + 2 * degree)
                some, row = np.unique(to[now], return_inverse=True)
                pool = np.full((len(some), degree + 2 * degree), -1)
                pool[:, :degree] = near[some]
                pool[row, degree + nth[now] - turn] = back[now]
                for part in np.array_split(np.arange(len(some)), -(-len(some) // BATCH)):
                    near[some[part]] = robust_prune(points, some[part], pool[part], degree, factor)
    return links, entry


def exact_distances(points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Euclidean distances in doubles of (b, m, d) to (b, d); scaled where squares would overflow or vanish."""
    away = points - queries[:, None, :]
    most = np.abs(away).max(2, initial=0)
    scale = np.where((most > 1e150) | ((most < 1e-150) & (most > 0)), most, 1.0)
    return scale * np.sqrt(((away / scale[:, :, None]) ** 2).sum(2))


def _copies(vectors: DataFrame, most: int) -> DataFrame:
    """vector, ids, copies: each distinct vector with the ``most`` smallest ids it occurs under.

    No more copies than that can be among the results, as ties go to the smaller id. They are cut down
    inside each task before the shuffle, so a vector that a third of all rows hold stays small.
    """

    def cut(batches):
        for batch in batches:
            frame = pd.DataFrame({"vec_id": batch.column("vec_id").to_numpy()})
            lists = batch.column("vector")
            flat = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False))
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            key = [flat[e - n : e].tobytes() for e, n in zip(ends, np.diff(ends, prepend=0))]
            frame["key"] = key
            grouped = frame.sort_values("vec_id").drop_duplicates(["key", "vec_id"]).groupby("key", sort=False)
            first = frame.index[~frame["key"].duplicated()]
            ids = grouped["vec_id"].apply(lambda x: x.head(most).tolist())
            count = frame.groupby("key", sort=False).size()
            keys = frame["key"][first]
            yield pa.RecordBatch.from_arrays(
                [
                    lists.take(pa.array(first.to_numpy())),
                    pa.array(ids[keys].tolist(), pa.list_(pa.int64())),
                    pa.array(count[keys].to_numpy(), pa.int64()),
                ],
                ["vector", "ids", "copies"],
            )

    partial = vectors.mapInArrow(cut, "vector array<double>, ids array<long>, copies long")
    smallest = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, most).alias("ids")
    copies = F.sum("copies").alias("copies")
    # a list of each batch: first brought together in parts, then once more
    part = F.pmod(F.xxhash64("ids"), F.lit(256)).alias("part")
    return partial.groupBy("vector", part).agg(smallest, copies).groupBy("vector").agg(smallest, copies)


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index: dims, shard, node, vector, ids, copies, links, entry; one row per distinct vector.

    ``vectors`` has vec_id and ``vector`` (doubles). Shards are dealt by a hash of the vector and their
    number follows from the row count.
    """
    nodes = stage(_copies(vectors, k + 1), "ann-nodes")
    shards = -(-max(1, nodes.count()) // shard_rows)
    placed = nodes.withColumns({"dims": F.size("vector"), "shard": F.pmod(F.xxhash64("vector"), F.lit(shards))})

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(first=rows["ids"].map(lambda x: x[0])).sort_values("first").drop(columns="first")
        rows = rows.reset_index(drop=True)
        links, entry = build_graph(np.stack(rows["vector"].to_numpy()))
        return rows.assign(node=np.arange(len(rows)), links=list(links), entry=entry)[
            ["dims", "shard", "node", "vector", "ids", "copies", "links", "entry"]
        ]

    schema = "dims int, shard long, node long, vector array<double>, ids array<long>, copies long, links array<long>, entry long"
    return stage(placed.groupBy("dims", "shard").applyInPandas(build, schema), "ann-index")


def search_index(
    index: DataFrame, queries: DataFrame, k: int, beam: int = BEAM, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the k nearest that the shards' beams find.

    ``score`` is the Euclidean distance in doubles. A query's own id is no candidate; ties go to the
    smaller id. Entries may have any finite size. A vector's shards are those of its length. An id with several vectors is returned once, with the
    nearest of them, and as a query asks with each.
    """
    blocks = -(-max(1, queries.count()) // query_rows)
    shards = index.groupBy(F.col("dims").alias("q_dims"), F.col("shard").alias("q_shard")).count()
    block = F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(blocks))
    asked = queries.select("vec_id", "vector", F.size("vector").alias("q_dims"), block.alias("q_block"))
    asked = asked.join(shards.drop("count"), "q_dims")
    every = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    copies = index.withColumn("block", F.explode(every))

    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        rows = rows.sort_values("node")
        points, links = np.stack(rows["vector"].to_numpy()), np.stack(rows["links"].to_numpy())
        near, entry = levelled(points, points[:0])[0], int(rows["entry"].iloc[0])
        names, out = rows["ids"].tolist(), []
        for part in np.array_split(np.arange(len(queries)), -(-len(queries) // BATCH)):
            some = queries.iloc[part]
            vectors, own = np.stack(some["vector"].to_numpy()), some["vec_id"].to_numpy()
            width = max(beam, k + 1)
            while len(vectors):
                found, _, _ = beam_search(near, links, entry, levelled(points, vectors)[1], width)
                score = exact_distances(points[found], vectors)
                score[found < 0] = np.inf
                short = []
                for row, (q, nodes, d) in enumerate(zip(own, found, score)):
                    pairs = sorted((x, int(i)) for x, node in zip(d, nodes) if node >= 0 for i in names[node] if i != q)
                    nearest: dict[int, float] = {}
                    for x, i in pairs:
                        nearest.setdefault(i, x)
                    if len(nearest) < k and width < len(points):
                        short.append(row)
                    else:
                        out += [(q, i, x) for i, x in list(nearest.items())[:k]]
                # the beam is full of vectors of a few ids: a wider one for these queries
                vectors, own, width = vectors[short], own[short], min(4 * width, len(points))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    asked = asked.groupBy("q_dims", "q_shard", "q_block")
    hits = copies.groupBy("dims", "shard", "block").cogroup(asked).applyInPandas(
        search, "query_id long, vec_id long, score double"
    )
    best = hits.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def as_vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, vector (doubles) of the rows with an id and a usable vector that isn't zero."""
    vector = F.col(column)
    nonzero = F.exists(vector, lambda x: x != 0)
    known = df.where(F.col("vec_id").isNotNull() & usable(vector)).where(nonzero)
    return known.select(F.col("vec_id").cast("long").alias("vec_id"), vector.cast("array<double>").alias("vector"))
