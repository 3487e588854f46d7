"""Exact top-k inner products with Fagin's threshold algorithm.

Candidates are dealt into shards of bounded size. A shard sorts its vectors by each dimension once; for a
query its lists are read from the end that the query's component favours, all dimensions in
step. Every vector that shows up is scored exactly, and reading stops when no unseen one can reach the kth score.
Blocks of queries meet every shard; each returns k rows per query, from which the best k are taken.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 1 << 14
QUERY_ROWS = 1 << 14
#: Entries of each list that are read at first; every further step reads twice as many.
FIRST_DEPTH = 64


#: Scores beyond it are given as it.
LIMIT = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Not null, with components that are all finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def whole_components(vector: Column) -> Column:
    """floor(256 * x) of each component, as a number without a fraction; beyond a long, the long's limit."""
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))


class Shard:
    """Vectors of one length with their sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, 0)
        self.repeated = len(np.unique(ids)) < len(ids)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k ids with the best vectors, but for ``own``, ties to the smaller id."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, bool)
        best, score = np.empty(0, np.int64), np.empty(0, query.dtype)
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            end = min(n, depth + step)
            fresh = np.zeros(n, bool)
            if len(up) + len(down):
                fresh[self.order[n - end : n - depth, up]] = True
                fresh[self.order[depth:end, down]] = True
                fresh &= ~seen
            else:  # every score is 0
                fresh[:], end = True, n
            seen |= fresh
            new = np.flatnonzero(fresh)
            new = new[self.ids[new] != own]
            got = self.vectors[new] @ query
            if got.dtype == object:
                got = np.clip(got, -LIMIT, LIMIT)
            if len(best) == k:
                near = got >= score[-1]
                new, got = new[near], got[near]
            if len(new) > k and not self.repeated:
                least = np.partition(got, len(got) - k)[len(got) - k]
                near = got >= least
                new, got = new[near], got[near]
            best, score = np.append(best, self.ids[new]), np.append(score, got)
            first = np.lexsort((best, -score))
            if self.repeated:  # the best vector of each id
                first = first[np.sort(np.unique(best[first], return_index=True)[1])]
            best, score = best[first[:k]], score[first[:k]]
            bound = query[up] @ self.sorted[n - end, up] + query[down] @ self.sorted[end - 1, down]
            if len(best) == k and score[-1] > bound:
                break
            depth, step = end, 2 * step
        return best, score


def _exact(vectors: np.ndarray, queries: np.ndarray) -> np.dtype:
    """A type in which all sums of products are exact."""
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * vectors.shape[1]
    return np.dtype(np.float32 if most < 2**24 else np.float64 if most < 2**53 else object)


def _search(k: int):
    def search(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries) and len(vectors["vector"].iloc[0]):
            rows, asked = np.stack(vectors["vector"].to_numpy()), np.stack(queries["vector"].to_numpy())
            kind = _exact(rows, asked)
            if kind == object:
                rows, asked = (np.frompyfunc(int, 1, 1)(x) for x in (rows, asked))  # integers of any size
            shard = Shard(vectors["vec_id"].to_numpy(), rows.astype(kind))
            for own, query in zip(queries["vec_id"].to_numpy(), asked.astype(kind)):
                ids, scores = shard.top(own, query, k)
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": [int(s) for s in scores]}))
        if not out:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return pd.concat(out, ignore_index=True)

    return search


def dealt(vectors: DataFrame, queries: DataFrame, shard_rows: int, query_rows: int):
    """Both sides grouped by (dims, shard, block): every block of queries with every shard.

    Numbers of shards and blocks follow from the row counts, so groups stay bounded. A shard is copied
    once for each block, a block once for each shard.
    """
    shards, blocks = -(-max(1, vectors.count()) // shard_rows), -(-max(1, queries.count()) // query_rows)
    turn = F.xxhash64("vec_id", F.lit(8))
    left = vectors.withColumns(
        {
            "dims": F.size("vector"),
            "shard": F.pmod(turn, F.lit(shards)),
            "block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))),
        }
    )
    right = queries.select(
        "vec_id",
        "vector",
        F.size("vector").alias("q_dims"),
        F.pmod(turn, F.lit(blocks)).alias("q_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("q_shard"),
    )
    return left.groupBy("dims", "shard", "block"), right.groupBy("q_dims", "q_shard", "q_block")


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k vectors with the largest inner product.

    Both tables have vec_id and ``vector``, an array of whole numbers. A query's own id is no candidate; ties
    go to the smaller id. Vectors of another length than the query's aren't compared with it. Rows
    that repeat an id and vector count once, as do rows without an id not at all. An id with several vectors is
    returned once, with the best of them, and as a query asks with each. Scores are exact; one that a long can't hold
    counts as the long's limit, and so as tied with others of that kind.
    """
    known = [
        df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
        .where("vec_id IS NOT NULL AND vector IS NOT NULL")
        .distinct()
        for df in (vectors, queries)
    ]
    left, right = dealt(*known, shard_rows, query_rows)
    found = left.cogroup(right).applyInPandas(_search(k), "query_id long, vec_id long, score long")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
