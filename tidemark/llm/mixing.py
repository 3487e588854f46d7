"""Mixing sources to target weights with blocks of equal tokens, apportioned by Sainte-Laguë quotas.

Every source's words are dealt into shards of about the same size, each a sequence of its documents in
a seeded order, cut into blocks of equal length. All blocks of the mix are allocated to sources by highest
quotients of their targets, and each source's blocks to its shards in the same way; what is left of a target in
words is taken as the first words of further blocks. A shard with
quota q and n blocks takes all blocks q // n times and q % n of them once more, chosen by a seeded stride that is
coprime to n; the block next in turn is the one taken in part. Only sums per source
and per shard reach the driver; there are at most ``MAX_SHARDS`` shards beyond one per source.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import lean, quoted, without
from tidemark.session import stage

#: Fixed values of the mix: weights by position of the source, and the most a source is repeated.
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3

BLOCK_WORDS = 128
SHARD_WORDS = 100_000
MAX_SHARDS = 1 << 18
SEED = 11
#: Larger than any number of blocks in a shard and prime, so coprime to it.
STRIDES = (2_147_483_647, 2_147_483_629, 2_147_483_587, 2_147_483_579)
WORD = r"[^\x20\x09-\x0D]++"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]]) -> dict[str | None, float]:
    """Words to take from each source: shares by weight, at most 3 times a source's size.

    Sources are in code point order, null last. The excess of a full source goes to the others
    by weight until none is above its limit.
    """
    order = [s for s, _ in sorted(sizes, key=_order)]
    size, total = dict(sizes), sum(n for _, n in sizes)
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    open_, left, out = set(order), float(total), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > MOST_REPEATS * size[s]}
        if not full:
            out.update({s: unit * weight[s] for s in open_})
            break
        out.update({s: float(MOST_REPEATS * size[s]) for s in full})
        open_ -= full
        left = total - sum(out.values())
    return out


def highest_quotients(weights: np.ndarray, limits: np.ndarray, seats: int) -> np.ndarray:
    """Sainte-Laguë seats for each weight (quotients w, w/3, w/5, ...), none above its limit.

    A divisor found by bisection gives all seats but those that tie on it; they go one by one to the
    highest quotient, the earlier weight first.
    """
    weights, limits = np.asarray(weights, float), np.asarray(limits, np.int64)
    limits = np.where(weights > 0, limits, 0)
    seats = int(min(seats, limits.sum()))
    if seats <= 0:
        return np.zeros(len(weights), np.int64)

    def given(divisor: float) -> np.ndarray:
        return np.minimum(limits, np.floor(np.minimum(weights / divisor + 0.5, 2.0**62)).astype(np.int64))

    low, high = 0.0, float(weights.max()) * 2 + 1  # more seats than wanted, fewer
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if given(middle).sum() > seats else (low, middle)
    out = given(high)
    heap = [(-weights[i] / (2 * out[i] + 1), i) for i in np.flatnonzero(out < limits)]
    heapq.heapify(heap)
    for _ in range(seats - int(out.sum())):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < limits[i]:
            heapq.heappush(heap, (-weights[i] / (2 * out[i] + 1), i))
    return out


def _order(source: tuple[str | None, int]) -> tuple[bool, str]:
    """Sources by code point, null last."""
    return source[0] is None, source[0] or ""


def apportion(target: dict[int, float], shards: pd.DataFrame) -> np.ndarray:
    """Whole blocks to take from each shard: one apportionment over sources, then one over each source's shards.

    ``shards`` has _n (number of the source), words and blocks. A source weighs as many of its blocks as its target
    has, and can give each of them MOST_REPEATS times.
    """
    sums = shards.groupby("_n")[["words", "blocks"]].sum()
    goal = np.array([target[n] for n in sums.index], float)
    wanted = goal * sums["blocks"].to_numpy() / np.maximum(sums["words"].to_numpy(), 1)
    wanted = np.where(sums["words"].to_numpy() > 0, wanted, 0.0)
    seats = highest_quotients(wanted, MOST_REPEATS * sums["blocks"].to_numpy(), int(wanted.sum() + 1e-9))
    quota = np.zeros(len(shards), np.int64)
    for n, blocks in zip(sums.index, seats):
        own = np.flatnonzero(shards["_n"].to_numpy() == n)
        rows = shards.iloc[own]
        quota[own] = highest_quotients(rows["words"].to_numpy(), MOST_REPEATS * rows["blocks"].to_numpy(), int(blocks))
    return quota


def plan_shards(target: dict[int, float], shards: pd.DataFrame, block: int = BLOCK_WORDS) -> pd.DataFrame:
    """``shards`` (_n: number of the source, _part, words) with blocks, their number, quota and rest.

    ``rest`` is the number of words that are taken of one block beyond the quota, less than that block
    has or all of it.
    """
    shards = shards.sort_values(["_n", "_part"]).reset_index(drop=True)
    shards["words"] = np.maximum(shards["words"].astype(np.int64), 0)
    shards["blocks"] = np.maximum(1, np.round(shards["words"] / block)).astype(np.int64)
    shards["quota"], shards["rest"] = apportion(target, shards), np.int64(0)
    for n, rows in shards.groupby("_n"):
        words, blocks = rows["words"].to_numpy(), rows["blocks"].to_numpy()
        if not words.sum():
            continue
        limit, length = MOST_REPEATS * blocks, words / blocks
        quota = rows["quota"].to_numpy().copy()
        rest = np.zeros(len(words), np.int64)
        left = int(round(target[n] - (quota * length).sum()))
        # blocks rounded up, or longer than average, can exceed the target by a little
        for i in np.argsort(-length, kind="stable"):
            if left >= 0:
                break
            back = min(int(quota[i]), ceil(-left / length[i])) if words[i] else 0
            quota[i] -= back
            left += int(round(back * length[i]))
        for i in np.flatnonzero((quota < limit) & (words >= blocks)):
            if left <= 0:
                break
            rest[i] = min(left, words[i] // blocks[i])
            left -= rest[i]
        shards.loc[rows.index, "quota"], shards.loc[rows.index, "rest"] = quota, rest
    shards["words"] = np.maximum(shards["words"], 1)
    return shards


def _once_more() -> Column:
    """Word ranges (at, to) of the document in the blocks that are taken once more, the last one in part."""

    def edge(b: Column) -> Column:
        return F.floor(b * F.col("_words") / F.col("_blocks")).cast("long")

    def turn(b: Column) -> Column:
        return (b * F.col("_stride") + F.col("_offset")) % F.col("_blocks")

    def chosen(b: Column) -> Column:
        return turn(b) <= F.col("_quota") % F.col("_blocks")

    def stop(b: Column) -> Column:
        part = F.least(edge(b) + F.col("_rest"), edge(b + 1))
        return F.when(turn(b) < F.col("_quota") % F.col("_blocks"), edge(b + 1)).otherwise(part)

    end = F.col("_begin") + F.col("size")
    first = F.floor(F.col("_begin") * F.col("_blocks") / F.col("_words")).cast("long") - 1
    last = F.floor(end * F.col("_blocks") / F.col("_words")).cast("long") + 1
    near = F.sequence(F.greatest(first, F.lit(0)), F.least(last, F.col("_blocks") - 1))
    ranges = F.transform(
        F.filter(near, chosen),
        lambda b: F.struct(
            (F.greatest(edge(b), F.col("_begin")) - F.col("_begin")).alias("at"),
            (F.least(stop(b), end) - F.col("_begin")).alias("to"),
        ),
    )
    ranges = F.filter(ranges, lambda r: r["at"] < r["to"])
    return F.when(F.col("size") > 0, ranges).otherwise(F.slice(ranges, 1, 0))


ADDED = ("size", "source_size", "target", "taken", "passes", "ranges")


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A local table whose size Spark knows, so that it is broadcast only below the session's threshold."""
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [[] for _ in fields]
    arrays = [pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.table(arrays, names=fields.names))


def mix(docs: DataFrame, seed: int = SEED, carry: bool = True) -> DataFrame:
    """``docs`` with size, source_size, target, taken, passes and ranges for each document.

    Without ``carry`` the result has doc_id, source and those columns only, and no text is shuffled.

    ``passes`` is how often the whole document is taken; ``ranges`` lists the word ranges (at, to) that
    are taken once more. ``taken`` counts words, repeats included, at most 3 times ``size``. A null
    text has size 0. Documents without a source form a source of their own, last in the order. The
    seeded order is by a hash of the id, so reruns agree; rows that repeat an id are documents of
    their own. Columns with a name of those added are replaced; others may have any name.
    """
    names = without(docs, ADDED).columns if carry else ["doc_id", "source"]
    own = {"doc_id", "source", "text"}
    others = [c for c in names if c.lower() not in own]
    source = [F.col(c) for c in sorted(own)] + [F.struct(*[quoted(c) for c in others]).alias("others")] * bool(others)
    mixed = _mix(docs.select(*source), seed, carry)
    columns = [(F.col(c) if c.lower() in own else F.col("others").getField(c)).alias(c) for c in names]
    return mixed.select(*columns, *ADDED)


def _mix(docs: DataFrame, seed: int, carry: bool) -> DataFrame:
    spark = docs.sparkSession
    light = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    sources = light.groupBy("source").agg(F.sum("size").alias("total")).collect()
    sizes = [(r["source"], int(r["total"])) for r in sources]
    goal, total = targets(sizes), sum(n for _, n in sizes)
    per_shard = max(SHARD_WORDS, -(-total // MAX_SHARDS))
    known = [(i, s, n, goal[s], max(1, -(-n // per_shard))) for i, (s, n) in enumerate(sorted(sizes, key=_order))]
    of = _small(spark, known, "_n long, _source string, source_size long, target double, _shards long")

    def dealt(df: DataFrame) -> DataFrame:
        placed = df.join(of, F.col("source").eqNullSafe(F.col("_source")))
        placed = placed.withColumn("_turn", F.xxhash64(F.lit(seed), "doc_id"))
        shard = F.pmod(F.xxhash64(F.lit(seed + 1), "_turn"), F.col("_shards"))
        return placed.withColumn("_part", F.col("_n") * F.lit(1 << 32) + shard)

    sums = dealt(light).groupBy("_n", "_part").agg(F.sum("size").alias("words")).toPandas()
    plan = plan_shards({n: t for n, _, _, t, _ in known}, sums)
    rows = list(plan[["_part", "words", "blocks", "quota", "rest"]].itertuples(index=False, name=None))
    quotas = _small(spark, rows, "_at long, _words long, _blocks long, _quota long, _rest long")
    draw = F.xxhash64(F.lit(seed + 2), F.col("_at"))
    stride = F.get(F.array(*[F.lit(s) for s in STRIDES]), F.pmod(draw, F.lit(len(STRIDES))).cast("int"))
    quotas = quotas.withColumns(
        {"_stride": stride.cast("long") % F.col("_blocks"), "_offset": F.pmod(F.xxhash64(draw), F.col("_blocks"))}
    )
    # rows without words take no part in any order: however many, none of them meets another
    if carry:
        worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
        own = without(docs, ADDED).where(worded).withColumn("size", word_count(F.col("text")))
        empty = without(docs, ADDED).where(~worded)
    else:
        own, empty = light.where("size > 0"), light.where("size = 0").drop("size")
    tie = [F.xxhash64("text")] if carry else []
    order = Window.partitionBy("_part").orderBy("_turn", "doc_id", "size", *tie)
    before = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = dealt(own).withColumn("_begin", F.coalesce(before, F.lit(0)))
    placed = placed.join(quotas, F.col("_part") == F.col("_at"))
    passes = F.when(F.col("size") > 0, F.floor(F.col("_quota") / F.col("_blocks"))).otherwise(0)
    ranged = placed.withColumns({"ranges": _once_more(), "passes": passes.cast("int")})
    extra = F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + r["to"] - r["at"])
    taken = (F.col("passes") * F.col("size") + extra).cast("long")
    kept = [quoted(c) for c in (without(docs, ADDED).columns if carry else ["doc_id", "source"])]
    empty = empty.join(of, F.col("source").eqNullSafe(F.col("_source"))).withColumns(
        {
            "size": F.lit(0).cast("long"),
            "taken": F.lit(0).cast("long"),
            "passes": F.lit(0).cast("int"),
            "ranges": F.array().cast("array<struct<at:bigint,to:bigint>>"),
        }
    )
    ranged = ranged.withColumn("taken", taken)
    return ranged.select(*kept, *ADDED).union(empty.select(*kept, *ADDED))


def mixed_texts(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row for each pass over a document.

    A whole pass returns the row as it is; the ranges of a further pass become one row whose text
    is the words of those ranges, with the white space inside each and a line feed between them.
    ``n_chars``, if there, is counted anew for those. Documents that the mix doesn't take are left out.
    """
    inside = {c: c.lower() if c.lower() in ("doc_id", "source", "text") else f"_in{i}" for i, c in enumerate(docs.columns)}
    carried = docs.select(*[quoted(c).alias(name) for c, name in inside.items()])
    mixed = mix(carried, seed).where("taken > 0").select(*inside.values(), "passes", "ranges")
    names, text = list(inside.values()), list(inside.values()).index("text")
    titles = docs.columns
    count = next((i for i, c in enumerate(titles) if c.lower() == "n_chars"), None)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cuts = [], []
            texts = batch.column("text")
            for i, (passes, ranges) in enumerate(zip(batch.column("passes").to_pylist(), batch.column("ranges").to_pylist())):
                rows += [i] * (passes + bool(ranges))
                cuts += [None] * passes + ([cut(texts[i].as_py(), ranges)] if ranges else [])
            taken = batch.select(names).take(pa.array(rows, pa.int64()))
            columns = list(taken.columns)
            changed = pa.array(cuts, pa.string())
            columns[text] = pc.coalesce(changed, columns[text])
            if count is not None:
                length = pa.array([None if c is None else len(c) for c in cuts], pa.int64())
                columns[count] = pc.coalesce(length.cast(columns[count].type), columns[count])
            yield pa.RecordBatch.from_arrays(columns, titles)

    return mixed.mapInArrow(lean(copy), docs.schema)


def cut(text: str, ranges: list[dict[str, int]]) -> str:
    """The words of the ranges (at, to), which are in order, each with the white space inside it."""
    words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return "\n".join(text[words[r["at"]][0] : words[r["to"] - 1][1]] for r in ranges)
