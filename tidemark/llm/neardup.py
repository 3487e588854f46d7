"""MinHash near-dedup with min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so 72
values cost 36 hash evaluations. Bands of three values make buckets. Texts with the same
shingle set are one class from the start, and a bucket holds classes of like size. At first a bucket's classes
aren't paired with each other: each is held against one hub, on full sets. Two classes that are both
linked to the hub are connected. If one isn't, the two can only be linked if they differ from the hub in
the same way: the shingles in which each differs, those it adds and those it lacks, must have a good
part in common. So new buckets are made of the rarest of these shingles, where components still differ.
They are short; their classes are held against 8, 512, 32768 .. hubs a round until a bucket is connected
or done, but only those whose remaining shingles suffice for a link. A large group of near copies costs
a star and short lists instead of a square, and no link between components is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lean, quoted
from tidemark.llm.shingles import mix64, shingle_sets
from tidemark.session import stage

#: Link from this similarity on: 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
ROWS, BANDS = 3, 24
HASHES = ROWS * BANDS // 2
#: Odd multipliers: x -> a * x permutes the 64-bit hashes.
_FACTORS = np.random.default_rng(36).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Growth of set sizes from one size class to the next: more than that between two linked sets.
SIZE_STEP = 1.01 * 100 / SIMILARITY
#: Up to so many ids (8 bytes each) are broadcast to pick out their texts; beyond it, both sides are shuffled.
BROADCAST_IDS = 2_000_000


def min_max(shingles: np.ndarray) -> bytes:
    """The signature: for each permutation the upper 32 bits of its smallest and largest hash."""
    low = np.full(HASHES, np.iinfo(np.uint64).max)
    high = np.zeros(HASHES, np.uint64)
    for at in range(0, len(shingles), 1 << 14):
        hashes = shingles[None, at : at + (1 << 14)] * _FACTORS[:, None]
        low = np.minimum(low, hashes.min(1))
        high = np.maximum(high, hashes.max(1))
    return (np.stack([low, high], 1).ravel() >> np.uint64(32)).astype(np.uint32).tobytes()


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n (size of the set), f1 and f2 (128-bit hash of the set), sig, for each row.

    Without words n is 0 and f1, f2 and sig are null.
    """

    def make(batches):
        for batch in batches:
            n, f1, f2, sig = [], [], [], []
            for s in shingle_sets(batch.column("text").to_pylist()):
                n.append(len(s))
                f1.append(int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else None)
                f2.append(int(mix64(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else None)
                sig.append(min_max(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(f1, pa.int64()),
                    pa.array(f2, pa.int64()),
                    pa.array(sig, pa.binary()),
                ],
                ["doc_id", "n", "f1", "f2", "sig"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(lean(make), "doc_id long, n long, f1 long, f2 long, sig binary")


def _banded(classes: DataFrame) -> DataFrame:
    """bucket (64-bit hash of band and its values), node, n: one row per class and band."""
    width = 4 * ROWS
    parts = [F.substring("sig", 1 + width * b, width) for b in range(BANDS)]
    buckets = F.array(*[F.xxhash64(F.lit(b), part) for b, part in enumerate(parts)])
    return classes.select("node", "n", F.explode(buckets).alias("bucket"))


def _shared(members: DataFrame) -> DataFrame:
    """The members of buckets that hold two or more."""
    several = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("bucket")
    return members.join(several, "bucket")


def _by_size(members: DataFrame) -> DataFrame:
    """bucket, node: each bucket divided by size class; a set is in its own and in the next one.

    Linked sets are of the same class or of neighbouring ones, so they meet in one of the new buckets.
    """
    own = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(SIZE_STEP)))).cast("long")
    divided = members.select("bucket", "node", F.explode(F.array(own, own + 1)).alias("size"))
    return divided.select(F.xxhash64("bucket", "size").alias("bucket"), "node")


def components(edges: DataFrame, name: str) -> DataFrame:
    """node, component: the smallest node reachable, for every node with an edge (a, b).

    Large-star and small-star steps in turn: neighbours are linked to the smallest one, until every
    node points at one root and no root at another. Each step is written to the shared folder.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = stage(pairs.distinct(), name)
    while not _are_stars(pairs):
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        both = pairs.union(pairs.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        small = large.join(least, "u").select(moved.alias("u"), F.col("m").alias("v"))
        pairs = stage(small.where("u <> v").distinct(), name)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every u has one v only, and no v is a u: counted by node, combined before the shuffle."""
    above = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"))
    ends = above.union(pairs.select("v", F.lit(0)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return not seen.where("ups > 1 OR (ups = 1 AND least = 0)").head(1)


def against_hub(x: np.ndarray, hub: np.ndarray) -> tuple[bool, np.ndarray]:
    """(linked, shingles that only one of both holds) of a set and its hub, both sorted."""
    differ = np.setxor1d(x, hub, assume_unique=True)
    same = (len(x) + len(hub) - len(differ)) // 2
    return 100 * same >= SIMILARITY * (same + len(differ)), differ.view(np.int64)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b (a hub), n (size of a's set), linked, differ for each pair: see ``against_hub``."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))

    def compare(batches):
        for batch in batches:
            found = [
                against_hub(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                for x, y in zip(batch.column("sa"), batch.column("sb"))
            ]
            differ = pa.array([f[1] for f in found], pa.list_(pa.int64()))
            linked = pa.array([bool(f[0]) for f in found], pa.bool_())
            n = pa.array([len(x.as_buffer()) // 8 for x in batch.column("sa")], pa.int64())
            names = ["a", "b", "n", "linked", "differ"]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), n, linked, differ], names)

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "sa", "sb")
    return joined.mapInArrow(lean(compare), "a long, b long, n long, linked boolean, differ array<long>")


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, shingles (sorted hashes as bytes) of the documents named in ``nodes``, each set once."""

    def make(batches):
        for batch in batches:
            packed = [s.tobytes() for s in shingle_sets(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(packed, pa.binary())], ["node", "shingles"]
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    few = nodes.count() <= BROADCAST_IDS
    sets = texts.join(F.broadcast(nodes) if few else nodes, "node", "left_semi")
    sets = sets.mapInArrow(lean(make), "node long, shingles binary")
    return sets.withColumn("h", F.xxhash64("shingles")).dropDuplicates(["node", "h"]).drop("h")


def _central_hubs(members: DataFrame, stars: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b: every node of ``members`` with the hub that each of its buckets settles on.

    ``stars`` has a first hub for each bucket and ``pairs`` how its nodes compare with it. A hub weighs as
    many as are linked to it. A node takes the heaviest hub of its buckets, and a bucket the heaviest
    of its nodes', which needn't be in it. So the buckets of a group settle on the text that most derive from.
    """
    weight = pairs.groupBy(F.col("b").alias("hub")).agg(F.sum(F.col("linked").cast("long")).alias("weight"))
    # a node is in one bucket a band, so it is the first hub of as many at most; members meet the weight by bucket
    weighed = stars.join(weight, "hub", "left").fillna(0, ["weight"])
    heaviest = members.join(weighed, "bucket")
    for key in ("node", "bucket"):
        best = heaviest.groupBy(key).agg(F.max(F.struct("weight", (-F.col("hub")).alias("hub"))).alias("best"))
        best = best.select(key, F.col("best.weight").alias("weight"), (-F.col("best.hub")).alias("hub"))
        heaviest = members.join(best, key)
    settled = heaviest.select(F.col("node").alias("a"), F.col("hub").alias("b"))
    return settled.where("a <> b").distinct()


def _open_buckets(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """bucket, node, side, excess, reach: where links between components may still be, after ``pairs`` were compared.

    Let d_i be the number of shingles in which i differs from the hub h, p = 100 - SIMILARITY and
    q = 100 + SIMILARITY. As i and j differ where only one of them differs from h, they are linked if
    2q * (shingles in which both differ) >= e_i + e_j, where e_i = q * d_i - p * n_i is i's excess. For i not
    linked to h, e_i > p * n_h; for j linked to h, -p * n_h <= e_j <= p * n_h. So the sum is positive unless
    both are linked to h, that is connected, and there is a first common shingle from the rarest among the hub's
    sets to the most frequent. In the one of less excess it is followed by e_i / q - 1 others or more (side 1), in
    the other by (e_j + the hub's least) / 2q - 1 or more (side 2). A set linked to h only meets sets of more excess.
    What both have in common is bounded by what is left from that shingle on in either, so neither's excess
    goes beyond the other's ``reach``, 2q * left - e.
    """
    p, q = 100 - SIMILARITY, 100 + SIMILARITY
    label = found.select(F.col("node").alias("a"), F.col("component"))
    own = F.coalesce("component", "a").alias("component")
    excess = (q * F.size("differ") - p * F.col("n")).cast("long").alias("excess")
    members = pairs.join(label, "a", "left").select("a", "b", "linked", "differ", own, excess)
    several = members.groupBy("b").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.min("excess").alias("least")
    )
    members = members.join(several.where("x < y").select("b", "least"), "b")
    size = F.size("differ").alias("size")
    least_left = [
        F.greatest(F.ceil(e), F.lit(1)).alias(name)
        for name, e in (("first", F.col("excess") / q), ("second", (F.col("excess") + F.col("least")) / (2 * q)))
    ]
    # from here on a bucket is the hash of hub and shingle: grouped by both, a hub's sets would stay in one task
    spread = members.select("a", "b", "linked", "component", "excess", size, *least_left, F.explode("differ").alias("k"))
    spread = spread.withColumn("bucket", F.xxhash64("b", "k")).drop("k")
    often = spread.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("often"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    rarest = Window.partitionBy("a", "b").orderBy("often", "bucket")
    ranked = spread.join(often, "bucket").withColumn("left", F.col("size") - F.row_number().over(rarest) + 1)
    side = F.when(F.col("left") >= F.col("first"), 1).otherwise(0) + F.when(
        ~F.col("linked") & (F.col("left") >= F.col("second")), 2
    ).otherwise(0)
    ranked = ranked.where("x < y").withColumn("side", side).where("side > 0")
    reach = (2 * q * F.col("left") - F.col("excess")).alias("reach")
    return ranked.select("bucket", F.col("a").alias("node"), "side", "excess", reach)


def _unlinked(members: DataFrame, stars: DataFrame, pairs: DataFrame) -> DataFrame:
    """The members of buckets that hold a node not linked to the bucket's first hub."""
    apart = pairs.where("NOT linked").select(F.col("a").alias("node"), F.col("b").alias("hub"))
    ends = members.join(stars, "bucket").join(apart, ["node", "hub"]).select("bucket").distinct()
    return members.join(ends, "bucket")


def _still_open(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members, with their component, if any, that may be linked to one of another component.

    That is those in buckets of two components or more whose excess is within the reach of another side's and the other way round.
    """
    label = members.join(found, "node", "left")
    own = F.coalesce("component", "node")
    bounds = [
        f(F.when(F.col("side").bitwiseAND(side) > 0, F.col(c))).alias(f"{c}{side}")
        for side in (1, 2)
        for c, f in (("excess", F.min), ("reach", F.max))
    ]
    ends = label.groupBy("bucket").agg(F.min(own).alias("x"), F.max(own).alias("y"), *bounds)
    near = "((side & {0}) > 0 AND excess <= reach{1} AND reach >= excess{1})"
    kept = label.join(ends.where("x < y"), "bucket").where(f"{near.format(1, 2)} OR {near.format(2, 1)}")
    return kept.select("bucket", "node", "side", "excess", "reach", "component")


def _next_hubs(members: DataFrame, hubs: int) -> DataFrame:
    """bucket, hub, hub_side, hub_component: up to ``hubs`` of each bucket, unlinked ones first.

    In a bucket of one large component and a few single texts these are all that must be compared.
    """
    slot = F.pmod(F.xxhash64("node"), F.lit(hubs)).alias("slot")
    first = F.min(F.struct(F.col("component").isNotNull().alias("linked"), "node", "side", "excess", "reach", "component"))
    chosen = members.groupBy("bucket", slot).agg(first.alias("hub"))
    return chosen.select(
        "bucket",
        F.col("hub.node").alias("hub"),
        F.col("hub.side").alias("hub_side"),
        F.col("hub.excess").alias("hub_excess"),
        F.col("hub.reach").alias("hub_reach"),
        F.col("hub.component").alias("hub_component"),
    )


def _joined(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """The components after the linked ones of ``pairs`` are added."""
    links = pairs.where("linked").select("a", "b")
    if not links.head(1):
        return found
    known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(known.union(links), "near-components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Documents link if 100 * intersection >= 75 * union of their sets of 5-word shingles (A-Z lower-cased,
    split at ASCII white space; fewer words: the whole sequence). ``component_id`` is the smallest id
    reachable, ``kept`` marks it. A text without words has no shingle and no link. Rows that repeat an id
    are one document, linked by whatever any of them is linked to; each of them is returned. A row
    without an id takes no part: its component is null and it is kept.
    """
    every = stage(signatures(docs), "near-signatures")
    rows = every.where("n > 0 AND doc_id IS NOT NULL")
    # texts with the same set are one class, named by its smallest id
    classes = rows.groupBy("f1", "f2").agg(
        F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("sig").alias("sig")
    )
    classes = stage(classes, "near-classes")
    named = classes.select("f1", "f2", "node")
    member = stage(rows.join(named, ["f1", "f2"]).select("doc_id", "node"), "near-members")
    # an id with several texts ties their classes together
    several = member.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("c")).where("b < c")
    tied = member.join(several, "doc_id").where("node <> b")
    links = stage(tied.select(F.col("node").alias("a"), "b").distinct(), "near-links")
    members = _shared(_by_size(_shared(_banded(classes))))
    members = stage(members.select("bucket", "node").distinct(), "near-buckets")
    sets = stage(_sets(docs, stage(members.select("node").distinct(), "near-nodes")), "near-sets")
    found = components(links, "near-components")
    stars = stage(members.groupBy("bucket").agg(F.min("node").alias("hub")), "near-stars")
    pairs = members.join(stars, "bucket").where("node <> hub")
    pairs = pairs.select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    first = stage(_compared(pairs, sets), "near-pairs")
    members = stage(_unlinked(members, stars, first), "near-buckets")
    settled = stage(_central_hubs(members, stars, first), "near-settled")
    more = stage(_compared(settled.join(first.select("a", "b"), ["a", "b"], "left_anti"), sets), "near-pairs")
    both = first.unionByName(more)
    found = _joined(found, both)
    pairs = both.join(settled, ["a", "b"])
    members = stage(_still_open(_open_buckets(pairs, found), found), "near-buckets")
    hubs = 8
    while members.head(1):
        hub = stage(_next_hubs(members, hubs), "near-hubs")
        ends = members.join(hub, "bucket").where(
            "node <> hub AND (side | hub_side) = 3 AND NOT (component <=> hub_component AND component IS NOT NULL)"
            " AND excess <= hub_reach AND hub_excess <= reach"
        )
        pairs = ends.select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()
        found = _joined(found, stage(_compared(pairs, sets), "near-pairs"))
        # hubs are done; the rest of a bucket goes on while it lies in two components or more
        done = hub.select("bucket", F.col("hub").alias("node"))
        rest = members.drop("component").join(done, ["bucket", "node"], "left_anti")
        members = stage(_still_open(rest, found), "near-buckets")
        hubs *= 64
    label = member.distinct().join(found, "node", "left").groupBy("doc_id")
    label = label.agg(F.min(F.coalesce("component", "node")).alias("component"))
    out = every.select("doc_id", F.col("n").alias("n_shingles")).join(label, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that are the first of their group, with their own columns."""
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[quoted(c) for c in docs.columns])
