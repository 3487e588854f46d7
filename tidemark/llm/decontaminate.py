"""Benchmark decontamination: which passages of documents hold a window of a benchmark item.

A prefix-filtered join. A window (ten consecutive words of an item, or all of a shorter item) is a set of word
shingles, and a document holds the window only if it holds all of them. So one shingle is a
sufficient prefix: the window's rarest one by the number of documents that hold it. Documents emit
the shingles that occur in any window, found by a bitmap of fixed size, with the words around them. Hits of
prefix shingles are joined with their windows, bounded by position and length, and verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import groups, lower_ascii, quoted
from tidemark.llm.shingles import mix64, powers, random_bytes
from tidemark.session import stage

WINDOW = 10
#: Words of a shingle; a shorter window is one shingle.
SHINGLE = 5
#: Bits of the bitmap that stands for all windows' shingles: 8 MB whatever the benchmark's size.
BITS = 26
#: Words of a piece of text that is passed on around hits.
PIECE = 64
#: Bytes of text hashed at a time; a longer text is hashed alone.
RUN = 1 << 20

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_INSIDE = np.ones(256, bool)
_INSIDE[:128] = [chr(b).isalnum() for b in range(128)]
_VALUE = random_bytes(13)
_VALUE[65:91] = _VALUE[97:123]
_BASE = 0xA24BAED4963EE407  # odd, so it has an inverse modulo 2^64


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte after the last) of each word of UTF-8 bytes."""
    inside = np.concatenate([[False], _INSIDE[data], [False]])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = turn[::2], turn[1::2]
    up = powers(_BASE, len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[data] * up[: len(data)], dtype=np.uint64)])
    back = powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
    return mix64((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64)), begin, end


def hash_shingles(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` words that start at each place."""
    if len(words) < n:
        return words[:0]
    total = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[j : j + len(total)]
    return mix64(total)


def windows_of(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item_id, window (its words, joined by a blank), length: the distinct windows of every item."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where("size(words) > 0")
    last = F.greatest(F.size("words") - size, F.lit(0))
    each = items.select("item_id", "words", F.explode(F.sequence(F.lit(1), last + 1)).alias("at"))
    window = F.slice("words", F.col("at"), size)
    return each.select(
        "item_id", F.array_join(window, " ").alias("window"), F.size(window).alias("length")
    ).distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """window, length, offset, hash: the shingles of each distinct window, at their place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, hashes = [], []
            for text, n in zip(batch.column("window").to_pylist(), batch.column("length").to_pylist()):
                found = hash_shingles(hash_words(np.frombuffer(text.encode(), np.uint8))[0], min(n, SHINGLE))
                hashes.append(found.view(np.int64))
                offsets.append(np.arange(len(found), dtype=np.int32))
            lists = [pa.array(offsets, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, "offsets", "hashes"])

    schema = "window string, length int, offsets array<int>, hashes array<long>"
    listed = windows.select("window", "length").distinct().mapInArrow(run, schema)
    each = listed.select("window", "length", F.explode(F.arrays_zip("offsets", "hashes")).alias("s"))
    return each.select("window", "length", F.col("s.offsets").alias("offset"), F.col("s.hashes").alias("hash"))


def bitmap(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """One bit for each value of the hashes' top ``bits`` bits; at most 2^bits / 64 words reach the driver."""
    top = F.shiftrightunsigned("hash", 64 - bits)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (top % 64).cast("int"))
    rows = hashes.groupBy(F.floor(top / 64).alias("word")).agg(F.bit_or(one).alias("bits")).toPandas()
    found = np.zeros(1 << (bits - 6), np.uint64)
    found[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return found


#: A-Z to a-z, and no other letter.
LOWER = {i: i + 32 for i in range(65, 91)}


def pieces(at: np.ndarray, hashes: np.ndarray, least: np.ndarray, most: np.ndarray, say) -> list[dict]:
    """A text's hits dealt to pieces of ``PIECE`` words or less, each of which holds its hits' surroundings."""
    found, i = [], 0
    while i < len(at):
        first = int(least[i])
        j = i + max(1, int(np.searchsorted(most[i:], first + PIECE, "right")))
        hits = [{"place": p, "hash": h} for p, h in zip((at[i:j] - first).tolist(), hashes[i:j].tolist())]
        found.append({"first": first, "words": say(first, int(most[j - 1])), "hits": hits})
        i = j
    return found


def scan(docs: DataFrame, marks: np.ndarray, lengths: list[int], window: int = WINDOW) -> DataFrame:
    """The columns of ``docs`` but ``text``, as ``row``, with key, n_words and ``pieces`` of each text.

    Pieces hold the shingles in the bitmap: first (number of the piece's first word), words, and hits as
    (place in the piece, hash), with all words around a hit that a window with it can reach.
    """
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    bits = int(np.log2(len(marks))) + 6

    def hits_of(words: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, ...]:
        """(place, hash, least, most) of the shingles of all texts in the bitmap; ``cut``: the texts' first words."""
        found = []
        for n in lengths:
            hashes = hash_shingles(words, n)
            top = hashes >> np.uint64(64 - bits)
            held = (shared.value[(top >> np.uint64(6)).astype(np.int64)] >> (top & np.uint64(63))) & np.uint64(1)
            at = np.flatnonzero(held)
            own = np.searchsorted(cut, at, "right") - 1
            inside = at + n <= cut[own + 1]
            at, own = at[inside], own[inside]
            least, most = np.maximum(at - (window - n), cut[own]), np.minimum(at + window, cut[own + 1])
            found.append((at, hashes[at].view(np.int64), least, most))
        at, hashes, least, most = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((hashes, most, at))
        return at[order], hashes[order], np.minimum.accumulate(least[order][::-1])[::-1], np.maximum.accumulate(most[order])

    kind = pa.list_(
        pa.struct(
            [
                ("first", pa.int64()),
                ("words", pa.list_(pa.string())),
                ("hits", pa.list_(pa.struct([("place", pa.int32()), ("hash", pa.int64())]))),
            ]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for a, b in groups([n + 1 for n in sizes], RUN):
                raw = [t.encode() if t else b"" for t in batch.column("text").slice(a, b - a).to_pylist()]
                data = b" ".join(raw) + b" "
                words, begin, end = hash_words(np.frombuffer(data, np.uint8))
                cut = np.searchsorted(begin, np.cumsum([0, *(len(r) + 1 for r in raw)]))
                hits = hits_of(words, cut)
                each: list[list[dict]] = [[] for _ in raw]
                of = np.searchsorted(cut, hits[0], "right") - 1
                for k in np.unique(of).tolist():
                    i, j = np.searchsorted(of, [k, k + 1])
                    start = int(cut[k])

                    def say(x: int, y: int) -> list[str]:
                        ends = zip(begin[start + x : start + y].tolist(), end[start + x : start + y].tolist())
                        return [data[u:v].decode().translate(LOWER) for u, v in ends]

                    at, hashes, least, most = (h[i:j] for h in hits)
                    each[k] = pieces(at - start, hashes, np.maximum(least, start) - start, np.minimum(most, cut[k + 1]) - start, say)
                columns = [
                    batch.column("row").slice(a, b - a),
                    pa.array(np.arange(key, key + b - a)),
                    pa.array(np.diff(cut).astype(np.int64)),
                    pa.array(each, kind),
                ]
                key += b - a
                yield pa.RecordBatch.from_arrays(columns, ["row", "key", "n_words", "pieces"])

    kept = [quoted(c) for c in docs.columns if c.lower() != "text"]
    source = docs.select(F.struct(*(kept or [F.lit(0).alias("none")])).alias("row"), "text")
    hit = "array<struct<place: int, hash: bigint>>"
    schema = f"key long, n_words long, pieces array<struct<first: bigint, words: array<string>, hits: {hit}>>"
    return source.mapInArrow(run, T.StructType([source.schema["row"], *T.StructType.fromDDL(schema).fields]))


def occurrences(scanned: DataFrame, shingles: DataFrame) -> DataFrame:
    """key, window, length, begin: where a document holds a window, verified word by word.

    ``shingles`` is ``window_shingles``. Rarity is the number of documents that hold a shingle, over all of them;
    a window with a shingle that no document holds is out.
    """
    hits = scanned.select("key", F.explode("pieces").alias("p")).select("key", "p.*")
    hits = hits.select("key", "first", "words", F.explode("hits").alias("hit"))
    start = F.greatest(F.col("hit.place") - WINDOW, F.lit(0))
    hits = hits.select(
        "key",
        F.col("hit.hash").alias("hash"),
        (F.col("first") + start).alias("first"),
        (F.col("hit.place") - start).alias("place"),
        F.slice("words", start + 1, 2 * WINDOW).alias("words"),
    )
    in_text = F.array_distinct(F.flatten(F.transform("pieces", lambda p: p["hits"]["hash"])))
    held = scanned.select(F.explode(in_text).alias("hash")).groupBy("hash").agg(F.count("*").alias("n"))
    by_window = shingles.join(held, "hash", "left").groupBy("window", "length")
    rarest = by_window.agg(
        F.min_by(F.struct("hash", "offset"), F.struct("n", "hash", "offset")).alias("prefix"),
        F.count("n").alias("found"),
        F.count("*").alias("all"),
    )
    prefixes = rarest.where("found = all").select("window", "length", "prefix.*")
    near = hits.join(prefixes, "hash")
    placed = near.withColumn("begin", F.col("place") - F.col("offset"))  # in the run
    bounded = placed.where((F.col("begin") >= 0) & (F.col("begin") + F.col("length") <= F.size("words")))
    same = F.array_join(F.slice("words", F.col("begin") + 1, F.col("length")), " ") == F.col("window")
    return bounded.where(same).select("key", "window", "length", (F.col("first") + F.col("begin")).alias("begin"))


def spans(found: DataFrame) -> DataFrame:
    """key, begin, end: the words of each document that any occurrence covers, as disjoint stretches."""
    reach = found.groupBy("key", "begin").agg(F.max(F.col("begin") + F.col("length")).alias("end"))
    order = Window.partitionBy("key").orderBy("begin")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = reach.withColumn("new", F.when(F.coalesce(before < F.col("begin"), F.lit(True)), 1).otherwise(0))
    numbered = marked.withColumn("span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("key", "span").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).drop("span")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text``, as one struct), n_words, spans and item_ids.

    ``spans`` lists the stretches of hit words as (begin, end), counted from 0 in words, ``item_ids`` the items
    with a window in the text. Both are empty for a clean document, and for a null text, which has no
    words. Items without words, or with a null text, have no window; items that repeat an id are one. Rows that
    repeat are rows of their own. Whole texts count on both sides.
    """
    windows = stage(windows_of(benchmark), "benchmark-windows")
    shingles = stage(window_shingles(windows), "benchmark-shingles")
    lengths = sorted(min(r[0], SHINGLE) for r in windows.where(f"length < {SHINGLE}").select("length").distinct().collect())
    scanned = stage(scan(docs, bitmap(shingles), [*lengths, SHINGLE]), "decontamination-scan")
    found = stage(occurrences(scanned, shingles), "decontamination-found")
    covered = spans(found).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    items = found.select("key", "window").distinct().join(windows.select("window", "item_id"), "window")
    held = items.where("item_id IS NOT NULL").groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    hit = covered.join(held, "key", "left")
    columns = scanned.select("key", "row", "n_words", (F.size("pieces") > 0).alias("near"))
    clean = columns.where("NOT near").select("*", *[F.lit(None).cast(hit.schema[c].dataType).alias(c) for c in hit.columns[1:]])
    every = columns.where("near").join(hit, "key", "left").unionByName(clean)  # only texts with hits are shuffled
    none = F.array().cast("array<struct<begin: bigint, end: bigint>>")
    ids = F.array().cast(f"array<{windows.schema['item_id'].dataType.simpleString()}>")
    return every.select(
        "row", "n_words", F.coalesce("spans", none).alias("spans"), F.coalesce("item_ids", ids).alias("item_ids")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` but those whose ``key`` belongs to a text with a hit word. A null key stays."""
    bad = contamination(docs.select(key, "text"), benchmark).where("size(spans) > 0").select(f"row.{key}").distinct()
    return docs.join(bad, key, "left_anti")
