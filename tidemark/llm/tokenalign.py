"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and how often.

Spark cuts texts into units at single blanks, where both tokenizers must end a token. A task takes a bounded
run of documents (a block), makes the distinct units of its flattened lists and tokenises each unit once. Byte
offsets are segmented cumulative sums of token lengths; an Acero hash join on (unit, end) finds the
offsets where both end, and cumulative sums of these marks number the groups. Links of a document are its
units' links. Each block passes on one partial count per distinct id pair; Spark adds them up, joins the
sums back to the blocks that hold the pair, and a co-group by block adds them over each document's links.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import groups, quoted
from tidemark.session import stage

#: Bytes of text in a block, unless one document alone has more.
BLOCK = 1 << 21
#: Distinct units whose alignment a task remembers; beyond it, it starts afresh.
REMEMBERED = 1 << 19
#: Units that are encoded at a time, and how many of them stand in a row.
STRETCH, ROW = 1 << 13, 128
#: Bits of an id pair's key that hold the second id.
SHIFT = 20
#: A blank that ends a token in either vocabulary: what stands before it is neither white space nor a control.
CUT = r"(?<=[^\s\p{Z}\p{C}▁]) (?!\z)"


@dataclass(frozen=True)
class Vocabularies:
    """Both tokenizers, as the contents of their files. Workers need no path."""

    a_json: str
    b_model: bytes

    @staticmethod
    def read(a_path: str, b_path: str) -> Vocabularies:
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return Vocabularies(a.read(), b.read())


def _byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable Latin-1 is itself, the rest counts up from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, loaded in a task, the bytes of each of their ids, and the units met so far."""

    def __init__(self, files: Vocabularies):
        self.units: pa.Array = pa.array([], pa.string())
        self.known: Units | None = None
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.a_json)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        names = {i: name for name, i in self.a.get_vocab(with_added_tokens=False).items()}
        spelled = [bytes(letters[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.a_bytes = pa.array(spelled, pa.binary())
        self.a_length = np.array([len(x) for x in spelled])

        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b_model)
        pieces = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            single = self.b.is_byte(i)
            pieces.append(bytes([int(piece[3:5], 16)]) if single else piece.replace("▁", " ").encode())
        self.b_bytes = pa.array(pieces, pa.binary())
        kind = json.loads(files.a_json).get("pre_tokenizer") or {}
        inner = any("▁" in p.lstrip("▁") for p in map(self.b.id_to_piece, range(self.b.get_piece_size())))
        if kind.get("type") != "ByteLevel" or not kind.get("use_regex", True) or inner:
            raise ValueError("texts can't be cut at blanks for these vocabularies")

    def encode(self, units: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of blank + unit in A, and of the unit in B, which adds the blank itself."""
        a, b = [], []
        for start in range(0, len(units), STRETCH):
            some = units.slice(start, STRETCH)
            texts = some.to_pylist()
            a.append(self._encode_row(texts, np.asarray(pc.binary_length(some)).astype(np.int64) + 1))
            b.append(pa.array(self.b.encode(texts, num_threads=1), pa.list_(pa.int64())))
        none = pa.array([], pa.list_(pa.int64()))
        return pa.concat_arrays([*a, none]), pa.concat_arrays([*b, none])

    def _encode_row(self, texts: list[str], sizes: np.ndarray) -> pa.ListArray:
        """Ids of each blank + text in A, whose sizes in bytes are given.

        Many texts in a row are encoded as one, which costs less than each by itself. Tokens that end with
        every text are those that each would have alone; if not all do, each is encoded alone.
        """
        rows = [" " + " ".join(texts[i : i + ROW]) for i in range(0, len(texts), ROW)]
        encoded = self.a.encode_batch_fast(rows, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.int64) for e in encoded])
        ends, texts_end = np.cumsum(self.a_length[ids]), np.cumsum(sizes)
        cut = np.searchsorted(ends, texts_end, "right")
        if not (ends[np.maximum(cut - 1, 0)] == texts_end).all():
            alone = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
            return pa.array(alone, pa.list_(pa.int64()))
        return pa.ListArray.from_arrays(np.append(0, cut).astype(np.int32), pa.array(ids))

    def look_up(self, units: pa.Array) -> np.ndarray:
        """The place in ``known`` of each of the distinct ``units``; new ones are aligned first."""
        at = pc.index_in(units, value_set=self.units)
        if at.null_count:
            if len(self.units) + at.null_count > REMEMBERED:
                self.units, self.known, at = self.units[:0], None, pa.nulls(len(units), pa.int32())
            new = units.filter(at.is_null())
            found = align_units(new, self)
            self.known = found if self.known is None else self.known.extended(found)
            self.units = pa.concat_arrays([self.units, new])
            at = pc.index_in(units, value_set=self.units)
        return np.asarray(at).astype(np.int64)


def _segment_ends(lists: pa.ListArray, lengths: pa.Array) -> pa.Array:
    """Running sum of ``lengths`` (one for each flattened element) that starts anew with each list."""
    total = pc.cumulative_sum(lengths)
    starts = np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()
    before = np.concatenate([[0], np.asarray(total)])[starts]
    return pc.subtract(total, pa.array(before).take(lists.value_parent_indices().cast(pa.int64())))


def _spelled(lists: pa.ListArray, names: pa.Array) -> pa.Array:
    """The bytes of each list's ids in a row."""
    parts = pa.ListArray.from_arrays(lists.offsets, names.take(lists.values))
    return pc.binary_join(parts, b"")


def _sums(keys: list, keyed: pa.Table, value: str) -> pa.Table:
    return keyed.group_by(keys, use_threads=False).aggregate([(value, "sum")])


@dataclass
class Units:
    """What is known of each distinct unit: whether both vocabularies spell it, counts, groups, pairs."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    text: pa.Array
    pairs: pa.Table  # unit, key, links

    def extended(self, more: Units) -> Units:
        moved = more.pairs.set_column(0, "unit", pc.add(more.pairs["unit"], len(self.good)))
        both = [np.concatenate([getattr(self, c), getattr(more, c)]) for c in ("good", "n_a", "n_b", "n_groups")]
        return Units(*both, pa.concat_arrays([self.text, more.text]), pa.concat_tables([self.pairs, moved]))


def align_units(units: pa.Array, pair: Pair) -> Units:
    """Tokenise and align distinct units, all of them in one set of Arrow operations."""
    a, b = pair.encode(units)
    want = pc.binary_join_element_wise(pa.scalar(b" "), units.cast(pa.binary()), pa.scalar(b""))
    good = np.asarray(pc.and_(pc.equal(_spelled(a, pair.a_bytes), want), pc.equal(_spelled(b, pair.b_bytes), want)))
    a, b = (pc.if_else(pa.array(good), x, pa.scalar([], x.type)) for x in (a, b))
    sides = []
    for lists, names in ((a, pair.a_bytes), (b, pair.b_bytes)):
        ids = lists.flatten()
        unit = lists.value_parent_indices().cast(pa.int64())
        flat = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lists.value_lengths())]).astype(np.int32), ids)
        end = _segment_ends(flat, pc.binary_length(names.take(ids)).cast(pa.int64()))
        sides.append((ids, unit, end))
    (a_ids, a_unit, a_end), (b_ids, b_unit, b_end) = sides
    left = pa.table({"unit": a_unit, "end": a_end, "i": np.arange(len(a_ids))})
    right = pa.table({"unit": b_unit, "end": b_end, "j": np.arange(len(b_ids))})
    both = left.join(right, ["unit", "end"], join_type="inner", use_threads=False)
    a_last, b_last = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_last[both["i"].to_numpy()], b_last[both["j"].to_numpy()] = 1, 1
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last  # marks before the token
    ends = np.flatnonzero(a_last)
    unit_of = np.asarray(a_unit)[ends]  # of each group

    counts = [
        pa.table({"group": g, name: ids, "n": np.ones(len(g), np.int64)}).group_by(["group", name], use_threads=False)
        for g, name, ids in ((a_group, "a", a_ids), (b_group, "b", b_ids))
    ]
    held_a = counts[0].aggregate([("n", "sum")]).rename_columns(["group", "a", "n_a"])
    held_b = counts[1].aggregate([("n", "sum")]).rename_columns(["group", "b", "n_b"])
    linked = held_a.join(held_b, "group", join_type="inner", use_threads=False)
    key = pc.bit_wise_or(pc.shift_left(linked["a"], SHIFT), linked["b"])
    links = pc.multiply(linked["n_a"], linked["n_b"])
    unit = unit_of[linked["group"].to_numpy()] if len(linked) else np.empty(0, np.int64)
    pairs = _sums(["unit", "key"], pa.table({"unit": unit, "key": key, "links": links}), "links")

    def joined(ids: pa.Array, last: np.ndarray) -> pa.Array:
        cut = np.concatenate([[0], np.flatnonzero(last) + 1]).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(cut, ids.cast(pa.string())), ",")

    n_groups = np.bincount(unit_of, minlength=len(units))
    each = pc.binary_join_element_wise(joined(a_ids, a_last), joined(b_ids, b_last), "|")
    text = pc.binary_join(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n_groups)]).astype(np.int32), each), ";")
    size = lambda x: np.bincount(np.asarray(x), minlength=len(units))
    return Units(good, size(a_unit), size(b_unit), n_groups, text, pairs.rename_columns(["unit", "key", "links"]))


def align_block(units: pa.ListArray, pair: Pair) -> dict[str, pa.Array]:
    """The result columns of a block of documents, given their units (null or empty: no tokens).

    ``pair_at`` and ``pair_links`` list a document's distinct id pairs, as places in ``keys``, and how often
    each is linked; ``keys`` and ``key_docs`` (documents of the block that hold it) are those of the
    whole block, in its first row.
    """
    n = len(units)
    flat = pc.list_flatten(units)
    doc = np.asarray(pc.list_parent_indices(units)).astype(np.int64)
    coded = flat.dictionary_encode()
    place = pair.look_up(coded.dictionary)
    at, known = place[np.asarray(coded.indices)], pair.known or align_units(coded.dictionary, pair)
    count = lambda of: np.bincount(doc, weights=of, minlength=n).astype(np.int64)
    n_units = count(np.ones(len(doc)))
    good = (count(known.good[at]) == n_units) & (n_units > 0)

    per_doc = pa.table({"doc": doc, "unit": at, "times": np.ones(len(doc), np.int64)})
    per_doc = _sums(["doc", "unit"], per_doc.filter(good[doc]), "times")
    used = np.zeros(len(known.good), bool)
    used[place] = True
    pairs = known.pairs.filter(used[known.pairs["unit"].to_numpy()])
    held = per_doc.join(pairs, "unit", join_type="inner", use_threads=False)
    held = held.append_column("n", pc.multiply(held["links"], held["times_sum"]))
    held = _sums(["doc", "key"], held, "n").sort_by([("doc", "ascending"), ("key", "ascending")]).combine_chunks()
    key, links = held["key"].combine_chunks(), held["n_sum"].combine_chunks()
    keys = key.dictionary_encode()
    docs_of = pa.table({"key": key, "docs": np.ones(len(key), np.int64)})
    partial = _sums(["key"], docs_of, "docs")
    place = pc.index_in(keys.dictionary, partial["key"].combine_chunks())
    key_docs = partial["docs_sum"].combine_chunks().take(place)

    per = np.bincount(held["doc"].to_numpy(), minlength=n)
    cut = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
    unit_cut = np.concatenate([[0], np.cumsum(n_units)]).astype(np.int32)
    text = pc.binary_join(pa.ListArray.from_arrays(unit_cut, known.text.take(pa.array(at))), ";")
    n_links = np.add.reduceat(np.append(links.to_numpy(), 0), cut[:-1]) * (per > 0) if n else np.empty(0, np.int64)
    first = lambda x: pa.array([x.tolist() if x is not None else None] + [None] * (n - 1), pa.list_(pa.int64()))
    return {
        "n_a": pa.array(count(known.n_a[at]) * good),
        "n_b": pa.array(count(known.n_b[at]) * good),
        "n_groups": pa.array(count(known.n_groups[at]) * good),
        "n_links": pa.array(n_links, pa.int64()),
        "groups": pc.if_else(pa.array(good), text, ""),
        "pair_at": pa.ListArray.from_arrays(cut, keys.indices.cast(pa.int32())),
        "pair_links": pa.ListArray.from_arrays(cut, links),
        "keys": first(keys.dictionary.to_numpy()) if n else pa.array([], pa.list_(pa.int64())),
        "key_docs": first(key_docs.to_numpy()) if n else pa.array([], pa.list_(pa.int64())),
    }


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
#: Columns of ``align`` that ``count_links`` uses up.
INNER = ("block", "pair_at", "pair_links", "keys", "key_docs")


def align(docs: DataFrame, files: Vocabularies) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text``, as one struct) and the alignment of each text.

    n_a, n_b: tokens; n_groups: stretches between offsets where both vocabularies end a token; n_links:
    occurrence pairs that share a group; ``groups``: ids in order, ``a1,a2|b1;a3|b2,b3``. The
    columns in INNER are for ``count_links``.

    Texts that are null or empty, or that a vocabulary doesn't spell byte for byte, have no tokens: zeros and
    an empty string. Whole texts count, each unit once per task however often it occurs. Rows that
    repeat are rows of their own, also those without an id. One pass without a shuffle.
    """
    kept = [quoted(c) for c in docs.columns if c.lower() != "text"]
    units = F.when(F.col("text") != "", F.split("text", CUT, -1)).alias("units")
    source = docs.select(F.struct(*(kept or [F.lit(0).alias("none")])).alias("row"), units)
    longs = [T.StructField(c, T.LongType()) for c in COUNTS]
    schema = T.StructType(
        [
            source.schema["row"],
            *longs,
            T.StructField("groups", T.StringType()),
            T.StructField("pair_at", T.ArrayType(T.IntegerType())),
            *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("pair_links", "keys", "key_docs")],
            T.StructField("block", T.LongType()),
        ]
    )
    loaded: list[Pair] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not loaded:
                loaded.append(Pair(files))
            whole = batch.column("units")
            before = np.concatenate([[0], np.cumsum(pc.binary_length(whole.values), dtype=np.int64)])
            sizes = np.diff(before[np.asarray(whole.offsets)])
            for start, stop in groups((sizes + 64).tolist(), BLOCK):
                found = align_block(whole.slice(start, stop - start), loaded[0])
                found["block"] = pa.array(np.full(stop - start, number))
                number += 1
                names = ["row", *found]
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(start, stop - start), *found.values()], names)
                pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """block, at, key, n (documents that hold the pair linked), best: n is the highest of its A id."""
    of_block = aligned.where("size(keys) > 0").select(
        "block", F.posexplode(F.arrays_zip("keys", "key_docs")).alias("at", "pair")
    )
    of_block = of_block.select("block", "at", F.col("pair.keys").alias("key"), F.col("pair.key_docs").alias("docs"))
    counts = of_block.groupBy("key").agg(F.sum("docs").alias("n"))
    counts = counts.withColumn("a", F.shiftright("key", SHIFT))
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    marked = counts.join(highest, "a").select("key", "n", (F.col("n") == F.col("most")).alias("best"))
    return of_block.join(marked, "key").select("block", "at", "key", "n", "best")


def count_links(aligned: DataFrame) -> DataFrame:
    """The rows of ``align`` with n_best and count_sum instead of INNER; other columns pass through.

    An id pair's count is the number of documents (rows) of the whole table that hold it linked. n_best
    counts a document's links whose count is the highest of their A id, ties included; count_sum adds the
    counts of all its links. A pair that a third of all documents hold is one row per block.
    """
    aligned = stage(aligned, "token-alignment")
    kept = [f for f in aligned.schema.fields if f.name not in INNER]
    schema = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def add(docs: pa.Table, counts: pa.Table) -> pa.Table:
        counts = counts.sort_by("at").combine_chunks()
        at = docs["pair_at"].combine_chunks()
        links = pc.list_flatten(docs["pair_links"].combine_chunks())
        flat = pc.list_flatten(at)
        n = counts["n"].combine_chunks().take(flat) if len(flat) else pa.array([], pa.int64())
        best = counts["best"].combine_chunks().take(flat) if len(flat) else pa.array([], pa.bool_())
        linked = pa.table(
            {
                "doc": pc.list_parent_indices(at).cast(pa.int64()),
                "n_best": pc.if_else(best, links, pa.scalar(0, pa.int64())),
                "count_sum": pc.multiply(links, n),
            }
        )
        sums = linked.group_by("doc", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
        out = [docs[f.name] for f in kept]
        for c in ("n_best", "count_sum"):
            all_docs = np.zeros(len(docs), np.int64)
            all_docs[sums["doc"].to_numpy()] = sums[f"{c}_sum"].to_numpy()
            out.append(pa.array(all_docs))
        return pa.table(out, [f.name for f in schema.fields])

    left = aligned.select(*[f.name for f in kept], "block", "pair_at", "pair_links").groupBy("block")
    counted = pair_counts(aligned).select(F.col("block").alias("of_block"), "at", "n", "best")
    right = counted.groupBy("of_block")
    return left.cogroup(right).applyInArrow(add, schema)
