"""Byte-level BPE: encoding of long texts in overlapping chunks, and decoding.

Texts up to ``CHUNK`` characters are encoded where they are read. A longer text is cut into overlapping chunks
that become rows of their own, so its work is spread: chunks are pre-tokenised in parallel, neighbours are
stitched at the first pre-token start that both found in their overlap, and the pieces between these
points are encoded. Each match of the pattern is encoded by itself, so the ids don't depend on the cuts.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free_name, lean, quoted, with_arrow, without
from tidemark.session import stage

#: Characters of a chunk, without the overlap with the next one.
CHUNK = 1 << 16
OVERLAP = 1 << 10
#: Distinct pre-tokens whose ids a task remembers; beyond it, it starts afresh.
REMEMBERED = 1 << 17


class _Remembered(dict):
    """Ids of pre-tokens, as bytes, worked out at first use."""

    def __init__(self, plain):
        super().__init__()
        self.plain = plain

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = np.array(self.plain.encode_ordinary(piece), "<u4").tobytes()
        if len(piece) < 64:
            self[piece] = ids
        return ids


class Codec:
    """Vocabulary and pattern, loaded where they are used. ``ranks`` is the text of a rank file."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x)}
        self.pattern = regex.compile(pattern)
        self.bytes_of = {i: token for token, i in table.items()}
        self.plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.ids = _Remembered(self.plain)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return self.plain.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    def encode_range(self, text: str, start: int, end: int) -> bytes:
        """The ids of the pre-tokens that start in [start, end), a pre-token starting at ``start``."""
        out = []
        for match in self.pattern.finditer(text, start):
            if match.start() >= end:
                break
            out.append(self.ids[match.group()])
        return b"".join(out)

    def starts(self, text: str) -> np.ndarray:
        return np.array([m.start() for m in self.pattern.finditer(text)], np.int64)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(path: str) -> bytes:
    """The rank file, read once on the driver; tasks get its content and need no such path."""
    with open(path, "rb") as file:
        return file.read()


IDS = T.StructField("ids", T.BinaryType())
N_TOKENS = T.StructField("n_tokens", T.LongType())
DECODED = T.StructField("decoded", T.BinaryType())


def _once(ranks: bytes, pattern: str):
    """A function that returns the task's codec, made on first use."""
    made: list[Codec] = []

    def codec() -> Codec:
        if not made:
            made.append(Codec(ranks, pattern))
        return made[0]

    return codec


def encode(
    docs: DataFrame,
    ranks: bytes,
    pattern: str,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    decoded: bool = False,
) -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens``.

    Whole texts are encoded, without special tokens; a null or empty text has no token. Columns that are
    called ids or n_tokens already are replaced; rows that repeat are encoded one by one. With ``decoded``
    there is a column of that name too, as of ``decode``; short texts' ids are decoded by the worker that
    made them, which saves a second worker with its own vocabulary for each task.
    """
    added = [IDS, N_TOKENS, *([DECODED] if decoded else [])]
    source = without(docs, [f.name for f in added])
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    codec = _once(ranks, pattern)

    def make(texts: pa.Array) -> list[pa.Array]:
        ids = [codec().encode(t) if t else b"" for t in texts.to_pylist()]
        made = [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
        if decoded:
            made.append(pa.array([codec().decode(x) for x in ids], pa.binary()))
        return made

    short = with_arrow(source.where(~long), "text", make, added)
    key = free_name(source, "_key")
    keyed = source.where(long).withColumn(key, F.sha2(F.encode("text", "utf-8"), 256))
    ids = _encode_long(keyed.select(F.col(key).alias("_key"), "text"), ranks, pattern, chunk, overlap)
    joined = keyed.join(ids.withColumnRenamed("_key", key), key)
    joined = joined.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
    joined = joined.select(*[quoted(c) for c in source.columns], "ids", "n_tokens")
    return short.unionByName(decode(joined, ranks, pattern) if decoded else joined)


def _encode_long(texts: DataFrame, ranks: bytes, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """_key, ids for each distinct text."""
    codec = _once(ranks, pattern)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("_key").to_pylist(), batch.column("text").to_pylist()):
                at = list(range(0, len(text), chunk))
                parts = [text[a : a + chunk + overlap] for a in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(at)), pa.array(range(len(at)), pa.int64()), pa.array(parts)],
                    ["_key", "no", "part"],
                )

    def pre_tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for part in batch.column("part").to_pylist():
                starts = codec().starts(part)
                heads.append(starts[starts < overlap])
                tails.append(starts[starts >= chunk] - chunk)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, kind), pa.array(tails, kind)], [*batch.schema.names, "head", "tail"]
            )

    distinct = texts.groupBy("_key").agg(F.first("text").alias("text"))
    chunks = distinct.mapInArrow(lean(cut), "_key string, no long, part string").repartition("_key", "no")
    marked = chunks.mapInArrow(lean(pre_tokenise), "_key string, no long, part string, head array<long>, tail array<long>")
    marked = stage(marked, "bpe-chunks")
    runs = marked.select("_key", "no", "head", "tail").groupBy("_key").applyInPandas(
        stitch, "_key string, no long, run long, begin long, stop long"
    )
    pieces = marked.select("_key", "no", "part").join(runs, ["_key", "no"])

    def encode_run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("no")
        text = "".join([*(p[:chunk] for p in rows["part"].iloc[:-1]), rows["part"].iloc[-1]])
        stop = rows["stop"].iloc[-1]
        end = len(text) if stop < 0 else (len(rows) - 1) * chunk + chunk + int(stop)
        ids = codec().encode_range(text, int(rows["begin"].iloc[0]), end)
        return pd.DataFrame({"_key": rows["_key"].iloc[:1], "run": rows["run"].iloc[:1], "ids": [ids]})

    encoded = pieces.groupBy("_key", "run").applyInPandas(encode_run, "_key string, run long, ids binary")

    def concatenate(rows: pd.DataFrame) -> pd.DataFrame:
        ids = b"".join(map(bytes, rows.sort_values("run")["ids"]))
        return pd.DataFrame({"_key": rows["_key"].iloc[:1], "ids": [ids]})

    return encoded.groupBy("_key").applyInPandas(concatenate, "_key string, ids binary")


def stitch(chunks: pd.DataFrame) -> pd.DataFrame:
    """For the chunks of one text: the run each belongs to, and where its first and last piece lie.

    ``head`` has the pre-token starts of a chunk inside its overlap with the one before, ``tail`` those
    in the overlap with the next, both counted from the overlap's start. The first common one is a
    true start if the earlier chunk was true there. Without any, all chunks up to the text's end are one
    run that is tokenised in order. ``stop`` is -1 at the end of the text.
    """
    chunks = chunks.sort_values("no")
    begins, runs = [0], [0]
    head, tail = chunks["head"].tolist(), chunks["tail"].tolist()
    for i in range(1, len(chunks)):
        common = np.intersect1d(tail[i - 1], head[i]) if runs[-1] == i - 1 else []
        if len(common):
            begins.append(int(common[0]))
            runs.append(i)
        else:
            begins.append(0)
            runs.append(runs[-1])
    stops = [begins[i + 1] if i + 1 < len(runs) and runs[i + 1] == i + 1 else -1 for i in range(len(runs))]
    return pd.DataFrame({"_key": chunks["_key"], "no": chunks["no"], "run": runs, "begin": begins, "stop": stops})


def decode(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ids in a row. Null ids decode to nothing."""
    codec = _once(ranks, pattern)

    def make(ids: pa.Array) -> list[pa.Array]:
        return [pa.array([codec().decode(x) if x else b"" for x in ids.to_pylist()], pa.binary())]

    return with_arrow(encoded, "ids", make, [DECODED])
