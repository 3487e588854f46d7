"""Encoding against the public library, in chunks small enough to be stitched, and decoding."""

import base64

import numpy as np
import pytest
import tiktoken
from plain import AWKWARD, SCHEMA, documents
from pyspark.sql import functions as F

from tidemark.llm import bpe, queries

ODD = [
    "don't  stop\n\n\tnow " * 40,
    "a" * 400,  # one pre-token longer than any overlap
    " " * 300 + "end",
    "\n\t" * 150 + "x  \n y",
    "日本語のテキスト と emoji 🙂🙂 " * 20,
    "x" * 130 + " plain words follow here " * 10 + "'" * 90 + "s",
    "1234567890" * 30,
]


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary()


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks, pattern = vocabulary
    table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x)}
    return tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def ids(binary):
    return np.frombuffer(bytes(binary), "<u4").tolist()


@pytest.mark.parametrize("chunk, overlap", [(64, 24), (100, 10), (1 << 16, 1 << 10)])
def test_ids_do_not_depend_on_chunks(spark, vocabulary, library, chunk, overlap):
    texts = [t for _, t, _ in AWKWARD] + ODD
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(0, texts[0], "s")])
    encoded = bpe.encode(docs, *vocabulary, chunk=chunk, overlap=overlap)
    rows = bpe.decode(encoded, *vocabulary).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        want = library.encode_ordinary(texts[r["doc_id"]] or "")
        assert ids(r["ids"]) == want and r["n_tokens"] == len(want)
        assert bytes(r["decoded"]) == (texts[r["doc_id"]] or "").encode()


def test_both_ways_in_one_pass(spark, vocabulary):
    texts = [t for _, t, _ in AWKWARD] + ODD
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    apart = bpe.decode(bpe.encode(docs, *vocabulary, chunk=64, overlap=24), *vocabulary)
    at_once = bpe.encode(docs.withColumn("decoded", F.lit(1)), *vocabulary, chunk=64, overlap=24, decoded=True)
    assert sorted(map(tuple, at_once.collect())) == sorted(map(tuple, apart.collect()))


def test_empty_table(spark, vocabulary):
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.decode(bpe.encode(empty, *vocabulary), *vocabulary).collect() == []


def test_pre_tokens_one_by_one(vocabulary, library):
    codec = bpe.Codec(*vocabulary)
    for text in ODD:
        assert ids(codec.encode_range(text, 0, len(text))) == library.encode_ordinary(text)
