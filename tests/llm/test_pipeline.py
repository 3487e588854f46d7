"""Each stage of the pipeline against a plain version on its own input, and the whole run."""

import hashlib

import numpy as np
import pytest
from plain import SCHEMA, AWKWARD, deduped_lines, documents, near_components, words

import corpus_pipeline
from tidemark.llm import mixing, queries, toxicity
from tidemark.llm.bpe import Codec
from tidemark.llm.common import table
from tidemark.session import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, SF, "documents")]
    for name, f in corpus_pipeline.STAGES:
        docs.append(stage(f(spark, docs[-1], SF), f"test-{name}"))
    return [[tuple(r) for r in d.collect()] for d in docs], [d.columns for d in docs]


def test_columns(steps):
    _, columns = steps
    assert all(c == columns[0] for c in columns[:-1])


def test_toxic_documents_go(spark, steps):
    model = toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    scored = toxicity.score(table(spark, SF, "documents"), model).collect()
    assert sorted(steps[0][1]) == sorted(tuple(r)[:5] for r in scored if r["predicted"] == 0)


def test_repeated_lines_go(steps):
    got = {r[0]: r[1] for r in steps[0][2]}
    assert got == {i: t for i, t, _, _ in deduped_lines([r[:2] for r in steps[0][1]])}


def test_one_of_each_group_stays(steps):
    least = near_components([r[:2] for r in steps[0][2]])
    assert sorted(steps[0][3]) == sorted(r for r in steps[0][2] if least[r[0]] == r[0])


def test_mix(spark, steps):
    frame = spark.createDataFrame(steps[0][3], table(spark, SF, "documents").schema)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(frame, carry=False).collect() if r["taken"]}
    got = {}
    for r in steps[0][4]:
        got[r[0]] = got.get(r[0], 0) + len(words(r[1]))
    assert got == taken


def test_encoding(steps):
    codec = Codec(*queries.vocabulary())
    want = []
    for r in steps[0][4]:
        ids = codec.encode(r[1])
        want.append((r[0], len(np.frombuffer(ids, "<u4")), hashlib.sha256(ids).hexdigest(), hashlib.sha256(r[1].encode()).hexdigest()))
    assert sorted(steps[0][5]) == sorted(want)


def test_run(spark, steps):
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(steps[0][5])


@pytest.mark.parametrize("rows", [[], AWKWARD])
def test_awkward_tables_pass_all_stages(spark, rows):
    docs = documents(spark, rows) if rows else spark.createDataFrame([], SCHEMA)
    for _, f in corpus_pipeline.STAGES:
        docs = stage(f(spark, docs, SF), "test-awkward")
    assert docs.columns[0] == "doc_id"
