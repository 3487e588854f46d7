"""The two classifiers: accuracy on held-out rows, what they learn from, and awkward rows."""

import zlib

import numpy as np
import pytest
from plain import AWKWARD, SCHEMA, documents

from tidemark.llm import ngrams, quality, toxicity
from tidemark.llm.common import table

SF = "/root/testdata/sf0.1"
BOTH = [(toxicity, "toxic", 5, 0), (quality, "quality", 3, 1)]


@pytest.fixture(scope="module")
def models(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    return {m: m.fit(docs, labels) for m, *_ in BOTH}


def auc(score, y):
    rank = score.rank()
    up = y.sum()
    return (rank[y == 1].sum() - up * (up + 1) / 2) / (up * (len(y) - up))


@pytest.mark.parametrize("module, label, folds, fold", BOTH)
def test_held_out_rows(spark, models, module, label, folds, fold):
    docs = table(spark, SF, "documents").select("doc_id", "text").join(table(spark, SF, "labels"), "doc_id")
    got = module.score(docs, models[module]).select("doc_id", label, "score", "predicted").toPandas()
    held = got[got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % folds == fold)]
    assert len(held) > 500 and auc(held["score"], held[label]) > 0.97
    assert (held["predicted"] == held[label]).mean() > 0.95
    assert ((got["score"] >= 0.5) == (got["predicted"] == 1)).all() and got["score"].between(0, 1).all()


@pytest.mark.parametrize("module, label, folds, fold", BOTH)
def test_held_out_labels_change_nothing(spark, module, label, folds, fold):
    sf = "/root/testdata/sf0.001"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    changed = labels.selectExpr(
        "doc_id", *[f"IF(crc32(cast(string(doc_id) AS binary)) % {folds} = {fold}, 1 - {c}, {c}) AS {c}" for c in ("quality", "toxic")]
    )
    one, two = module.fit(docs, labels), module.fit(docs, changed)
    assert np.array_equal(one.weight, two.weight) and np.array_equal(one.index, two.index)


@pytest.mark.parametrize("module, label, folds, fold", BOTH)
def test_awkward_rows_get_a_score(spark, models, module, label, folds, fold):
    docs = documents(spark, AWKWARD)
    got = module.score(docs, models[module])
    assert got.schema["score"].dataType.typeName() == "double"
    rows = got.collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 2}) == 1
    assert module.score(spark.createDataFrame([], SCHEMA), models[module]).collect() == []


@pytest.mark.parametrize("module, label, folds, fold", BOTH)
def test_without_labels_or_with_one_class(spark, module, label, folds, fold):
    docs = documents(spark, [(i, f"text {i}", "a") for i in range(12)])
    schema = "doc_id long, quality int, toxic int"
    none = module.fit(docs, spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 7, 7)], schema))
    assert {r["score"] for r in module.score(docs, none).collect()} == {0.5}
    one = module.fit(docs, spark.createDataFrame([(i, 1, 1) for i in range(12)], schema))
    assert all(0.5 < r["score"] < 1 for r in module.score(docs, one).collect())


def test_a_long_text_counts_whole_and_each_feature_once():
    grams = ngrams.Grams(3, 5, lower=True)
    text = "abcdefgh " * (ngrams.RUN // 6) + "zebra"
    row, feature = grams.present([text, "zebra", None], None)
    assert set(feature[row == 1]) <= set(feature[row == 0])
    assert len(set(feature[row == 0])) == (row == 0).sum()


def test_sample_is_bounded_and_stable(spark):
    docs = documents(spark, [(i, f"text {i}", "a") for i in range(50)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    take = lambda: ngrams.labelled_sample(docs, labels, "toxic", lambda i: i >= 0, 20)
    assert sorted(take().collect()) == sorted(take().collect()) and take().count() == 20


def test_dual_descent_separates():
    starts, columns = np.array([0, 1, 2, 4, 6]), np.array([0, 1, 0, 2, 1, 2])
    weight, bias = quality.dual_descent(starts, columns, np.array([1, 0, 1, 0]), np.ones(3), cost=10.0)
    margin = [weight[columns[a:b]].sum() + bias for a, b in zip(starts[:-1], starts[1:])]
    assert margin[0] > 0 > margin[1] and margin[2] > 0 > margin[3]


def test_sample_is_drawn_from_ids_with_a_text(spark):
    """Labels of ids that the documents lack don't use up the sample, and a rare class fills its half."""
    docs = documents(spark, [(i, f"text {i % 90}", "a") for i in range(100)] + [(1, "again", "a")] * 30)
    labels = spark.range(100_000).selectExpr("id AS doc_id", "int(id % 10 = 0) AS toxic")
    got = ngrams.labelled_sample(docs, labels, "toxic", lambda i: i >= 0, 60).collect()
    assert len(got) == 60 and sum(r["y"] for r in got) == 10
    got = ngrams.labelled_sample(docs, labels, "toxic", lambda i: i >= 0, 12).collect()
    assert len(got) == 12 and sum(r["y"] for r in got) == 6


@pytest.mark.parametrize("module", [toxicity, quality])
def test_scores_equal_plain(spark, module):
    """The n-grams, features and scores of a few hundred texts, one at a time in plain Python."""
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = module.fit(docs, table(spark, sf, "labels"))
    got = {r["doc_id"]: r["score"] for r in module.score(docs, model).collect()}
    mask = 0xFFFFFFFF
    for doc_id, text in docs.collect():
        padded = " " + ((text or "").lower() if module.GRAMS.lower else text or "") + " " if text else " "
        seen = set()
        for n in range(module.GRAMS.least, module.GRAMS.most + 1):
            for at in range(len(padded) - n + 1):
                h = 0
                for c in padded[at : at + n]:
                    h = (h * 0x01000193 + ord(c)) & mask
                h = ((h ^ (h >> 15)) * 0x9E3779B1 + n) & mask
                seen.add(((h * 0x85EBCA6B) & mask) >> (32 - ngrams.BITS))
        z = sum(model.weight[model.index[h]] for h in seen if model.index[h] >= 0) + model.bias
        if module is quality:
            z = z * model.slope + model.shift
        assert got[doc_id] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -40, 40))), abs=1e-9)
