"""Targets, quotas and the mix."""

import random

import numpy as np
import pandas as pd
import pytest
from plain import AWKWARD, SCHEMA, documents, words

from tidemark.llm import mixing
from tidemark.llm.common import table


def test_targets_stop_at_three_times_the_size():
    goal = mixing.targets([("b", 1000), ("a", 10), (None, 500), ("c", 490)])
    assert goal["a"] == 30 and sum(goal.values()) == pytest.approx(2000)
    assert goal["b"] / goal["c"] == pytest.approx(2) and goal[None] / goal["c"] == pytest.approx(5)


def one_by_one(weights, limits, seats):
    out = [0] * len(weights)
    for _ in range(int(min(seats, sum(n for w, n in zip(weights, limits) if w > 0)))):
        open_ = [i for i in range(len(weights)) if out[i] < limits[i] and weights[i] > 0]
        best = max(open_, key=lambda i: (weights[i] / (2 * out[i] + 1), -i))
        out[best] += 1
    return out


def test_highest_quotients():
    draw = random.Random(1)
    for _ in range(200):
        n = draw.randrange(1, 8)
        weights = [draw.choice([0, 1, 2, 3, 5.5, 100]) for _ in range(n)]
        limits = [draw.randrange(0, 60) for _ in range(n)]
        seats = draw.randrange(0, 80)
        got = mixing.highest_quotients(np.array(weights), np.array(limits), seats)
        assert list(got) == one_by_one(weights, limits, seats), (weights, limits, seats)


def test_mix_of_the_test_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = mixing.mix(docs, carry=False).toPandas()
    size = {r["doc_id"]: len(words(r["text"])) for r in docs.collect()}
    assert dict(zip(got["doc_id"], got["size"])) == size
    assert (got["taken"] <= 3 * got["size"]).all()
    each = got.groupby("source").agg(size=("size", "sum"), own=("source_size", "max"), target=("target", "max"), taken=("taken", "sum"))
    assert (each["size"] == each["own"]).all() and each["target"].sum() == pytest.approx(sum(size.values()))
    assert ((each["taken"] - each["target"]).abs() < 0.02 * each["target"]).all()
    again = mixing.mix(docs.repartition(7), carry=False).toPandas()
    columns = ["doc_id", "taken"]
    assert got[columns].sort_values(columns).values.tolist() == again[columns].sort_values(columns).values.tolist()


def test_mixed_texts_hold_the_taken_words(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, carry=False).where("taken > 0").collect()}
    got = {}
    texts = {r["doc_id"]: words(r["text"]) for r in docs.collect()}
    rows = mixing.mixed_texts(docs)
    assert rows.schema.names == docs.schema.names
    for r in rows.collect():
        own = words(r["text"])
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(own)
        assert r["n_chars"] == len(r["text"]) and set(own) <= set(texts[r["doc_id"]])
    assert got == taken


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD)
    got = mixing.mix(docs).collect()
    assert len(got) == len(AWKWARD) and sum(r["size"] for r in got) == sum(len(words(t)) for _, t, _ in AWKWARD)
    assert {r["source"]: r["source_size"] for r in got}[None] == 3
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.mixed_texts(docs).schema.names == docs.schema.names
    assert sum(len(words(r["text"])) for r in mixing.mixed_texts(docs).collect()) == sum(r["taken"] for r in got)


def test_empty_table_and_texts_without_words(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).collect() == [] and mixing.mixed_texts(empty).collect() == []
    got = mixing.mix(documents(spark, [(1, None, "a"), (2, " ", "b")])).collect()
    assert [(r["taken"], r["target"]) for r in got] == [(0, 0.0)] * 2


@pytest.mark.parametrize("carry", [False, True])
def test_rows_without_words_meet_in_no_window(spark, carry):
    rows = [(i, None if i % 2 else " \n", "a") for i in range(400)] + [(i, "some words here", "b") for i in range(400, 500)]
    docs = documents(spark, rows)
    mixed = mixing.mix(docs, carry=carry)
    plan = mixed._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = plan[next(i for i, line in enumerate(plan) if "- Window [" in line) :]
    filters = [line for line in below if "Filter" in line]
    assert filters and "NOT" not in filters[0] and ("> 0" in filters[0] or "RLIKE" in filters[0])
    got = {r["doc_id"]: r for r in mixed.collect()}
    assert set(got) == set(range(500))
    assert all((got[i]["size"], got[i]["taken"], got[i]["passes"], got[i]["ranges"]) == (0, 0, 0, []) for i in range(400))
    assert all(got[i]["source_size"] == (300 if i >= 400 else 0) for i in range(500))


@pytest.mark.parametrize("sizes", [(300, 60, 700), (60, 500, 20), (5, 1, 2), (1000, 3000, 129)])
def test_small_sources_meet_their_targets(spark, sizes):
    rows, left = [], dict(zip("abc", sizes))
    for source, n in left.items():
        while n:
            own = min(n, 37)
            rows.append((len(rows), "word " * own, source))
            n -= own
    docs = documents(spark, rows)
    got = mixing.mix(docs).toPandas()
    each = got.groupby("source").agg(target=("target", "max"), taken=("taken", "sum"))
    assert ((each["taken"] - each["target"]).abs() <= 1).all(), each
    assert (got["taken"] <= 3 * got["size"]).all()
    assert sum(len(words(r["text"])) for r in mixing.mixed_texts(docs).collect()) == got["taken"].sum()


def test_plans_of_many_shards_meet_their_targets():
    draw = np.random.default_rng(3)
    for _ in range(50):
        words_ = draw.integers(0, draw.choice([50, 400, 100_000]), draw.integers(1, 40))
        goal = float(draw.uniform(0, 3) * words_.sum())
        plan = mixing.plan_shards({0: goal}, pd.DataFrame({"_n": 0, "_part": range(len(words_)), "words": words_}))
        taken = (plan["quota"] * plan["words"] / plan["blocks"])[words_ > 0].sum() + plan["rest"].sum()
        assert abs(taken - goal) <= 1, (words_, goal, taken)
        full = (plan["quota"] == 3 * plan["blocks"]) & (plan["rest"] > 0)
        assert (plan["quota"] <= 3 * plan["blocks"]).all() and not full.any()


def test_blocks_are_apportioned_to_sources_then_to_shards():
    shards = pd.DataFrame(
        {"_n": [0, 0, 0, 1, 1, 2, 3], "words": [5000, 4000, 130, 900, 800, 60, 0], "blocks": [39, 31, 1, 7, 6, 1, 1]}
    )
    target = {0: 8000.5, 1: 1900.0, 2: 180.0, 3: 0.0}
    words, blocks = [9130, 1700, 60], [71, 13, 1]
    wanted = [target[n] * b / w for n, (w, b) in enumerate(zip(words, blocks))] + [0.0]
    seats = one_by_one(wanted, [3 * b for b in blocks] + [3], int(sum(wanted)))
    want = one_by_one([5000, 4000, 130], [117, 93, 3], seats[0]) + one_by_one([900, 800], [21, 18], seats[1])
    want += one_by_one([60], [3], seats[2]) + [0]
    assert mixing.apportion(target, shards).tolist() == want and seats[3] == 0


@pytest.mark.parametrize("name", ["_n", "_source", "_words", "_part", "_begin", "others", "_turn"])
def test_extra_columns_of_any_name(spark, name):
    rows = [(1, "a b c", "s", 7), (2, "d e", "t", 8)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source string, `{name}` int")
    got = mixing.mix(docs).collect()
    assert {r["doc_id"]: r[name] for r in got} == {1: 7, 2: 8}
