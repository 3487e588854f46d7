"""Benchmark decontamination against a scan of all places."""

import re

import pytest
from plain import AWKWARD, SCHEMA, documents, lower

from tidemark.llm import decontaminate, queries, sql

ITEMS = [
    (1, "Alpha beta, gamma: delta epsilon zeta eta theta iota kappa lambda mu nu"),
    (2, "What is x?"),
    (3, "single"),
    (4, "one two three four five six seven"),
    (5, None),
    (6, " .,; "),
    (7, "beta gamma delta epsilon zeta eta theta iota kappa lambda"),
    (8, "la la la la la la la la la la la la"),
    (8, "another text of the same item number, with eleven words in it"),
    (10, "ÉÉ éé Straße 42 naïve ÄÖ x-y_z"),
    (None, "an item without a number that is long enough to count"),
]
TEXTS = [
    "before ALPHA beta gamma delta epsilon zeta eta theta iota kappa lambda mu after",
    "alpha beta gamma delta epsilon zeta eta theta iota nothing kappa lambda",
    "what is x? What-is... X and single",
    "one two three four five six seven one two three four five six seven",
    "one two three four five six",
    "la " * 500,
    "la " * 9,
    "ÉÉ éé Straße 42 naïve ÄÖ X y Z; éé éé straße 42 naïve äö x y z",
    "singleton un-single",
    "word " * 3000 + "beta gamma delta epsilon zeta eta theta iota kappa lambda " + "word " * 3000,
    "an item without a number that is long enough to count",
    "kappa lambda mu nu alpha beta",
]


def plain(docs, items):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = set()
    for i, t in items:
        w = find(t)
        windows |= {(i, tuple(w[k : k + 10])) for k in range(max(len(w) - 9, 1)) if w}
    out = []
    for i, t in docs:
        w, hit, held = find(t), set(), set()
        for item, window in windows:
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
                    held |= {item} - {None}
        out.append((i, len(w), sorted(hit), sorted(held)))
    return out


def run(docs, items):
    rows = decontaminate.contamination(docs, items).select("row.doc_id", "n_words", "spans", "item_ids").collect()
    return [(r[0], r[1], [x for b, e in r[2] for x in range(b, e)], r[3]) for r in rows]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id long, text string, window string, n int")


@pytest.mark.parametrize("run_bytes, bits", [(1 << 20, 26), (100, 6)])
def test_awkward_rows_equal_plain(spark, items, monkeypatch, run_bytes, bits):
    """Also with a text a run and a bitmap that nearly every shingle is in."""
    monkeypatch.setattr(decontaminate, "RUN", run_bytes)
    whole = decontaminate.bitmap
    monkeypatch.setattr(decontaminate, "bitmap", lambda hashes: whole(hashes, bits))
    rows = AWKWARD + [(100 + i, t, "z") for i, t in enumerate(TEXTS)]
    got = run(documents(spark, rows).repartition(3), items)
    want = plain([r[:2] for r in rows], ITEMS)
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(bool(r[2]) for r in want) >= 8


def test_spans_are_disjoint(spark, items):
    docs = documents(spark, [(1, "single single what is x single la " + "la " * 20, "a")])
    spans = decontaminate.contamination(docs, items).first()["spans"]
    assert [tuple(s) for s in spans] == [(0, 6), (6, 27)] or all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_empty_tables(spark, items):
    none = spark.createDataFrame([], SCHEMA)
    assert run(none, items) == []
    got = run(documents(spark, AWKWARD), items.limit(0))
    assert all(not hit and not held for _, _, hit, held in got) and len(got) == len(AWKWARD)


def test_contaminated_rows_go_and_clean_ones_stay(spark, items):
    docs = documents(spark, AWKWARD + [(100 + i, t, "z") for i, t in enumerate(TEXTS)])
    left = decontaminate.decontaminated(docs, items)
    bad = {i for i, _, hit, _ in plain(docs.select("doc_id", "text").collect(), ITEMS) if hit}
    assert left.columns == docs.columns
    assert sorted(r[0] or 0 for r in left.collect()) == sorted(i or 0 for i, _, _ in AWKWARD + [(100 + i, t, 0) for i, t in enumerate(TEXTS)] if i not in bad)


def test_windows_join_by_one_shingle(spark, items):
    """A window has one prefix, the rarest of its shingles."""
    windows = decontaminate.windows_of(items)
    shingles = decontaminate.window_shingles(windows)
    docs = documents(spark, [(1, ITEMS[0][1], "a"), (2, " ".join(ITEMS[0][1].split()[:9]), "a")])
    scanned = decontaminate.scan(docs, decontaminate.bitmap(shingles), [1, 3, 5])
    found = decontaminate.occurrences(scanned, shingles).collect()
    assert len(found) == len({(r["key"], r["window"], r["begin"]) for r in found}) == 4


def test_query_and_sql_are_registered():
    assert "op13_decontaminate" in queries.QUERIES and "op13_decontaminate" in sql.SQL
