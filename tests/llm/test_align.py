"""Cross-tokenizer alignment against a token-by-token version."""

from collections import Counter, defaultdict

import public_tokenizers
import pytest
from plain import AWKWARD, SCHEMA, documents

from tidemark.llm import queries, tokenalign
from tidemark.llm.common import table
from tidemark.session import stage

TEXTS = [
    "x ",
    " ",
    "  lead and  two   blanks ",
    "a literal ▁ sign",
    "<|endoftext|> <s> </s> <0x41> 's don't",
    "é" * 50 + " 日本語 テスト",
    "😀 😀x 👍🏽",
    "\x00 nul \x1c \x85   x   y 　 z  u",
    "line\n\n next\r\n\t tab \t x",
    "=" * 3000 + " " + " " * 900 + "-" * 1000,
    "nob" * 700,
]


@pytest.fixture(scope="module")
def files():
    return queries.vocabularies()


def plain(texts, files):
    """For each text n_a, n_b, n_groups, n_links, n_best, count_sum, groups, by whole texts and all pairs."""
    pair = tokenalign.Pair(files)
    spelled_a, spelled_b = pair.a_bytes.to_pylist(), pair.b_bytes.to_pylist()
    found = []
    for text in texts:
        a = pair.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pair.b.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if b"".join(spelled_a[i] for i in a) != want or b"".join(spelled_b[i] for i in b) != want:
            a, b = [], []
        ends = []
        for ids, spelled in ((a, spelled_a), (b, spelled_b)):
            at = 0
            ends.append([at := at + len(spelled[i]) for i in ids])
        cuts, stretches = sorted(set(ends[0]) & set(ends[1])), []
        for low, high in zip([0, *cuts], cuts):
            stretches.append([[i for i, e in zip(ids, end) if low < e <= high] for ids, end in zip((a, b), ends)])
        found.append((len(a), len(b), stretches))
    count = Counter(p for *_, g in found for p in {(x, y) for s, t in g for x in s for y in t})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for n_a, n_b, g in found:
        links = [(x, y) for s, t in g for x in s for y in t]
        said = ";".join(",".join(map(str, s)) + "|" + ",".join(map(str, t)) for s, t in g)
        of_best = sum(count[p] == best[p[0]] for p in links)
        out.append((n_a, n_b, len(g), len(links), of_best, sum(count[p] for p in links), said))
    return out


def run(docs, files):
    got = tokenalign.count_links(tokenalign.align(docs, files))
    return got.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()


def test_awkward_rows_equal_plain(spark, files, monkeypatch):
    monkeypatch.setattr(tokenalign, "BLOCK", 3000)  # several blocks a task, few remembered units
    monkeypatch.setattr(tokenalign, "REMEMBERED", 8)
    rows = AWKWARD + [(100 + i, t, "z") for i, t in enumerate(TEXTS)]
    got = run(documents(spark, rows).repartition(3), files)
    want = plain([t for _, t, _ in rows], files)
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got), key=key) == sorted(((r[0], *w) for r, w in zip(rows, want)), key=key)


def test_whole_small_table_equals_plain(spark, files):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = docs.collect()
    want = sorted((r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows], files)))
    assert sorted(map(tuple, run(docs.repartition(5), files))) == want


def test_empty_table_and_other_columns(spark, files):
    assert run(spark.createDataFrame([], SCHEMA), files) == []
    docs = spark.createDataFrame([("a b", 1, "k")], "text string, n_a int, block string")
    row = tokenalign.count_links(tokenalign.align(docs, files)).first()
    assert row["row"].asDict() == {"n_a": 1, "block": "k"} and row["n_a"] == 2
    only = tokenalign.count_links(tokenalign.align(docs.select("text"), files)).first()
    assert only["n_groups"] == 2


def test_pairs_are_counted_once_a_block(spark, files):
    """A pair that every document holds crosses the shuffle once for each block."""
    docs = spark.createDataFrame([(i, "the same words") for i in range(400)], "doc_id long, text string").coalesce(1)
    aligned = stage(tokenalign.align(docs, files), "test-align")
    assert aligned.where("size(keys) > 0").count() == aligned.select("block").distinct().count() == 1
    assert {r["n"] for r in tokenalign.pair_counts(aligned).collect()} == {400}


def test_other_vocabularies_are_refused(files):
    other = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    with pytest.raises((ValueError, KeyError)):
        tokenalign.Pair(tokenalign.Vocabularies(other, files.b_model))
