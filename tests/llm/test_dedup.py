"""Line and near deduplication against plain Python."""

import random

import pytest
from plain import AWKWARD, SCHEMA, deduped_lines, documents, near_components, shingles

from tidemark.llm import linededup, neardup
from tidemark.llm.common import table
from tidemark.session import stage

SF = "/root/testdata/sf0.001"


def ordered(rows):
    return sorted(rows, key=repr)


def test_lines_of_awkward_rows(spark):
    got = linededup.dedup_lines(documents(spark, AWKWARD)).select("doc_id", "text", "n_lines", "n_dropped")
    assert ordered(map(tuple, got.collect())) == ordered(deduped_lines([r[:2] for r in AWKWARD]))


def test_lines_of_the_test_table(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    got = linededup.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert ordered(map(tuple, got)) == ordered(deduped_lines([tuple(r) for r in docs.collect()]))


def test_a_line_held_by_many_blocks_of_documents(spark):
    rows = [(i, "the same line everywhere\nown line number %d" % i, "s") for i in range(0, 40_000, 400)]
    got = linededup.dedup_lines(documents(spark, rows))
    assert {r["doc_id"]: r["n_dropped"] for r in got.collect()} == {i: int(i > 0) for i, _, _ in rows}


def test_more_than_64_lines(spark):
    rows = [(1, "\n".join(f"line number {i:03d}" for i in range(0, 300, 3)), "s")]
    rows.append((2, "\n".join(f"line number {i:03d}" for i in range(300)), "s"))
    got = linededup.dedup_lines(documents(spark, rows)).select("doc_id", "text", "n_lines", "n_dropped")
    assert ordered(map(tuple, got.collect())) == ordered(deduped_lines([r[:2] for r in rows]))


def test_bitmaps_hold_words_with_drops_only(spark):
    rows = [(1, "line one of all\nline two of all", "s"), (2, "x\n" * 70 + "line two of all", "s")]
    marks = linededup.drop_bitmaps(documents(spark, rows)).collect()
    assert [(r["doc_id"], [(w["word"], w["bits"]) for w in r["words"]]) for r in marks] == [(2, [(1, 64)])]


def test_line_plan_runs_no_python(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    plan = linededup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "BroadcastNestedLoop" not in plan


@pytest.mark.parametrize("cut", [linededup.cut_repeated_lines, neardup.keep_first])
def test_columns_stay_and_an_empty_table_is_fine(spark, cut):
    empty = spark.createDataFrame([], SCHEMA)
    assert cut(empty).collect() == []
    assert cut(documents(spark, AWKWARD)).schema.names == empty.schema.names


def near(df):
    rows = neardup.near_duplicates(df).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows), key=repr)


def expected(rows):
    least = near_components(rows)
    out = [(i, len(shingles(t)), least.get(i), i is None or least[i] == i) for i, t in rows]
    return sorted(out, key=repr)


def test_near_duplicates_of_awkward_rows(spark):
    assert near(documents(spark, AWKWARD)) == expected([r[:2] for r in AWKWARD])


def test_near_duplicates_of_the_test_table(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    assert near(docs) == expected([tuple(r) for r in docs.collect()])


def test_a_large_group_with_links_of_all_strengths(spark):
    """Copies of one text with more and more words changed, copies of copies, and parts of it."""
    draw = random.Random(4)
    base = [f"w{draw.randrange(10_000)}" for _ in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        source = rows[draw.randrange(len(rows))][1].split() if rows and i % 5 == 0 else own
        own = list(source)
        for _ in range(draw.randrange(14)):
            own[draw.randrange(len(own))] = f"x{draw.randrange(100_000)}"
        if i % 11 == 0:
            own = own[: draw.randrange(60, 119)]
        rows.append((1000 - i, " ".join(own)))
    got = near(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == expected(rows)


def test_a_large_group_costs_no_square_of_comparisons(spark, monkeypatch):
    """Texts that differ from one base at many places, mostly too far for a link, with few replacements to draw from."""
    draw = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(400):
        own = list(base)
        for _ in range(draw.randrange(4, 12)):
            own[draw.randrange(len(own))] = f"x{draw.randrange(6)}"
        if i % 3 == 0:
            own = own[: draw.randrange(100, 149)]
        rows.append((i, " ".join(own)))
    compared = []

    def counted(df, name):
        out = stage(df, name)
        if name == "near-pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(neardup, "stage", counted)
    assert near(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)
    assert sum(compared) < 15 * len(rows)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(101, 100)], "a long, b long")
    got = {r["node"]: r["component"] for r in neardup.components(edges, "chain").collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_keep_first_keeps_one_of_each_group(spark):
    rows = [r[:2] for r in AWKWARD]
    kept = neardup.keep_first(documents(spark, AWKWARD))
    least = near_components(rows)
    want = sorted([i for i, _ in rows if i is None or least[i] == i], key=repr)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == want


@pytest.mark.parametrize("name", ["_id", "_drop", "_hash", "_gone", "marked", "row"])
def test_extra_columns_of_any_name(spark, name):
    line = "a line that several documents hold"
    rows = [(1, line + "\nfirst one", 7), (2, "second one\n" + line, 8)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, `{name}` int")
    assert {r["text"]: r[name] for r in linededup.dedup_lines(docs).collect()} == {rows[0][1]: 7, "second one": 8}
    assert {r["text"]: r[name] for r in linededup.cut_repeated_lines(docs).collect()} == {rows[0][1]: 7, "second one": 8}
    assert sorted(r[name] for r in neardup.keep_first(docs).collect()) == [7, 8]
