"""Plain Python versions of what the operators compute, and small tables with awkward rows."""

from __future__ import annotations

import re
from collections import defaultdict

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score string, SIZE string, n_lines string, ids string, kept string"
)


def documents(spark, rows):
    """(doc_id, text, source) with further columns, some named like those that operators add."""
    full = [
        (i, t, None if i is None else "en", s, None if t is None else len(t), "x", "y", "z", None, "k")
        for i, t, s in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


SHARED = "this passage of more than ten letters occurs in several documents"
AWKWARD = [
    (1, "One line here\n" + SHARED + "\n\nend", "a"),
    (2, SHARED.upper() + "  \nshort\nshort", "a"),
    (2, SHARED.upper() + "  \nshort\nshort", "a"),
    (3, None, "b"),
    (4, "", None),
    (5, " \t \n ", "b"),
    (6, "word " * 4000, "c"),
    (7, "word " * 4000 + "more", "c"),
    (8, "a b c", "c"),
    (9, "A  B\nC", "c"),
    (None, "a b c", None),
    (10, "é" * 12 + "\n" + "É" * 12, "b"),
    (11, "É" * 12, "b"),
]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words(lower(text or ""))
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def near_components(docs):
    """(doc_id, text) rows to doc_id -> smallest reachable id, holding every pair of sets together."""
    sets = [(i, shingles(t)) for i, t in docs if i is not None]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    index = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for x in s:
            index[x].add(k)
    pairs = {(a, b) for holders in index.values() for a in holders for b in holders if a < b}
    for a, b in pairs:
        (i, x), (j, y) = sets[a], sets[b]
        if 100 * len(x & y) >= 75 * len(x | y):
            i, j = sorted((find(i), find(j)))
            root[j] = i
    return {i: find(i) for i in root}


def deduped_lines(docs):
    """(doc_id, text) rows to [(doc_id, text, n_lines, n_dropped)]."""
    key = lambda line: lower(line.strip(" \t\n\x0b\f\r"))
    holders = defaultdict(set)
    for i, t in docs:
        if i is not None:
            for line in (t or "").split("\n"):
                holders[key(line)].add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        stays = [i is None or len(key(x)) < 10 or min(holders[key(x)]) == i for x in lines]
        kept = [x for x, s in zip(lines, stays) if s]
        text = t if all(stays) else "\n".join(kept)
        out.append((i, text, len(lines), len(lines) - len(kept)))
    return out
