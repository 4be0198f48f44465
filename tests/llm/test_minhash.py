from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tastes.llm.common import Scratch, ascii_lower_words
from tastes.llm.minhash import connected_components, near_duplicates


def shingles(text, k):
    w = ascii_lower_words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(rows, k=4, percent=80):
    """Brute force: smallest id reachable over links of full sets."""
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(9999)}"
    return words


@pytest.mark.parametrize("k", [4, 5])
def test_components_equal_brute_force(docs_df, k):
    rng = random.Random(k)
    rows, n = [], 0
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 150))]
        for _ in range(rng.randint(1, 9)):
            rows.append((n, " ".join(edited(base, rng, rng.randint(0, 4)))))
            n += 1
    rng.shuffle(rows)
    found = near_duplicates(docs_df(rows), k, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components(rows, k)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_chain_of_edits_is_one_component(docs_df):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for n in range(40):
        rows.append((n, " ".join(words)))
        words = edited(words, rng, 2)
    found = {r.doc_id: r.component_id for r in near_duplicates(docs_df(rows), 4).collect()}
    assert found == {i: c for i, (_, c) in components(rows).items()}


def test_copies_in_thousands(docs_df):
    rows = [(n, "one text in very many copies of it") for n in range(3000)]
    found = near_duplicates(docs_df(rows, 8), 4).where("kept").collect()
    assert [r.doc_id for r in found] == [0]


def test_edges(docs_df):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "Hi there"), (5, "hi\x0bTHERE"), (6, "hi there you"),
        (7, "É a b c d"), (8, "é a b c d"), (None, "hi there"), (None, None), (4, "Hi there"),
    ]
    found = near_duplicates(docs_df(rows), 4).collect()
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert len(found) == len(rows)
    assert [by[i].n_shingles for i in (1, 2, 3, 4, 6)] == [0, 0, 0, 1, 1]
    assert [by[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 2, 3, 4, 4, 6, 7, 8]
    assert [(r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, True)] * 2


def test_rows_that_repeat_an_id_are_one_node(docs_df):
    rows = [(5, "a b c d e f"), (9, "a b c d e f"), (9, "p q r s t u"), (12, "p q r s t u")]
    found = near_duplicates(docs_df(rows), 4).collect()
    assert {r.component_id for r in found} == {5}


def test_empty_table_and_clashing_columns(docs_df):
    assert near_duplicates(docs_df([]), 5).count() == 0
    named = docs_df([(1, "a b"), (2, "a b")]).withColumns(
        {c: F.lit(1) for c in ("key", "u", "v", "sig", "digest", "sketch", "component_id")}
    )
    assert {r.component_id for r in near_duplicates(named, 5).collect()} == {1}


def test_components_of_random_links(spark):
    rng = random.Random(3)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100, n) for n in range(101, 160)]
    got = connected_components(
        spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test")
    ).collect()
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in parent if find(x) != x}
    assert {r.doc_id: r.component_id for r in got} == want
