from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge_rows import docs, empty

from ordwise.llm import jaccard_join, queries
from ordwise.llm.common import words
from ordwise.llm.components import connected


def brute(rows, n_words, percent):
    """``{doc_id: (set size, component)}`` by counting shared shingles of all pairs that share one."""
    sets, parent = {}, {}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def tie(x, y):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)

    same = defaultdict(list)
    for i, t in rows:
        w = words(t)
        s = frozenset(tuple(w[j:j + n_words]) for j in range(max(1, len(w) - n_words + 1))) if w else frozenset()
        sets.setdefault(i, []).append(s)
        parent[i] = i
        if s:
            same[s].append(i)
    lists = defaultdict(list)
    reps = {}
    for s, ids in same.items():
        for i in ids:
            tie(ids[0], i)
        reps[len(reps)] = (s, ids[0])
        for t in s:
            lists[t].append(len(reps) - 1)
    shared = Counter()
    for ids in lists.values():
        shared.update((a, b) for k, a in enumerate(ids) for b in ids[k + 1:])
    for (a, b), c in shared.items():
        if 100 * c >= percent * (len(reps[a][0]) + len(reps[b][0]) - c):
            tie(reps[a][1], reps[b][1])
    return sorted((i, len(s), find(i) if s else i) for i, ss in sets.items() for s in ss)


def run(df, n_words, percent):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(df, n_words, percent).collect()
                  if r.doc_id is not None)


def near_copies(rng, vocabulary, groups=12, members=14, size=120):
    rows = []
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([3, 12, size]))
        for _ in range(members):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8, 15])):
                act = rng.random()
                at = rng.randrange(len(w))
                if act < 0.6:
                    w[at] = rng.choice(vocabulary)
                elif act < 0.8 and len(w) > 2:
                    del w[at]
                else:
                    w.insert(at, rng.choice(vocabulary))
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return [(i * 3 + 1, t, "en", "a") for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed, n_words, percent", [(1, 3, 90), (2, 5, 80), (3, 1, 60)])
def test_near_copies_match_brute_force(spark, seed, n_words, percent):
    rng = random.Random(seed)
    rows = near_copies(rng, [f"w{i}" for i in range(4000 if seed < 3 else 60)])
    assert run(docs(spark, rows), n_words, percent) == brute([r[:2] for r in rows], n_words, percent)


def test_no_link_is_lost_without_frequencies_or_leaders(spark, monkeypatch):
    """The result does not depend on the token order, the leaders or the bounds."""
    rows = near_copies(random.Random(5), [f"w{i}" for i in range(500)], groups=8)
    want = brute([r[:2] for r in rows], 3, 90)
    monkeypatch.setattr(jaccard_join, "frequent", lambda d, n: (np.array([], "uint64"), np.array([], "int64")))
    monkeypatch.setattr(jaccard_join, "BROADCAST_DOCS", 0)
    monkeypatch.setattr(jaccard_join, "MAX_MATCH", 1)
    assert run(docs(spark, rows), 3, 90) == want


def test_long_chain_is_one_component(spark):
    base = [f"w{i}" for i in range(400)]
    rows = [(100 - k, " ".join([*base[:k * 8], *(f"x{i}" for i in range(k * 8, 400))][::-1]), "en", "a") for k in range(40)]
    got = run(docs(spark, rows), 3, 90)
    assert got == brute([r[:2] for r in rows], 3, 90)
    assert {c for _, _, c in got} == {61}


def test_documents_match_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in queries.op2_ngram_jaccard_join(spark, sf).collect())
    assert got == brute(rows, 3, 90)


def test_edge_rows(spark):
    df = docs(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert run(df, 3, 90) == brute([r for r in rows if r[0] is not None], 3, 90)
    nulls = [r for r in jaccard_join.join(df, 3, 90).collect() if r.doc_id is None]
    assert len(nulls) == 2 and all(r.component_id is None for r in nulls)
    assert jaccard_join.join(empty(spark)).collect() == []
    # one id, two texts: one document, which ties what either text links to
    two = [(5, "a b c d e f", "en", "a"), (5, "p q r s t u", "en", "a"), (3, "a b c d e f", "en", "a"), (4, "P q r s t u", "en", "a")]
    assert {r[2] for r in run(docs(spark, two), 3, 90)} == {3}


def test_one_of_each(spark):
    df = docs(spark)
    got = jaccard_join.one_of_each(df)
    assert got.columns == df.columns
    ids = sorted((r.doc_id for r in got.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 2, 3, 4, 5, 7, 8, None, None]  # 6 repeats 1
    assert jaccard_join.one_of_each(empty(spark)).collect() == []
    again = docs(spark, [(1, "a b c", "en", "a")] * 3 + [(2, "", "en", "a")] * 2)
    assert sorted(r.doc_id for r in jaccard_join.one_of_each(again).collect()) == [1, 2]
    # no id, one id at two texts: documents by their texts, behind those with an id of their own
    text = " ".join(f"w{i}" for i in range(60))
    near, other, apart = text + " tail", " ".join(f"v{i}" for i in range(40)), " ".join(f"u{i}" for i in range(40))
    rows = [(None, text, "en", "a"), (None, near, "en", "a"), (None, other, "en", "a"), (None, other, "de", "b"), (5, near, "en", "a"),
            (7, apart, "en", "a"), (7, other, "en", "a"), (7, apart, "en", "a"), (9, text, "en", "a")]
    got = jaccard_join.one_of_each(docs(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in got)[0] == (False, 5, near)
    assert sorted(r.text for r in got) == sorted([near, other, apart])


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(None, 1), (7, 7), (2, None)]
    links += [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(5001, 5400)]
    parent = {x: x for ab in links for x in ab if x is not None}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for _ in range(300):
        for a, b in links:
            if a is not None and b is not None:
                lo, hi = sorted((parent[a], parent[b]))
                parent[a] = parent[b] = lo
                parent[hi] = min(parent[hi], lo)
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {x for a, b in links if a is not None and b is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_links(rows, n_words, percent):
    """``{doc_id: number of other ids that it links with}`` by comparing all pairs."""
    sets = defaultdict(set)
    for i, t in rows:
        w = words(t)
        if w and i is not None:
            sets[i].add(frozenset(tuple(w[j:j + n_words]) for j in range(max(1, len(w) - n_words + 1))))
    return {i: sum(any(100 * len(s & t) >= percent * len(s | t) for s in sets[i] for t in sets[k]) for k in sets if k != i) for i in sets}


@pytest.mark.parametrize("bounds", [(400_000, 2048, 2048), (700, 3, 50)])
def test_links_inside_groups_are_counted(spark, monkeypatch, bounds):
    """Members that share a leader count their links with one another, in one block or several."""
    for name, value in zip(("BLOCK_TOKENS", "BLOCK_CLASSES", "TOKEN_COLUMNS"), bounds):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = near_copies(random.Random(7), [f"w{i}" for i in range(4000)], groups=6)
    # ids with two texts, repeated rows, rows without text or id
    rows += [(1, rows[5][1], "en", "a"), (4, rows[20][1], "en", "a"), rows[3], rows[3], (9000, "", "en", "a"), (None, rows[3][1], "en", "a")]
    got = jaccard_join.links(docs(spark, rows), 3, 90)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "class_id", "n_links"]
    want = brute_links([r[:2] for r in rows], 3, 90)
    assert max(want.values()) > 3
    assert {(r.doc_id, r.n_links) for r in got.collect()} == {(i, want.get(i, 0)) for i, *_ in rows}
    plain = jaccard_join.join(docs(spark, rows), 3, 90)
    assert sorted(map(str, got.drop("n_links").collect())) == sorted(map(str, plain.collect()))
