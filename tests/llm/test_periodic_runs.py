from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

from edge_rows import LONG, docs, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordwise.llm import periodic_runs, queries


def brute_runs(words, min_words=24, min_periods=3):
    """Every lag, every place: maximal equal stretches whose smallest period is the lag."""
    n, out = len(words), set()
    for q in range(1, n // min_periods + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_words, min_periods * q):
                piece = words[i:j + q]
                if not any(all(piece[k] == piece[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=140) | st.lists(st.sampled_from("abc"), max_size=120),
       st.integers(0, 40), st.integers(1, 20), st.integers(0, 120))
def test_runs_of_small_alphabets_equal_brute_force(words, a, p, more):
    looped = words[:a] + [words[a:a + p][i % p] for i in range(more) if len(words) >= a + p] + words[a:]
    for text in (words, looped):
        raw = [w.encode() for w in text]
        for least, periods in ((24, 3), (6, 2), (1, 3)):
            assert periodic_runs.find_runs(raw, least, periods) == brute_runs(raw, least, periods)


def test_runs_within_prose_nested_and_overlapping():
    rng = random.Random(3)
    prose = [f"w{int(rng.paretovariate(0.7))}" for _ in range(900)]
    inner = ["a"] * 30 + ["b"] + ["a"] * 30 + ["c"]
    text = prose[:200] + inner * 4 + prose[200:400] + ["x", "y"] * 13 + ["x", "z"] * 14 + prose[400:] + prose[880:] * 5
    raw = [w.encode() for w in text]
    got = periodic_runs.find_runs(raw)
    assert got == brute_runs(raw)
    assert {q for _, _, q in got} >= {1, 2, 20, 62}
    assert periodic_runs.collapse(raw, got).decode() == brute_collapse(text, got)


def test_splitting_needs_recursion_and_keeps_whole_segments():
    # "k" is frequent in the text but rare in the piece that is left once "r" splits it
    text = [b"k"] + [b"a"] * 30 + [b"r"] + [b"k"] * 2 + [b"b", b"c"] * 20
    ids = periodic_runs.word_numbers(text)
    assert [(lo, hi) for lo, hi in periodic_runs.split_rare(ids)] == [(1, 31), (34, 74)]


def test_long_uniform_and_low_entropy_texts_stay_quick():
    rng = random.Random(5)
    assert periodic_runs.find_runs([b"a"] * 60_000) == [(0, 60_000, 1)]
    coin = [rng.choice((b"a", b"b")) for _ in range(20_000)]
    for s, n, q in periodic_runs.find_runs(coin):
        assert n >= max(24, 3 * q) and coin[s:s + n - q] == coin[s + q:s + n]


def expected(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    words = [w.decode() for w in words]
    runs = brute_runs(words) if len(words) < 1500 else periodic_runs.find_runs([w.encode() for w in words])
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, None if not runs else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(brute_collapse(words, runs).encode()).hexdigest())


def test_query_equals_brute_force(spark, sf):
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    assert got == {r.doc_id: expected(r.doc_id, r.text) for r in rows}
    assert sum(r[1] > 0 for r in got.values()) > 30


def test_edge_rows(spark):
    df = docs(spark).withColumn("runs", F.lit("taken"))
    out = periodic_runs.detect(df)
    assert out.columns == [*df.columns, "n_words", "_runs", "collapsed"]
    rows = out.collect()
    assert len(rows) == df.count()
    for r in rows:
        words = (r.text or "").encode().split()
        assert r.n_words == len(words) and r.runs == "taken"
        if r.text != LONG:
            assert [tuple(x) for x in r._runs] == brute_runs(words)
            assert r.collapsed == " ".join(w.decode() for w in words)
    one = next(r for r in rows if r.text == LONG)
    assert [tuple(x) for x in one._runs] == [(0, one.n_words, 9)] and one.collapsed == "so it goes on and on without an end"
    assert periodic_runs.detect(empty(spark)).collect() == []
