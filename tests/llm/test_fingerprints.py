from __future__ import annotations

import hashlib

import numpy as np
from edge_rows import LONG, docs, empty
from pyspark.sql import functions as F

from ordwise.llm import fingerprints as fp
from ordwise.llm import queries


def brute(rows):
    """Rows (doc_id, text) -> expected output, by sorting everything."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    make = fp.Fingerprinter()
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        new = fp.edited(t, nxt)
        a, b, c = make(t), make(new), make(nxt)
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), fp.pack(a), fp.pack(b),
                    fp.likeness(a, b), fp.likeness(a, c)))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def test_edge_rows(spark):
    df = docs(spark)
    got = [tuple(r) for r in fp.with_edits(df).collect()]
    assert sorted(got, key=key) == sorted(brute([(r.doc_id, r.text) for r in df.collect()]), key=key)
    assert fp.with_edits(empty(spark)).collect() == []
    one = docs(spark, [(9, "alone it stands here now", "en", "a")])
    assert [tuple(r) for r in fp.with_edits(one).collect()] == brute([(9, "alone it stands here now")])
    assert {r.fingerprint for r in fp.fingerprints(df).where("doc_id in (1, 6)").collect()} == {got[[g[0] for g in got].index(1)][3]}


def test_ids_beyond_53_bits_beside_nulls(spark):
    rows = [((1 << 60) + k, f"some text number {k}", "en", "a") for k in (1, 3)] + [(None, "a text without id", "en", "a")]
    got = [tuple(r) for r in fp.with_edits(docs(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(brute([r[:2] for r in rows]), key=key)
    assert {r.doc_id for r in fp.fingerprints(docs(spark, rows)).collect()} == {r[0] for r in rows}


def test_documents_match_brute_force(spark, sf):
    got = [tuple(r) for r in queries.op8_fingerprints(spark, sf).collect()]
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(got) == sorted(brute(rows))


def test_estimate_is_near_the_true_similarity_and_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for share in (0.0, 0.2, 0.5, 0.8, 1.0):
        for _ in range(40):
            n = int(rng.integers(40, 1500))
            both = rng.integers(0, 1 << 63, int(n * share)).astype("uint64")
            a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, n - len(both)).astype("uint64") * np.uint64(2) + np.uint64(k)]))
                    for k in (0, 1))
            a, b = fp._mix(a), fp._mix(b)
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(fp.likeness(fp.signature(np.unique(a)), fp.signature(np.unique(b))) - true)
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.15


def test_packing_round_trip_and_short_sets():
    make = fp.Fingerprinter()
    for text in ("a", "a b c", LONG, "x y z " * 5):
        sig = make(text)
        assert (fp.unpack(fp.pack(sig)) == sig).all() and fp.likeness(sig, make(text.upper())) == 1.0
    assert make("") is None and make(" \n") is None and fp.pack(None) == "" and fp.unpack("") is None
    assert fp.likeness(None, None) == 1.0 and fp.likeness(None, make("a")) == 0.0


def test_rank_among_cuts_and_many_ranges(spark, monkeypatch):
    cuts = sorted({(i * 37) % 10007 for i in range(5000)})
    got = spark.range(0, 10100, 7).select("id", fp._rank(F.col("id"), cuts, fan=8).alias("r")).collect()
    assert all(r.r == sum(c <= r.id for c in cuts) for r in got)
    assert spark.range(2).select(fp._rank(F.col("id"), []).alias("r")).first().r == 0
    monkeypatch.setattr(fp, "RANGES_PER_PARTITION", 300)
    rows = [(i * 3, f"text {i} " * 6, "en", "a") for i in range(1500)]
    assert sorted(tuple(r) for r in fp.with_edits(docs(spark, rows)).collect()) == sorted(brute([r[:2] for r in rows]))
