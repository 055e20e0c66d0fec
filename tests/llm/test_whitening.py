from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordwise.llm import queries, whitening

DDL = "vec_id long, embedding array<double>, x string, v int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, 2) for i, v in rows], DDL)


def whole(vector):
    return [math.floor(64 * float(c)) + 1_000_000 for c in vector]


def check(rows, got, k):
    """Rows (id, vector) that remain, against whole-number and numpy brute force."""
    x = [whole(v) for _, v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    z = [[n * r[i] - s[i] for i in range(d)] for r in x]
    v = np.array([[sum(r[i] * r[j] for r in z) / n ** 3 for j in range(d)] for i in range(d)])
    e = np.linalg.eigvalsh(v)[::-1]
    table = defaultdict(dict)
    for r in got:
        assert r.n == n
        table[r.vec_id][r.component] = r
    assert len(got) == n * k
    w = np.array([[table[i][c].whitened for c in range(1, k + 1)] for i, _ in rows])
    for (i, _), far in zip(rows, z):
        assert {table[i][c].deviation for c in range(1, k + 1)} == {sum(a * a for a in far)}
        assert table[i][1].deviation_digits == str(sum(a * a for a in far))
    assert np.allclose([table[rows[0][0]][c].explained for c in range(1, k + 1)], e[:k] / np.trace(v), rtol=1e-9)
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-9
    assert got[0].identity_error < 1e-9
    # the same projections up to sign
    away = np.array(z, float) / n
    back, *_ = np.linalg.lstsq(away, w, rcond=None)
    units = back * np.sqrt(e[:k])
    assert np.allclose(units.T @ units, np.eye(k), atol=1e-6)
    assert np.allclose(v @ units, units * e[:k], atol=1e-6 * e[0])


def test_whole_table_equals_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.op13_embedding_whitening(spark, sf)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, got.collect(), 32)


def test_pair_squares_recover_covariances_exactly_beyond_64_bits():
    rng = np.random.default_rng(2)
    for scale in (10, 1 << 20, 1 << 58):
        y = rng.integers(-scale, scale, (50, 5))
        exact = [[int(c) for c in r] for r in y]
        sums = [sum(r[i] for r in exact) for i in range(5)]
        want = [[(50 * sum(r[i] * r[j] for r in exact) - sums[i] * sums[j]) / 2500 for j in range(5)] for i in range(5)]
        assert whitening.covariances(50, sums, whitening.pair_squares(y), 5).tolist() == want


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(a) for a in rng.normal(1e12, 1e13, 3)]) for i in range(40)]
    got = whitening.whiten(frame(spark, rows)).collect()
    x = [whole(v) for _, v in rows]
    sums = [sum(r[i] for r in x) for i in range(3)]
    want = {i: sum((40 * a - b) ** 2 for a, b in zip(r, sums)) for (i, _), r in zip(rows, x)}
    assert {r.vec_id: int(r.deviation_digits) for r in got} == want
    assert all(r.deviation is None for r in got if want[r.vec_id] >= 1 << 63)
    assert got[0].identity_error < 1e-9


def test_edge_rows(spark):
    good = [(i, [float(i % 7), float(i * i % 11), float(i % 3)]) for i in range(30)] + [((1 << 60) + 1, [0.5, -2.0, 9.0])]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [math.nan, 0.0, 1.0]), (93, [math.inf, 0.0, 1.0]), (94, [-math.inf, 0.0, 1.0]),
           (95, []), (96, [1.0, 2.0]), (97, [1e300, 0.0, 0.0])]
    got = whitening.whiten(frame(spark, good + bad)).collect()
    check(good, got, 3)
    again = whitening.whiten(frame(spark, good + [(None, good[0][1]), good[1], good[1]]))
    assert again.select("n").first().n == len(good) + 3
    assert again.where("vec_id is null").count() == 3 and again.where("vec_id = 1").count() == 9
    assert whitening.whiten(frame(spark, bad[:3])).collect() == []
    assert whitening.whiten(frame(spark, good).limit(0)).collect() == []


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_variance(spark, rows):
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 2 * len(rows)
    assert all((r.whitened, r.explained, r.identity_error, r.deviation) == (None, None, None, 0) for r in got)


def test_dependent_dimensions(spark):
    rows = [(i, [float(i % 5), float(2 * (i % 5)), float(i % 4)]) for i in range(40)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 120 and got[0].identity_error < 1e-9
    flat = [r for r in got if r.component == 3]
    assert all(r.whitened is None and r.explained == pytest.approx(0, abs=1e-12) for r in flat)


def test_component_limit_and_names(spark):
    rows = [(i, [float(i % 5), float(i % 3), float(i % 4)]) for i in range(40)]
    df = frame(spark, rows).select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<float>").alias("e"))
    assert whitening.whiten(df, 2, "id", "e").count() == 80
