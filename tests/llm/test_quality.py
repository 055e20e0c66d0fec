from __future__ import annotations

import math

import numpy as np
from edge_rows import docs, empty, labels
from pyspark.sql import functions as F

from ordwise.llm import quality, queries


def test_accuracy_on_documents_left_out(spark, sf):
    documents, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(documents, marks.where("doc_id % 3 <> 0"))
    got = {r.doc_id: r.predicted for r in quality.predictions(documents, model).collect()}
    rest = [(got[r.doc_id], r.quality) for r in marks.where("doc_id % 3 = 0").collect()]
    assert np.mean([a == b for a, b in rest]) > 0.97


def test_every_document_has_a_row(spark, sf):
    got = queries.op10_quality_classifier(spark, sf)
    assert got.select("doc_id").distinct().count() == got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_posteriors_match_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    for host, rate in (("a", 0.9), ("b", 0.2), (None, 0.5), ("c", 0.7)):
        for path, n in (("x", 200), ("y", 3), (None, 1)):
            rows += [(host, path, float(rng.normal(math.log(rate / (1 - rate)), 0.5))) for _ in range(n)]
    seen = spark.createDataFrame(rows, "host string, path string, e double")
    got = {(r.host, r.path): r for r in quality.site_posteriors(seen, "host", "path", "e").collect()}
    groups: dict = {}
    for h, p, e in rows:
        groups.setdefault((h, p), []).append(1 / (1 + math.exp(-e)))
    hosts = {h: [x for (g, _), v in groups.items() if g == h for x in v] for h, _ in groups}
    total = [x for v in groups.values() for x in v]
    mean = sum(total) / len(total)

    def strength(gs):
        gs = [(len(v), sum(v), c) for v, c in gs if len(v) > 1]
        n = sum(g[0] for g in gs)
        ss = sum(k * (s / k - c) ** 2 for k, s, c in gs)
        noise = mean * (1 - mean)
        spread = (ss - (len(gs) - 1) * noise) / max(n - sum(g[0] ** 2 for g in gs) / n, 1e-9)
        return 1000.0 if spread <= 0 else min(max(noise / spread - 1, 2.0), 1000.0)

    a = strength([(v, mean) for v in hosts.values()])
    host_rate = {h: (sum(v) + a * mean) / (len(v) + a) for h, v in hosts.items()}
    b = strength([(v, host_rate[h]) for (h, _), v in groups.items()])
    assert got.keys() == groups.keys()
    for (h, p), v in groups.items():
        rate = (sum(v) + b * host_rate[h]) / (len(v) + b)
        r = got[(h, p)]
        assert r.n == len(v) and math.isclose(r.host_rate, host_rate[h], rel_tol=1e-9) and math.isclose(r.path_rate, rate, rel_tol=1e-9)
        shift = math.log(rate / (1 - rate)) - math.log(mean / (1 - mean))
        assert math.isclose(r.shift, shift, rel_tol=1e-9, abs_tol=1e-12)
    # a site of one document leans on its host, one of many on itself
    assert abs(got[("b", None)].path_rate - host_rate["b"]) < abs(got[("b", None)].path_rate - groups[("b", None)][0])


def test_edge_rows(spark, monkeypatch):
    df = docs(spark)
    model = quality.fit(df, labels(spark, [(1, 1, 0), (7, 0, 0), (2, 0, 0), (5, 1, 1), (None, 1, 1), (3, None, 0)]))
    got = quality.predictions(df, model).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted for r in got)
    monkeypatch.setattr(quality, "BROADCAST_PATHS", 0)
    assert sorted(map(str, quality.predictions(df, model).collect())) == sorted(map(str, got))
    assert quality.predictions(empty(spark), model).collect() == []
    assert quality.keep_good(empty(spark), model).collect() == []
    bare = quality.fit(df, labels(spark, []))
    assert quality.predictions(df, bare).where(F.col("score").isNull()).count() == 0


def test_columns_named_as_the_sites_own(spark, sf):
    given = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    model = quality.fit(given, spark.read.parquet(f"{sf}/labels.parquet"))
    df = given.withColumn("_site_host", F.lit("x")).withColumn("_SITE_shift", F.lit(9.0))
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.keep_good(given, model).collect()}
