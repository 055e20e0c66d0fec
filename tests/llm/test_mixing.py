from __future__ import annotations

import math
import os
import sys
from collections import Counter

import duckdb
import pytest
from edge_rows import docs, empty
from pyspark.sql import functions as F

from ordwise.llm import mixing, queries

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))
from check_oracles import digest  # noqa: E402


def test_matches_sql(spark, sf):
    df = queries.op6_source_mixing(spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    res = con.execute(queries.oracle_sql()["op6_source_mixing"])
    names, rows = [d[0] for d in res.description], res.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(names) == sorted(df.columns) and len(rows) == len(got)
    assert digest(df.columns, got)[0] == digest(names, rows)[0]


def test_edge_rows(spark):
    df = docs(spark)
    got = mixing.mix(df, seed=3)
    assert got.columns == [*df.columns, "mix_rate", "_copy", "mix_order"]  # 'copy' is taken
    rows = got.collect()
    by_source = Counter(r.source for r in df.collect())
    for r in rows:
        assert r.mix_rate == pytest.approx(len(df.collect()) / len(by_source) / by_source[r.source])
    assert {tuple(r)[:-1] for r in rows} == {tuple(r)[:-1] for r in mixing.mix(df, seed=3, partitions=1).collect()}
    assert mixing.mix(empty(spark)).collect() == []
    only = mixing.mix(df, weights={"b": 2.0, "missing": 1.0})
    assert {r.source for r in only.collect()} <= {"b"}
    assert mixing.mix(df, weights={}).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(df, weights={"a": -1.0})


def test_counts_are_poisson_and_weights_are_met(spark):
    n = 20000
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") < n * 0.9, "big").otherwise("small").alias("source"))
    got = mixing.mix(df, weights={"big": 1.0, "small": 3.0}).groupBy("source", "doc_id").count().collect()
    total = Counter()
    for r in got:
        total[r.source] += r["count"]
    assert total["small"] / (total["small"] + total["big"]) == pytest.approx(0.75, abs=0.01)
    rate = 0.75 * n / (n * 0.1)
    counts = Counter(r["count"] for r in got if r.source == "small")
    for k in range(3, 13):
        p = math.exp(-rate) * rate ** k / math.factorial(k)
        assert counts[k] / (n * 0.1) == pytest.approx(p, abs=4 * math.sqrt(p / (n * 0.1)))


def test_large_rates_do_not_underflow(spark):
    cdf = spark.range(1).select(mixing.poisson_cdf(F.lit(2000.0), F.lit(2600)).alias("c")).first().c
    assert cdf[-1] == pytest.approx(1.0, abs=1e-9) and cdf[2000] == pytest.approx(0.506, abs=0.002)


def test_rows_without_an_id_draw_each_for_themselves(spark):
    """Production seed: distinct and equal rows without ids meet their source's weight and spread over partitions."""
    rows = [(None, f"text {i}", "en", "a") for i in range(1000)] + [(None, "the same text", "en", "a")] * 1000
    rows += [(i, f"other {i}", "en", "b") for i in range(4000)]
    df = docs(spark, rows)
    got = mixing.mix(df.repartition(3)).collect()
    own = [r for r in got if r.doc_id is None]
    assert len(own) == pytest.approx(3000, rel=0.05)  # rate 1.5
    same = [r for r in own if r.text == "the same text"]
    assert len(same) == pytest.approx(1500, rel=0.1)
    assert len({r.mix_order for r in own}) == len(own)
    again = mixing.mix(df.coalesce(1), partitions=7).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
