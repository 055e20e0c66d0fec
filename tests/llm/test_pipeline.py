from __future__ import annotations

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from edge_rows import docs, empty
from ordwise.llm import quality, toxicity
from ordwise.llm.common import materialize
from test_jaccard_join import brute
from test_packing import check_places, expected_pieces


@pytest.fixture(scope="module")
def staged(spark, sf):
    """Input and output of every stage over whole documents."""
    frames = [spark.read.parquet(f"{sf}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(materialize(stage(spark, frames[-1], sf), f"test-{name}"))
    return frames


def test_stage_names_and_columns(staged):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_classifier", "ngram_jaccard_join", "source_mixing", "best_fit_packing"]
    assert all(f.columns == staged[0].columns for f in staged[:-1])


def test_filters_follow_their_classifiers(spark, staged, sf):
    marks = spark.read.parquet(f"{sf}/labels.parquet")
    for before, after, module in ((staged[0], staged[1], toxicity), (staged[1], staged[2], quality)):
        told = {r.doc_id: r.predicted for r in module.predictions(before, module.fit(before, marks)).collect()}
        keep = 0 if module is toxicity else 1
        assert {r.doc_id for r in after.select("doc_id").collect()} == {i for i, p in told.items() if p == keep}


def test_one_document_of_each_group_stays(staged):
    rows = [(r.doc_id, r.text) for r in staged[2].collect()]
    assert {r.doc_id for r in staged[3].collect()} == {c for _, _, c in brute(rows, 5, 80)}


def test_mixture_and_sequences(staged):
    before = {r.doc_id: r for r in staged[3].collect()}
    mixed = staged[4].collect()
    assert all(before[r.doc_id] == r for r in mixed)
    per_source = Counter(r.source for r in mixed)
    assert max(per_source.values()) < 2 * len(mixed) / len(per_source)
    packed = staged[5].collect()
    order = lambda t: tuple(t)
    assert sorted((tuple(r)[:5] for r in packed), key=order) == sorted(expected_pieces([(r.doc_id, r.text) for r in mixed]), key=order)
    check_places(packed)


def test_run_equals_the_stages(spark, staged, sf):
    key = lambda rows: sorted(tuple(r)[:5] for r in rows)
    assert key(corpus_pipeline.run(spark, sf).collect()) == key(staged[-1].collect())


def test_edge_rows_and_empty_tables(spark, sf):
    for df in (docs(spark), empty(spark)):
        out = defaultdict(int)
        for name, stage in corpus_pipeline.STAGES:
            df = materialize(stage(spark, df, sf), f"edge-{name}")
            out[name] = df.count()
        assert (out["best_fit_packing"] > 0) == (out["source_mixing"] > 0)
