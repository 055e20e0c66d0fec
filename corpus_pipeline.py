"""The training-data pipeline: toxicity filter, quality filter, one document
of each near-duplicate group, source mixing, sequence packing. Each stage
takes what its predecessor kept; all but the last return the columns of
``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordwise.llm import jaccard_join, mixing, packing, quality, toxicity
from ordwise.llm.common import materialize, prepare, release, table
from ordwise.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: rows that the classifier predicts toxic go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: rows of a posterior under one half go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: near duplicates by five-word shingles and a similarity of
    0.8; the smallest id of each group stays."""
    return jaccard_join.one_of_each(docs, n_words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: equal shares of all sources; a document appears as often as
    its Poisson draw says."""
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality_classifier", keep_good_quality), ("ngram_jaccard_join", one_of_each_group),
          ("source_mixing", mix_sources), ("best_fit_packing", pack_sequences)]

#: Trained models and tokenizers are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and reread."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    stored = None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if stored:
            release(stored)
        stored = docs
    return STAGES[-1][1](spark, docs, sf_dir)
