"""Registered queries of this subpackage: ``name -> (spark, sf_dir) ->
DataFrame``, each over whole tables with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, chat_format, fingerprints, html_extract, jaccard_join, license_scan, mixing, packing, periodic_runs,
               quality, token_counts, toxicity, whitening)
from .common import scratch_path, table


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(table(spark, sf, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf, "documents"), n_words=3, percent=90)


def op2_ngram_jaccard_links(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.links(table(spark, sf, "documents"), n_words=3, percent=90)


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.predictions(docs, toxicity.fit(docs, table(spark, sf, "labels")))


def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Load all documents, then a batch that deletes every tenth document,
    cuts another tenth to its first half and moves it to a newer tokenizer
    version; both batches are sent twice."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "lang")
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "token-rollup"))
    third, half = F.pmod("doc_id", F.lit(10)), F.floor(F.length("text") / 2).cast("int")
    load = docs.withColumn("op", F.lit("insert"))
    corrections = docs.where(third.isin(3, 7)).withColumn("op", F.when(third == 3, "delete").otherwise("revise")) \
        .withColumn("text", F.substring(F.col("text"), F.lit(1), half))
    words, bytes_ = ("word_bpe_49k", tokenizer("word_bpe_49k.json")), ("byte_bpe_50k", tokenizer("byte_bpe_50k.tiktoken"))
    rollup.apply("load", load, *words)
    rollup.apply("corrections", corrections, *bytes_)
    rollup.apply("corrections", corrections, *bytes_)
    rollup.apply("load", load, *words)
    return rollup.totals()


def op5_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return ann.search(table(spark, sf, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


def op6_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_extract.extract(table(spark, sf, "pages"))


def op8_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, sf, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), tokenizer("word_bpe_49k.json"))


def op10_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality.predictions(docs, quality.fit(docs, table(spark, sf, "labels")))


def with_loops(docs: DataFrame) -> DataFrame:
    """Documents ``(doc_id, text)`` of which about a tenth, by the crc32 of
    their id, repeat a stretch of their words to the end."""
    def loop(batches):
        import pyarrow as pa
        for b in batches:
            texts = b.column(1).to_pylist()
            for k, (doc_id, text) in enumerate(zip(b.column(0).to_pylist(), texts)):
                h = zlib.crc32(str(doc_id).encode())
                words = text.encode().split() if text and doc_id is not None and h % 10 == 0 else []
                if words:
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    texts[k] = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(loop, "doc_id long, text string")


def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic_runs.detect(with_loops(table(spark, sf, "documents")))
    nothing = F.lit(None).cast("struct<start:long,length:long,period:long>")
    # runs go by start, then period: the first of equal exponents stays
    top = F.aggregate("runs", nothing, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                              r["period"].cast("string"), F.lit("\n"))
    return (found.withColumn("top", top)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
                    F.expr("1000 * top.length div top.period").alias("exponent_milli"),
                    F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")))


#: A conversation whose texts hold the control strings of the template.
CONTROL_CONVERSATION = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op12_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    path = tokenizer("byte_bpe_50k.tiktoken")
    return chat_format.read_back(chat_format.assemble(rows.unionByName(extra), path), path).drop("n_tokens")


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}


def oracle_sql() -> dict[str, str]:
    extra = " UNION ALL ".join(f"SELECT {c}, {t}, '{r}', '{text}'" for c, t, r, text in CONTROL_CONVERSATION)
    return {"op2_ngram_jaccard_join": jaccard_join.oracle(3, 90), "op6_source_mixing": mixing.oracle(),
            "op12_chat_formatting": chat_format.oracle(extra)}
