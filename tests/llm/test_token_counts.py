from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from edge_rows import docs, empty
from pyspark.sql import functions as F

from ordwise.llm import queries
from ordwise.llm.token_counts import TokenRollup
from ordwise.llm.tokens import byte_bpe, word_bpe

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.tiktoken"))
DDL = "op string, doc_id long, text string, source string, lang string, seq long, n_tokens string, extra int"


def changes(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DDL)


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


def test_batches_add_up_and_repeat_without_effect(spark, tmp_path):
    n = word_bpe(WORD).count
    rollup = TokenRollup(spark, str(tmp_path))
    assert rollup.totals().collect() == []
    first = changes(spark, [("insert", 1, "one two three", "a", "en", 0), ("insert", 2, "vier", "a", "de", 0),
                            ("insert", 3, None, "b", None, 0), ("insert", None, "no id", None, "en", 0)])
    assert rollup.apply("b1", first, "w1", WORD) and not rollup.apply("b1", first, "w1", WORD)
    assert totals(rollup) == {("a", "en", "w1"): (1, n("one two three")), ("a", "de", "w1"): (1, 1), ("b", None, "w1"): (1, 0),
                              (None, "en", "w1"): (1, n("no id"))}
    second = changes(spark, [("revise", 1, "one", "a", "en", 1), ("revise", 1, "one two", "a", "en", 2), ("delete", 2, None, "a", "de", 0),
                             ("delete", 99, None, "z", "zz", 0), ("insert", 4, "x y", "c", "en", 0), ("delete", 4, None, "c", "en", 0)])
    assert rollup.apply("b2", second, "bytes", BYTE)
    want = {("a", "en", "bytes"): (1, byte_bpe(BYTE).count("one two")), ("b", None, "w1"): (1, 0), (None, "en", "w1"): (1, n("no id"))}
    assert totals(rollup) == want
    assert not rollup.apply("b1", first, "w1", WORD) and totals(rollup) == want
    # a document that moves to another source leaves its old group; a deleted one comes back
    assert rollup.apply("b3", changes(spark, [("insert", 2, "zwei drei", "a", "de", 0), ("revise", 3, "x", "c", "fr", 0)]), "w1", WORD)
    assert totals(rollup) == {**{k: v for k, v in want.items() if k[0] != "b"}, ("a", "de", "w1"): (1, n("zwei drei")), ("c", "fr", "w1"): (1, 1)}
    again = Counter()
    for r in rollup.documents().collect():
        again[r.source, r.lang, r.tokenizer] += r.n_tokens
    assert again == {k: v[1] for k, v in totals(rollup).items()}


def test_a_failed_attempt_leaves_nothing_behind(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path))
    good = changes(spark, [("insert", 1, "a b", "s", "en", 0)])
    with pytest.raises(Exception, match="unknown op"):
        rollup.apply("bad", changes(spark, [("insert", 5, "t", "s", "en", 0), ("upsert", 6, "t", "s", "en", 0)]), "w1", WORD)
    assert rollup.apply("good", good, "w1", WORD) and totals(rollup) == {("s", "en", "w1"): (1, 2)}
    # files of an attempt that never committed are not read
    good.limit(0).selectExpr("'ghost' source", "'en' lang", "'w1' tokenizer", "9L n_docs", "9L n_tokens").write.parquet(
        f"{tmp_path}/attempts/99999999-dead/deltas")
    assert totals(rollup) == {("s", "en", "w1"): (1, 2)}


def test_edge_rows(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path))
    df = docs(spark).withColumn("op", F.lit("insert"))
    assert rollup.apply("b", df, "w1", WORD)
    rows = {(r.doc_id, k if r.doc_id is None else None): r for k, r in enumerate(df.collect())}
    want: Counter = Counter()
    for r in rows.values():
        want[r.source, r.lang] += word_bpe(WORD).count(r.text or "")
    assert {(k[0], k[1]): v[1] for k, v in totals(rollup).items()} == dict(want)
    before = totals(rollup)
    assert rollup.apply("none", empty(spark).withColumn("op", F.lit("insert")), "w1", WORD) and totals(rollup) == before


def test_rows_without_id_are_counted_each(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path))
    rows = [("insert", None, "t", "s", None, 0), ("insert", None, "t", None, "s", 0), ("insert", None, "t", "s", None, 1)]
    assert rollup.apply("b1", changes(spark, rows), "w1", WORD)
    assert totals(rollup) == {("s", None, "w1"): (2, 2), (None, "s", "w1"): (1, 1)}
    assert rollup.apply("b2", changes(spark, [("delete", None, "t", "s", None, 0)] + [("delete", None, "t", None, "s", 0)] * 3), "w1", WORD)
    assert totals(rollup) == {("s", None, "w1"): (1, 1)}
    assert rollup.apply("b3", changes(spark, [("insert", None, "t", "s", None, 0)] * 4), "w2", WORD)
    assert totals(rollup) == {("s", None, "w2"): (5, 5)}


def test_a_commit_folder_of_a_dead_writer_blocks_nothing(spark, tmp_path):
    rollup = TokenRollup(spark, str(tmp_path))
    assert rollup.apply("b1", changes(spark, [("insert", 1, "a b", "s", "en", 0)]), "w1", WORD)
    (tmp_path / "commits" / "00000001" / "_temporary").mkdir(parents=True)
    for _ in range(2):
        rollup.apply("b2", changes(spark, [("insert", 2, "c", "s", "en", 0)]), "w1", WORD)
    assert totals(rollup) == {("s", "en", "w1"): (2, 3)} and len(rollup.commits()) == 2


def test_query_matches_a_recount(spark, sf):
    want: dict = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        if r.doc_id % 10 == 3:
            continue
        if r.doc_id % 10 == 7:
            key, n = (r.source, r.lang, "byte_bpe_50k"), byte_bpe(BYTE).count(r.text[:len(r.text) // 2])
        else:
            key, n = (r.source, r.lang, "word_bpe_49k"), word_bpe(WORD).count(r.text)
        docs_, tokens = want.get(key, (0, 0))
        want[key] = (docs_ + 1, tokens + n)
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in queries.op4_token_counts(spark, sf).collect()}
    assert got == want
