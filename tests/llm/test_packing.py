from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from edge_rows import docs, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ordwise.llm import packing, queries
from ordwise.llm.tokens import byte_bpe, word_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def expected_pieces(rows, size=2048):
    out = []
    for doc_id, text in rows:
        ids = WHOLE.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), size)):
            part = ids[at:at + size]
            out.append((doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def check_places(rows, size=2048):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return bins


def order(t):
    return tuple((x is None, x) for x in t)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x17f), st.sampled_from("'s't'REll <|>ΣİǺ漢 \n\t")), max_size=40))
def test_ids_equal_the_whole_tokenizer(text):
    assert word_bpe(PATH).ids(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_byte_counts_equal_the_whole_encoder(text):
    tok = byte_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert tok.count(text) == len(tok._enc.encode_ordinary(text))


def test_special_strings_and_cache_overflow(monkeypatch):
    from ordwise.llm import tokens
    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    tok = tokens.WordBpe(PATH)
    for text in ("<|endoftext|> a<|startoftext|>b", "it's They'LL 12½ a b", "one two three four five one two", "x" * 500):
        assert tok.ids(text).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_edge_rows(spark):
    df = docs(spark)
    got = packing.pack(df, PATH, group_pieces=4).collect()
    want = expected_pieces([(r.doc_id, r.text) for r in df.collect()])
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(want, key=order)
    check_places(got)
    assert packing.pack(empty(spark), PATH).collect() == []


def test_ids_beyond_53_bits_beside_nulls_and_repeated_rows(spark):
    rows = [((1 << 60) + k, f"text {k}", "en", "a") for k in (1, 3)] + [(None, "no id", "en", "a")] + [(4, "the same", "en", "a")] * 400
    got = packing.pack(docs(spark, rows), PATH, group_pieces=40)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=order) == sorted(expected_pieces([r[:2] for r in rows]), key=order)
    check_places(got.collect())
    groups = [r["count"] for r in got.groupBy((got.sequence_id / (1 << 32)).cast("long").alias("g")).count().collect()]
    assert len(groups) > 8 and max(groups) < 80  # equal pieces spread over the groups


def test_documents_match_brute_force_and_fill_well(spark, sf):
    got = queries.op9_best_fit_packing(spark, sf).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(tuple(r)[:5] for r in got) == sorted(expected_pieces(rows))
    bins = check_places(got)
    assert len(bins) <= 1.03 * sum(r.length for r in got) / 2048 + 1


def test_best_fit_with_few_open_bins():
    rng = random.Random(1)
    lengths = [rng.randint(1, 100) for _ in range(3000)]
    for open_bins in (1, 4, 64):
        bins, offsets = packing.best_fit(lengths, 100, open_bins)
        fill = defaultdict(int)
        for b, o, n in zip(bins, offsets, lengths):
            assert o == fill[b]
            fill[b] += n
        assert max(fill.values()) <= 100
    few, many = (len(set(packing.best_fit(lengths, 100, k)[0])) for k in (1, 64))
    assert many < few
