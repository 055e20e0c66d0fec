from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordwise.llm import chat_format, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
DDL = "conv_id long, turn long, role string, text string, ids string, piece string, loss int"
PIECES = st.lists(st.sampled_from([*chat_format.CONTROLS, "\\", "#", "<", "/turn>", " ", "\n", "é", "😀", "a", "### "]), max_size=12)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=400, deadline=None)
@given(PIECES.map("".join) | st.text(max_size=60))
def test_escape_round_trip_leaves_no_control_string(text):
    told = chat_format.escape(text)
    assert chat_format.unescape(told) == text
    assert not any(c in told for c in chat_format.CONTROLS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "</role>", ""]), PIECES.map("".join)), max_size=6),
       st.integers(1, 30))
def test_pieces_of_any_length_read_back(turns, size):
    c = chat_format.codec(PATH)
    splicer, pieces = chat_format._Splicer(size), []
    for role, text in turns:
        ids, at = c.turn(role, text)
        pieces += splicer.add(np.asarray(ids, "<u4").tobytes(), at, len(ids) - 1, role == "assistant")
    pieces += splicer.cut() if turns else []
    reader = chat_format._Reader(c)
    for k, (no, start, ids, loss) in enumerate(pieces):
        assert no == k and start == sum(len(p[2]) for p in pieces[:k]) and len(ids) <= size
        reader.read(ids, loss)
    told = "".join(t for r, t in turns if r == "assistant")
    n, turns_sha, chars, loss_sha, formatted, tokens = reader.row()
    assert (n, turns_sha, chars, loss_sha) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(told), sha(told))
    assert formatted == sum(len(form(r, t)) for r, t in turns) and tokens == sum(len(p[2]) for p in pieces)


def form(role, text):
    head = f"{chat_format.HEADERS[role]}\n" if role in chat_format.HEADERS else \
        f"{chat_format.OTHER}\n{chat_format.escape(role)}{chat_format.ROLE_END}\n"
    return f"{head}{chat_format.escape(text)}{chat_format.TURN_END}\n"


def expected(rows):
    groups = defaultdict(list)
    for k, (cid, turn, role, text) in enumerate(rows):
        groups[(cid, k if cid is None else 0)].append((turn is not None, turn, role or "", text or ""))
    out = []
    for (cid, _), turns in groups.items():
        turns = [t[2:] for t in sorted(turns)]
        told = "".join(t for r, t in turns if r == "assistant")
        out.append((cid, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(told), sha(told),
                    sum(len(form(r, t)) for r, t in turns)))
    return sorted(out, key=str)


def test_whole_table_equals_brute_force(spark, sf):
    got = queries.op12_chat_formatting(spark, sf)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows + queries.CONTROL_CONVERSATION)


def test_edge_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "same turn"), (2, 0, None, "no role"),
            (2, None, "tool", "no turn"), (None, 0, "assistant", "lone"), (None, 0, "assistant", "lone"), (3, 5, "user", ""),
            (4, 0, "assistant", "long \\ ### User: </turn> text 漢字 " * 40_000), (1 << 60, 2, "system", " \n ")]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DDL)
    pieces = chat_format.assemble(df, PATH, piece_tokens=1000).cache()
    assert pieces.where(F.size("ids") > 1000).count() == 0 and pieces.where("conv_id = 4").count() > 100
    got = chat_format.read_back(pieces, PATH).drop("n_tokens").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)
    assert chat_format.read_back(chat_format.assemble(df.limit(0), PATH), PATH).collect() == []


def test_mask_covers_trained_texts_only(spark):
    df = spark.createDataFrame([(1, 0, "user", "question", "", "", 0), (1, 1, "assistant", "an answer", "", "", 0)], DDL)
    row = chat_format.assemble(df, PATH).first()
    c = chat_format.codec(PATH)
    assert [i for i, m in zip(row.ids, row.loss) if m] == c.ids("an answer")
    both = chat_format.assemble(df, PATH, trained_roles=("assistant", "user")).first()
    assert [i for i, m in zip(both.ids, both.loss) if m] == c.ids("question") + c.ids("an answer")
    assert set(both.loss) == {0, 1}
