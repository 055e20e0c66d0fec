"""Chat formatting by token-level assembly.

Template (text form), turn by turn::

    ### User:\\n<text></turn>\\n

with one header for each of three roles; any other role is written as
``### Other:\\n<role></role>\\n<text></turn>\\n``. Headers and ends are single
reserved ids above the tokenizer's vocabulary. Each text is encoded by itself,
so no token crosses a segment, no text can make a reserved id, and a turn's
ids do not depend on its neighbours.

Control strings in a text are escaped reversibly: backslashes are doubled and
a backslash is put behind the first character of each control string. No
escaped text holds a control string, so the text form can be parsed as well.

The loss mask is a prefix sum: +1 where the text of a trained turn starts, -1
where it ends; tokens with sum 1 are under the mask. Turns are encoded where
they lie; then one exchange brings a conversation's turns together in order
and they are spliced as a stream into pieces of bounded length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

# Fixed values of the template: the control strings, in order of their reserved ids.
HEADERS = {"system": "### System:", "user": "### User:", "assistant": "### Assistant:"}
OTHER, ROLE_END, TURN_END = "### Other:", "</role>", "</turn>"
CONTROLS = [*HEADERS.values(), OTHER, ROLE_END, TURN_END]
#: In the text form each control string ends its line.
LINE_END = "\n"
#: Tokens per assembled row: bounds a row, a longer conversation has more rows.
PIECE_TOKENS = 1 << 16

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURNS = "conv_id long, turn long, role string, tokens binary, text_start long, text_end long, trained boolean"
_PIECES = "conv_id long, piece int, start long, ids array<int>, loss array<tinyint>"
_READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
         "formatted_chars long, n_tokens long")


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Codec:
    """Ids of texts and control strings, and back."""

    def __init__(self, path: str):
        from .tokens import byte_bpe
        self._enc = byte_bpe(path)._enc
        self.base = self._enc.n_vocab
        self.reserved = {c: self.base + k for k, c in enumerate(CONTROLS)}
        self._bytes = {i: b for b, i in self._enc._mergeable_ranks.items()}

    def ids(self, text: str) -> list[int]:
        return self._enc.encode_ordinary(escape(text))

    def turn(self, role: str, text: str) -> tuple[list[int], int]:
        """The ids of a turn and where those of its text start."""
        if role in HEADERS:
            head = [self.reserved[HEADERS[role]]]
        else:
            head = [self.reserved[OTHER], *self.ids(role), self.reserved[ROLE_END]]
        return [*head, *self.ids(text), self.reserved[TURN_END]], len(head)

    def raw(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids.tolist()))


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a tokenizer file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_turns(conversations: DataFrame, tokenizer_path: str, trained_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Each row's ids (little-endian unsigned 32-bit ``tokens``) with the place
    of its text: a map, without order or exchange."""
    def encode(batches) -> Iterator:
        import pyarrow as pa

        from ordwise.llm.chat_format import codec
        c = codec(tokenizer_path)
        for b in batches:
            roles = [r or "" for r in b.column(2).to_pylist()]
            tokens, starts, ends = [], [], []
            for role, text in zip(roles, b.column(3).to_pylist()):
                ids, at = c.turn(role, text or "")
                tokens.append(np.asarray(ids, "<u4").tobytes())
                starts.append(at)
                ends.append(len(ids) - 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(roles, pa.string()), pa.array(tokens, pa.binary()),
                 pa.array(starts, pa.int64()), pa.array(ends, pa.int64()),
                 pa.array([r in trained_roles for r in roles])],
                names=["conv_id", "turn", "role", "tokens", "text_start", "text_end", "trained"])

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(encode, _TURNS)


class _Splicer:
    """Turns of one conversation in order -> pieces of bounded length."""

    def __init__(self, size: int):
        self.size, self.ids, self.steps, self.held = size, [], [], 0
        self.piece, self.start, self.open = 0, 0, 0

    def add(self, tokens: bytes, lo: int, hi: int, trained: bool) -> Iterator[tuple]:
        ids = np.frombuffer(tokens, "<u4")
        step = np.zeros(len(ids), np.int64)
        if trained and hi > lo:
            step[lo], step[hi] = 1, -1
        self.ids.append(ids)
        self.steps.append(step)
        self.held += len(ids)
        if self.held >= self.size:
            yield from self.cut(whole_only=True)

    def cut(self, whole_only: bool = False) -> Iterator[tuple]:
        ids, steps = np.concatenate(self.ids), np.concatenate(self.steps)
        at = 0
        while len(ids) - at >= (self.size if whole_only else 1):
            part = slice(at, at + self.size)
            mask = self.open + np.cumsum(steps[part])
            yield self.piece, self.start, ids[part].astype(np.int32), mask.astype(np.int8)
            self.open, n = int(mask[-1]), len(mask)
            self.piece, self.start, at = self.piece + 1, self.start + n, at + n
        self.ids, self.steps, self.held = [ids[at:]], [steps[at:]], len(ids) - at


def assemble(conversations: DataFrame, tokenizer_path: str, trained_roles: tuple[str, ...] = ("assistant",),
             piece_tokens: int = PIECE_TOKENS) -> DataFrame:
    """Formatted conversations: ``conv_id, piece, start, ids, loss`` with the
    token ids and loss mask (1: trained on) of at most ``piece_tokens`` tokens
    a row, ``start`` tokens before it; a conversation's pieces lie together, in
    order, in one partition.

    Turns go by ``turn`` (null first), equal ones by role and ids. A null text
    or role is an empty one; repeated rows all count. A row without ``conv_id``
    is a conversation of its own. Other columns are left out; an empty table
    gives no rows. A conversation is spliced as a stream of its turns, so that
    even one with a third of all rows needs the memory of a piece."""
    spark = conversations.sparkSession
    prepare(spark)
    turns = encode_turns(conversations, tokenizer_path, trained_roles)
    named = (turns.where(F.col("conv_id").isNotNull()).repartition("conv_id")
             .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "tokens"))
    lone = turns.where(F.col("conv_id").isNull())

    def splice(batches) -> Iterator:
        import pyarrow as pa

        from ordwise.llm.chat_format import _Splicer
        conv, open_ = None, None

        def record(rows: list[tuple]):
            at = np.cumsum([0, *(len(r[3]) for r in rows)]).astype(np.int32)
            lists = (pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([r[k] for r in rows]))) for k in (3, 4))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.int64()), *lists], names=["conv_id", "piece", "start", "ids", "loss"])

        rows, held = [], 0
        for b in batches:
            cols = [b.column(k) for k in (0, 3, 4, 5, 6)]
            for cid, tokens, lo, hi, trained in zip(*(c.to_pylist() for c in cols)):
                if open_ is not None and (cid is None or cid != conv):
                    rows += [(conv, *p) for p in open_.cut()]
                    held += open_.start
                    open_ = None
                if open_ is None:
                    conv, open_ = cid, _Splicer(piece_tokens)
                for p in open_.add(tokens, lo, hi, trained):
                    rows.append((conv, *p))
                    held += piece_tokens
                if held >= 4 * piece_tokens:
                    yield record(rows)
                    rows, held = [], 0
        if open_ is not None:
            rows += [(conv, *p) for p in open_.cut()]
        if rows:
            yield record(rows)

    return named.mapInArrow(splice, _PIECES).unionByName(lone.mapInArrow(splice, _PIECES))


class _Reader:
    """Reads a conversation back from its ids and mask, piece by piece."""

    def __init__(self, c: Codec):
        self.c, self.names = c, {i: s for s, i in c.reserved.items()}
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = self.tokens = 0
        self.role, self.text, self.masked = "", [], []

    def read(self, ids: np.ndarray, loss: np.ndarray) -> None:
        self.tokens += len(ids)
        at = 0
        for k in [*np.flatnonzero(ids >= self.c.base).tolist(), len(ids)]:
            if k > at:
                self.text.append(self.c.raw(ids[at:k]))
                if loss[at:k].any():
                    self.masked.append(self.c.raw(ids[at:k][loss[at:k] == 1]))
            if k < len(ids):
                self._control(self.names[int(ids[k])], bool(loss[k]))
            at = k + 1

    def _take(self, parts: list[bytes]) -> str:
        got = b"".join(parts).decode()
        parts.clear()
        return got

    def _control(self, mark: str, masked: bool) -> None:
        self.formatted += len(mark) + len(LINE_END)
        if masked:
            self.masked.append(mark.encode())
        if mark == ROLE_END:
            raw = self._take(self.text)
            self.formatted += len(raw)
            self.role = unescape(raw)
        elif mark == TURN_END:
            raw = self._take(self.text)
            self.formatted += len(raw)
            self.turns.update(f"{self.role}\n{unescape(raw)}\n".encode())
            self.n_turns += 1
            told = unescape(self._take(self.masked))
            self.loss_chars += len(told)
            self.loss.update(told.encode())
        else:
            self.role = next((r for r, h in HEADERS.items() if h == mark), "")

    def row(self) -> tuple:
        return (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted, self.tokens)


def read_back(pieces: DataFrame, tokenizer_path: str) -> DataFrame:
    """What the assembled ids and masks say, a row per conversation: ``n_turns``,
    ``turns_sha256`` (role, \\n, text, \\n per turn), ``loss_chars`` and
    ``loss_sha256`` (all text under the mask, unescaped), ``formatted_chars``
    (code points of the text form) and ``n_tokens``. Takes the rows of
    ``assemble`` as they lie; stored ones must be brought together and sorted
    by ``conv_id, piece`` first."""
    def read(batches) -> Iterator:
        import pyarrow as pa

        from ordwise.llm.chat_format import _Reader, codec
        c, conv, reader, rows = codec(tokenizer_path), None, None, []
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]

        def record(rows: list[tuple]):
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            ids, loss = b.column(3), b.column(4)
            for k, (cid, piece) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if piece == 0:
                    if reader is not None:
                        rows.append((conv, *reader.row()))
                    conv, reader = cid, _Reader(c)
                reader.read(ids[k].values.to_numpy(zero_copy_only=False), loss[k].values.to_numpy(zero_copy_only=False))
            if rows:
                yield record(rows)
                rows = []
        if reader is not None:
            yield record([(conv, *reader.row())])

    return pieces.mapInArrow(read, _READ)


def oracle(extra: str = "") -> str:
    """DuckDB SQL for ``read_back(assemble(conversations))``; ``extra``: more
    rows, as a SELECT of ``conv_id, turn, role, text``."""
    q = "'" + "|".join(re.escape(c) for c in CONTROLS) + "'"
    known = " ".join(f"WHEN '{r}' THEN {len(h) + len(LINE_END)}" for r, h in HEADERS.items())
    more = f"UNION ALL {extra}" if extra else ""

    def grown(col: str) -> str:
        return (f"(length({col}) + length({col}) - length(replace({col}, '\\', '')) "
                f"+ len(regexp_extract_all(replace({col}, '\\', '\\\\'), {q})))")

    return f"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations {more}),
keyed AS (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS lone,
  {grown('text')} + {len(TURN_END) + len(LINE_END)} + CASE role {known}
    ELSE {len(OTHER) + len(ROLE_END) + 2 * len(LINE_END)} + {grown('role')} END AS formatted FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role)) AS loss_sha256,
  CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM keyed GROUP BY conv_id, lone"""
