"""Token ids of the public tokenizers, with a word cache per Python worker.

Workers import this module by name, so loaded tokenizers and caches live as
long as the worker, not the task.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

#: Cached words per worker; the cache starts anew beyond it (speed only).
CACHE_WORDS = 400_000
#: Longer stretches without white space are encoded without the cache.
CACHE_WORD_CHARS = 64

_WORD_BPE: dict[str, "WordBpe"] = {}
_BYTE_BPE: dict[str, "ByteBpe"] = {}
_STRETCH = re.compile(r"[^ \t\n\r]+")

# The quick path takes texts of characters below U+0180: their lower case and
# classes are the same to Python and to the tokenizer, and NFC keeps them.
_QUICK = re.compile("[\x00-\u017f]*").fullmatch
_L = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_N = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_PIECE = re.compile(f"[{_L}]+|[{_N}]|'(?:s|t|re|ve|m|ll|d)|[^ \\t\\n\\x0b\\x0c\\r\\x85\\xa0{_L}{_N}]+").findall


def _byte_letters() -> dict[int, str]:
    """Byte-level spelling: printable Latin-1 bytes stand for themselves, the
    others for the characters from U+0100 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


class _Cache(dict):
    """Piece -> ids; starts anew when full."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, piece: str):
        got = self._make(piece)
        if len(piece) <= CACHE_WORD_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[piece] = got
        return got


class WordBpe:
    """A ``tokenizers`` file that lower-cases, drops white space, cuts a text
    into letter runs, digits and runs of other signs, and merges inside these
    pieces only. Ids equal ``Tokenizer.encode(text, add_special_tokens=False)``:
    usual texts are cut here and their pieces merged once per worker; texts
    with characters from U+0180 on or with ``<|`` go through the whole
    tokenizer, stretch by stretch between spaces."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._model, self._letters = self._tok.model, _byte_letters()
        self._pieces = _Cache(self._merge).__getitem__
        self._stretches = _Cache(self._encode).__getitem__

    def _merge(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = "".join(map(self._letters.__getitem__, piece.encode()))
        elif not piece.isprintable():
            piece = piece.translate(self._letters)
        return array("I", [t.id for t in self._model.tokenize(piece)]).tobytes()

    def _encode(self, stretch: str) -> bytes:
        return array("I", self._tok.encode(stretch, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> np.ndarray:
        if "<|" not in text and _QUICK(text):
            packed = b"".join(map(self._pieces, _PIECE(text.lower())))
        else:
            packed = b"".join(map(self._stretches, _STRETCH.findall(text)))
        return np.frombuffer(packed, "<u4")

    def count(self, text: str) -> int:
        return len(self.ids(text))


class ByteBpe:
    """Token counts of a ``tiktoken`` rank file, cached per regex piece (no
    token crosses a piece)."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import regex
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})
        self._pieces = regex.compile(public_tokenizers.PATTERN).findall
        self._cache: dict[str, int] = {}

    def count(self, text: str) -> int:
        n, cache = 0, self._cache
        for w in self._pieces(text):
            got = cache.get(w)
            if got is None:
                got = len(self._enc.encode_ordinary(w))
                if len(w) <= CACHE_WORD_CHARS:
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    cache[w] = got
            n += got
        return n


def word_bpe(path: str) -> WordBpe:
    if path not in _WORD_BPE:
        _WORD_BPE[path] = WordBpe(path)
    return _WORD_BPE[path]


def byte_bpe(path: str) -> ByteBpe:
    if path not in _BYTE_BPE:
        _BYTE_BPE[path] = ByteBpe(path)
    return _BYTE_BPE[path]
