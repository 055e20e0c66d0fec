"""Toxicity: boosted trees over dense features, calibrated by isotonic
regression.

A lexicon of words and word beginnings that mark toxic texts is learnt from
labelled rows (counts in a Spark aggregation over a bounded sample, one text
per group of copies). Features are densities and counts of lexicon hits,
hits near a second-person word, capitals, punctuation and obfuscated
spellings. Features of training rows use the lexicon of the other half of
the sample, so the trees see it as new texts will. Only the text is scored.

Scoring is one pass over the documents without a shuffle; the model is a few
kilobytes whatever the input.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import trees
from .common import append_columns, column_names, crc_mod, labelled_sample, materialize, prepare

#: Bound of the training sample (rows).
SAMPLE_ROWS = 12_000
THRESHOLD = 0.3
#: A lexicon entry stands in this share of the toxic texts at least, and in 3.
MIN_SHARE, MIN_TEXTS = 0.01, 3
#: How many times likelier an entry must be in toxic texts.
ODDS = 8.0
#: A weak entry may be this much (in log probability) likelier to be chance than a strong one.
WEAKER = 5.0
BEGINNINGS = (4, 5, 6, 7)
CACHE_WORDS = 300_000

# Second-person words of the four languages.
SECOND_PERSON = frozenset("""you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch
euer eure tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros os""".split())

_LEET = str.maketrans("0134578@$!|+", "oieastbasiit")
_EDGE = string.punctuation + "¡¿«»“”„‘’…"
_NON_LETTER = re.compile(r"[\W\d_]+")


def spelling(token: str) -> tuple[str, bool]:
    """A token's plain spelling, and whether letters were replaced or parted."""
    core = token.casefold().strip(_EDGE)
    if not core or core.isalpha() and token[0] not in "$@":
        return core, False
    plain = _NON_LETTER.sub("", token.casefold().translate(_LEET).strip(_EDGE))
    return plain, len(plain) >= 3 and not core.isdigit() and any(c.isalpha() for c in core)


def terms(word: str) -> list[str]:
    return [word] + [f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n]


class Featurizer:
    """Dense features of texts for one lexicon ``{term: strong?}``."""

    N = 15

    def __init__(self, lexicon: dict[str, bool]):
        self.lexicon, self._cache = lexicon, {}

    def _code(self, token: str) -> int:
        """Bits of a token: 1 strong hit, 2 weak hit, 4 obfuscated, 8 capitals,
        16 second person, 32 exclamation, 64 question, 128 single letter, 256 no letter."""
        word, hidden = spelling(token)
        hits = [self.lexicon[t] for t in terms(word) if t in self.lexicon] if word else []
        code = (1 if any(hits) else 2 if hits else 0) | (4 if hidden else 0)
        code |= 8 if len(word) > 1 and token.isupper() else 0
        code |= (16 if word in SECOND_PERSON else 0) | (32 if "!" in token else 0) | (64 if "?" in token else 0)
        code |= (128 if len(word) == 1 else 0) | (0 if word else 256)
        if len(token) <= 64:
            if len(self._cache) >= CACHE_WORDS:
                self._cache.clear()
            self._cache[token] = code
        return code

    def one(self, text: str) -> list[float]:
        tokens = text.split()
        n = len(tokens)
        if not n:
            return [0.0] * self.N
        known = list(map(self._cache.get, tokens))
        codes = np.array([self._code(t) if c is None else c for t, c in zip(tokens, known)], "int32")
        strong = codes & 1 > 0
        single = np.flatnonzero(codes & 128)
        if len(single) >= 4:  # letters set apart: look their run up as one word
            for run in np.split(single, np.flatnonzero(np.diff(single) > 1) + 1):
                if len(run) >= 4:
                    word = "".join(spelling(tokens[i])[0] for i in run)
                    if any(self.lexicon.get(t) for t in terms(word)):
                        strong[run[0]] = True
                        codes[run[0]] |= 4
        weak, hidden, caps = codes & 2 > 0, codes & 4 > 0, codes & 8 > 0
        you = np.flatnonzero(codes & 16)
        hit_at = np.flatnonzero(strong | weak)
        near = 0
        if len(you) and len(hit_at):
            after = np.searchsorted(you, hit_at)
            gap = np.minimum(np.abs(hit_at - you[np.minimum(after, len(you) - 1)]),
                             np.abs(hit_at - you[np.maximum(after - 1, 0)]))
            near = int((gap <= 3).sum())
        burst = 0
        strong_at = np.flatnonzero(strong)
        if len(strong_at):
            burst = int((np.searchsorted(strong_at, strong_at + 50) - np.arange(len(strong_at))).max())
        k = int(strong.sum())
        return [k / n, np.log1p(k), weak.sum() / n, np.log1p(weak.sum()), hidden.sum() / n,
                np.log1p((hidden & (strong | weak)).sum()), caps.sum() / n, np.log1p((caps & strong).sum()),
                (codes & 32 > 0).sum() / n, (codes & 64 > 0).sum() / n, len(you) / n, np.log1p(near),
                (codes & 256 > 0).sum() / n, float(burst), np.log1p(n)]

    def all(self, texts: list[str]) -> np.ndarray:
        return np.array([self.one(t) for t in texts], float).reshape(len(texts), self.N)


class Model:
    def __init__(self, lexicon: dict[str, bool], boosted: trees.Boosted, centres: np.ndarray, means: np.ndarray):
        self.lexicon, self.boosted, self.centres, self.means = lexicon, boosted, centres, means
        self._featurizer = None

    def scores(self, texts: list[str | None]) -> np.ndarray:
        self._featurizer = self._featurizer or Featurizer(self.lexicon)
        if not len(self.centres) or not texts:
            return np.zeros(len(texts))
        raw = self.boosted.raw(self._featurizer.all([t or "" for t in texts]))
        return np.interp(raw, self.centres, self.means)


def _term_counts(sample: DataFrame) -> list:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for b in batches:
            for text, y, half in zip(b["text"], b["y"], b["half"]):
                found = {t for token in set(text.split()) for t in terms(spelling(token)[0])}
                seen.update((t, int(half), int(y)) for t in found if t)
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["term", "half", "y", "n"])

    one = lambda c, v: F.sum(F.when(c, F.col("n")).otherwise(0)).alias(v)
    y, half = F.col("y"), F.col("half")
    return (sample.mapInPandas(count, "term string, half int, y int, n long").groupBy("term")
            .agg(*(one((half == h) & (y == v), f"n{h}{v}") for h in (0, 1) for v in (0, 1)))
            .where(F.col("n01") + F.col("n11") >= MIN_TEXTS).collect())


def _lexicon(counts: list, halves: tuple[int, ...], sizes: dict) -> dict[str, bool]:
    """Entries that are likelier in toxic texts than chance allows: the log of
    the binomial tail bound must pay for the number of terms looked at."""
    clean, toxic = (sum(sizes.get((h, v), 0) for h in halves) for v in (0, 1))
    out: dict[str, bool] = {}
    if not clean or not toxic:
        return out
    share, price = toxic / (clean + toxic), np.log(max(len(counts), 1))
    for r in counts:
        n0, n1 = (sum(r[f"n{h}{v}"] for h in halves) for v in (0, 1))
        odds = (n1 + 0.5) / (toxic + 1) / ((n0 + 0.5) / (clean + 1))
        if n1 < max(MIN_TEXTS, MIN_SHARE * toxic) or odds < ODDS:
            continue
        q = n1 / (n0 + n1)
        surprise = n1 * np.log(q / share) + (n0 * np.log((1 - q) / (1 - share)) if n0 else 0.0)
        if surprise >= price - WEAKER:
            out[r["term"]] = bool(surprise >= price)
    return out


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> Model:
    """Train on labelled rows whose crc32(doc_id) mod 4 is not 2. With no
    usable label, or one class only, every text scores that class's share."""
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, "toxic", max_rows, fold=True)
    # one text of each group of copies (equal smallest hash of words two apart): the smallest id's
    w = F.split(F.lower("text"), r"\s+")
    three = F.zip_with(w, F.slice(w, 3, F.greatest(F.size(w), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    sample = materialize(sample.groupBy(F.coalesce(F.array_min(three), F.xxhash64("text")).alias("_copy"))
                         .agg(F.min(F.struct("doc_id", "text", "y")).alias("first")).select("_copy", "first.*")
                         .withColumn("half", F.pmod(F.xxhash64("_copy"), F.lit(2)).cast("int"))
                         .select("doc_id", "text", F.col("y").cast("int").alias("y"), "half"), "toxic-sample")
    sizes = {(r["half"], r["y"]): r["count"] for r in sample.groupBy("half", "y").count().collect()}
    counts = _term_counts(sample)
    by_half = {h: _lexicon(counts, (1 - h,), sizes) for h in (0, 1)}

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = {h: Featurizer(lex) for h, lex in by_half.items()}
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "half": b["half"], "x": [
                made[h].one(t) for t, h in zip(b["text"], b["half"])]})

    rows = sample.mapInPandas(features, "doc_id long, y int, half int, x array<double>").collect()
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), Featurizer.N)
    y, half = np.array([r["y"] for r in rows], float), np.array([r["half"] for r in rows])
    unseen = np.zeros(len(y))
    for h in (0, 1):
        unseen[half == h] = trees.Boosted(x[half != h], y[half != h]).raw(x[half == h])
    return Model(_lexicon(counts, (0, 1), sizes), trees.Boosted(x, y), *trees.isotonic(unseen, y))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1. Null and empty texts score as texts
    without words. All columns stay; ``name`` must be free."""
    return append_columns(docs, f"{name} double", lambda texts: [pa.array(model.scores(texts), pa.float64())])


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; a null id is not held out."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(narrow, model).select(
        "doc_id", F.coalesce(crc_mod("doc_id") == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows the model predicts toxic, columns as they were."""
    name, = column_names(docs, "toxic_score")
    return score(docs, model, name).where(F.col(name) < THRESHOLD).drop(name)
