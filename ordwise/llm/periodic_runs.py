"""Periodic run detection by recursive frequency splitting.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
identical), of at least ``max(min_words, min_periods * q)`` words, that no
neighbouring word extends. Every word of a run occurs in it at least
``min_periods`` times, so a word that occurs less often within its segment is
in no run of the segment and splits it. The pieces are counted anew and split
again until nothing changes; usual prose falls apart into pieces too short
for a run. What survives is scanned lag by lag.

Lag scan. At lag ``q`` a run is a streak of ``max(min_words - q, (min_periods
- 1) * q)`` or more equal pairs ``w[i] == w[i + q]``. Such a streak holds a
whole aligned block of half that length, so only block starts are compared
first: all lags together look at ``m log m`` places of a segment of ``m``
words. Lags go up; a streak inside a run whose period divides ``q`` is that
run again and is left out, so each run comes once, with its smallest period.

One map over the documents: no exchange, a lost executor repeats its tasks.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame

from .common import append_columns, column_names, prepare

MIN_WORDS = 24
MIN_PERIODS = 3
_RUN = "struct<start:long,length:long,period:long>"


def word_numbers(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def split_rare(ids: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int]]:
    """``(start, end)`` of the segments of ``min_words`` or more words in
    which every word occurs at least ``min_periods`` times."""
    stable: list[tuple[int, int]] = []
    at, seg = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    width = int(ids.max(initial=0)) + 1
    while len(at):
        _, which, counts = np.unique(seg * width + ids[at], return_inverse=True, return_counts=True)
        often = counts[which] >= min_periods
        torn = np.zeros(int(seg[-1]) + 1, bool)
        torn[seg[~often]] = True
        whole = ~torn[seg]
        for lo, hi in _stretches(at[whole], seg[whole]):
            if hi - lo >= min_words:
                stable.append((lo, hi))
        left = often & torn[seg]
        at, seg = at[left], seg[left]
        if len(at):
            new = np.empty(len(at), bool)
            new[0], new[1:] = True, (np.diff(at) != 1) | (np.diff(seg) != 0)
            seg = np.cumsum(new) - 1
            long = np.bincount(seg)[seg] >= min_words
            at, seg = at[long], seg[long]
    return sorted(stable)


def _stretches(at: np.ndarray, seg: np.ndarray) -> Iterable[tuple[int, int]]:
    if len(at):
        cuts = np.flatnonzero(np.diff(seg) != 0) + 1
        for part in np.split(at, cuts):
            yield int(part[0]), int(part[-1]) + 1


def _streak(w: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The longest stretch ``[lo, hi)`` around ``i`` with ``w[j] == w[j + q]``."""
    hi, step, end = i, 64, len(w) - q
    while hi < end:
        differ = w[hi:hi + step][:end - hi] != w[hi + q:hi + q + step]
        if differ.any():
            hi += int(differ.argmax())
            break
        hi, step = hi + len(differ), step * 4
    lo, step = i, 64
    while lo > 0:
        a = max(0, lo - step)
        differ = w[a:lo] != w[a + q:lo + q]
        if differ.any():
            lo -= int(differ[::-1].argmax())
            break
        lo, step = a, step * 4
    return lo, hi


def lag_scan(w: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a segment."""
    m = len(w)
    runs: list[tuple[int, int, int]] = []
    found = np.empty((0, 3), np.int64)
    for q in range(1, m // min_periods + 1):
        need = max(min_words - q, (min_periods - 1) * q, 1)
        block = max(1, need // 2)
        at = np.arange(0, m - q - block + 1, block)
        at = at[w[at] == w[at + q]]
        for t in (block - 1, block // 2, block // 4, 3 * block // 4, block // 8, 7 * block // 8):
            if not len(at):
                break
            at = at[w[at + t] == w[at + t + q]]
        if not len(at):
            continue
        for s, n, _ in found[(q % found[:, 2] == 0) & (found[:, 1] > q)]:
            at = at[(at < s) | (at >= s + n - q)]
        done, new = -1, []
        for i in at.tolist():
            if i >= done:
                lo, done = _streak(w, i, q)
                if done - lo >= need:
                    new.append((lo, done - lo + q, q))
        if new:
            runs += new
            found = np.asarray(runs, np.int64)
    return runs


def find_runs(words: list[bytes], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a text, by start, then period."""
    if len(words) < min_words:
        return []
    ids = word_numbers(words)
    return sorted(((lo + s, n, q) for lo, hi in split_rare(ids, min_words, min_periods)
                   for s, n, q in lag_scan(ids[lo:hi], min_words, min_periods)),
                  key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The text with one period left of each run: a word goes if any run
    holds it after that run's first period. Kept words are joined by a space."""
    if runs:
        keep = np.ones(len(words), bool)
        for s, n, q in runs:
            keep[s + q:s + n] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def detect(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``docs`` with ``n_words long, runs array<struct<start, length, period>>``
    (word numbers from 0, by start, then period) and ``collapsed string``.

    Words are what lies between the six ASCII white-space characters, taken as
    they are. A null, empty or blank text has no words, no runs and an empty
    collapsed text; whole texts are read, however long. Each row is treated by
    itself: repeated rows, equal ids and null ids give a row each. Columns that
    already have one of the names stay; the new ones get a leading underscore.
    An empty table gives no rows. At least two periods are required."""
    if min_periods < 2:
        raise ValueError("a run needs two periods or more")
    prepare(docs.sparkSession)
    n_words, runs_name, collapsed = column_names(docs, "n_words", "runs", "collapsed")

    def make(texts: list[str | None]) -> list:
        import pyarrow as pa
        counts, found, kept = [], [], []
        for text in texts:
            words = text.encode().split() if text else []
            runs = find_runs(words, min_words, min_periods)
            counts.append(len(words))
            found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
            kept.append(collapse(words, runs))
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        return [pa.array(counts, pa.int64()), pa.array(found, pa.list_(run)),
                pa.array(kept, pa.binary()).cast(pa.string())]

    return append_columns(docs, f"{n_words} long, {runs_name} array<{_RUN}>, {collapsed} string", make)
