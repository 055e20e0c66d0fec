"""Document fingerprints by one-permutation MinHash.

Every shingle is hashed once; the high bits choose one of ``BINS`` bins and
each bin keeps its smallest value. Empty bins are filled by optimal
densification: a bin probes others by its own hash sequence, which does not
depend on the text, until it meets a filled one. The low ``BITS`` bits per bin
are packed; chance agreement of the low bits is corrected in the estimate.

``with_edits`` also fingerprints each document's edited text, which borrows
from the next document in descending id order. Documents are dealt to ranges
of ids; the head of each range is copied to the range before, so every
successor is found by streaming through one sorted range, and no window
spans the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column_names, prepare, words

BINS = 512
BITS = 4
SHINGLE_WORDS = 5
#: Id ranges per shuffle partition when successors are sought.
RANGES_PER_PARTITION = 4

_MULT = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift, multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hashes of words (hashing a short word costs less than a look-up)."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, tokens)), ">u8").astype("uint64")


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the distinct ``n``-word shingles (the whole sequence if shorter)."""
    if not len(hashes):
        return hashes
    k = min(n, len(hashes))
    with np.errstate(over="ignore"):
        out = np.full(len(hashes) - k + 1, np.uint64(k), "uint64")
        for i in range(k):
            out = _mix(out * _MULT + hashes[i:len(hashes) - k + 1 + i])
    return np.unique(out)


#: probe[a, i]: the bin that empty bin i asks in its a-th attempt.
_PROBES = (_mix(np.arange(64 * BINS, dtype="uint64") * _MULT + np.uint64(7)) >> np.uint64(20)).astype("int64").reshape(64, BINS) % BINS


def signature(values: np.ndarray) -> np.ndarray | None:
    """Densified bin minima of a shingle set; None for the empty set."""
    if not len(values):
        return None
    where = (values >> np.uint64(64 - BINS.bit_length() + 1)).astype("int64")
    low = values & np.uint64((1 << 48) - 1)
    mins = np.full(BINS, np.uint64(1 << 63), "uint64")
    np.minimum.at(mins, where, low)
    filled = mins != np.uint64(1 << 63)
    empty = np.flatnonzero(~filled)
    source = np.arange(BINS)
    for a in range(len(_PROBES)):
        if not len(empty):
            break
        ask = _PROBES[a, empty]
        ok = filled[ask]
        source[empty[ok]] = ask[ok]
        empty = empty[~ok]
    if len(empty):  # few filled bins: one more hash ranks them for each empty bin
        have = np.flatnonzero(filled).astype("uint64")
        with np.errstate(over="ignore"):
            rank = _mix(empty.astype("uint64")[:, None] * np.uint64(BINS) + have[None, :] + np.uint64(1 << 32))
        source[empty] = have[rank.argmin(1)].astype("int64")
    return (mins[source] & np.uint64((1 << BITS) - 1)).astype("uint8")


def pack(sig: np.ndarray | None) -> str:
    """Lowercase hex of the packed low-order bits; '' for no signature."""
    if sig is None:
        return ""
    bits = np.unpackbits(sig[:, None], axis=1)[:, 8 - BITS:]
    return np.packbits(bits.ravel()).tobytes().hex()


def unpack(text: str) -> np.ndarray | None:
    if not text:
        return None
    bits = np.unpackbits(np.frombuffer(bytes.fromhex(text), "uint8"))[:BINS * BITS].reshape(BINS, BITS)
    return np.packbits(np.pad(bits, ((0, 0), (8 - BITS, 0))), axis=1)[:, 0]


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Estimated Jaccard similarity, corrected for chance agreement. Two
    fingerprints of empty sets are alike, an empty and another are not."""
    if a is None or b is None:
        return float(a is None and b is None)
    same = float((a == b).mean())
    chance = 2.0 ** -BITS
    return min(1.0, max(0.0, (same - chance) / (1 - chance)))


class Fingerprinter:
    def __init__(self, n: int = SHINGLE_WORDS):
        self.n = n

    def __call__(self, text: str) -> np.ndarray | None:
        return signature(shingles(word_hashes(words(text)), self.n))


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first
    code points of ``following``, or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _rank(value: Column, cuts: list[int], fan: int = 64) -> Column:
    """How many of the sorted ``cuts`` are at most ``value``, by a search tree
    of arrays: ``fan`` comparisons a level."""
    levels = [cuts]
    while len(levels[0]) > fan:
        levels.insert(0, levels[0][::fan])
    at = F.lit(0)
    for k, level in enumerate(levels):
        # the last entry at most ``value`` one level up begins this level's stretch
        start = F.greatest(at - 1, F.lit(0)) * fan if k else F.lit(0)
        part = F.slice(F.array(*map(F.lit, level)).cast("array<long>"), start + 1, F.lit(fan))
        at = start + F.size(F.filter(part, lambda c: c <= value))
    return at.cast("int")


_FIELDS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")


def fingerprints(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fingerprint`` of every row's whole text (null: empty)."""
    prepare(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        make = Fingerprinter(n)
        for b in batches:
            made = pa.array([pack(make(t or "")) for t in b.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), made], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, fingerprint string")


def with_edits(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprints of every document and of its edited text. The next
    document follows in descending doc_id, ties by text, null ids last; after
    the last comes the first (a single row is its own next). Null texts are
    empty; extra columns are left out; no rows give no rows."""
    spark = docs.sparkSession
    prepare(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    steps = [i / (parts * RANGES_PER_PARTITION) for i in range(1, parts * RANGES_PER_PARTITION)]
    cuts = sorted(set(ids.agg(F.percentile_approx("doc_id", steps, 10_000)).first()[0] or []))

    # range r holds cuts[r-1] <= doc_id < cuts[r]; null ids go below all others
    at = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(_rank(F.col("doc_id"), cuts))
    # one row per range: a bounded table whatever the input
    heads = sorted((r["r"], r["head"]) for r in ids.select(at.alias("r"), "doc_id").groupBy("r")
                   .agg(F.max("doc_id").alias("head")).collect())
    if not heads:
        return spark.createDataFrame([], _FIELDS)
    # the head of a range also closes the next higher one; the topmost closes the lowest
    closes = spark.createDataFrame([(head, heads[(i + 1) % len(heads)][0]) for i, (_, head) in enumerate(heads)],
                                   "head long, r int")
    dealt = rows.withColumn("r", at)
    spare = rows.join(F.broadcast(closes), F.col("doc_id").eqNullSafe(F.col("head"))).select(
        "doc_id", "text", "r", F.lit(1).alias("tail"))
    ranged = (dealt.withColumn("tail", F.lit(0)).unionByName(spare)
              .repartition(parts, "r")
              .sortWithinPartitions("r", "tail", F.col("doc_id").desc_nulls_last(), "text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        make, kinds = Fingerprinter(n), (pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())

        def stream():
            for b in batches:
                yield from zip(*(b.column(k).to_pylist() for k in range(4)))

        def pairs():
            held = None
            for r, tail, doc_id, text in stream():
                sig = make(text) if not tail or held and held[0] == r else None
                if held and held[0] == r:
                    yield held[1:], text, sig
                held = None if tail else (r, doc_id, text, sig)

        def row(own, following, next_sig):
            doc_id, text, sig = own
            new = edited(text, following)
            new_sig = make(new)
            return (doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), pack(sig), pack(new_sig), likeness(sig, new_sig), likeness(sig, next_sig))

        todo = (row(*p) for p in pairs())
        while part := list(islice(todo, 500)):
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*part), kinds)],
                                             names=[f.split()[0] for f in _FIELDS.split(", ")])

    return ranged.select("r", "tail", "doc_id", "text").mapInArrow(run, _FIELDS)
