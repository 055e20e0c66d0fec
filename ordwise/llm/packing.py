"""Best-fit packing of documents into fixed-length token sequences.

Documents are tokenized where they lie; one narrow row per piece remains
(no ids, no text). Pieces are dealt by hash into groups of bounded size and
each group is packed by bounded-space online best-fit: at most ``OPEN_BINS``
bins are open, found through a bitset of their free spaces; a piece goes to
the fullest bin that takes it, and when one bin too many is open the fullest
closes first. Groups are independent, so a lost executor repeats only its
own groups, and no task holds more than a group.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare

SEQUENCE_TOKENS = 2048
SEPARATOR_ID = 0
#: Bins open at a time in a group.
OPEN_BINS = 512
#: Pieces per group on average: bounds a packing task, grows in number with the input.
GROUP_PIECES = 8000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECES}, sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece of every document. A null or empty text is a
    document of its separator alone; each row counts as its own document,
    repeated ids and null ids included; other columns are left out."""
    prepare(docs.sparkSession)

    def cut(batches: Iterator) -> Iterator:
        from ordwise.llm.tokens import word_bpe
        tok, kinds = word_bpe(tokenizer_path), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                arr = np.append(tok.ids(text or ""), np.uint32(SEPARATOR_ID)).astype("<u4", copy=False)
                for k, at in enumerate(range(0, len(arr), size)):
                    part = arr[at:at + size]
                    rows.append((doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _PIECES)


def best_fit(lengths, size: int, open_bins: int) -> tuple[list[int], list[int]]:
    """Bin number and offset for each length, in order of arrival."""
    by_free: list[list[int]] = [[] for _ in range(size + 1)]
    free_set, n_open, made = 0, 0, 0
    bins, offsets = [], []
    for need in lengths:
        fits = free_set >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            bin_no = by_free[free].pop()
            if not by_free[free]:
                free_set &= ~(1 << free)
            n_open -= 1
        else:
            bin_no, free, made = made, size, made + 1
        bins.append(bin_no)
        offsets.append(size - free)
        left = free - need
        if left:
            by_free[left].append(bin_no)
            free_set |= 1 << left
            n_open += 1
            if n_open > open_bins:
                fullest = (free_set & -free_set).bit_length() - 1
                by_free[fullest].pop()
                if not by_free[fullest]:
                    free_set &= ~(1 << fullest)
                n_open -= 1
    return bins, offsets


def pack(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS,
         open_bins: int = OPEN_BINS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece with its place: ``doc_id, piece, start, length,
    ids_crc32, sequence_id, offset``. An empty table gives no rows."""
    # the stored row number tells repeated pieces apart: they spread over all groups
    cut = materialize(pieces(docs, tokenizer_path, size).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))

    def place(key: tuple[pa.Scalar, ...], b: pa.Table) -> pa.Table:
        b = b.sort_by([("_order", "ascending"), ("_row", "ascending")])
        bins, offsets = best_fit(b["length"].to_pylist(), size, open_bins)
        return (b.drop_columns(["_row", "_order", "_group"])
                .append_column("sequence_id", pa.array(np.asarray(bins, "int64") + (key[0].as_py() << 32)))
                .append_column("offset", pa.array(offsets, pa.int64())))

    order = F.xxhash64("doc_id", "piece", "ids_crc32", "_row")
    return (cut.withColumn("_order", order)
            .withColumn("_group", F.pmod(order, F.lit(groups)))
            .groupBy("_group").applyInArrow(place, _PACKED))
