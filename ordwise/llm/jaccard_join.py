"""N-gram Jaccard join with adaptive multi-match prefixes.

Texts are sets of word shingles (64-bit hashes). Equal sets form a class and
are joined once. All tokens have one global order, rare before frequent;
frequencies are counted over all documents, and only their order matters for
the result's cost, never for the result.

Prefix rule. Let a set of ``n`` tokens be filed under its first
``p = n - ceil(t n) + l`` tokens. Common tokens of two sets that lie in both
prefixes number ``c``, and the overlap is at most ``c + max(n - p)``. So a
pair of similarity ``t`` shares at least ``alpha - max(n - p)`` prefix tokens,
with ``alpha = ceil(t / (1 + t) * (n1 + n2))``, which is ``l`` or more. A longer
prefix thus asks for more shared tokens. Each document takes the ``l`` of the
least estimated cost, from the lengths of its tokens' posting lists.

Large groups. Each document is first checked against one leader: the document
that leads most of its posting lists (the one that has the token earliest,
which in a group of near copies is the one with the fewest changes). Links
found this way are contracted; after that only pairs of different components
are candidates. Documents that still share tokens with another component get
their prefixes lengthened once more, by a tenth of their size: what remains of
a group of copies then needs so many shared tokens that few documents have
them, and those need to be listed under their few rarest ones only. A group of
any size costs links in proportion to its members, and every pair that could
connect two components is still checked.

All links. Linked documents are in one component, so ``links`` compares all
pairs of classes of each component: the classes are dealt to blocks and every
two blocks meet in one cell, where shared tokens are counted by matrix products
and only sums leave the cell. This part grows with the square of a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column_names, materialize, prepare, release, sided, words
from .components import connected
from .fingerprints import shingles, word_hashes

#: Bound of the table of frequent tokens that shapes the global order.
FREQUENT_TOKENS = 1 << 18
#: Shingles counted together in a task before its repeated ones are sent on.
COUNT_CHUNK = 2_000_000
#: Longest lengthening of a prefix for the index.
MAX_MATCH = 4
#: One part in so many of a set lengthens the prefix of a costly document.
LONG_PART = 10
#: Rounds that drop documents without enough tokens shared with other components.
OPEN_ROUNDS = 3
#: Cost of verifying a candidate, in steps along a posting list.
VERIFY_COST = 20
#: Documents whose texts are fetched by broadcast of their ids, at most.
BROADCAST_DOCS = 200_000
#: Tokens and classes in a block of a component, about.
BLOCK_TOKENS, BLOCK_CLASSES = 400_000, 2048
#: Tokens that one matrix product counts.
TOKEN_COLUMNS = 2048


def _need(n, percent: int):
    """Least overlap with any similar set: ceil(t n)."""
    return -(-percent * n // 100)


def frequent(docs: DataFrame, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that occur in most documents, sorted, with estimated counts: at
    most ``FREQUENT_TOKENS``. Counts are over all documents; a token seen once
    in a chunk of a task is not counted there."""

    def count(batches):
        held, size = [], 0

        def flush():
            token, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n > 1
            return pa.RecordBatch.from_arrays([pa.array(token[keep].view("int64")), pa.array(n[keep])], names=["token", "n"])

        for b in batches:
            for text in b.column(0).to_pylist():
                s = shingles(word_hashes(words(text)), n_words)
                held.append(s)
                size += len(s)
                if size >= COUNT_CHUNK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    seen = materialize(docs.select("text").mapInArrow(count, "token long, n long").groupBy("token")
                       .agg(F.sum("n").alias("n")), "jaccard-frequent")
    # the count above which tokens fit the bound, by powers of the fourth root of two
    steps = seen.groupBy(F.floor(F.log2("n") * 4).alias("step")).count().orderBy(F.desc("step")).collect()
    total, low = 0, None
    for r in steps:
        total += r["count"]
        if total > FREQUENT_TOKENS:
            break
        low = r["step"]
    rows = seen.where(F.floor(F.log2("n") * 4) >= low).toPandas() if low is not None else pd.DataFrame({"token": [], "n": []})
    token, n = rows["token"].to_numpy("int64").view("uint64"), rows["n"].to_numpy("int64")
    order = np.argsort(token)
    release(seen)
    return token[order], n[order]


def _sets(docs: DataFrame, n_words: int, percent: int, ranks) -> DataFrame:
    """``doc_id, h1, h2`` (128-bit hash of the set), ``n`` and the lengthened prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        known, count = shared.value
        for b in batches:
            h1, h2, ns, prefixes = [], [], [], []
            for text in b.column(1).to_pylist():
                s = shingles(word_hashes(words(text)), n_words)
                n = len(s)
                digest = xxhash.xxh3_128_digest(s.tobytes())
                h1.append(int.from_bytes(digest[:8], "little", signed=True))
                h2.append(int.from_bytes(digest[8:], "little", signed=True))
                ns.append(n)
                if n and len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    weight = np.where(known[at] == s, count[at], 0)
                    s = s[np.lexsort((s, weight))]
                prefixes.append(s[:min(n, n - _need(n, percent) + max(MAX_MATCH, -(-n // LONG_PART)))].view("int64"))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype("int32")
            flat = np.concatenate(prefixes) if prefixes else np.array([], "int64")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(ns, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "h1", "h2", "n", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, h1 long, h2 long, n long, prefix array<long>")


def _with_lists(rows: DataFrame, wanted: Column, *facts: Column) -> DataFrame:
    """``rows`` with facts about their token's list, where ``wanted`` holds of
    them. A list is aggregated before the shuffle and joined back as one row,
    so a token of very many documents is split among tasks like any skewed join."""
    return rows.join(rows.groupBy("token").agg(*facts).where(wanted), "token")


def _postings(classes: DataFrame, percent: int) -> DataFrame:
    """Tokens that several classes file themselves under: ``token, cid, pos, n,
    p, leader`` with each class's prefix length ``p`` chosen by cost."""
    base = F.col("n") - _least_overlap(F.col("n"), percent)
    rows = classes.select("cid", "n", F.posexplode(F.slice("prefix", F.lit(1), (base + MAX_MATCH).cast("int"))).alias("pos", "token"))
    by_token = Window.partitionBy("token")
    shared = (rows.withColumn("len", F.count(F.lit(1)).over(by_token))
              .withColumn("leader", F.min(F.struct("pos", "cid")).over(by_token)["cid"])
              .where(F.col("len") > 1))
    shared = materialize(shared.select("token", "cid", "pos", "n", "len", "leader"), "jaccard-postings")
    costs = shared.groupBy("cid", "n").agg(*(
        F.sum(F.when(F.col("pos") < base + m, F.col("len") - 1).otherwise(0)).alias(f"s{m}") for m in range(1, MAX_MATCH + 1)))
    best = F.array_min(F.array(*(F.struct((F.col(f"s{m}") * (1 + VERIFY_COST / m)).alias("cost"), F.lit(m).alias("m"))
                                 for m in range(1, MAX_MATCH + 1))))["m"]
    chosen = costs.select("cid", F.least(F.col("n"), base + best).cast("long").alias("p"))
    index = materialize(shared.join(chosen, "cid").where(F.col("pos") < F.col("p"))
                        .select("token", "cid", "pos", "n", "p", "leader"), "jaccard-index")
    release(shared)
    return index


def _least_overlap(n: Column, percent: int) -> Column:
    """Least overlap with any similar set: ceil(t n)."""
    return F.ceil(n * percent / 100)


def _overlap(n1: Column, n2: Column, percent: int) -> Column:
    """Overlap that makes two sets similar: ceil(t / (1 + t) * (n1 + n2))."""
    return F.ceil((n1 + n2) * percent / (100 + percent))


def _fewest_needed(n: Column, rest: Column, lo: Column, hi: Column, rest_of, percent: int) -> Column:
    """The fewest prefix tokens that a set of ``n``, with ``rest`` tokens
    outside its prefix, shares with any similar set of ``lo`` to ``hi`` tokens."""
    sizes = F.sequence(F.greatest(lo, _least_overlap(n, percent)), F.least(hi, F.floor(n * 100 / percent)))
    return F.greatest(F.lit(1), F.array_min(F.transform(sizes, lambda m: _overlap(n, m, percent) - F.greatest(rest, rest_of(m)))))


def _between_parts(rows: DataFrame) -> DataFrame:
    """Rows of tokens that different parts share, with the list's length and
    the smallest and largest set size in it."""
    return _with_lists(rows, F.col("p_lo") != F.col("p_hi"), F.min("part").alias("p_lo"), F.max("part").alias("p_hi"),
                       F.min("n").alias("lo"), F.max("n").alias("hi"), F.count(F.lit(1)).alias("len")).drop("p_lo", "p_hi")


def _open_documents(rows: DataFrame, rest: Column, rest_of, percent: int) -> DataFrame:
    """``cid, n, part, s, r`` of the documents that share enough tokens (``s``)
    with other components to be similar to any document there (``r``)."""
    met = rows.groupBy("cid", "n", "part").agg(F.count(F.lit(1)).alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                               F.first(rest).alias("rest"))
    r = _fewest_needed(F.col("n"), F.col("rest"), F.col("lo"), F.col("hi"), rest_of, percent)
    return met.withColumn("r", r).where(F.col("s") >= F.col("r")).select("cid", "n", "part", "s", "r")


def _candidates(index: DataFrame, classes: DataFrame, label: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Pairs ``a, b`` of classes in different components that may be similar,
    and the tables that they are read from; ``index`` and ``classes`` are used
    up here."""
    parts = (index.join(label, index["cid"] == label["node"], "left")
             .select("token", "cid", "n", "p", F.coalesce("root", "cid").alias("part")))
    left = materialize(_open_documents(_between_parts(parts), F.col("n") - F.col("p"),
                                       lambda m: _least_overlap(m, percent) - 1, percent), "jaccard-open")
    release(index)

    # the same with lengthened prefixes, among the documents that are left;
    # each round drops documents and with them tokens of others
    rest_of = lambda m: F.greatest(_least_overlap(m, percent) - F.greatest(F.lit(MAX_MATCH), F.ceil(m / LONG_PART)), F.lit(0))
    rows = (classes.select("cid", "prefix").join(left.select("cid", "n", "part"), "cid")
            .select("cid", "n", "part", F.explode("prefix").alias("token")))
    kept = None
    for _ in range(OPEN_ROUNDS):
        # a token that one part has alone stays so: the next round starts from what this one keeps
        stored, kept = kept, materialize(_between_parts(rows), "jaccard-rows")
        release(left, stored or classes)
        left = materialize(_open_documents(kept, rest_of(F.col("n")), rest_of, percent), "jaccard-open")
        rows = kept.select("cid", "n", "part", "token").join(left.select("cid"), "cid")
    # of s tokens in one order, two sets that share r have one among the first s - r + 1
    rows = materialize(kept.join(left.select("cid", "s", "r"), "cid").withColumn(
        "k", F.row_number().over(Window.partitionBy("cid").orderBy("len", "token"))), "jaccard-rows")
    short = materialize(rows.where(F.col("k") <= F.col("s") - F.col("r") + 1).select("token", "cid", "n", "part"), "jaccard-short")
    x = short.select("token", *(F.col(c).alias(f"{c}1") for c in ("cid", "n", "part")))
    y = short.select("token", *(F.col(c).alias(f"{c}2") for c in ("cid", "n", "part")))
    pairs = x.join(y, (x["token"] == y["token"]) & (F.col("cid1") < F.col("cid2")) & (F.col("part1") != F.col("part2"))
                   & _similar_size(F.col("n1"), F.col("n2"), percent)).select("cid1", "cid2", "n1", "n2").distinct()
    # tokens that no other component has are in no shared prefix: a few per document remain to compare
    shared = rows.groupBy("cid").agg(F.collect_list("token").alias("tokens"))
    first = shared.select(F.col("cid").alias("cid1"), F.col("tokens").alias("tokens1"))
    second = shared.select(F.col("cid").alias("cid2"), F.col("tokens").alias("tokens2"))
    need = _overlap(F.col("n1"), F.col("n2"), percent) - F.greatest(rest_of(F.col("n1")), rest_of(F.col("n2")))
    release(kept, left)
    return (pairs.join(first, "cid1").join(second, "cid2")
            .where(F.size(F.array_intersect("tokens1", "tokens2")) >= need)
            .select(F.col("cid1").alias("a"), F.col("cid2").alias("b"))), [rows, short]


def _similar_size(n1: Column, n2: Column, percent: int) -> Column:
    return F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent


def _verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, n_words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of classes whose sets have the wanted similarity,
    counted exactly on the whole texts of the classes' first documents."""
    pairs = materialize(pairs.select("a", "b"), "jaccard-pairs")
    named = classes.select("cid", F.col("rep").alias("doc_id"), "h1", "h2")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct().join(named, "cid")
    wanted = materialize(wanted, "jaccard-wanted")
    texts = materialize(docs.select("doc_id", "text").join(sided(wanted, BROADCAST_DOCS), "doc_id")
                        .select("cid", "text", "h1", "h2"), "jaccard-texts")
    left = texts.select(F.col("cid").alias("a"), F.col("text").alias("ta"), F.col("h1").alias("a1"), F.col("h2").alias("a2"))
    right = texts.select(F.col("cid").alias("b"), F.col("text").alias("tb"), F.col("h1").alias("b1"), F.col("h2").alias("b2"))
    both = pairs.join(right, "b").join(left, "a")

    def run(batches):
        last = (None, None)

        def own_set(text, h1, h2):
            """The set, or None if the row is another text with the same id."""
            s = shingles(word_hashes(words(text)), n_words)
            digest = xxhash.xxh3_128_digest(s.tobytes())
            same = (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)) == (h1, h2)
            return s if same else None

        for b in batches:
            got_a, got_b = [], []
            for a, c, ta, a1, a2, tb, b1, b2 in zip(*(b.column(i).to_pylist() for i in range(8))):
                if last[0] != (a, ta):
                    last = (a, ta), own_set(ta, a1, a2)
                x, y = last[1], own_set(tb, b1, b2)
                if x is None or y is None:
                    continue
                inter = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * inter >= percent * (len(x) + len(y) - inter):
                    got_a.append(a)
                    got_b.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(got_a, pa.int64()), pa.array(got_b, pa.int64())], names=["a", "b"])

    links = materialize(both.select("a", "b", "ta", "a1", "a2", "tb", "b1", "b2").mapInArrow(run, "a long, b long").distinct(),
                        "jaccard-links")
    release(pairs, wanted, texts)
    return links


def _class_tokens(wanted: DataFrame, docs: DataFrame, n_words: int) -> DataFrame:
    """``cid, tokens``: the whole set of each of the classes ``cid, doc_id, h1, h2``."""
    texts = docs.join(sided(wanted, BROADCAST_DOCS), "doc_id").select("cid", "text", "h1", "h2")

    def run(batches):
        for b in batches:
            cids, tokens = [], []
            for cid, text, h1, h2 in zip(*(b.column(i).to_pylist() for i in range(4))):
                data = shingles(word_hashes(words(text)), n_words).tobytes()
                digest = xxhash.xxh3_128_digest(data)
                # else another text with the same id
                if (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)) == (h1, h2):
                    cids.append(cid)
                    tokens.append(data)
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(tokens, pa.binary())], names=["cid", "tokens"])

    return texts.mapInArrow(run, "cid long, tokens binary")


def similar(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets on the left have the wanted similarity to which on the right."""
    n1, n2 = np.array([len(s) for s in left], "int64"), np.array([len(s) for s in right], "int64")
    t1, t2 = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(t1, t2)
    sides = []
    for n, t in ((n1, t1), (n2, t2)):
        row, at = np.repeat(np.arange(len(n)), n), np.minimum(np.searchsorted(both, t), max(0, len(both) - 1))
        held = both[at] == t if len(both) else np.zeros(len(t), bool)
        row, at = row[held], at[held]
        order = np.argsort(at, kind="stable")
        sides.append((row[order], at[order]))
    inter = np.zeros((len(n1), len(n2)), "int64")
    for start in range(0, len(both), TOKEN_COLUMNS):
        part = []
        for n, (row, at) in zip((n1, n2), sides):
            lo, hi = np.searchsorted(at, [start, start + TOKEN_COLUMNS])
            x = np.zeros((len(n), min(TOKEN_COLUMNS, len(both) - start)), "float32")
            x[row[lo:hi], at[lo:hi] - start] = 1
            part.append(x)
        inter += (part[0] @ part[1].T).astype("int64")
    return 100 * inter >= percent * (n1[:, None] + n2[None, :] - inter)


def _neighbours(cells: DataFrame, percent: int) -> DataFrame:
    """Per cell of two blocks, ``a, s``: the weight ``s`` of the classes there
    that class ``a`` is similar to, itself included; and as ``a, b`` the pairs
    in which either class is marked."""
    per_cell = cells.repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi", "cid")

    def cell(rows):
        blocks = [[], []]
        for r in rows:
            blocks[r[3] != r[1]].append(r)
        lo, hi = blocks[0], blocks[1] if rows[0][1] != rows[0][2] else blocks[0]
        if not lo or not hi:
            return
        m = similar(*([np.frombuffer(r[7], "uint64") for r in side] for side in (lo, hi)), percent)
        c1, c2 = (np.array([r[4] for r in side], "int64") for side in (lo, hi))
        w1, w2 = (np.array([r[5] for r in side], "int64") for side in (lo, hi))
        f1, f2 = (np.array([r[6] for r in side], bool) for side in (lo, hi))
        ways = [(m, c1, c2, w2, f1, f2)] + ([(m.T, c2, c1, w1, f2, f1)] if lo is not hi else [])
        for k, own, other, weight, f, g in ways:
            s = np.where(k, weight[None, :], 0).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.nulls(len(own), pa.int64()), pa.array(s)], names=["a", "b", "s"])
            for i in np.flatnonzero((k & (f[:, None] | g[None, :])).any(1)):
                to = other[k[i] & (f[i] | g)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(to), own[i])), pa.array(to), pa.nulls(len(to), pa.int64())],
                                                 names=["a", "b", "s"])

    def run(batches):
        held, last = [], None
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(8))):
                if r[:3] != last:
                    if held:
                        yield from cell(held)
                    held, last = [], r[:3]
                if not held or held[-1][4] != r[4]:  # a repeated row gives its class again
                    held.append(r)
        if held:
            yield from cell(held)

    return per_cell.select("root", "lo", "hi", "block", "cid", "w", "marked", "tokens").mapInArrow(run, "a long, b long, s long")


def _count_links(docs: DataFrame, owned: DataFrame, classes: DataFrame, root: DataFrame, n_words: int,
                 percent: int) -> tuple[DataFrame, DataFrame]:
    """``cid, own_links`` of the documents of one class, ``doc_id, all_links``
    of those whose rows have different texts."""
    owned = materialize(owned.distinct(), "jaccard-owned")
    several = materialize(owned.groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id"), "jaccard-several")
    several_in = materialize(owned.join(several, "doc_id"), "jaccard-several-in")
    marked = several_in.select("cid").distinct().withColumn("marked", F.lit(True))
    w = owned.join(several, "doc_id", "left_anti").groupBy("cid").agg(F.count(F.lit(1)).alias("w"))
    weights = materialize(classes.select("cid", "n", "rep", "h1", "h2").join(w, "cid", "left").join(marked, "cid", "left").select(
        "cid", "n", "rep", "h1", "h2", F.coalesce("w", F.lit(0)).alias("w"), F.coalesce("marked", F.lit(False)).alias("marked")), "jaccard-weights")

    grouped = weights.join(root, weights["cid"] == root["node"])
    blocks = grouped.groupBy("root").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_TOKENS), F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES)).alias("blocks"))
    blocks = materialize(blocks.where(F.col("blocks") > 1), "jaccard-blocks")
    placed = grouped.join(sided(blocks, BROADCAST_DOCS), "root", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = materialize(placed.select("root", "blocks", F.pmod(F.xxhash64("cid"), F.col("blocks")).alias("block"), "cid",
                                       F.col("rep").alias("doc_id"), "h1", "h2", "w", "marked"), "jaccard-placed")
    tokens = materialize(_class_tokens(placed.select("cid", "doc_id", "h1", "h2"), docs, n_words), "jaccard-tokens")
    cells = placed.join(tokens, "cid").withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.withColumn("lo", F.least("block", "with")).withColumn("hi", F.greatest("block", "with"))
    found = materialize(_neighbours(cells, percent), "jaccard-neighbours")
    release(placed, tokens)

    pairs = found.where(F.col("b").isNotNull()).select("a", "b")
    sums = found.where(F.col("b").isNull()).groupBy("a").agg(F.sum("s").alias("s"))
    # documents of several classes count once however many of those are similar
    met = pairs.join(several_in, pairs["b"] == several_in["cid"]).groupBy("a").agg(F.countDistinct("doc_id").alias("met"))
    own = weights.join(sums, weights["cid"] == sums["a"], "left").drop("a").join(met, weights["cid"] == met["a"], "left").select(
        "cid", (F.coalesce("s", "w") + F.coalesce("met", F.lit(0)) - 1).alias("own_links"))
    around = several_in.join(pairs, several_in["cid"] == pairs["a"]).select("doc_id", F.col("b").alias("cid")).distinct()
    single = around.join(weights.select("cid", "w"), "cid").groupBy("doc_id").agg(F.sum("w").alias("singles"))
    others = several_in.select("cid", F.col("doc_id").alias("other"))
    multiple = around.join(others, "cid").groupBy("doc_id").agg(F.countDistinct("other").alias("others"))
    return own, single.join(multiple, "doc_id").select("doc_id", (F.col("singles") + F.col("others") - 1).alias("all_links"))


def join(docs: DataFrame, n_words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` per row of ``docs``.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of
    their ``n_words``-word shingles (the whole sequence if they have fewer
    words). ``component_id`` is the smallest id reachable by links, the
    document's own included, ``class_id`` the smallest id with the same set.
    Null and empty texts and texts without words have no shingles and link
    with nothing; rows with a null id neither, and have null components.
    Rows that repeat an id are one document. Other columns are left out."""
    return _join(docs, n_words, percent, key, text, False)


def links(docs: DataFrame, n_words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``join`` with ``n_links``: the number of other documents that the row's
    document links with, members of its own class included. A document whose
    rows have different texts links by any of them. 0 for rows without
    shingles or id."""
    return _join(docs, n_words, percent, key, text, True)


def _join(docs: DataFrame, n_words: int, percent: int, key: str, text: str, count: bool,
          spent: list[DataFrame] | None = None) -> DataFrame:
    """``join`` or ``links``; the tables that the result is read from are
    appended to ``spent``."""
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = materialize(_sets(docs, n_words, percent, frequent(docs, n_words)), "jaccard-sets")
    found = (sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("h1", "h2")
             .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
             .withColumn("cid", F.monotonically_increasing_id()))
    found = materialize(found, "jaccard-found")
    # from here on only the classes carry prefixes, and those only to the candidates
    rows, classes = sets.select("doc_id", "h1", "h2", "n"), found.drop("prefix")
    rows, classes = materialize(rows, "jaccard-members"), materialize(classes, "jaccard-classes")
    release(sets)
    members = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    index = _postings(found, percent)

    # one leader each: the one that leads most of a class's posting lists
    votes = index.where(F.col("leader") != F.col("cid")).groupBy("cid", "n", "leader").agg(F.count(F.lit(1)).alias("votes"))
    stars = votes.groupBy("cid", "n").agg(F.min(F.struct((-F.col("votes")).alias("v"), "leader"))["leader"].alias("leader"))
    sizes = classes.select(F.col("cid").alias("leader"), F.col("n").alias("leader_n"))
    stars = stars.join(sizes, "leader").where(_similar_size(F.col("n"), F.col("leader_n"), percent))
    first = _verify(stars.select(F.col("leader").alias("a"), F.col("cid").alias("b")), classes, docs, n_words, percent)
    label = materialize(connected(first), "jaccard-labels")

    pairs, held = _candidates(index, found, label, percent)
    second = _verify(pairs, classes, docs, n_words, percent)
    release(label, *held)

    # documents whose rows have different texts tie their classes together
    owned = members.join(classes.select("h1", "h2", "cid"), ["h1", "h2"]).select("doc_id", "cid")
    split = owned.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where(F.col("a") != F.col("z"))
    tied = owned.join(split, "doc_id").where(F.col("a") != F.col("cid")).select("a", F.col("cid").alias("b"))
    root = materialize(connected(first.unionByName(second).unionByName(tied)), "jaccard-roots")
    release(first, second)
    placed = classes.join(root, classes["cid"] == root["node"], "left").select(
        "h1", "h2", "cid", "rep", F.coalesce("root", "cid").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("rep").alias("component"))
    placed = placed.join(smallest, "root").select("h1", "h2", "cid", F.col("rep").alias("class"), "component")
    none = (F.col("n") == 0) | F.col("doc_id").isNull()
    columns = ["doc_id", F.col("n").alias("n_shingles"),
               F.when(none, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
               F.when(none, F.col("doc_id")).otherwise(F.col("class")).alias("class_id")]
    if spent is not None:
        spent += [rows, classes, root]
    if not count:
        return rows.join(placed.drop("cid"), ["h1", "h2"], "left").select(*columns)
    own, several = _count_links(docs, owned, classes, root, n_words, percent)
    return rows.join(placed.join(own, "cid"), ["h1", "h2"], "left").join(several, "doc_id", "left").select(
        *columns, F.when(none, F.lit(0)).otherwise(F.coalesce("all_links", "own_links")).cast("long").alias("n_links"))


#: Keys of rows that their id does not name start here, above usual ids.
SURROGATE_KEYS = 1 << 62


def one_of_each(docs: DataFrame, n_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest
    id. Rows without an id, and rows whose id also stands at another text, are
    documents by their text: copies and near copies among them go like any
    others, and documents with an id of their own stay before them. Of rows
    that repeat a document one stays. Texts without words are copies of one
    another only under one id, or without any. Columns stay as they were."""
    key, low, high, gone = column_names(docs, "row_key", "low_hash", "high_hash", "gone_id")
    told = F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit("")))
    unclear = materialize(docs.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias(gone))
                          .agg(F.min(told).alias(low), F.max(told).alias(high)).where(F.col(low) != F.col(high)).select(gone), "jaccard-unclear")
    named = F.col("doc_id").cast("long")
    marked = docs.join(sided(unclear, BROADCAST_DOCS), named == F.col(gone), "left")
    keyed = marked.withColumn(key, F.when(named.isNull() | F.col(gone).isNotNull(), F.shiftrightunsigned(told, 2) + F.lit(SURROGATE_KEYS))
                              .otherwise(named)).drop(gone)
    spent: list[DataFrame] = []
    joined = _join(keyed, n_words, percent, key, "text", False, spent)
    joined = materialize(joined.select(F.col("doc_id").alias(gone), "component_id"), "jaccard-joined")
    release(*spent)
    others = materialize(joined.where(F.col("component_id") != F.col(gone)).select(gone).distinct(), "jaccard-gone")
    again = materialize(joined.groupBy(gone).count().where(F.col("count") > 1).select(gone), "jaccard-again")
    release(joined)
    kept = keyed.join(sided(others, BROADCAST_DOCS), F.col(key) == F.col(gone), "left_anti")
    if again.isEmpty():
        return kept.drop(key)
    twice = kept.join(sided(again, BROADCAST_DOCS), F.col(key) == F.col(gone), "left_semi")
    single = kept.join(sided(again, BROADCAST_DOCS), F.col(key) == F.col(gone), "left_anti")
    return single.unionByName(twice.dropDuplicates([key])).drop(key)


def oracle(n_words: int, percent: int) -> str:
    """``join`` over ``documents`` as DuckDB SQL: all pairs that share a shingle
    are counted, so it is for small tables."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {n_words} THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i + {n_words - 1}], ' ') FOR i IN range(1, len(ws) - {n_words - 2})]) END AS s FROM w),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
tokens AS (SELECT doc_id, unnest(s) AS token FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y, c = p.n AND c = q.n AS same FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= {percent} * (p.n + q.n - c)),
reach(d, r) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT reach.d, links.y FROM reach JOIN links ON reach.r = links.x),
least_of AS (SELECT d, min(r) AS component_id FROM reach GROUP BY d),
twins AS (SELECT x, min(y) AS y FROM links WHERE same GROUP BY x)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, least(doc_id, coalesce(y, doc_id)) AS class_id
FROM sizes JOIN least_of ON d = doc_id LEFT JOIN twins ON x = doc_id"""
