"""Approximate nearest neighbours over learned partitions.

On a bounded sample a k-nearest-neighbour graph is built and partitioned into
parts of nearly equal size that cut few edges. A small classifier learns the
parts from the vectors alone. It files every row under its most probable part
and sends a query to its several most probable parts, as many as gave the
sample's neighbours the wanted recall; candidates are reranked by exact cosine
in double precision.

Parts are cut into blocks of bounded size by a hash of the id, and so are a
part's queries; one task compares one block of queries with one block of rows.
A part, or one vector repeated over a third of all rows, thus spreads over
many tasks, and only the nearest few of each comparison are sent on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare

#: Bound of the training sample (rows).
SAMPLE_ROWS = 4000
#: Sample rows per learned part, at least; bounds the number of parts.
PART_ROWS = 250
GRAPH_NEIGHBOURS = 10
#: Recall that routing must reach on the sample.
TARGET_RECALL = 0.95
BLOCK_ROWS, BLOCK_QUERIES = 4096, 8192


def partition_graph(neighbours: np.ndarray, parts: int, seed: int = 5, sweeps: int = 30) -> np.ndarray:
    """Balanced partition of a neighbour graph: grow parts from seeds, then
    move nodes to the part most of their neighbours are in while there is room."""
    n, k = neighbours.shape
    rng = np.random.default_rng(seed)
    cap = int(np.ceil(n / parts * 1.05))
    links: list[list[int]] = [list(r) for r in neighbours]
    for i, row in enumerate(neighbours):
        for j in row:
            links[j].append(i)
    part, size = np.full(n, -1), np.zeros(parts, int)
    fronts: list[list[int]] = [[int(s)] for s in rng.choice(n, parts, replace=False)]
    left = n
    spare = iter(rng.permutation(n))
    while left:
        for p in range(parts):
            if size[p] >= cap or not left:
                continue
            node = -1
            while fronts[p]:
                c = fronts[p].pop(0)
                if part[c] < 0:
                    node = c
                    break
            if node < 0:
                node = next((int(s) for s in spare if part[s] < 0), -1)
                if node < 0:
                    left = int((part < 0).sum())
                    continue
            part[node], left = p, left - 1
            size[p] += 1
            fronts[p].extend(links[node])
    for _ in range(sweeps):
        moved = 0
        for i in rng.permutation(n):
            votes = np.bincount(part[links[i]], minlength=parts)
            votes[(size >= cap) & (np.arange(parts) != part[i])] = -1
            best = int(votes.argmax())
            if votes[best] > votes[part[i]]:
                size[part[i]] -= 1
                size[best] += 1
                part[i], moved = best, moved + 1
        if not moved:
            break
    return part


class Router:
    """A softmax classifier with one hidden layer: vector -> part log-odds."""

    def __init__(self, x: np.ndarray, targets: np.ndarray, hidden: int = 128, epochs: int = 40, seed: int = 5):
        rng = np.random.default_rng(seed)
        d, p = x.shape[1], targets.shape[1]
        self.w = [rng.normal(0, np.sqrt(2 / d), (d, hidden)), np.zeros(hidden),
                  rng.normal(0, np.sqrt(1 / hidden), (hidden, p)), np.zeros(p)]
        m, v, t = [np.zeros_like(a) for a in self.w], [np.zeros_like(a) for a in self.w], 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
                h = np.maximum(x[rows] @ self.w[0] + self.w[1], 0)
                z = h @ self.w[2] + self.w[3]
                q = np.exp(z - z.max(1, keepdims=True))
                e = (q / q.sum(1, keepdims=True) - targets[rows]) / len(rows)
                back = (e @ self.w[2].T) * (h > 0)
                t += 1
                for i, g in enumerate((x[rows].T @ back, back.sum(0), h.T @ e, e.sum(0))):
                    g = g + 1e-4 * self.w[i]
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - 0.003 * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest entry to one half or
    more: cosines stay exactly the same and squares neither over- nor underflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(sample: np.ndarray, k: int, target: float = TARGET_RECALL) -> tuple[Router | None, int, int]:
    """``(router, number of parts, probes)`` from sample vectors. Too few rows
    for two parts give no router: one part, one probe."""
    parts = len(sample) // PART_ROWS
    if parts < 2:
        return None, 1, 1
    x = _unit(sample.astype(float))
    near = np.empty((len(x), max(GRAPH_NEIGHBOURS, k)), int)
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -2
        top = np.argpartition(-s, near.shape[1], axis=1)[:, :near.shape[1]]
        near[at:at + 512] = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1), 1)
    part = partition_graph(near[:, :GRAPH_NEIGHBOURS], parts)
    targets = np.zeros((len(x), parts))
    np.add.at(targets, (np.repeat(np.arange(len(x)), GRAPH_NEIGHBOURS), part[near[:, :GRAPH_NEIGHBOURS]].ravel()), 0.5 / GRAPH_NEIGHBOURS)
    targets[np.arange(len(x)), part] += 0.5
    # odd rows are left out of a first classifier to count the probes that unseen queries need
    odd = np.arange(len(x)) % 2 == 1
    router = Router(x[~odd], targets[~odd])
    order = np.argsort(-router(x[odd]), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], 1)
    router = Router(x, targets)
    filed = router(x).argmax(1)
    needed = np.sort(np.take_along_axis(place, filed[near[odd, :k]], 1).ravel())
    probes = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]) + 1
    return router, parts, probes


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` (array of doubles): rows with an id and a vector that is
    not null, empty or zero and holds finite numbers only, of the table's most
    common length (the smaller of two as common)."""
    v = F.col(vector).cast("array<double>")
    ok = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
        & F.exists("v", lambda e: e != 0))
    dim = ok.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return ok.where(F.size("v") == F.lit(dim["d"] if dim else -1))


_FOUND = "query_id long, vec_id long, score double"


def search(vectors: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows found for each row where ``is_query`` (a column
    expression over ``vec_id``) holds: ``query_id, rank, vec_id, score``,
    nearest first, ties to the smaller id. A row is no candidate of a query
    with its id; of rows with one id the smallest vector counts, once."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = materialize(usable(vectors, key, vector).groupBy("vec_id").agg(F.min("v").alias("v")), "ann-rows")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = int(min(1.0, SAMPLE_ROWS / n) * (1 << 30)) + 1
    sample = rows.where(F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) < share).collect()
    sample.sort(key=lambda r: r["vec_id"])
    router, parts, probes = fit(np.array([r["v"] for r in sample], float), k)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if router is None:
                order = np.zeros((len(b), 1), int)
            else:
                order = np.argsort(-router(_unit(np.stack(b["v"].to_list()).astype(float))), axis=1, kind="stable")
            yield pd.DataFrame({"vec_id": b["vec_id"], "v": b["v"], "parts": list(order.astype("int32"))})

    routed = materialize(rows.mapInPandas(route, "vec_id long, v array<double>, parts array<int>"), "ann-routed")
    # a row per part: sizes decide how many blocks the part is cut into
    sizes = {r["p"]: r["n"] for r in routed.groupBy(F.col("parts")[0].alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    of = lambda table: F.create_map(*(F.lit(int(x)).cast("long") for kv in sorted(table.items()) for x in kv))
    size, cuts = of(sizes), of({p: -(-n // BLOCK_ROWS) for p, n in sizes.items()})
    # a query goes on to further parts until those it asks hold its neighbours and itself
    asks = F.aggregate("parts", F.struct(F.lit(0).alias("m"), F.lit(0).cast("long").alias("s")), lambda acc, p: F.when(
        (acc["m"] < probes) | (acc["s"] <= k),
        F.struct((acc["m"] + 1).alias("m"), (acc["s"] + F.coalesce(F.try_element_at(size, p.cast("long")), F.lit(0))).alias("s"))).otherwise(acc))["m"]
    asked = (routed.where(is_query).select(F.col("vec_id").alias("query_id"), "v", F.explode(F.slice("parts", F.lit(1), asks)).alias("p"))
             .withColumn("p", F.col("p").cast("long")).where(cuts[F.col("p")].isNotNull()))
    # a row per part: each part's queries are cut by themselves
    per_part = {r["p"]: -(-r["n"] // BLOCK_QUERIES) for r in asked.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not per_part:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    query_cuts = of(per_part)

    # each block of a part's rows meets every block of the queries that ask the part
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    filed = (routed.select("vec_id", "v", F.col("parts")[0].cast("long").alias("p")).where(query_cuts[F.col("p")].isNotNull())
             .withColumn("b", F.pmod(F.xxhash64("vec_id", F.lit("block")), cuts[F.col("p")])).withColumn("qb", upto(query_cuts[F.col("p")])))
    asked = (asked.withColumn("qb", F.pmod(F.xxhash64("query_id", F.lit("query")), query_cuts[F.col("p")]))
             .withColumn("b", upto(cuts[F.col("p")])))

    def nearest(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x, y = (_scaled(np.stack(d["v"].to_list()).astype(float)) for d in (c, q))
        ids, nx, ny = c["vec_id"].to_numpy(), np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
        out = []
        for at in range(0, len(y), 256):
            s = (y[at:at + 256] @ x.T) / ny[at:at + 256, None] / nx
            for i, row in enumerate(s, at):
                qid = q["query_id"].iat[i]
                row[ids == qid] = -np.inf
                low = np.partition(row, -k)[-k] if len(row) > k else -np.inf
                cand = np.flatnonzero((row >= low - 1e-9) & (row > -np.inf))
                # the same sum for equal vectors, whatever their place in the block
                exact = (x[cand] * y[i]).sum(1) / (nx[cand] * ny[i])
                best = np.lexsort((ids[cand], -exact))[:k]
                out += [(qid, ids[cand[j]], exact[j]) for j in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    on = ("p", "b", "qb")
    found = asked.groupBy(*on).cogroup(filed.groupBy(*on)).applyInPandas(nearest, _FOUND)
    from pyspark.sql import Window
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
