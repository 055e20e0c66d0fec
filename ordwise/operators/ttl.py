"""Validation with expiring state (state TTL, refreshed only by valid events).

The last valid state of an order expires ``ttl`` after it was written; an
expired state reads as absent, so the next event is accepted whatever its
rank. Only valid events refresh the clock, so validity is a left fold, not a
window.

Plan: rows are hash-partitioned on the order, sorted by arrival, and folded by
``mapInPandas``, which walks the Arrow batches carrying the state across batch
boundaries: memory per task is one batch, never a whole group.

Hot orders are folded chunk by chunk in parallel (``_incoming_states``). A
state that could be the last valid one at the end of a chunk must have a rank
that no later row of the chunk reaches, so there is at most one per rank: eight
candidates a chunk, whatever its length. Every chunk

1. finds the candidates it can end with, not knowing what comes before;
2. maps each candidate of the chunk before it to its own end (a candidate that
   outlives a whole chunk goes on to the next in another round);

and the true states follow from the small table of these maps, one short walk
per hot order. Then every chunk is folded from its true incoming state.

Rows that do not count (quarantined; duplicates when dropped) pass through
with their own route and leave the state untouched. ``prev_rank`` is the
rank of the live (unexpired) state seen by each row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship_package
from .scan import SkewPlan
from .validate import check_mode, quarantine_reason

#: No state yet, as a rank (time is 0).
_NONE = 0


def _fold(ttl_us: int):
    def run(batches):
        at, st_rank, st_us = None, _NONE, 0
        for pdf in batches:
            n = len(pdf)
            valid, prev = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
            orders, chunks = pdf["order_id"].to_numpy(dtype=object), pdf["_ck"].to_numpy(dtype=np.int64)
            counted, us = pdf["_counted"].to_numpy(dtype=bool), pdf["_us"].to_numpy(dtype=np.int64)
            rk = pdf["rk"].to_numpy(dtype=float, na_value=np.nan)
            in_rank, in_us = pdf["_in_rank"].to_numpy(dtype=np.int64), pdf["_in_us"].to_numpy(dtype=np.int64)
            for i in range(n):
                if at is None or orders[i] != at[0] or chunks[i] != at[1] or orders[i] is None:
                    at, st_rank, st_us = (orders[i], chunks[i]), in_rank[i], in_us[i]
                alive = st_rank != _NONE and us[i] - st_us < ttl_us
                if alive:
                    prev[i] = st_rank
                if counted[i] and (not alive or rk[i] >= st_rank):
                    valid[i], st_rank, st_us = True, int(rk[i]), us[i]
            out = pdf.drop(columns=["_counted", "_us", "_in_rank", "_in_us"])
            out["prev_rank"] = pd.array(np.where(prev == _NONE, None, prev), dtype="Int32")
            out["_valid"] = valid
            yield out
    return run


def _by_chunk(batches):
    """``(order, chunk), rows`` of sorted batches; a key may go over batches."""
    key, rows = None, []
    for pdf in batches:
        for row in zip(pdf["order_id"].tolist(), pdf["_ck"].tolist(), pdf["kind"].tolist(), pdf["rank"].tolist(), pdf["us"].tolist()):
            if row[:2] != key:
                if key is not None:
                    yield key, None
                key = row[:2]
            yield key, row[2:]
    if key is not None:
        yield key, None


def _ends(ttl_us: int):
    """States a chunk can end with: of chains that start at any of its rows."""
    def run(batches):
        out, live = [], {}
        for key, row in _by_chunk(batches):
            if row is None:
                out += [(*key, r, u) for r, u in live.items()]
                live = {}
            else:
                _, rank, us = row
                live = {r: u for r, u in live.items() if r > rank and us - u < ttl_us}
                live[rank] = us
        yield pd.DataFrame(out, columns=["order_id", "_ck", "rank", "us"])
    return run


def _maps(ttl_us: int):
    """End of a chunk for each candidate state that comes into it."""
    def run(batches):
        out, now = [], {}
        for key, row in _by_chunk(batches):
            if row is None:
                out += [(*key, *c, *s) for s, cs in now.items() for c in cs]
                now = {}
            elif row[0] == 0:
                now.setdefault(row[1:], []).append(row[1:])
            else:
                _, rank, us = row
                moved = [s for s in now if s[0] == _NONE or rank >= s[0] or us - s[1] >= ttl_us]
                if moved and moved != [(rank, us)]:
                    joined = [c for s in moved for c in now.pop(s)]
                    now.setdefault((rank, us), []).extend(joined)
        yield pd.DataFrame(out, columns=["order_id", "_ck", "in_rank", "in_us", "out_rank", "out_us"])
    return run


_STATE = "order_id string, _ck int, rank int, us long"
_MAP = "order_id string, _ck int, in_rank int, in_us long, out_rank int, out_us long"


def _incoming_states(rows: DataFrame, ttl_us: int) -> DataFrame:
    """``order_id, _ck, rank, us``: the state each chunk of a hot order starts
    with. ``rows`` are the hot rows with ``_counted, _us, _in_rank, _in_us``."""
    chunks = rows.groupBy("order_id", "_ck").agg(F.first("_in_rank").alias("rank"), F.first("_in_us").alias("us"))
    along = Window.partitionBy("order_id").orderBy("_ck")
    chunks = materialize(chunks.withColumn("next", F.lead("_ck").over(along)).withColumn("first", F.row_number().over(along) == 1),
                         "ttl-chunks")
    events = materialize(rows.where("_counted").select(
        "order_id", "_ck", F.lit(1).alias("kind"), F.col("rk").alias("rank"), F.col("_us").alias("us"), "arrival_seq"), "ttl-hot")

    def walk(df: DataFrame, fn, schema: str) -> DataFrame:
        return materialize(df.repartition("order_id", "_ck").sortWithinPartitions("order_id", "_ck", "kind", "us", "arrival_seq")
                           .mapInPandas(fn(ttl_us), schema), "ttl-walk")

    ends = walk(events, _ends, _STATE)
    onward = lambda states: (states.join(chunks.select("order_id", "_ck", "next"), ["order_id", "_ck"])
                             .where(F.col("next").isNotNull()).select("order_id", F.col("next").alias("_ck"), "rank", "us"))
    start = chunks.where("first").select("order_id", "_ck", "rank", "us")
    todo, known = materialize(onward(ends).unionByName(start).distinct(), "ttl-candidates"), None
    while not todo.isEmpty():
        marked = todo.select("order_id", "_ck", F.lit(0).alias("kind"), "rank", "us", F.lit(0).cast("long").alias("arrival_seq"))
        found = walk(events.join(todo.select("order_id", "_ck").distinct(), ["order_id", "_ck"], "left_semi").select(*marked.columns)
                     .unionByName(marked), _maps, _MAP)
        known = found if known is None else known.unionByName(found)
        passed = found.where((F.col("in_rank") == F.col("out_rank")) & (F.col("in_us") == F.col("out_us"))).select(
            "order_id", "_ck", F.col("in_rank").alias("rank"), F.col("in_us").alias("us"))
        seen = known.select("order_id", "_ck", F.col("in_rank").alias("rank"), F.col("in_us").alias("us"))
        todo = materialize(onward(passed).join(seen, ["order_id", "_ck", "rank", "us"], "left_anti").distinct(), "ttl-candidates")

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        """One hot order's chunks in turn: a few rows each."""
        step = {(c, r, u): s for c, r, u, *s in pdf[["_ck", "in_rank", "in_us", "out_rank", "out_us"]].itertuples(index=False)}
        state, out = (int(pdf["rank"].iloc[0]), int(pdf["us"].iloc[0])), []
        for c in sorted(set(pdf["_ck"])):
            out.append((pdf["order_id"].iloc[0], c, *state))
            state = tuple(step[(c, *state)])
        return pd.DataFrame(out, columns=["order_id", "_ck", "rank", "us"])

    return materialize(known.join(start.drop("_ck"), "order_id").groupBy("order_id").applyInPandas(follow, _STATE), "ttl-incoming")


def validate_with_ttl(df: DataFrame, ttl_seconds: int, on_duplicate: str = "drop",
                      plan: SkewPlan | None = None, strict: bool = False,
                      prepared: bool = False, prior: DataFrame | None = None) -> DataFrame:
    """Route flagged events (``is_dup``, ``rk``) with an expiring state.

    ``prepared=True``: ``df`` already comes from ``plan.prepare`` (as inside
    ``process_events``), so its partitioning is reused. ``prior`` (``order_id,
    prior_rank, prior_arrival_ts``): the state each order starts from.
    """
    check_mode(on_duplicate)
    plan = plan or SkewPlan()
    ship_package(df.sparkSession)
    df = quarantine_reason(df, strict)
    quarantined = F.col("quarantine_reason").isNotNull()
    counted = ~quarantined & (~F.col("is_dup") if on_duplicate == "drop" else F.lit(True))
    ttl_us = int(ttl_seconds) * 1_000_000
    micros = lambda c: F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})")

    g = df.withColumn("_counted", counted).withColumn("_us", micros("arrival_ts"))
    if not prepared:
        g = plan.prepare(g)
    if not plan.split:
        g = g.withColumn("_ck", F.lit(0))
    rank, us = F.lit(_NONE), F.lit(0).cast("long")
    if prior is not None:
        p = (prior.groupBy(F.col("order_id").alias("_prior_order"))
             .agg(F.max(F.struct(F.col("prior_arrival_ts").alias("ts"), F.col("prior_rank").cast("int").alias("rank"))).alias("_p")))
        g = g.join(p, F.col("order_id") == F.col("_prior_order"), "left")
        rank, us = F.coalesce("_p.rank", rank), F.coalesce(micros("_p.ts"), us)
    g = g.withColumn("_in_rank", rank).withColumn("_in_us", us).drop("_p", "_prior_order")
    if plan.split:
        g = materialize(g, "ttl-rows")
        into = _incoming_states(g.where(F.col("_ck") > 0), ttl_us).select(
            F.col("order_id").alias("_o"), F.col("_ck").alias("_c"), "rank", "us")
        g = (g.join(into, (F.col("order_id") == F.col("_o")) & (F.col("_ck") == F.col("_c")), "left")
             .withColumn("_in_rank", F.coalesce("rank", "_in_rank")).withColumn("_in_us", F.coalesce("us", "_in_us"))
             .drop("_o", "_c", "rank", "us").repartition("order_id", "_lone", "_ck"))
    elif prior is not None:
        g = g.repartition("order_id", "_lone")
    g = g.sortWithinPartitions("order_id", "_ck", "arrival_ts", "arrival_seq")
    schema = T.StructType([f for f in g.schema.fields if f.name not in ("_counted", "_us", "_in_rank", "_in_us")]
                          + [T.StructField("prev_rank", T.IntegerType()),
                             T.StructField("_valid", T.BooleanType())])
    folded = g.mapInPandas(_fold(ttl_us), schema)
    route = F.when(quarantined, F.lit("quarantine"))
    if on_duplicate == "drop":
        route = route.when(F.col("is_dup"), F.lit("duplicate"))
    route = route.when(F.col("_valid"), F.lit("valid")).otherwise(F.lit("invalid"))
    return folded.withColumn("route", route).drop("_valid")
