"""Skew-safe exclusive prefix aggregates in arrival order.

Dedup ("when was this id last seen?") and validation ("highest state reached
so far?") are both *exclusive running maxima* per key in arrival order:
``max(v) over (partition by key order by arrival rows unbounded preceding .. 1
preceding)``. Such a window puts every row of a key into one task, so a
single hot order holding a third of the data would run on one core.

Strategy (``SkewPlan``):

* ``detect_hot_keys`` counts a sample of the keys (a scan of the key and
  arrival columns) and keeps the orders above a threshold in a stored table,
  with the arrival positions at which each is cut, so that chunks hold about
  equal numbers of rows whatever the spread over time. The sample only
  chooses the physical split; every row is still processed and the result is
  exact whatever the sample finds. A caller that knows its input has no hot
  orders passes ``SkewPlan()`` and saves that scan.
* No hot orders (the normal case): one ``repartition`` on the order serves both
  the dedup window ``(order, event)`` and the validation window ``(order)``.
* Hot orders are split at their cuts into chunks ``_ck``; everything is
  partitioned by ``(order, _ck)``, so a hot order spreads over as many tasks
  as it has chunks. The in-chunk window gives the prefix within the chunk; a
  *carry* (max over all earlier chunks of the key) comes from a chunk-level
  table over the hot rows only. For validation that table has a row per hot
  order and chunk; for dedup one per sighted id and chunk, of which only ids
  seen in more than one chunk are kept. It is stored in the checkpoint folder
  and joined as Spark's size statistics say.
* Rows without an order or event id belong to no group: a number derived from
  their arrival stands in for the missing key, so malformed lines spread over
  all tasks and never meet in a window.

The arrival order ``(arrival_ts, arrival_seq)`` is total and chunks are cut
along it, so ``greatest(carry, in-chunk max)`` equals the single-window value
on every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# A key is split when it is estimated to hold more rows than this, into
# chunks of about so many rows.
DEFAULT_HOT_ROWS = 2_000_000
DEFAULT_CHUNK_ROWS = 500_000
DEFAULT_SAMPLE_FRACTION = 0.01


def lone_key(col: str) -> Column:
    """Null for a present key; for a missing one a number of the row's own."""
    return F.when(F.col(col).isNull(), F.xxhash64("arrival_ts", "arrival_seq"))


@dataclass
class SkewPlan:
    """Which orders are split, and where: ``hot`` is a stored table (order,
    sorted array of cut positions) or None."""
    hot: DataFrame | None = None
    key: str = "order_id"

    @property
    def split(self) -> bool:
        return self.hot is not None

    def prepare(self, df: DataFrame) -> DataFrame:
        """Add ``_lone`` (missing keys) and ``_ck`` (0, or the chunk of a hot
        order from 1) and hash-partition once on the key; every later window
        on ``key[, ...], _lone[, _ck]`` reuses it."""
        df = df.withColumn("_lone", lone_key(self.key))
        if not self.split:
            return df.repartition(self.key, "_lone")
        hot = self.hot.select(F.col(self.key).alias("_hot_key"), "cuts")
        position = F.struct(F.col("arrival_ts").alias("ts"), F.col("arrival_seq").alias("seq"))
        ck = F.when(F.col("_hot_key").isNotNull(),
                    F.size(F.filter("cuts", lambda c: c <= position)) + 1).otherwise(0)
        return (df.join(hot, F.col(self.key) == F.col("_hot_key"), "left").withColumn("_ck", ck)
                .drop("_hot_key", "cuts").repartition(self.key, "_lone", "_ck"))

    def finish(self, df: DataFrame) -> DataFrame:
        return df.drop("_ck", "_lone")


def detect_hot_keys(df: DataFrame, key: str = "order_id", hot_rows: int = DEFAULT_HOT_ROWS,
                    fraction: float = DEFAULT_SAMPLE_FRACTION,
                    chunk_rows: int = DEFAULT_CHUNK_ROWS, seed: int = 17) -> SkewPlan:
    """Plan from one scan of a sample: all keys estimated above ``hot_rows``,
    however many, each with a cut at about every ``chunk_rows`` rows (a sampled
    position every ``chunk_rows * fraction`` sampled rows)."""
    frac = min(1.0, max(fraction, 1e-9))
    rows = df.select(key, F.struct(F.col("arrival_ts").alias("ts"), F.col("arrival_seq").alias("seq")).alias("at"))
    sample = rows if frac >= 1.0 else rows.sample(False, frac, seed)
    step = max(1, int(chunk_rows * frac))
    # thinned before grouping: about ``1 / step`` of the sample, a few positions a chunk
    counted = (sample.where(F.col(key).isNotNull())
               .withColumn("_kept", F.pmod(F.xxhash64("at"), F.lit(step)) == 0)
               .groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.array_sort(
                   F.collect_list(F.when(F.col("_kept"), F.col("at")))).alias("cuts")))
    hot = counted.where(F.col("n") >= max(1, int(hot_rows * frac))).select(key, "cuts")
    if hot.select(key).isEmpty():  # the usual case: counts alone, nothing is written
        return SkewPlan(key=key)
    return SkewPlan(hot=materialize(hot, "hot-keys"), key=key)


def prefix_max_before(df: DataFrame, keys: Sequence[str], value: Column, out: str,
                      order_by: Sequence[str] = ("arrival_ts", "arrival_seq"),
                      plan: SkewPlan | None = None) -> DataFrame:
    """Add ``out`` = max(value) over the rows of the same key strictly before
    this row in ``order_by`` order (null when there is none).

    ``df`` must come from ``plan.prepare``; rows whose first key is missing
    are groups of their own through ``_lone``.
    """
    keys = [*keys, "_lone"]
    order = [F.col(c).asc() for c in order_by]
    split = bool(plan and plan.split)
    part = keys + (["_ck"] if split else [])
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    res = df.withColumn(out, F.max(value).over(w))
    if not split:
        return res

    # Carry from earlier chunks, computed over the hot rows only.
    chunk_max = df.where(F.col("_ck") > 0).groupBy(*keys, "_ck").agg(F.max(value).alias("_cm"))
    wk = Window.partitionBy(*keys).orderBy("_ck").rowsBetween(Window.unboundedPreceding, -1)
    carry = materialize(chunk_max.select(*(F.col(k).alias(f"_c_{k}") for k in [*keys, "_ck"]),
                                         F.max("_cm").over(wk).alias("_carry"))
                        .where(F.col("_carry").isNotNull()), "carry")
    same = F.lit(True)
    for k in [*keys, "_ck"]:
        same = same & (F.col(k).eqNullSafe(F.col(f"_c_{k}")))
    return (res.join(carry, same, "left")
            .withColumn(out, F.greatest(F.col("_carry"), F.col(out)))
            .drop("_carry", *(f"_c_{k}" for k in [*keys, "_ck"])))
