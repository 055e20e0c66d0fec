"""Counters: tumbling-window counts by event type and of duplicates, and
running totals across windows.

All are hash aggregates with map-side partial aggregation; a hot event type
collapses to one partial row per task before the shuffle. The same
functions serve batch frames and streaming frames (``groupBy(window(...))``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

COUNT_WINDOW_SECONDS = 30    # counts by event type
DUP_WINDOW_SECONDS = 2       # duplicate counts


def counts_tumbling(df: DataFrame, seconds: int = COUNT_WINDOW_SECONDS,
                    ts_col: str = "arrival_ts", by: str = "event_type") -> DataFrame:
    w = F.window(ts_col, f"{seconds} seconds")
    return (df.groupBy(w.alias("w"), F.col(by))
              .agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), by, "n"))


def duplicate_counts(df: DataFrame, seconds: int = DUP_WINDOW_SECONDS,
                     ts_col: str = "arrival_ts") -> DataFrame:
    """Count of duplicate sightings per window (needs ``is_dup``)."""
    w = F.window(ts_col, f"{seconds} seconds")
    return (df.where(F.col("is_dup"))
              .groupBy(w.alias("w"))
              .agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), "n"))


def running_totals(counts: DataFrame, by: str | None = "event_type") -> DataFrame:
    """Cumulative count across windows, per key or overall (``by=None``, e.g.
    of duplicates). Input is the per-window count table, not the events. Two
    levels: a window within each day, and the days' totals carried forward, so
    a task holds one key's day."""
    keys = [by] if by else []
    daily = counts.withColumn("_day", F.to_date("window_start"))
    within = (Window.partitionBy(*keys, "_day").orderBy("window_start")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    days = daily.groupBy(*keys, "_day").agg(F.sum("n").alias("_n"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carry = days.select(*(F.col(k).alias("_by") for k in keys), F.col("_day").alias("_d"),
                        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry"))
    same = F.col("_day").eqNullSafe(F.col("_d"))
    if by:
        same = same & F.col(by).eqNullSafe(F.col("_by"))
    return (daily.join(carry, same).withColumn("running_n", F.col("_carry") + F.sum("n").over(within))
            .select(*counts.columns, "running_n"))


def route_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("route").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("is_dup").cast("long")).alias("flagged_dups"))
