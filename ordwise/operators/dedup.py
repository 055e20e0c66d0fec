"""Duplicate detection: an event id seen again for the same order within the
TTL of its previous sighting (every sighting refreshes the TTL, so only the
gap to the previous sighting matters; a gap equal to the TTL is expired)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import SkewPlan, lone_key, prefix_max_before

DEFAULT_DEDUP_TTL_SECONDS = 600  # 10 minutes


def flag_duplicates(df: DataFrame, ttl_seconds: int | None = DEFAULT_DEDUP_TTL_SECONDS,
                    plan: SkewPlan | None = None) -> DataFrame:
    """Add ``prev_seen_ts`` and ``is_dup``. ``ttl_seconds=None``: no expiry. A
    row without an order or event id is never a duplicate of another.

    With a ``plan``, ``df`` must already be ``plan.prepare``-d.
    """
    if plan is None:
        plan = SkewPlan()
        df = plan.prepare(df)
    df = df.withColumn("_nameless", lone_key("event_id"))
    out = prefix_max_before(df, ["order_id", "event_id", "_nameless"], F.col("arrival_ts"),
                            "prev_seen_ts", plan=plan).drop("_nameless")
    gap = F.expr("timestampdiff(MICROSECOND, prev_seen_ts, arrival_ts)")
    fresh = F.lit(True) if ttl_seconds is None else gap < F.lit(ttl_seconds * 1_000_000)
    return out.withColumn("is_dup", F.col("prev_seen_ts").isNotNull() & fresh)


def drop_duplicates_within_watermark(stream: DataFrame, delay: str = "10 minutes",
                                     ts_col: str = "timestamp") -> DataFrame:
    """Event-time dedup mode for streams: keeps the first sighting of each
    (order, event id) and drops repeats while the watermark has not passed
    it. Unlike ``flag_duplicates`` a repeat does not refresh the window, so
    this is a separate mode, not the parity path."""
    return (stream.withColumn("_wm_ts", F.col(ts_col).cast("timestamp"))
            .withWatermark("_wm_ts", delay)
            .dropDuplicatesWithinWatermark(["order_id", "event_id"])
            .drop("_wm_ts"))
