"""Questions on top of the event tables: milestones, delivery time, invalid
report, funnel, transitions, reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lifecycle import STATE_RANKS, is_edge, state_of

PARTITION_KEY_FORMAT = "yyyy-MM/dd/HH"


def milestone_column(state: str) -> str:
    return state.removeprefix("ORDER_").lower() + "_at"


def order_milestones(events: DataFrame) -> DataFrame:
    """First event time of each lifecycle state per order (one aggregate
    with conditional mins; partial aggregation, no pivot)."""
    aggs = [F.min(F.when(F.col("event_type") == s, F.col("timestamp"))).alias(milestone_column(s))
            for s in STATE_RANKS]
    return events.groupBy("order_id").agg(*aggs)


def micros_between(start: str, end: str):
    return F.expr(f"timestampdiff(MICROSECOND, `{start}`, `{end}`)")


def delivery_times(milestones: DataFrame) -> DataFrame:
    return (milestones.where(F.col("delivered_at").isNotNull() & F.col("paid_at").isNotNull())
            .select("order_id", "paid_at", "delivered_at",
                    (F.col("delivered_at") - F.col("paid_at")).alias("delivery_time"),
                    micros_between("paid_at", "delivered_at").alias("delivery_micros")))


def avg_delivery_time(milestones: DataFrame) -> DataFrame:
    """Average of ``delivered_at - paid_at`` over orders having both.
    Reported as an exact integer sum plus a rounded mean in hours. The sum is a
    decimal: that of some 300,000 orders passes the range of a long
    (``as_long_if_it_fits`` gives it as one where it can)."""
    d = delivery_times(milestones)
    total = F.sum(F.col("delivery_micros").cast("decimal(19,0)"))
    return d.agg(
        F.count(F.lit(1)).alias("n_orders"),
        total.alias("total_delivery_micros"),
        F.round(total.cast("double") / F.count(F.lit(1)) / F.lit(3.6e9), 6).alias("avg_delivery_hours"),
    )


def as_long_if_it_fits(report: DataFrame, column: str) -> DataFrame:
    """A stored report of few rows with its exact decimal ``column`` as a long;
    as it is when a value passes the range of one."""
    small = F.col(column).try_cast("long")
    if report.where(F.col(column).isNotNull() & small.isNull()).isEmpty():
        return report.withColumn(column, small)
    return report


def partition_key(ts_col: str = "arrival_ts"):
    return F.date_format(F.col(ts_col), PARTITION_KEY_FORMAT)


def invalid_report(routed: DataFrame) -> DataFrame:
    """Invalid events by arrival hour and type, newest first."""
    return (routed.where(F.col("route") == "invalid")
            .groupBy(partition_key().alias("partition_key"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.max("arrival_ts").alias("last_arrival"))
            .orderBy(F.col("partition_key").desc(), F.col("n").desc(), "event_type"))


def status_funnel(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("n_orders"))


def with_transition(routed: DataFrame) -> DataFrame:
    """Valid events with the previous valid state of their order. Without
    state expiry valid ranks never decrease, so the previous valid state is
    the state of ``prev_rank`` (already computed by validation): no extra
    window or shuffle."""
    return (routed.where(F.col("route") == "valid")
            .withColumn("from_state", state_of("prev_rank"))
            .withColumn("to_state", F.col("event_type")))


def transition_matrix(routed: DataFrame) -> DataFrame:
    t = with_transition(routed)
    return t.groupBy("from_state", "to_state").agg(F.count(F.lit(1)).alias("n"))


def strict_violations(routed: DataFrame) -> DataFrame:
    """Valid events whose (previous state -> state) is not an edge of the
    lifecycle graph (repeats of the same state are not violations)."""
    t = with_transition(routed)
    bad = (F.col("from_state").isNotNull() & (F.col("from_state") != F.col("to_state"))
           & ~is_edge(F.col("from_state"), F.col("to_state")))
    return t.where(bad).select("order_id", "event_id", "arrival_ts", "arrival_seq",
                               "from_state", "to_state")


def status_disagreement(routed: DataFrame) -> DataFrame:
    """Orders whose latest valid state by event time differs from their last
    valid state in arrival order (status follows event time, validity
    follows arrival). Two partial aggregates in one pass, no window."""
    valid = routed.where(F.col("route") == "valid")
    by_time = F.max_by("event_type", F.struct(
        F.col("timestamp"), F.col("event_id"), F.col("arrival_ts"), F.col("arrival_seq")))
    by_arrival = F.max_by("event_type", F.struct(F.col("arrival_ts"), F.col("arrival_seq")))
    agg = valid.groupBy("order_id").agg(by_time.alias("event_time_status"),
                                        by_arrival.alias("arrival_status"))
    return agg.where(F.col("event_time_status") != F.col("arrival_status"))


def hourly_counts(df: DataFrame, name: str, ts_col: str = "arrival_ts") -> DataFrame:
    return df.groupBy(partition_key(ts_col).alias("partition_key")).agg(
        F.count(F.lit(1)).alias(name))


def reconcile_routed(routed: DataFrame, routes=("valid", "invalid", "duplicate", "quarantine")) -> DataFrame:
    """Route counts per arrival hour of one routed frame and whether they add
    up (one hash aggregate). ``reconcile`` compares stored tables."""
    counts = [F.count_if(F.col("route") == r).alias(r) for r in routes]
    out = routed.groupBy(partition_key().alias("partition_key")).agg(
        F.count(F.lit(1)).alias("raw"), *counts)
    total = sum((F.col(r) for r in routes), F.lit(0))
    return out.withColumn("balanced", F.col("raw") == total)


def reconcile(raw: DataFrame, outputs: dict[str, DataFrame]) -> DataFrame:
    """Per arrival hour: raw count vs the sum of the routed outputs.

    Each side is first reduced to per-hour counts (rows = hours), then the
    small count tables are full-outer joined.
    """
    out = hourly_counts(raw, "raw")
    for name, df in outputs.items():
        out = out.join(hourly_counts(df, name), "partition_key", "full_outer")
    names = ["raw", *outputs]
    out = out.fillna(0, subset=names)
    total = sum((F.col(n) for n in outputs), F.lit(0))
    return out.select("partition_key", *names,
                      (F.col("raw") == total).alias("balanced"))
