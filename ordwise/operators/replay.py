"""Replay from a point in time.

A range of the raw archive can be processed again on its own if validation
starts from the state that held when the range began. Routed rows are the
history of that state: every valid event is a new version of its order's last
valid rank, every arrival a new sighting of its event id. ``state_versions``
keeps the versions, ``as_of`` joins each order with the last version before
its starting point, and ``replay_from`` continues from there.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import DEFAULT_DEDUP_TTL_SECONDS
from .validate import process_events


def state_versions(routed: DataFrame) -> DataFrame:
    """``order_id, prior_rank, prior_arrival_ts, prior_arrival_seq``: what the
    state of an order was from that arrival on."""
    return routed.where(F.col("route") == "valid").select(
        "order_id", F.col("rk").alias("prior_rank"), F.col("arrival_ts").alias("prior_arrival_ts"),
        F.col("arrival_seq").alias("prior_arrival_seq"))


def as_of(versions: DataFrame, start: dt.datetime | DataFrame) -> DataFrame:
    """The version of each order that held just before ``start``: one time for
    all orders, or a table ``order_id, start_ts`` with a time for each. The
    latest version is a partial aggregate, so an order's versions never meet
    in one task unreduced."""
    if isinstance(start, DataFrame):
        starts = start.groupBy("order_id").agg(F.min("start_ts").alias("_start"))
        rows, before = versions.join(starts, "order_id"), F.col("prior_arrival_ts") < F.col("_start")
    else:
        rows, before = versions, F.col("prior_arrival_ts") < _moment(start)
    last = F.max_by(F.struct("prior_rank", "prior_arrival_ts"), F.struct("prior_arrival_ts", "prior_arrival_seq"))
    return rows.where(before).groupBy("order_id").agg(last.alias("s")).select("order_id", "s.*")


def sightings_as_of(routed: DataFrame, start: dt.datetime, ttl_seconds: int | None = DEFAULT_DEDUP_TTL_SECONDS) -> DataFrame:
    """Last sighting before ``start`` of each (order, event id) that can still
    flag a row from ``start`` on."""
    named = F.col("order_id").isNotNull() & F.col("event_id").isNotNull()
    rows = routed.where(named & (F.col("arrival_ts") < _moment(start)))
    if ttl_seconds is not None:
        rows = rows.where(F.col("arrival_ts") > _moment(start - dt.timedelta(seconds=ttl_seconds)))
    return rows.groupBy("order_id", "event_id").agg(F.max("arrival_ts").alias("last_seen_ts"))


def replay_from(events: DataFrame, history: DataFrame, start: dt.datetime, on_duplicate: str = "drop",
                dedup_ttl_seconds: int | None = DEFAULT_DEDUP_TTL_SECONDS, state_ttl_seconds: int | None = None,
                **options) -> DataFrame:
    """Route the decoded ``events`` that arrived at ``start`` or later as a full
    run would, continued from ``history`` (routed rows of an earlier run,
    which must reach back from ``start`` over the whole state)."""
    prior = as_of(state_versions(history), start)
    if state_ttl_seconds is None:
        prior = prior.drop("prior_arrival_ts")
    return process_events(events.where(F.col("arrival_ts") >= _moment(start)), on_duplicate, dedup_ttl_seconds, state_ttl_seconds,
                          prior=prior, prior_seen=sightings_as_of(history, start, dedup_ttl_seconds), **options)


def _moment(at: dt.datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
