"""Lifecycle validation and routing.

An event is *valid* when no earlier (in arrival order) counted event of its
order has a higher rank; equal rank is accepted and the first event of an
order is accepted whatever its state. Invalid ranks are always below the
running maximum, so the running max over all counted events equals the rank
of the last valid one: one exclusive prefix max, no UDF.

Routes (priority order): ``quarantine`` (malformed or unknown type),
``duplicate`` (only when duplicates are dropped), ``valid``, ``invalid``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import DEFAULT_DEDUP_TTL_SECONDS, flag_duplicates
from .scan import DEFAULT_HOT_ROWS, SkewPlan, detect_hot_keys, prefix_max_before

ROUTES = ["valid", "invalid", "duplicate", "quarantine"]


def quarantine_reason(df: DataFrame, strict: bool = False) -> DataFrame:
    """Why a row cannot be validated: undecodable or without ids
    (``malformed``), or of an unknown type. ``strict`` raises on such rows."""
    malformed = F.col("order_id").isNull() | F.col("event_id").isNull()
    if "malformed" in df.columns:
        malformed = F.coalesce(F.col("malformed"), F.lit(False)) | malformed
    reason = (F.when(malformed, F.lit("malformed"))
               .when(F.col("rk").isNull(), F.lit("unknown_type")))
    if strict:
        # carried-over sightings have no rank and are no input rows
        real = ~F.col("_ghost") if "_ghost" in df.columns else F.lit(True)
        reason = F.when(reason.isNotNull() & real,
                        F.raise_error(F.concat(F.lit("bad event: "), reason))).otherwise(reason)
    return df.withColumn("quarantine_reason", reason)


def check_mode(on_duplicate: str) -> None:
    if on_duplicate not in ("drop", "keep"):
        raise ValueError(f"on_duplicate must be 'drop' or 'keep', not {on_duplicate!r}")


def validate_running_max(df: DataFrame, on_duplicate: str = "drop",
                         plan: SkewPlan | None = None,
                         strict: bool = False, prior: DataFrame | None = None) -> DataFrame:
    """Route flagged events (needs ``is_dup``, ``rk``) without state expiry.

    Adds ``prev_rank`` (rank of the last valid event before this one) and
    ``route``. ``on_duplicate``: ``drop`` (duplicates get their own route and
    do not count) or ``keep`` (as coded upstream: flagged but still validated).
    ``strict=True`` raises on quarantined rows instead of routing them.
    ``df`` comes from ``plan.prepare`` (here: ``process_events``).
    """
    check_mode(on_duplicate)
    df = quarantine_reason(df, strict)
    quarantined = F.col("quarantine_reason").isNotNull()
    counted = ~quarantined
    if on_duplicate == "drop":
        counted = counted & ~F.col("is_dup")
    out = prefix_max_before(df, ["order_id"], F.when(counted, F.col("rk")), "prev_rank",
                            plan=plan)
    if prior is not None:
        # long-term state: the last valid rank of each order before this
        # input; several rows of an order count as their highest rank
        p = (prior.groupBy(F.col("order_id").alias("_prior_order"))
             .agg(F.max(F.col("prior_rank").cast("int")).alias("_prior")))
        out = (out.join(p, F.col("order_id") == F.col("_prior_order"), "left")
                  .withColumn("prev_rank", F.greatest("prev_rank", "_prior"))
                  .drop("_prior", "_prior_order"))
    route = F.when(quarantined, F.lit("quarantine"))
    if on_duplicate == "drop":
        route = route.when(F.col("is_dup"), F.lit("duplicate"))
    route = (route.when(F.col("prev_rank").isNull() | (F.col("rk") >= F.col("prev_rank")), F.lit("valid"))
                  .otherwise(F.lit("invalid")))
    return out.withColumn("route", route)


def process_events(df: DataFrame, on_duplicate: str = "drop",
                   dedup_ttl_seconds: int | None = DEFAULT_DEDUP_TTL_SECONDS,
                   state_ttl_seconds: int | None = None,
                   plan: SkewPlan | None = None,
                   hot_rows: int = DEFAULT_HOT_ROWS,
                   strict: bool = False, prior: DataFrame | None = None,
                   prior_seen: DataFrame | None = None) -> DataFrame:
    """Dedup + validation + route for decoded, ranked events.

    ``state_ttl_seconds=None`` (default) validates against all history (the
    documented long-term-state intent); a value gives the expiring variant.
    Without an explicit ``plan`` hot orders are detected by sampling, which
    scans the key and arrival columns once more (``detect_hot_keys``).
    Plan: one hash exchange on ``order_id`` (plus chunk for hot orders) feeds
    both the dedup and the validation window.

    ``prior`` (``order_id, prior_rank``, with ``prior_arrival_ts`` when states
    expire): last valid state per order from earlier loads (``prior_state`` or
    ``prior_expiring_state``), so an increment is validated against the
    long-term state instead of its own rows only. ``prior_seen`` (``order_id,
    event_id, last_seen_ts``, see ``prior_sightings``) carries the dedup ids
    across loads: they join the dedup window as rows that are not output.
    """
    check_mode(on_duplicate)
    if prior is not None and state_ttl_seconds is not None and "prior_arrival_ts" not in prior.columns:
        raise ValueError("an expiring prior state needs prior_arrival_ts (see prior_expiring_state)")
    columns = df.columns
    if prior_seen is not None:
        ghosts = prior_seen.groupBy("order_id", "event_id").agg(
            F.max("last_seen_ts").alias("arrival_ts")).select(
            "*", F.lit(-1).cast("long").alias("arrival_seq"), F.lit(True).alias("_ghost"))
        df = df.withColumn("_ghost", F.lit(False)).unionByName(ghosts, allowMissingColumns=True)
    if plan is None:
        plan = detect_hot_keys(df, "order_id", hot_rows=hot_rows)
    flagged = flag_duplicates(plan.prepare(df), dedup_ttl_seconds, plan=plan)
    if state_ttl_seconds is None:
        routed = validate_running_max(flagged, on_duplicate, plan=plan, strict=strict, prior=prior)
    else:
        from .ttl import validate_with_ttl
        routed = validate_with_ttl(flagged, state_ttl_seconds, on_duplicate, plan=plan,
                                   strict=strict, prepared=True, prior=prior)
    if prior_seen is not None:  # ghosts have no rank: never counted, then removed
        routed = routed.where(~F.col("_ghost"))
    return plan.finish(routed).select(*columns, "prev_seen_ts", "is_dup", "quarantine_reason", "prev_rank", "route")


def prior_state(routed: DataFrame) -> DataFrame:
    """Long-term state from earlier routed events: the highest valid rank per
    order (a partial aggregate; equals the last valid rank without expiry)."""
    return (routed.where(F.col("route") == "valid").groupBy("order_id")
            .agg(F.max("rk").alias("prior_rank")))


def prior_expiring_state(routed: DataFrame) -> DataFrame:
    """Long-term state when states expire: rank and arrival of the last valid
    event of each order (a partial aggregate)."""
    last = F.max_by(F.struct("rk", "arrival_ts"), F.struct("arrival_ts", "arrival_seq")).alias("s")
    return (routed.where(F.col("route") == "valid").groupBy("order_id").agg(last)
            .select("order_id", F.col("s.rk").alias("prior_rank"), F.col("s.arrival_ts").alias("prior_arrival_ts")))


def prior_sightings(routed: DataFrame, ttl_seconds: int = DEFAULT_DEDUP_TTL_SECONDS) -> DataFrame:
    """Dedup state to carry into the next load: the last sighting of each
    (order, event id) that can still flag a later arrival (within the TTL of
    the newest arrival seen). A global max (one value to the driver) bounds
    the sightings kept; the rest is one aggregate."""
    horizon = routed.agg(F.max("arrival_ts")).first()[0]
    named = routed.where(F.col("order_id").isNotNull() & F.col("event_id").isNotNull())
    last = named.groupBy("order_id", "event_id").agg(F.max("arrival_ts").alias("last_seen_ts"))
    if horizon is None:
        return last.limit(0)
    gap = F.expr("timestampdiff(MICROSECOND, last_seen_ts, _h)")
    return (last.withColumn("_h", F.lit(horizon).cast("timestamp_ntz"))
            .where(gap < F.lit(int(ttl_seconds) * 1_000_000)).drop("_h"))
