"""Dedup and validation edge rows (FIXTURES section 3) in every plan form."""

from __future__ import annotations

import pytest
from conftest import make_events
from pyspark.sql import functions as F

from ordwise.operators.scan import SkewPlan, detect_hot_keys
from ordwise.operators.validate import process_events

# seq, minute, order, event, type
ROWS = [
    (1, 0, "X", "a", "ORDER_PAID"),
    (2, 1, "X", "b", "ORDER_SHIPPED"),
    (3, 2, "X", "c", "ORDER_PAID"),
    (4, 3, "X", "b", "ORDER_SHIPPED"),
    (5, 12, "X", "b", "ORDER_SHIPPED"),
    (6, 22, "X", "b", "ORDER_SHIPPED"),
    (7, 33, "X", "d", "ORDER_PENDING"),
    (8, 34, "X", "e", "ORDER_LOST"),
    (9, 35, "X", "f", "ORDER_SHIPPED"),
    (10, 36, "X", "g", "ORDER_PAID"),
    (11, 36, "Y", "a", "ORDER_PENDING"),
    (12, 40, "X", "h", "ORDER_PAID"),
    (13, 46, "X", "i", "ORDER_PAID"),
]
# expected (route, is_dup) per seq
DROP = ["valid", "valid", "invalid", "duplicate", "duplicate", "valid", "invalid",
        "quarantine", "valid", "invalid", "valid", "invalid", "invalid"]
KEEP = ["valid", "valid", "invalid", "valid", "valid", "valid", "invalid",
        "quarantine", "valid", "invalid", "valid", "invalid", "invalid"]
KEEP_TTL = ["valid", "valid", "invalid", "valid", "valid", "valid", "valid",
            "quarantine", "valid", "invalid", "valid", "invalid", "valid"]
DUPS = {4, 5}


def _routes(df):
    rows = df.select("arrival_seq", "route", "is_dup").collect()
    got = {r.arrival_seq: (r.route, r.is_dup) for r in rows}
    return [got[i][0] for i in range(1, 14)], {k for k, v in got.items() if v[1]}


PLANS = {
    "single": lambda ev: SkewPlan(),
    # every order "hot": exercises chunking + carry on tiny data
    "split": lambda ev: detect_hot_keys(ev, hot_rows=1, fraction=1.0, chunk_rows=2),
}


@pytest.mark.parametrize("plan", list(PLANS))
def test_drop_no_expiry(spark, plan):
    ev = make_events(spark, ROWS)
    routes, dups = _routes(process_events(ev, "drop", plan=PLANS[plan](ev)))
    assert routes == DROP
    assert dups == DUPS


@pytest.mark.parametrize("plan", list(PLANS))
def test_keep_no_expiry(spark, plan):
    ev = make_events(spark, ROWS)
    routes, dups = _routes(process_events(ev, "keep", plan=PLANS[plan](ev)))
    assert routes == KEEP
    assert dups == DUPS


@pytest.mark.parametrize("plan", list(PLANS))
def test_keep_state_ttl(spark, plan):
    ev = make_events(spark, ROWS)
    routes, dups = _routes(process_events(ev, "keep", state_ttl_seconds=600, plan=PLANS[plan](ev)))
    assert routes == KEEP_TTL
    assert dups == DUPS


def test_first_event_any_state_and_equal_rank(spark):
    ev = make_events(spark, [(1, 0, "Z", "x", "ORDER_REFUNDED"),
                             (2, 1, "Z", "y", "ORDER_REFUNDED"),
                             (3, 2, "Z", "z", "ORDER_PENDING")])
    routes = {r.arrival_seq: r.route for r in process_events(ev).collect()}
    assert routes == {1: "valid", 2: "valid", 3: "invalid"}


def test_strict_mode_raises_on_unknown(spark):
    ev = make_events(spark, [(1, 0, "Z", "x", "ORDER_LOST")])
    with pytest.raises(Exception):
        process_events(ev, strict=True).collect()


def test_single_exchange_for_dedup_and_validation(spark):
    """No hot keys: one hash exchange on order_id feeds both windows."""
    ev = make_events(spark, ROWS)
    plan_text = process_events(ev, plan=SkewPlan())._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("Exchange hashpartitioning") == 1, plan_text


def test_prior_state_continues_history(spark):
    """Validating a later increment against the long-term state equals
    validating everything at once (J3)."""
    from ordwise.operators.validate import prior_state
    ev = make_events(spark, ROWS)
    full = {r.arrival_seq: r.route for r in process_events(ev, "drop").collect()}
    first = process_events(ev.where("arrival_seq <= 6"), "drop")
    rest = process_events(ev.where("arrival_seq > 6"), "drop", prior=prior_state(first))
    got = {r.arrival_seq: r.route for r in first.unionByName(rest).collect()}
    assert got == full


def test_prior_sightings_carry_dedup_across_loads(spark):
    """Lifecycle state and dedup ids together: a split load equals one pass
    exactly, including re-sends that straddle the split (rows 4-5 re-send
    event b first seen in row 2)."""
    from ordwise.operators.validate import prior_sightings, prior_state
    ev = make_events(spark, ROWS)
    full = {r.arrival_seq: (r.route, r.is_dup) for r in process_events(ev, "drop").collect()}
    for cut in (2, 3, 4, 6):
        first = process_events(ev.where(f"arrival_seq <= {cut}"), "drop")
        rest = process_events(ev.where(f"arrival_seq > {cut}"), "drop", prior=prior_state(first),
                              prior_seen=prior_sightings(first))
        got = {r.arrival_seq: (r.route, r.is_dup) for r in first.unionByName(rest).collect()}
        assert got == full, cut


def test_prior_combinations(spark):
    """Prior state with expiry, with ``strict``, and with several rows an order."""
    from ordwise.operators.validate import prior_expiring_state, prior_sightings, prior_state
    ev = make_events(spark, [r for r in ROWS if r[4] != "ORDER_LOST"])
    for ttl in (None, 600):
        full = {r.arrival_seq: (r.route, r.is_dup) for r in process_events(ev, "drop", state_ttl_seconds=ttl).collect()}
        for cut in (3, 6, 9):
            first = process_events(ev.where(f"arrival_seq <= {cut}"), "drop", state_ttl_seconds=ttl)
            prior = (prior_state if ttl is None else prior_expiring_state)(first)
            stale = prior.withColumn("prior_rank", F.lit(0))
            if ttl is not None:
                stale = stale.withColumn("prior_arrival_ts", F.col("prior_arrival_ts") - F.expr("interval 1 day"))
            rest = process_events(ev.where(f"arrival_seq > {cut}"), "drop", state_ttl_seconds=ttl, strict=True,
                                  prior=prior.unionByName(stale), prior_seen=prior_sightings(first))
            assert rest.columns == first.columns
            got = {r.arrival_seq: (r.route, r.is_dup) for r in first.unionByName(rest).collect()}
            assert got == full, (ttl, cut)
    with pytest.raises(ValueError, match="prior_arrival_ts"):
        process_events(ev, state_ttl_seconds=600, prior=prior_state(process_events(ev)))


def test_rows_without_ids_are_quarantined_and_never_duplicates(spark):
    rows = [(1, 0, None, None, "ORDER_PAID"), (2, 0, None, None, "ORDER_PAID"), (3, 1, "X", None, "ORDER_PAID"),
            (4, 1, "X", None, "ORDER_PAID"), (5, 2, "X", "a", "ORDER_PENDING")]
    ev = make_events(spark, rows)
    for plan in (None, *(make(ev) for make in PLANS.values())):
        for ttl in (None, 600):
            got = {r.arrival_seq: (r.route, r.is_dup) for r in process_events(ev, state_ttl_seconds=ttl, plan=plan).collect()}
            assert got == {**{i: ("quarantine", False) for i in (1, 2, 3, 4)}, 5: ("valid", False)}
