"""Property tests: Spark plans vs the brute-force model on random streams."""

from __future__ import annotations

import random

import pytest
from conftest import make_events, minutes
from brute_force_model import route_all

from ordwise.operators.scan import SkewPlan, detect_hot_keys
from ordwise.operators.validate import process_events

TYPES = ["ORDER_PENDING", "ORDER_PAID", "ORDER_SHIPPED", "ORDER_DELIVERED", "ORDER_CANCELLED",
         "ORDER_PAID_CANCELLED", "ORDER_RETURNED", "ORDER_REFUNDED", "ORDER_LOST"]


def random_rows(seed, n=400, orders=6, ids=40):
    rnd = random.Random(seed)
    rows, t = [], 0.0
    for seq in range(1, n + 1):
        t += rnd.choice([0, 0.5, 1, 2, 4, 9, 10, 11, 25])
        rows.append((seq, t, f"o{rnd.randrange(orders)}", f"e{rnd.randrange(ids)}",
                     rnd.choice(TYPES)))
    return rows


def model(rows, **kw):
    evs = [{"order_id": o, "event_id": e, "event_type": ty,
            "arrival_us": int((minutes(m) - minutes(0)).total_seconds() * 1e6), "arrival_seq": s}
           for s, m, o, e, ty in rows]
    return {k: v[0] for k, v in route_all(evs, **kw).items()}


def spark_routes(df):
    return {r.arrival_seq: r.route for r in df.select("arrival_seq", "route").collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("mode", ["drop", "keep"])
def test_running_max_matches_model(spark, seed, mode):
    rows = random_rows(seed)
    ev = make_events(spark, rows)
    expect = model(rows, mode=mode)
    assert spark_routes(process_events(ev, mode, plan=SkewPlan())) == expect
    split = detect_hot_keys(ev, hot_rows=1, fraction=1.0, chunk_rows=9)
    assert split.split
    assert spark_routes(process_events(ev, mode, plan=split)) == expect


@pytest.mark.parametrize("seed", [4, 5])
@pytest.mark.parametrize("mode", ["drop", "keep"])
def test_ttl_fold_matches_model(spark, seed, mode):
    rows = random_rows(seed)
    ev = make_events(spark, rows)
    expect = model(rows, mode=mode, state_ttl_us=600_000_000)
    assert spark_routes(process_events(ev, mode, state_ttl_seconds=600, plan=SkewPlan())) == expect
    split = detect_hot_keys(ev, hot_rows=1, fraction=1.0, chunk_rows=9)
    assert spark_routes(process_events(ev, mode, state_ttl_seconds=600, plan=split)) == expect


def test_valid_ranks_never_decrease_and_routes_partition_input(spark):
    rows = random_rows(9, n=600)
    ev = make_events(spark, rows)
    out = process_events(ev, "drop").select("order_id", "arrival_ts", "arrival_seq", "rk",
                                            "route").collect()
    assert len(out) == len(rows)
    by_order = {}
    for r in sorted(out, key=lambda r: (r.arrival_ts, r.arrival_seq)):
        if r.route == "valid":
            assert r.rk >= by_order.get(r.order_id, 0)
            by_order[r.order_id] = r.rk


def test_one_hot_order_is_detected_split_and_exact(spark):
    """One order holds a third of all rows: the sampled detection finds it
    (and only it), the plan spreads it over several chunks, and the routes
    equal the brute-force model."""
    rnd = random.Random(21)
    rows, t = [], 0.0
    for seq in range(1, 901):
        t += rnd.choice([0, 0.5, 1, 3, 7])
        order = "hot" if seq % 3 == 0 else f"o{rnd.randrange(40)}"
        rows.append((seq, t, order, f"e{rnd.randrange(200)}", rnd.choice(TYPES)))
    ev = make_events(spark, rows)
    plan = detect_hot_keys(ev, hot_rows=150, fraction=1.0, chunk_rows=30)
    assert [r.order_id for r in plan.hot.collect()] == ["hot"]
    chunks = plan.prepare(ev).where("order_id = 'hot'").select("_ck").distinct().count()
    assert chunks > 5
    for mode in ("drop", "keep"):
        assert spark_routes(process_events(ev, mode, plan=plan)) == model(rows, mode=mode)
    assert spark_routes(process_events(ev, "drop", state_ttl_seconds=600, plan=plan)) == \
        model(rows, mode="drop", state_ttl_us=600_000_000)


@pytest.mark.parametrize("seed", [41, 42])
def test_hot_order_without_gaps_is_folded_over_chunks(spark, seed):
    """No gap of a TTL anywhere: high ranks that expire, runs of low ranks that
    go over whole chunks, with and without a state to start from."""
    rnd = random.Random(seed)
    rows, t = [], 0.0
    for seq in range(1, 500):
        t += rnd.choice([0, 0.2, 0.5, 1, 2])
        etype = rnd.choice(["ORDER_PENDING"] * 12 + ["ORDER_LOST"] * 2 + TYPES) if seq % 60 else "ORDER_REFUNDED"
        rows.append((seq, t, "hot", f"e{seq}", etype))
    ev = make_events(spark, rows)
    want = model(rows, mode="drop", state_ttl_us=600_000_000)
    plan = detect_hot_keys(ev, hot_rows=100, fraction=1.0, chunk_rows=12)
    assert plan.split and plan.prepare(ev).select("_ck").distinct().count() > 15
    assert spark_routes(process_events(ev, "drop", state_ttl_seconds=600, plan=plan)) == want
    from ordwise.operators.validate import prior_expiring_state
    first = process_events(ev.where("arrival_seq <= 200"), "drop", state_ttl_seconds=600)
    rest = process_events(ev.where("arrival_seq > 200"), "drop", state_ttl_seconds=600, plan=plan, prior=prior_expiring_state(first))
    assert spark_routes(first.unionByName(rest)) == want
