"""Upsert edge rows (FIXTURES section 4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import make_events, minutes
from pyspark.sql import functions as F

from ordwise.operators.upsert import (empty_orders, latest_per_order, latest_per_order_rn,
                                      merge_orders)


def _now(day):
    return F.lit(dt.datetime(2030, 1, day)).cast("timestamp")


def ev(spark, rows):
    # rows: (seq, event_id, type, event_time_minute or None, product)
    base = make_events(spark, [(s, 0, "X", e, t, m) for s, e, t, m, _ in rows])
    prods = {s: p for s, _, _, _, p in rows}
    nulls = [s for s, _, _, m, _ in rows if m is None]
    out = base.withColumn("product_id", F.udf(lambda s: prods[s])("arrival_seq"))
    if nulls:
        out = out.withColumn("timestamp", F.when(F.col("arrival_seq").isin(nulls), None)
                             .otherwise(F.col("timestamp")))
    return out


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_newer_event_moves_status_keeps_attributes(spark):
    s1 = merge_orders(empty_orders(spark), ev(spark, [(1, "a", "ORDER_PAID", 1, "P1")]), _now(1))
    s2 = one(merge_orders(s1, ev(spark, [(2, "b", "ORDER_SHIPPED", 2, "P2")]), _now(2)))
    assert (s2.latest_event_id, s2.order_status, s2.latest_event_time) == ("b", "ORDER_SHIPPED", minutes(2))
    assert s2.product_id == "P1"
    assert s2.updated_at.date() == dt.date(2030, 1, 2)


def test_older_or_equal_event_changes_nothing(spark):
    s1 = merge_orders(empty_orders(spark), ev(spark, [(1, "a", "ORDER_SHIPPED", 2, "P1")]), _now(1))
    for t in (1, 2):
        s2 = one(merge_orders(s1, ev(spark, [(2, "b", "ORDER_PAID", t, "P2")]), _now(2)))
        assert (s2.latest_event_id, s2.order_status) == ("a", "ORDER_SHIPPED")
        assert s2.updated_at.date() == dt.date(2030, 1, 1)


def test_tie_in_one_load_takes_larger_id(spark):
    rows = [(1, "a", "ORDER_PAID", 2, "P1"), (2, "b", "ORDER_SHIPPED", 2, "P1")]
    for f in (latest_per_order, latest_per_order_rn):
        assert one(f(ev(spark, rows))).latest_event_id == "b"


def test_null_time_is_replaced_by_later_time(spark):
    s1 = merge_orders(empty_orders(spark), ev(spark, [(1, "a", "ORDER_PAID", None, "P1")]), _now(1))
    assert one(s1).latest_event_time is None
    s2 = one(merge_orders(s1, ev(spark, [(2, "b", "ORDER_SHIPPED", 1, "P1")]), _now(2)))
    assert (s2.latest_event_id, s2.latest_event_time) == ("b", minutes(1))


def test_price_becomes_decimal(spark):
    r = one(merge_orders(empty_orders(spark), ev(spark, [(1, "a", "ORDER_PAID", 1, "P1")]).withColumn(
        "price", F.lit(49.99)), _now(1)))
    assert r.price == Decimal("49.99")


def test_increments_equal_full_recompute(spark):
    """Status, id and time: merging slices equals one load of everything
    (event times distinct per order)."""
    rows = [(i, f"e{i:02d}", t, (i * 7) % 23, "P") for i, t in enumerate(
        ["ORDER_PENDING", "ORDER_PAID", "ORDER_SHIPPED", "ORDER_DELIVERED"] * 5, start=1)]
    full = ev(spark, rows)
    a, b = full.where("arrival_seq % 3 = 0"), full.where("arrival_seq % 3 <> 0")
    inc = merge_orders(merge_orders(empty_orders(spark), a, _now(1)), b, _now(2))
    once = merge_orders(empty_orders(spark), full, _now(1))
    cols = ["order_id", "latest_event_id", "order_status", "latest_event_time"]
    assert inc.select(cols).collect() == once.select(cols).collect()
