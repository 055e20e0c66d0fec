"""The average delivery time where the sum of microseconds passes a long."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from ordwise.operators import analytics
from ordwise.plans import analyst_sql

PAID, DELIVERED = dt.datetime(1, 1, 1), dt.datetime(9999, 1, 1)
MICROS = (DELIVERED - PAID) // dt.timedelta(microseconds=1)


def report(spark, how, n):
    rows = [(f"o{k}", PAID, DELIVERED) for k in range(n)] + [("open", PAID, None)]
    m = spark.createDataFrame(rows, "order_id string, paid_at timestamp_ntz, delivered_at timestamp_ntz")
    if how == "operator":
        return analytics.avg_delivery_time(m)
    analyst_sql.register_views(spark, order_milestones=m)
    return analyst_sql.run(spark, "avg_delivery_time")


@pytest.mark.parametrize("how", ["operator", "sql"])
def test_a_sum_beyond_a_long_is_exact(spark, how):
    n = 40  # 40 times 9,998 years
    assert n * MICROS > 1 << 63
    out = analytics.as_long_if_it_fits(report(spark, how, n), "total_delivery_micros")
    assert out.first()[:] == (n, Decimal(n * MICROS), round(MICROS / 3.6e9, 6))


@pytest.mark.parametrize("how", ["operator", "sql"])
def test_a_sum_that_fits_is_a_long(spark, how):
    out = analytics.as_long_if_it_fits(report(spark, how, 3), "total_delivery_micros")
    assert dict(out.dtypes)["total_delivery_micros"] == "bigint" and out.first()[:2] == (3, 3 * MICROS)
    none = analytics.as_long_if_it_fits(report(spark, how, 0), "total_delivery_micros")
    assert none.dtypes == out.dtypes and none.first()[:] == (0, None, None)
