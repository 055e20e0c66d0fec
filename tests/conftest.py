from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from ordwise.session import build_session, drop_scratch  # noqa: E402

T0 = dt.datetime(2025, 11, 22, 10, 0, 0)

EVENT_DDL = ("event_id string, order_id string, event_type string, timestamp timestamp_ntz, "
             "customer_id string, product_id string, quantity int, price double, "
             "arrival_ts timestamp_ntz, arrival_seq long, malformed boolean")


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, driver_memory="4g")
    yield s
    drop_scratch(s)
    s.stop()


def minutes(m: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=m)


def make_events(spark, rows):
    """rows: (seq, minute, order, event_id, type[, event_time_minute]) -> ranked events."""
    from ordwise.functions.codec import with_rank
    data = []
    for r in rows:
        seq, m, order, eid, etype = r[:5]
        et = minutes(r[5]) if len(r) > 5 and r[5] is not None else minutes(m)
        data.append((eid, order, etype, et, "C1", "P1", 1, 9.99, minutes(m), seq, False))
    return with_rank(spark.createDataFrame(data, EVENT_DDL))
