"""Input adapters: work spread over the cores, slices read alone."""

from __future__ import annotations

import datetime as dt

from conftest import T0
from pyspark.sql import functions as F

from ordwise.plans import catalog
from ordwise.sources.testdata import arrival_slice, clickstream_wire

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def wire(spark):
    rows = [(k, T0 + dt.timedelta(minutes=k), k % 7, "view", 1.5, '{"k": 3}') for k in range(1, 301)]
    return clickstream_wire(spark.createDataFrame(rows, EVENTS).coalesce(1))


def test_the_rows_of_one_task_are_dealt_to_all_cores(spark):
    got = wire(spark).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(got) == spark.sparkContext.defaultParallelism > 1
    assert sum(r["count"] for r in got) == 300 + 15


def test_a_slice_reads_its_own_folder(spark):
    all_rows = arrival_slice(wire(spark))
    stored = catalog._sliced(all_rows)
    for k in range(3):
        one = stored.where(F.col("slice") == k)
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, all_rows.where(F.col("slice") == k).select(*one.columns).collect()))
        files = {r[0] for r in one.select(F.input_file_name()).distinct().collect()}
        assert files and all(f"/slice={k}/" in f for f in files)
