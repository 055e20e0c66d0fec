"""Indexed state, catalog tables, sized files, replay from a point, content."""

from __future__ import annotations

import os
import tempfile

import pyarrow.parquet as pq
import pytest
from conftest import make_events, minutes
from pyspark.sql import functions as F
from test_loader import warehouse
from test_properties import random_rows
from test_streaming import routes

from ordwise.operators import fingerprint, replay
from ordwise.operators.upsert import empty_orders, merge_orders
from ordwise.operators.validate import process_events
from ordwise.plans import compaction, loader
from ordwise.plans.archive import read_raw_archive, with_partition_columns, write_csv_archive
from ordwise.plans.state_table import StateTable
from ordwise.plans.tables import Tables, aligned_shuffles
from ordwise.sources.files import list_files


@pytest.fixture
def ranks(spark):
    return StateTable(spark, f"{tempfile.mkdtemp(prefix='ordwise-state-')}/ranks", ["order_id"], "prior_rank", "int", buckets=8)


def values(spark, pairs):
    return spark.createDataFrame(pairs, "order_id string, prior_rank int")


def held(df):
    return {r.order_id: r.prior_rank for r in df.collect()}


def test_lookup_reads_the_buckets_of_its_keys_only(spark, ranks):
    ranks.append(values(spark, [(f"o{k}", k % 8 + 1) for k in range(400)] + [("o1", 1), (None, 3)]), 0)
    wanted = values(spark, [("o5", 0), ("o77", 0), ("absent", 0)]).select("order_id")
    touched = {r[0] for r in wanted.select(ranks.bucket()).distinct().collect()}
    found = ranks.lookup(wanted, 1)
    assert held(found) == {"o5": 6, "o77": 6}
    read = {int(p.split("bucket=")[1].split("/")[0]) for p in found.inputFiles()}
    assert read == touched and len(read) < 8
    assert "In(order_id" in found._jdf.queryExecution().toString().replace("PushedFilters: [", "")
    file = found.inputFiles()[0].removeprefix("file://")
    assert pq.ParquetFile(file).metadata.num_rows > 0 and b"parquet.avro" not in open(file, "rb").read(4)


def test_a_batch_sees_earlier_batches_only_and_may_run_twice(spark, ranks):
    every = spark.createDataFrame([("a",), ("b",), ("c",)], "order_id string")
    assert held(ranks.lookup(every, 0)) == {}
    ranks.append(values(spark, [("a", 2), ("b", 5)]), 0)
    for _ in range(2):  # the second run of batch 1 does not see the first
        assert held(ranks.lookup(every, 1)) == {"a": 2, "b": 5}
        ranks.append(values(spark, [("a", 4), ("c", 1)]), 1)
    assert held(ranks.lookup(every, 2)) == {"a": 4, "b": 5, "c": 1}


def test_compaction_keeps_values_and_merges_files(spark, ranks):
    for k in range(4):
        ranks.append(values(spark, [(f"o{i}", (i + k) % 9) for i in range(60)]), k)
    every = spark.createDataFrame([(f"o{i}",) for i in range(60)], "order_id string")
    before = held(ranks.lookup(every, 4))
    n = list_files(spark, ranks.root).where("file_path like '%.parquet'").count()
    assert ranks.compact(4, min_files=2) == 8
    assert held(ranks.lookup(every, 4)) == before
    assert list_files(spark, ranks.root).where("file_path like '%.parquet'").count() < n
    ranks.append(values(spark, [("o1", 99)]), 4)
    ranks.compact(4, min_files=2)  # batch 4 may run again: its bucket stays as it is
    assert held(ranks.lookup(every, 4)) == before and held(ranks.lookup(every, 5))["o1"] == 99


def test_many_keys_are_not_pushed_by_value(spark, ranks, monkeypatch):
    monkeypatch.setattr("ordwise.plans.state_table.PUSHED_KEYS", 3)
    ranks.append(values(spark, [(f"o{k}", 1) for k in range(50)]), 0)
    assert len(held(ranks.lookup(spark.createDataFrame([(f"o{k}",) for k in range(30)], "order_id string"), 1))) == 30


def tables(spark):
    where = tempfile.mkdtemp(prefix="ordwise-tables-")
    t = Tables(spark, "t_" + os.path.basename(where).replace("-", "_").lower(), where, buckets=4)
    t.create_tables()
    return t


def test_upsert_exchanges_the_increment_only(spark):
    t, ev = tables(spark), make_events(spark, random_rows(8, n=200))
    t.upsert_orders(ev.where("arrival_seq <= 100"))
    with aligned_shuffles(spark, t.buckets):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = t.merged_orders(ev.where("arrival_seq > 100"))._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_bucketed_upsert_equals_the_plain_merge(spark):
    t, ev = tables(spark), make_events(spark, random_rows(9, n=300))
    want = empty_orders(spark)
    for k in range(4):
        part = ev.where(f"arrival_seq % 4 = {k}")
        want = merge_orders(want, part)
        assert t.upsert_orders(part) == k + 1
    drop = ["updated_at"]
    assert sorted(map(str, t.orders().drop(*drop).collect())) == sorted(map(str, want.drop(*drop).collect()))
    assert len([n for n in os.listdir(t.location) if n.startswith("orders_v")]) == 2
    t.create_tables()
    assert t.orders().count() == want.count()


def test_sql_on_event_tables_prunes_partitions(spark):
    t, ev = tables(spark), make_events(spark, [(k, k * 40, "o", f"e{k}", "ORDER_PAID") for k in range(1, 100)])
    t.insert_events("order_events", process_events(ev))
    q = spark.sql(f"SELECT event_id FROM {t.name('order_events')} WHERE dt = '2025-11-23' AND hr = '05'")
    assert len({os.path.dirname(f) for f in q.inputFiles()}) >= 1
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "dt" in plan.split("PartitionFilters")[1][:120]
    want = ev.where("date_format(arrival_ts, 'yyyy-MM-dd HH') = '2025-11-23 05'")
    assert sorted(r.event_id for r in q.collect()) == sorted(r.event_id for r in want.collect())


def test_sized_files(spark):
    rows = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("s"),
                                       F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("part"))
    root = tempfile.mkdtemp(prefix="ordwise-sized-") + "/t"
    compaction.write_sized(rows.repartition(40), root, 2 << 20, ("part",), ratio=1.3)
    sizes = {p: [r.length for r in list_files(spark, f"{root}/part={p}").collect() if r.file_path.endswith(".parquet")] for p in "ab"}
    assert len(sizes["a"]) >= 3 and max(sizes["a"]) <= 4 << 20   # the large folder is cut
    assert len(sizes["b"]) <= 2                                    # the small one is not
    assert spark.read.parquet(root).count() == 200_000


def test_compacted_loads_keep_rows_tracking_and_undo(spark):
    wh, landing = warehouse(spark), tempfile.mkdtemp(prefix="ordwise-land-")
    ev = process_events(make_events(spark, [(k, k * 7, f"o{k % 5}", f"e{k}", "ORDER_PAID") for k in range(1, 90)]))
    for k in range(3):
        write_csv_archive(ev.where(f"arrival_seq % 3 = {k}"), landing)
        loader.load(spark, wh, landing, "valid")
    before = sorted(map(str, wh.events("valid").drop("load_id").collect()))
    n = list_files(spark, wh.table_path("valid")).where("file_path like '%.parquet'").count()
    new = compaction.compact_loads(spark, wh, "valid")
    assert sorted(map(str, wh.events("valid").drop("load_id").collect())) == before
    assert {r.load_id for r in wh.events("valid").select("load_id").distinct().collect()} == {new}
    assert list_files(spark, wh.table_path("valid")).where("file_path like '%.parquet'").count() <= n // 2
    assert loader.load(spark, wh, landing, "valid")["files"] == 0
    assert compaction.compact_loads(spark, wh, "valid") is None
    loader.undo_load(spark, wh, new)
    assert wh.events("valid").count() == 0 and loader.load(spark, wh, landing, "valid")["files"] > 0


@pytest.mark.parametrize("mode,state_ttl", [("drop", None), ("keep", None), ("drop", 600)])
def test_replay_from_any_point_equals_the_full_run(spark, mode, state_ttl):
    ev = make_events(spark, random_rows(31, n=250, orders=4, ids=20))
    full = process_events(ev, mode, state_ttl_seconds=state_ttl)
    for start in (minutes(0), minutes(300), minutes(301.5), minutes(700)):
        got = replay.replay_from(ev, full, start, mode, state_ttl_seconds=state_ttl)
        want = full.where(F.col("arrival_ts") >= F.lit(start))
        pick = lambda df: {k: v[:2] for k, v in routes(df).items()}
        assert pick(got) == pick(want)


def test_as_of_takes_a_time_per_order(spark):
    full = process_events(make_events(spark, [(1, 0, "a", "e1", "ORDER_PENDING"), (2, 5, "a", "e2", "ORDER_PAID"),
                                              (3, 6, "b", "e3", "ORDER_SHIPPED"), (4, 9, "a", "e4", "ORDER_SHIPPED")]))
    starts = spark.createDataFrame([("a", minutes(9)), ("b", minutes(6))], "order_id string, start_ts timestamp_ntz")
    assert [(r.order_id, r.prior_rank) for r in replay.as_of(replay.state_versions(full), starts).collect()] == [("a", 2)]


def test_raw_archive_since_prunes_days(spark):
    wire = make_events(spark, [(k, k * 300, "o", f"e{k}", "ORDER_PAID") for k in range(1, 30)]).select(
        F.lit("x").alias("value"), "arrival_ts", "arrival_seq")
    root = tempfile.mkdtemp(prefix="ordwise-raw-") + "/raw"
    with_partition_columns(wire).write.partitionBy("dt", "hr").parquet(root)
    got = read_raw_archive(spark, root, minutes(300 * 20))
    assert sorted(r.arrival_seq for r in got.collect()) == list(range(20, 30))
    assert "PartitionFilters: [isnotnull(dt" in got._jdf.queryExecution().executedPlan().toString()


def test_a_swapped_row_is_seen_by_content_not_by_count(spark):
    ev = make_events(spark, random_rows(12, n=150))
    routed = process_events(ev)
    assert all(r.balanced for r in fingerprint.reconcile_content(ev, routed).collect())
    one, other = (routed.where(f"arrival_seq = {k}") for k in (10, 11))
    swapped = routed.where("arrival_seq <> 10").unionByName(other.withColumn("arrival_ts", F.lit(one.first().arrival_ts)))
    rows = fingerprint.reconcile_content(ev, swapped).collect()
    assert all(r.counts_agree for r in rows) and sum(not r.balanced for r in rows) == 1
    missing = fingerprint.reconcile_content(ev, routed.where("arrival_seq <> 10")).collect()
    assert sum(not r.counts_agree for r in missing) == 1
    # nulls, empty texts and neighbours stay apart
    a = spark.createDataFrame([("x", None), ("", "x"), (None, "x"), ("ab", "c"), ("a", "bc")], "a string, b string")
    assert a.select(fingerprint.row_hash(a, ("a", "b")).alias("h")).distinct().count() == 5
