"""Files and loader edge rows (FIXTURES section 5)."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ordwise.functions.codec import csv_line, parse_csv_lines
from ordwise.plans import loader

LINE = "e1,o1,ORDER_PAID,2025-11-22T10:15:32.1,C1,P1,2,49.99\n"


def landing(files: dict[str, bytes]) -> str:
    root = tempfile.mkdtemp(prefix="ordwise-landing-")
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(data)
    return root


def warehouse(spark):
    return loader.Warehouse(spark, tempfile.mkdtemp(prefix="ordwise-wh-"))


def keys(df):
    return sorted(r.partition_key for r in df.select("partition_key").collect())


def test_gate_blocks_empty_and_in_progress(spark):
    root = landing({
        "2025-11/22/10/part-0.csv": LINE.encode(),
        "2025-11/22/11/part-0.csv": b"",                       # zero-byte
        "2025-11/22/12/part-0.csv": LINE.encode(),
        "2025-11/22/12/.part-1.inprogress": b"x",               # still being written
        "dt=2025-11-22/hr=13/part-0.csv": LINE.encode(),        # hive layout
        "batch_id=0/dt=2025-11-22/hr=14/part-0.csv": LINE.encode(),  # hour over two
        "batch_id=1/dt=2025-11-22/hr=14/part-0.csv": b"",            # batch folders
    })
    files = loader.discover(spark, root, "valid")
    ready = {r.partition_key: r.ready for r in loader.partition_status(files).collect()}
    assert ready == {"2025-11/22/10": True, "2025-11/22/11": False,
                     "2025-11/22/12": False, "2025-11/22/13": True, "2025-11/22/14": False}


def test_tracked_files_skipped_new_file_in_loaded_hour_loaded(spark):
    root = landing({"2025-11/22/10/part-0.csv": LINE.encode()})
    wh = warehouse(spark)
    assert loader.load(spark, wh, root, "valid")["partitions"] == 1
    assert loader.load(spark, wh, root, "valid")["files"] == 0          # nothing pending
    with open(os.path.join(root, "2025-11/22/10/part-1.csv"), "w") as f:
        f.write(LINE.replace("e1", "e2"))
    s = loader.load(spark, wh, root, "valid")
    assert s["partitions"] == 1 and s["files"] == 1                     # only the new file
    assert ids(wh) == ["e1", "e2"]


def ids(wh, dataset="valid"):
    return sorted(r.event_id for r in wh.events(dataset).collect())


def test_late_file_after_promotion_is_added(spark):
    root, done = landing({"2025-11/22/10/part-0.csv": LINE.encode()}), tempfile.mkdtemp(prefix="ordwise-loaded-")
    wh = warehouse(spark)
    loader.load(spark, wh, root, "valid", promote_to=done)
    with open(os.path.join(root, "2025-11/22/10/part-9.csv"), "w") as f:
        f.write(LINE.replace("e1", "e2"))
    assert loader.load(spark, wh, root, "valid", promote_to=done)["files"] == 1
    assert ids(wh) == ["e1", "e2"]
    assert sorted(os.listdir(os.path.join(done, "2025-11/22/10"))) == ["part-0.csv", "part-9.csv"]


def test_failed_load_leaves_committed_rows_and_is_retried(spark, monkeypatch):
    root = landing({"2025-11/22/10/part-0.csv": LINE.encode()})
    wh = warehouse(spark)
    loader.load(spark, wh, root, "valid")
    with open(os.path.join(root, "2025-11/22/10/part-1.csv"), "w") as f:
        f.write(LINE.replace("e1", "e2"))

    def broken(*_a, **_k):
        raise RuntimeError("snapshot write failed")
    with monkeypatch.context() as m:
        m.setattr(loader.OrdersStore, "upsert", broken)
        with pytest.raises(RuntimeError, match="snapshot write failed"):
            loader.load(spark, wh, root, "valid")
    assert ids(wh) == ["e1"]
    assert loader.load(spark, wh, root, "valid")["files"] == 1
    assert ids(wh) == ["e1", "e2"] and wh.orders.current().count() == 1


def test_dead_run_and_unfinished_snapshot_are_invisible_and_do_not_block(spark):
    root = landing({"2025-11/22/10/part-0.csv": LINE.encode()})
    wh = warehouse(spark)
    first = loader.load(spark, wh, root, "valid")["load_id"]
    # rows of a load that never committed, and an attempt without a manifest
    spark.read.parquet(f"{wh.table_path('valid')}/load_id={first}").write.partitionBy("dt", "hr").parquet(
        f"{wh.table_path('valid')}/load_id=dead")
    os.makedirs(os.path.join(wh.root, "orders/data/attempt-dead/bucket=0"))
    with open(os.path.join(wh.root, "orders/manifests/.tmp-attempt-dead"), "w") as f:
        f.write("{")
    assert ids(wh) == ["e1"]
    with open(os.path.join(root, "2025-11/22/10/part-1.csv"), "w") as f:
        f.write(LINE.replace("e1", "e2"))
    loader.load(spark, wh, root, "valid")
    assert ids(wh) == ["e1", "e2"] and wh.orders.versions() == [1, 2]


def test_undo_takes_back_one_load_only(spark):
    root = landing({"2025-11/22/10/part-0.csv": LINE.encode()})
    wh = warehouse(spark)
    loader.load(spark, wh, root, "valid")
    with open(os.path.join(root, "2025-11/22/10/part-1.csv"), "w") as f:
        f.write(LINE.replace("e1", "e2"))
    second = loader.load(spark, wh, root, "valid")["load_id"]
    loader.undo_load(spark, wh, second)
    assert ids(wh) == ["e1"]
    assert loader.load(spark, wh, root, "valid")["files"] == 1 and ids(wh) == ["e1", "e2"]


@pytest.mark.parametrize("bad", ["e9,o9,ORDER_PAID\n", LINE.replace("49.99", "1,2,3"), LINE.replace("2025-11-22T10:15:32.1", "garbage"),
                                 LINE.replace(",2,", ",two,"), LINE.replace("49.99", "much")])
def test_bad_line_fails_its_own_hour_only(spark, bad):
    root = landing({"2025-11/22/10/part-0.csv": (LINE + bad).encode(), "2025-11/22/11/part-0.csv": LINE.replace("e1", "e2").encode()})
    wh = warehouse(spark)
    s = loader.load(spark, wh, root, "valid")
    assert s["failed"] == ["2025-11/22/10"] and ids(wh) == ["e2"]
    with open(os.path.join(root, "2025-11/22/10/part-0.csv"), "w") as f:
        f.write(LINE)
    assert loader.load(spark, wh, root, "valid")["failed"] == [] and ids(wh) == ["e1", "e2"]


def test_blank_order_id_goes_to_quarantine_and_never_into_orders(spark):
    root = landing({"2025-11/22/10/part-0.csv": (LINE + LINE.replace("e1,o1", "e2, ")).encode()})
    wh = warehouse(spark)
    load_id = loader.load(spark, wh, root, "valid")["load_id"]
    for _ in range(2):
        assert ids(wh) == ["e1"] and ids(wh, "quarantine") == ["e2"] and wh.orders.current().count() == 1
        loader.undo_load(spark, wh, load_id)
        load_id = loader.load(spark, wh, root, "valid")["load_id"]


def test_orders_store_rewrites_touched_buckets_and_cleans_up(spark):
    from conftest import make_events
    store = loader.OrdersStore(spark, tempfile.mkdtemp(prefix="ordwise-orders-"), buckets=4)
    assert store.current().count() == 0 and store.lookup("o1").count() == 0
    for v in range(1, 10):
        store.upsert(make_events(spark, [(v, v, f"o{v % 3}", f"e{v}", "ORDER_PAID")]))
    rows = {r.order_id: r.latest_event_id for r in store.current().collect()}
    assert rows == {"o0": "e9", "o1": "e7", "o2": "e8"}
    assert [r.latest_event_id for r in store.lookup("o2").collect()] == ["e8"] and store.lookup("nope").count() == 0
    assert store.versions() == [8, 9]
    before = store.manifest()["folders"]
    store.upsert(make_events(spark, [(20, 20, "o1", "e20", "ORDER_SHIPPED")]))
    assert sum(before.get(k) != v for k, v in store.manifest()["folders"].items()) == 1
    plan = store.lookup("o2")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_id,o2)" in plan
    assert store.upsert(make_events(spark, [(30, 1, None, "x", "ORDER_PAID")])) == 10


def test_cleanup_rules(spark):
    raw = b"e1, o1 ,ORDER_PAID,2025-11-22T10:15:32.1,,   ,2,49.99\na\xffb,o2,ORDER_PAID,,C,P,1,1.0\n"
    root = landing({"2025-11/22/10/part-0.csv": raw})
    wh = warehouse(spark)
    loader.load(spark, wh, root, "valid")
    rows = {r.order_id: r for r in wh.events().collect()}
    r = rows["o1"]
    assert (r.customer_id, r.product_id, r.quantity, r.price) == (None, None, 2, 49.99)
    assert str(r.timestamp) == "2025-11-22 10:15:32.100000"
    assert rows["o2"].event_id == "a�b"


def test_comma_in_id_survives_round_trip(spark):
    df = spark.createDataFrame(
        [("e,1", "o\"1", "ORDER_PAID", None, "C", "P", 1, 2.5)],
        "event_id string, order_id string, event_type string, timestamp timestamp_ntz, "
        "customer_id string, product_id string, quantity int, price double")
    back = parse_csv_lines(df.select(csv_line(df).alias("line")), "line").collect()[0]
    assert (back.event_id, back.order_id, back.quantity) == ("e,1", 'o"1', 1)


@pytest.mark.parametrize("layout", ["2025-11/22/10/x.csv", "base/dt=2025-11-22/hr=10/x.csv"])
def test_partition_key_from_path(spark, layout):
    from ordwise.plans.archive import key_from_path
    df = spark.createDataFrame([(f"file:/tmp/{layout}",)], "p string")
    assert df.select(key_from_path(F.col("p"))).first()[0] == "2025-11/22/10"
