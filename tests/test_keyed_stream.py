"""Streams whose state is Spark's own: keyed validation, windows that keep
their late rows, running totals, a source that archives what it has read."""

from __future__ import annotations

import datetime as dt
import random
import tempfile

import pytest
from conftest import make_events, minutes
from pyspark.sql import functions as F
from test_properties import random_rows
from test_streaming import routes, wire_of

from ordwise.operators import metrics
from ordwise.operators.validate import process_events
from ordwise.sources.files import list_files
from ordwise.sources.streams import read_event_stream, write_wire_files
from ordwise.streaming import jobs, keyed, windows


def run(spark, parts, start, **source):
    """One availableNow run on the same checkpoint per landed part."""
    root = tempfile.mkdtemp(prefix="ordwise-keyed-")
    for part in parts:
        write_wire_files(part, f"{root}/src")
        stream = read_event_stream(spark, "files", f"{root}/src", **source)
        jobs.run_available(start(stream, f"{root}/out", f"{root}/ck", trigger={"availableNow": True}))
    return root


def cut(wire, *bounds):
    edges = [0, *bounds, 1 << 40]
    return [wire.where(f"arrival_seq > {lo} and arrival_seq <= {hi}") for lo, hi in zip(edges, edges[1:])]


@pytest.mark.parametrize("mode,state_ttl,dedup_ttl", [("drop", None, 600), ("keep", 600, 600), ("drop", None, None)])
def test_keyed_stream_equals_batch(spark, mode, state_ttl, dedup_ttl):
    """Few orders with many ids each, gaps below, at and above the TTL: many
    generations are opened, cleared and used again."""
    ev = make_events(spark, random_rows(11, n=300, orders=3, ids=12))
    options = {"on_duplicate": mode, "state_ttl_seconds": state_ttl, "dedup_ttl_seconds": dedup_ttl, "buckets": 2}
    root = run(spark, cut(wire_of(ev), 100, 200), lambda s, out, ck, **kw: keyed.start_keyed_validation(s, out, ck, **kw, **options))
    got = spark.read.parquet(f"{root}/out")
    assert got.count() == 300
    assert routes(got) == routes(process_events(ev, mode, dedup_ttl, state_ttl))


def test_rows_without_ids_and_arrivals_that_go_back(spark):
    """Malformed lines are quarantined; a batch may bring arrivals older than
    the newest of the batch before."""
    ev = make_events(spark, random_rows(5, n=120, orders=4, ids=30))
    wire = wire_of(ev).withColumn("value", F.when(F.col("arrival_seq") % 9 == 0, F.lit('{"order_id": "o')).otherwise(F.col("value")))
    late = wire.where("arrival_seq = 60").withColumn("value", F.regexp_replace("value", '"order_id":"[^"]*"', '"order_id":"other"'))
    parts = [wire.where("arrival_seq <= 80 and arrival_seq <> 60"), late.unionByName(wire.where("arrival_seq > 80"))]
    root = run(spark, parts, keyed.start_keyed_validation)
    got = spark.read.parquet(f"{root}/out")
    assert {r.arrival_seq for r in got.select("arrival_seq").collect()} == set(range(1, 121))
    assert got.where("route = 'quarantine' and quarantine_reason = 'malformed'").count() == 120 // 9
    again = run(spark, parts[:1], keyed.start_keyed_validation)
    jobs.run_available(keyed.start_keyed_validation(read_event_stream(spark, "files", f"{again}/src"), f"{again}/out", f"{again}/ck",
                                                    trigger={"availableNow": True}))
    assert spark.read.parquet(f"{again}/out").count() == 79


def test_the_session_keeps_its_state_store_settings(spark):
    key = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    before = spark.conf.get(key, None)
    with keyed.rocksdb_state(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before


def test_late_rows_come_out_and_nothing_is_lost(spark):
    rows = [(k, k, "o", f"e{k}", "ORDER_PAID" if k % 2 else "ORDER_SHIPPED") for k in range(1, 61)]
    ev = make_events(spark, rows)
    # every fifth event is an hour older than its arrival; one has no event time
    ev = ev.withColumn("timestamp", F.when(F.col("arrival_seq") == 7, F.lit(None).cast("timestamp_ntz"))
                       .when(F.col("arrival_seq") % 5 == 0, F.col("timestamp") - F.make_dt_interval(hours=F.lit(1))).otherwise(F.col("timestamp")))
    end = make_events(spark, [(1000, 60 * 24, "end", "end", "SENTINEL")])
    root = run(spark, [*cut(wire_of(ev), 20, 40), wire_of(end)],
               lambda s, out, ck, **kw: windows.start_counts_with_late(jobs.decode_stream(s), out, ck, **kw))
    counted, late = windows.read_counts(spark, f"{root}/out"), windows.read_late(spark, f"{root}/out")
    told = late.collect()
    assert {r.arrival_seq for r in told if r.kind == "late"} == {25, 30, 35, 40, 45, 50, 55, 60}
    assert {r.arrival_seq for r in told if r.kind == "untimed"} == {7}
    assert counted.agg(F.sum("n")).first()[0] + len(told) == 60
    first = next(r for r in told if r.arrival_seq == 25)
    assert (first.event_id, first.event_type, first.window_start) == ("e25", "ORDER_PAID", minutes(25) - dt.timedelta(hours=1))
    want = metrics.counts_tumbling(ev.where("timestamp is not null").join(late.select("arrival_seq"), "arrival_seq", "left_anti"), 30, "timestamp")
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, want.select(*counted.columns).collect()))


@pytest.mark.parametrize("by", ["event_type", None])
def test_running_totals_over_restarts(spark, by):
    ev = make_events(spark, [(k, k * 0.3, "o", f"e{k}", ["ORDER_PAID", "ORDER_SHIPPED", ""][k % 3]) for k in range(1, 61)])
    end = make_events(spark, [(1000, 60 * 24, "end", "end", "SENTINEL")])
    root = run(spark, [*cut(wire_of(ev), 20, 40), wire_of(end)], lambda s, out, ck, **kw: windows.start_running_totals(
        jobs.count_stream(jobs.decode_stream(s), 30), out, ck, by=by, **kw))
    got = spark.read.parquet(f"{root}/out")
    if by:
        want = metrics.running_totals(metrics.counts_tumbling(ev, 30))
        assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
    else:
        assert got.agg(F.max("running_n"), F.sum("n")).first()[:] == (60, 60)


def test_duplicate_totals_from_routed_output(spark):
    ev = make_events(spark, random_rows(23, n=200, orders=4, ids=25))
    end = make_events(spark, [(1000, 60 * 24 * 30, "end", "end", "ORDER_PAID")])
    root = run(spark, [*cut(wire_of(ev), 70, 140), wire_of(end)], keyed.start_keyed_validation)
    schema = spark.read.parquet(f"{root}/out").schema
    routed = spark.readStream.schema(schema).parquet(f"{root}/out")
    jobs.run_available(windows.start_running_totals(windows.duplicate_count_stream(routed), f"{root}/dups", f"{root}/ck2", by=None,
                                                    trigger={"availableNow": True}))
    want = metrics.running_totals(metrics.duplicate_counts(process_events(ev)), by=None)
    got = spark.read.parquet(f"{root}/dups")
    assert got.count() == want.count() > 0 and got.exceptAll(want.select(*got.columns)).count() == 0


def test_archived_source_files_are_not_read_again(spark):
    ev = make_events(spark, random_rows(3, n=90))
    done = tempfile.mkdtemp(prefix="ordwise-done-")
    root = run(spark, cut(wire_of(ev), 30, 60), lambda s, out, ck, **kw: jobs.start_raw_archive(s, out, ck, **kw), archive_dir=done)
    moved = [r.file_path for r in list_files(spark, done).collect() if r.file_path.endswith(".parquet")]
    left = [r.file_path for r in list_files(spark, f"{root}/src").collect() if r.file_path.endswith(".parquet")]
    assert moved and not {p.rsplit("/", 1)[1] for p in moved} & {p.rsplit("/", 1)[1] for p in left}
    assert sorted(r.arrival_seq for r in spark.read.parquet(f"{root}/out").collect()) == list(range(1, 91))


def progress(spark, wire, start):
    """State rows that a batch of one availableNow run updated, at most, and the run's folder."""
    root = tempfile.mkdtemp(prefix="ordwise-keyed-")
    write_wire_files(wire, f"{root}/src")
    query = start(read_event_stream(spark, "files", f"{root}/src"), f"{root}/out", f"{root}/ck", trigger={"availableNow": True})
    jobs.run_available(query)
    return max(op["numRowsUpdated"] for p in query.recentProgress for op in p["stateOperators"]), root


def test_state_of_windows_follows_hours_not_windows(spark):
    """600 windows of three hours, two types each: a window of a type is no state of its own."""
    ev = make_events(spark, [(k, k * 0.3, "o", f"e{k}", ["ORDER_PAID", "ORDER_SHIPPED"][k % 2]) for k in range(600)])
    end = make_events(spark, [(1000, 60 * 24, "end", "end", "SENTINEL")])
    updated, root = progress(spark, wire_of(ev.unionByName(end)), lambda s, out, ck, **kw: windows.start_counts_with_late(
        jobs.decode_stream(s), out, ck, **kw))
    assert 0 < updated <= 4 * windows.DEFAULT_SALTS * 4
    got = windows.read_counts(spark, f"{root}/out")
    want = metrics.counts_tumbling(ev, 30, "timestamp")
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
    assert windows.read_late(spark, f"{root}/out").count() == 0


def test_a_page_closes_window_by_window(spark):
    """The watermark goes through one hour: a closed window is written while
    the page's later ones still count, over a restart each."""
    ev = make_events(spark, [(k, k * 0.5, "o", f"e{k}", "ORDER_PAID") for k in range(1, 101)])
    root = run(spark, cut(wire_of(ev), 30, 60), lambda s, out, ck, **kw: windows.start_counts_with_late(jobs.decode_stream(s), out, ck, **kw))
    got = windows.read_counts(spark, f"{root}/out")
    assert got.count() == got.agg(F.sum("n")).first()[0] and 95 <= got.count() < 100
    assert got.agg(F.max("window_start")).first()[0] < minutes(50)


def test_state_of_orders_lies_in_pages_and_hours_in_few_files(spark):
    """2,000 orders over two hours, in two runs: far fewer state rows than
    orders, and no more files than an hour's share."""
    rows = [(k, k * 0.03, f"o{k % 2000}", f"e{k}", ["ORDER_PAID", "ORDER_SHIPPED"][k % 2]) for k in range(1, 4001)]
    ev, before = make_events(spark, rows), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        updated, root = progress(spark, wire_of(ev), keyed.start_keyed_validation)
        parts = run(spark, cut(wire_of(ev), 1500), lambda s, out, ck, **kw: keyed.start_keyed_validation(s, out, ck, **kw, buckets=3))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert 0 < updated < 1000
    files = [r.file_path for r in list_files(spark, f"{root}/out").collect() if r.file_path.endswith(".parquet")]
    assert len(files) <= 2 * 3 * keyed.FILES_PER_HOUR
    want = routes(process_events(ev))
    for at in (root, parts):
        assert routes(spark.read.parquet(f"{at}/out")) == want


def test_a_paged_map_holds_what_a_dict_holds():
    class Store:
        """A state variable, as a handle gives it."""
        def __init__(self):
            self.held, self.one = {}, None
        getValue = lambda self, k: self.held.get(k)
        updateValue = lambda self, k, v: self.held.__setitem__(k, v)
        removeKey = lambda self, k: self.held.pop(k, None)
        get = lambda self: self.one
        update = lambda self, v: setattr(self, "one", v)
        clear = lambda self: self.__init__()

    class Handle:
        getMapState = getValueState = lambda self, *a: Store()

    paged, want, rng = keyed.PagedMap(Handle(), "m", "rk int, us long"), {}, random.Random(3)
    for step in range(60):
        paged.begin()
        assert all(tuple(paged.get(k)) == v for k, v in rng.sample(sorted(want.items()), min(50, len(want)))) and paged.get("none") is None
        new = {f"k{rng.randrange(4000)}": (rng.randrange(9), step) for _ in range(rng.choice([0, 1, 10, 300]))}
        paged.put(new)
        want |= new
        if step % 20 == 19:
            paged.begin()
            paged.discard(lambda v: v[0] == 4)
            want = {k: v for k, v in want.items() if v[0] != 4}
        if step == 40:
            paged.clear()
            want = {}
        paged.begin()
        assert paged.entries == len(want) and {k: tuple(v) for at in range(paged.pages) for k, v in paged._page(at).items()} == want
        assert len(want) <= keyed.PAGE * paged.pages
