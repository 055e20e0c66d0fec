"""Differential: the stateful stream equals the batch plan, for any split of
the input into micro-batches that respects arrival order; restarts on the
same checkpoint and batches that run twice emit nothing twice."""

from __future__ import annotations

import os
import random
import tempfile

import pytest
from conftest import make_events
from pyspark.sql import functions as F
from test_properties import TYPES, model, random_rows

from ordwise.functions.codec import decode_wire, encode_wire, with_rank
from ordwise.operators.validate import prior_sightings, prior_state, process_events
from ordwise.sources.files import list_names
from ordwise.sources.streams import read_event_stream, write_wire_files
from ordwise.streaming import jobs, validation


def wire_of(ev):
    return ev.select(encode_wire(ev).alias("value"), "arrival_ts", "arrival_seq")


def routes(df):
    return {r.arrival_seq: (r.route, r.is_dup, r.prev_rank) for r in df.collect()}


def stream(spark, parts, out=None, **options):
    """Run the sink over wire slices, one availableNow run each."""
    root = tempfile.mkdtemp(prefix="ordwise-stream-")
    for part in parts:
        write_wire_files(part, f"{root}/src")
        jobs.run_available(validation.start_validation(
            read_event_stream(spark, "files", f"{root}/src"), f"{root}/out", f"{root}/ck",
            trigger={"availableNow": True}, **options))
    return f"{root}/out"


@pytest.mark.parametrize("mode,state_ttl,options", [("drop", None, {}), ("keep", 600, {"compact_every": 2}),
                                                    ("drop", None, {"compact_every": 1, "max_records_per_file": 10})])
def test_stream_equals_batch(spark, mode, state_ttl, options):
    rows = random_rows(11, n=300, orders=3, ids=12)   # few orders, many live ids each
    ev = make_events(spark, rows)
    wire = wire_of(ev)
    out = stream(spark, [wire.where(f"arrival_seq > {lo} and arrival_seq <= {hi}") for lo, hi in [(0, 100), (100, 200), (200, 10_000)]],
                 on_duplicate=mode, state_ttl_seconds=state_ttl, **options)
    got = validation.read_fanout(spark, out)
    assert got.count() == len(rows)
    assert routes(got) == routes(process_events(ev, mode, state_ttl_seconds=state_ttl))


def test_one_order_with_a_third_of_a_batch(spark):
    rnd = random.Random(31)
    rows, t = [], 0.0
    for seq in range(1, 601):
        t += rnd.choice([0, 0.5, 1, 3])
        rows.append((seq, t, "hot" if seq % 3 == 0 else f"o{rnd.randrange(40)}", f"e{rnd.randrange(200)}", rnd.choice(TYPES)))
    wire = wire_of(make_events(spark, rows))
    out = stream(spark, [wire.where("arrival_seq <= 300"), wire.where("arrival_seq > 300")], hot_rows=50)
    assert {k: v[0] for k, v in routes(validation.read_fanout(spark, out)).items()} == model(rows, mode="drop")


def test_malformed_lines_go_the_same_way_in_stream_and_batch(spark):
    """Cut lines, bad payload types and missing ids: quarantined, no state, and
    never duplicates of one another."""
    ev = make_events(spark, random_rows(17, n=90, orders=2, ids=9))
    text = encode_wire(ev)
    k = F.col("arrival_seq") % 9
    bad = (F.when(k == 1, F.lit("garbage")).when(k == 2, F.substring(text, 1, 40))
           .when(k == 3, F.regexp_replace(text, '"quantity":1', '"quantity":"abc"'))
           .when(k == 4, F.regexp_replace(text, '"event_id":"[^"]*",', "")).when(k == 5, F.regexp_replace(text, '"order_id":"[^"]*",', ""))
           .otherwise(text))
    wire = ev.select(bad.alias("value"), "arrival_ts", "arrival_seq")
    batch = process_events(with_rank(decode_wire(wire)))
    want = routes(batch)
    assert routes(validation.read_fanout(spark, stream(spark, [wire.where("arrival_seq <= 40"), wire.where("arrival_seq > 40")]))) == want
    assert all(want[s][0] == "quarantine" for s in want if s % 9 in (1, 2, 3, 4, 5))
    assert not any(want[s][1] for s in want if s % 9 in (1, 2, 4, 5))


def test_a_batch_that_runs_again_changes_nothing(spark):
    rows = random_rows(19, n=120)
    wire = wire_of(make_events(spark, rows))
    parts = [wire.where("arrival_seq <= 60"), wire.where("arrival_seq > 60")]
    out = stream(spark, parts)
    before = routes(validation.read_fanout(spark, out))
    validation.ValidationSink(out)(parts[1], 1)          # committed, but the query forgot
    assert routes(validation.read_fanout(spark, out)) == before
    # a batch without a commit is not read
    os.rename(f"{out}/_commits/{1:012d}", f"{out}/_commits/.gone")
    assert set(routes(validation.read_fanout(spark, out))) == set(range(1, 61))
    validation.ValidationSink(out)(parts[1], 1)
    assert routes(validation.read_fanout(spark, out)) == before


def test_compaction_drops_idle_state(spark):
    rows = [(i, i * 30.0, f"o{i}", f"e{i}", "ORDER_PAID") for i in range(1, 9)]   # half an hour apart
    wire = wire_of(make_events(spark, rows))
    out = stream(spark, [wire.where(f"arrival_seq = {i}") for i in range(1, 9)], state_ttl_seconds=600, compact_every=4)
    base = max(int(n.split("=")[1]) for n in list_names(spark, f"{out}/_state", dirs=True) if n.startswith("base="))
    for kind in ("ranks", "sightings"):
        assert spark.read.parquet(f"{out}/_state/base={base}/{kind}").count() == 1


def test_raw_archive_restart_emits_nothing_twice(spark):
    wire = wire_of(make_events(spark, random_rows(12, n=50)))
    root = tempfile.mkdtemp(prefix="ordwise-raw-")
    write_wire_files(wire, f"{root}/src")
    for _ in range(2):
        jobs.run_available(jobs.start_raw_archive(
            read_event_stream(spark, "files", f"{root}/src"), f"{root}/raw", f"{root}/ck",
            trigger={"availableNow": True}))
    got = spark.read.parquet(f"{root}/raw").select(*wire.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wire.collect()))


def test_stream_continues_prior_state(spark):
    """J3 for streams: a stream that starts from the states of earlier loads
    routes the rest exactly like one pass over everything."""
    ev = make_events(spark, random_rows(13, n=200))
    expect = routes(process_events(ev, "drop"))
    earlier = process_events(ev.where("arrival_seq <= 100"), "drop")
    out = stream(spark, [wire_of(ev.where("arrival_seq > 100"))], prior=prior_state(earlier), prior_seen=prior_sightings(earlier))
    assert routes(earlier) | routes(validation.read_fanout(spark, out)) == expect


def test_late_rows_are_dropped_and_closed_windows_emitted(spark):
    root = tempfile.mkdtemp(prefix="ordwise-counts-")
    for seq, event_time in ((1, 0), (2, 10), (3, 0.1), (4, 9.9), (5, 300)):   # 3 is far behind the watermark, 4 is not
        write_wire_files(wire_of(make_events(spark, [(seq, seq, "o", f"e{seq}", "ORDER_PAID", event_time)])), f"{root}/src")
        counts = jobs.count_stream(jobs.decode_stream(read_event_stream(spark, "files", f"{root}/src")), 30, "timestamp", "5 seconds")
        jobs.run_available(jobs.start_counts(counts, f"{root}/counts", f"{root}/ck", trigger={"availableNow": True}))
    got = sorted((r.window_start.minute, r.n) for r in spark.read.parquet(f"{root}/counts/*").collect())
    assert got == [(0, 1), (9, 1), (10, 1)]
