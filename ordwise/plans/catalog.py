"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Each query reads the given tables (through the adapters) and runs the
library's operators over all of their rows. Column names match the SQL in
``oracles.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import decode_wire, format_timestamp, parse_csv_lines
from ..operators import analytics, fingerprint, metrics, replay, upsert
from ..operators.validate import prior_expiring_state, prior_sightings, prior_state, process_events
from ..session import materialize, scratch_path, ship_package
from ..sources.files import list_files
from ..sources.streams import read_event_stream, write_wire_files
from ..sources.testdata import SLICES, arrival_slice, clickstream_events, clickstream_wire, order_lineitem_events, table
from ..streaming import jobs as sjobs
from ..streaming import keyed, validation, windows
from . import analyst_sql, compaction, loader
from .archive import PARTITION_COLS, key_from_path, read_raw_archive, with_partition_columns, write_csv_archive
from .state_table import StateTable
from .tables import Tables

ROUTE_COLS = ["event_id", "order_id", "event_type", "arrival_seq", "is_dup", "prev_rank", "route"]
ORDER_OUT = ["order_id", "latest_event_id", "order_status", "latest_event_time",
             "customer_id", "product_id", "quantity", "price"]
SLICE1_TYPES = ["ORDER_PENDING", "ORDER_PAID", "ORDER_SHIPPED"]
LOOKUP_ORDER_ID = "7"


def routed(spark: SparkSession, sf: str, mode: str = "drop") -> DataFrame:
    return process_events(clickstream_events(spark, sf), on_duplicate=mode)


def q_parse_flatten_events(spark, sf):
    return clickstream_events(spark, sf).select(
        "event_id", "order_id", "event_type", "timestamp", "customer_id", "product_id",
        "quantity", "price", "arrival_ts", "arrival_seq", "rk")


def q_quarantine_unknown(spark, sf):
    return (routed(spark, sf).where(F.col("route") == "quarantine")
            .select("event_id", "order_id", "event_type", "arrival_seq", "quarantine_reason"))


def q_duplicate_flags(spark, sf):
    return routed(spark, sf).select("event_id", "order_id", "arrival_ts", "arrival_seq",
                                    "prev_seen_ts", "is_dup")


def q_dedup_drop(spark, sf):
    return (routed(spark, sf).where(~F.col("is_dup"))
            .select("event_id", "order_id", "event_type", "arrival_seq"))


def q_validate_drop_dups(spark, sf):
    return routed(spark, sf, "drop").select(*ROUTE_COLS)


def q_validate_keep_dups(spark, sf):
    return routed(spark, sf, "keep").select(*ROUTE_COLS)


STATE_TTL_SECONDS = 600
TTL_COLS = ["event_id", "order_id", "event_type", "arrival_seq", "is_dup", "route"]


def q_validate_ttl(spark, sf):
    return process_events(clickstream_events(spark, sf), on_duplicate="drop",
                          state_ttl_seconds=STATE_TTL_SECONDS).select(*TTL_COLS)


def q_validate_ttl_keep_dups(spark, sf):
    return process_events(clickstream_events(spark, sf), on_duplicate="keep",
                          state_ttl_seconds=STATE_TTL_SECONDS).select(*TTL_COLS)


def q_route_counts(spark, sf):
    return metrics.route_counts(routed(spark, sf))


def q_counts_tumbling_30s(spark, sf):
    return metrics.counts_tumbling(clickstream_events(spark, sf), 30)


def q_dup_counts_2s(spark, sf):
    return metrics.duplicate_counts(routed(spark, sf), 2)


def q_running_totals(spark, sf):
    return metrics.running_totals(metrics.counts_tumbling(clickstream_events(spark, sf), 30))


def q_dup_running_totals(spark, sf):
    return metrics.running_totals(metrics.duplicate_counts(routed(spark, sf), 2), by=None)


def q_latest_order_state(spark, sf):
    return upsert.latest_per_order(order_lineitem_events(spark, sf))


def q_latest_order_state_rn(spark, sf):
    return upsert.latest_per_order_rn(order_lineitem_events(spark, sf))


def q_orders_upsert_incremental(spark, sf):
    ev = order_lineitem_events(spark, sf)
    first = ev.where(F.col("event_type").isin(SLICE1_TYPES))
    second = ev.where(~F.col("event_type").isin(SLICE1_TYPES))
    snap1 = upsert.merge_orders(upsert.empty_orders(spark), first)
    snap2 = upsert.merge_orders(snap1, second)
    return snap2.select(*ORDER_OUT)


def _stored_orders(spark, sf):
    """The orders table as loads leave it: hash buckets sorted by order id."""
    store = loader.OrdersStore(spark, scratch_path(spark, "orders-store"))
    store.upsert(order_lineitem_events(spark, sf))
    return store


def q_orders_point_lookup(spark, sf):
    """One bucket of the stored table, the id pushed to its scan."""
    return _stored_orders(spark, sf).lookup(LOOKUP_ORDER_ID).select(*ORDER_OUT)


def q_order_milestones(spark, sf):
    return analytics.order_milestones(order_lineitem_events(spark, sf))


def _delivery_report(report):
    """Computed and stored once (one row), then typed."""
    return analytics.as_long_if_it_fits(materialize(report, "delivery-time"), "total_delivery_micros")


def q_avg_delivery_time(spark, sf):
    return _delivery_report(analytics.avg_delivery_time(analytics.order_milestones(order_lineitem_events(spark, sf))))


def q_invalid_events_report(spark, sf):
    return analytics.invalid_report(routed(spark, sf))


def q_partition_keys_hourly(spark, sf):
    ev = clickstream_events(spark, sf)
    return ev.groupBy(analytics.partition_key().alias("partition_key"),
                      F.date_format("arrival_ts", "yyyy-MM-dd").alias("dt"),
                      F.date_format("arrival_ts", "HH").alias("hr")).agg(
        F.count(F.lit(1)).alias("n"))


def q_transition_matrix(spark, sf):
    return analytics.transition_matrix(routed(spark, sf))


def q_strict_transition_violations(spark, sf):
    return analytics.strict_violations(routed(spark, sf))


def q_status_funnel(spark, sf):
    valid = routed(spark, sf).where(F.col("route") == "valid")
    return analytics.status_funnel(upsert.latest_per_order(valid))


def q_status_disagreement(spark, sf):
    return analytics.status_disagreement(routed(spark, sf))


def q_reconcile_routes(spark, sf):
    return analytics.reconcile_routed(routed(spark, sf))


def q_csv_cleanup(spark, sf):
    """CSV lines with dirty fields: blanks, padding, a bad timestamp, a 'Z', an
    invalid UTF-8 byte."""
    valid = routed(spark, sf).where(F.col("route") == "valid")
    n = F.col("arrival_seq")
    dirty = valid.select(
        "event_id", "order_id", "event_type",
        F.when(n % 13 == 0, F.lit("not a time")).when(n % 5 == 0, F.concat(format_timestamp(F.col("timestamp")), F.lit("Z")))
        .otherwise(format_timestamp(F.col("timestamp"))).alias("timestamp"),
        F.when(n % 7 == 0, F.lit("   ")).otherwise(F.col("customer_id")).alias("customer_id"),
        F.concat(F.lit("  "), F.col("product_id"), F.lit(" ")).alias("product_id"),
        F.when(n % 11 == 0, F.lit(" ")).otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.col("price").cast("string").alias("price"), n)
    text = F.concat_ws(",", *[c for c in dirty.columns if c != "arrival_seq"])
    line = F.when(n % 19 == 0, F.concat(F.unhex(F.lit("FF")), text.cast("binary"))).otherwise(text.cast("binary"))
    return parse_csv_lines(dirty.select(line.cast("string").alias("line"), "arrival_seq"), "line").select(
        "event_id", "order_id", "event_type", "timestamp", "customer_id", "product_id",
        "quantity", "price", "arrival_seq")


def _incremental(spark, sf, state_ttl=None):
    """Arrival slices one after another, each continued from the states the
    slices before it left."""
    events = materialize(arrival_slice(clickstream_events(spark, sf)), "incremental")
    earlier = None
    for k in range(SLICES):
        prior = prior_seen = None
        if earlier is not None:
            prior = (prior_state if state_ttl is None else prior_expiring_state)(earlier)
            prior_seen = prior_sightings(earlier)
        out = materialize(process_events(events.where(F.col("slice") == k), "drop", state_ttl_seconds=state_ttl,
                                         prior=prior, prior_seen=prior_seen), "incremental-slice")
        earlier = out if earlier is None else earlier.unionByName(out)
    return earlier


def q_validate_incremental(spark, sf):
    return _incremental(spark, sf).select(*ROUTE_COLS)


def q_validate_incremental_ttl(spark, sf):
    return _incremental(spark, sf, STATE_TTL_SECONDS).select(*TTL_COLS)


# --- analyst SQL (temp views + spark.sql) -------------------------------------
EVENT_TABLE_COLS = ["event_id", "order_id", "event_type", "timestamp", "customer_id",
                    "product_id", "quantity", "price"]


def q_sql_latest_order_state(spark, sf):
    analyst_sql.register_views(spark, orders=_stored_orders(spark, sf).current().select(*ORDER_OUT))
    return analyst_sql.run(spark, "latest_order_state", order_id=LOOKUP_ORDER_ID)


def q_sql_avg_delivery_time(spark, sf):
    analyst_sql.register_views(
        spark, order_milestones=analytics.order_milestones(order_lineitem_events(spark, sf)))
    return _delivery_report(analyst_sql.run(spark, "avg_delivery_time"))


def q_sql_invalid_lifecycle_events(spark, sf):
    invalid = routed(spark, sf).where(F.col("route") == "invalid").select(
        *EVENT_TABLE_COLS, analytics.partition_key().alias("partition_key"))
    analyst_sql.register_views(spark, invalid_order_events=invalid)
    return analyst_sql.run(spark, "invalid_lifecycle_events")


# --- loader ------------------------------------------------------------------
SPLIT_DAY = 15  # first load: arrival day-of-month <= 15; second: the rest
DATASETS = ["valid", "invalid"]


def _routed_once(spark, sf):
    """Routed events materialised once in the checkpoint folder, so the
    archive slices below do not each recompute dedup and validation. The decoded
    events are stored before: hot orders are looked for in their key columns,
    not by decoding all lines once more."""
    return materialize(process_events(materialize(clickstream_events(spark, sf), "decoded")), "routed")


def _write_slice(r, landing, first: bool):
    day = F.dayofmonth("arrival_ts")
    cond = day <= SPLIT_DAY if first else day > SPLIT_DAY
    for ds in DATASETS:
        write_csv_archive(r.where((F.col("route") == ds) & cond), landing[ds])


def _setup(spark, name):
    root = scratch_path(spark, name)
    landing = {ds: f"{root}/landing/{ds}-events" for ds in DATASETS}
    return loader.Warehouse(spark, f"{root}/warehouse"), landing


def q_load_pending_partitions(spark, sf):
    r = _routed_once(spark, sf)
    wh, landing = _setup(spark, "pending")
    _write_slice(r, landing, first=True)
    for ds in DATASETS:
        loader.load(spark, wh, landing[ds], ds)
    _write_slice(r, landing, first=False)
    files = loader.discover(spark, landing["valid"], "valid").unionByName(
        loader.discover(spark, landing["invalid"], "invalid"))
    return (loader.pending_partitions(files, wh.tracker())
            .select("dataset", "partition_key", "ready"))


EVENT_OUT = [*EVENT_TABLE_COLS, "partition_key"]


def q_load_is_idempotent(spark, sf):
    r = _routed_once(spark, sf)
    wh, landing = _setup(spark, "idempotent")
    _write_slice(r, landing, first=True)
    _write_slice(r, landing, first=False)
    for ds in DATASETS:
        loader.load(spark, wh, landing[ds], ds)              # load
        again = loader.load(spark, wh, landing[ds], ds)      # nothing pending
        assert again["files"] == 0
    tables = wh.events("valid").withColumn("dataset", F.lit("valid")).unionByName(
        wh.events("invalid").withColumn("dataset", F.lit("invalid")))
    return tables.select("dataset", *EVENT_OUT)


def q_load_late_file_after_promote(spark, sf):
    """Every hour is loaded and promoted; then a file with the rest of its
    rows lands in it."""
    valid = _routed_once(spark, sf).where(F.col("route") == "valid")
    wh, landing = _setup(spark, "late")
    done = landing["valid"].replace("/landing/", "/loaded/")
    late = F.pmod("arrival_seq", F.lit(5)) == 0
    for part in (valid.where(~late), valid.where(late)):
        write_csv_archive(part, landing["valid"])
        loader.load(spark, wh, landing["valid"], "valid", promote_to=done)
    return wh.events("valid").select(*EVENT_OUT)


def q_load_retry_after_failed_snapshot(spark, sf):
    """The orders upsert of the first try fails; the second try loads it all."""
    valid = _routed_once(spark, sf).where(F.col("route") == "valid")
    wh, landing = _setup(spark, "retry")
    write_csv_archive(valid, landing["valid"])
    try:
        loader.load(spark, wh, landing["valid"], "valid", now=F.raise_error(F.lit("clock is down")).cast("timestamp"))
    except Exception as ex:  # noqa: BLE001 - the failure this query is about
        assert "clock is down" in str(ex)
    loader.load(spark, wh, landing["valid"], "valid")
    return wh.events("valid").select(*EVENT_OUT)


def q_orders_from_loads(spark, sf):
    r = _routed_once(spark, sf)
    wh, landing = _setup(spark, "orders")
    for first in (True, False):
        _write_slice(r, landing, first=first)
        loader.load(spark, wh, landing["valid"], "valid")
    return wh.orders.current().select(*ORDER_OUT)


# --- streaming -----------------------------------------------------------------
# Arrival slices landed one after another; each is followed by one
# availableNow run on the same checkpoint (a restart per slice).
SENTINEL = "SENTINEL"  # closes the open windows; its own window stays open


def _sliced(rows):
    """Stored in a folder per slice, of which a slice reads its own."""
    path = scratch_path(rows.sparkSession, "slices")
    rows.write.partitionBy("slice").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _replay(spark, sf, name, start_query, close_windows=False, archive=False):
    """Land the wire records slice by slice and run ``start_query(stream,
    root, checkpoint)`` to completion after each slice. ``archive``: the source
    moves files it is done with."""
    root = scratch_path(spark, name)
    src, ck = f"{root}/source", f"{root}/checkpoint"
    wire = _sliced(arrival_slice(clickstream_wire(table(spark, sf, "events"))))
    slices = [wire.where(F.col("slice") == k).drop("slice") for k in range(SLICES)]
    if close_windows:
        later = wire.agg((F.max("arrival_ts") + F.make_dt_interval(F.lit(2))).alias("arrival_ts"), (F.max("arrival_seq") + 10).alias("arrival_seq"))
        slices.append(later.select(F.to_json(F.struct(
            F.lit("end").alias("event_id"), F.lit("end").alias("order_id"), F.lit(SENTINEL).alias("event_type"),
            format_timestamp(F.col("arrival_ts")).alias("timestamp"))).alias("value"), "arrival_ts", "arrival_seq"))
    for part in slices:
        write_wire_files(part, src)
        stream = read_event_stream(spark, "files", src, archive_dir=f"{root}/done" if archive else None)
        sjobs.run_available(start_query(stream, root, ck))
    return root


def _validated(spark, sf, name, **options):
    return _replay(spark, sf, name, lambda st, r, ck: validation.start_validation(
        st, f"{r}/out", ck, trigger={"availableNow": True}, **options))


def q_stream_validate_replay(spark, sf):
    root = _validated(spark, sf, "stream-validate")
    return validation.read_fanout(spark, f"{root}/out").select(*ROUTE_COLS)


def q_stream_duplicate_counts(spark, sf):
    root = _validated(spark, sf, "stream-dups")
    return validation.read_duplicate_counts(spark, f"{root}/out")


def q_stream_orders(spark, sf):
    orders = scratch_path(spark, "stream-orders-store")
    _validated(spark, sf, "stream-orders", orders_root=orders)
    return loader.OrdersStore(spark, orders).current().select(*ORDER_OUT)


def _stream_counts(spark, sf, name, **options):
    root = _replay(spark, sf, name, lambda st, r, ck: sjobs.start_counts(
        sjobs.count_stream(sjobs.decode_stream(st), 30, **options), f"{r}/counts", ck,
        trigger={"availableNow": True}), close_windows=True)
    return spark.read.parquet(f"{root}/counts/*")


def q_stream_counts(spark, sf):
    return _stream_counts(spark, sf, "stream-counts")


def q_stream_event_time_counts(spark, sf):
    return _stream_counts(spark, sf, "stream-et-counts", ts_col="timestamp", watermark="5 seconds")


def _raw_archive(spark, sf):
    start = lambda st, r, ck: sjobs.start_raw_archive(st, f"{r}/raw", ck, trigger={"availableNow": True})
    root = _replay(spark, sf, "stream-raw", start)
    # one more run on the same checkpoint with no new input: nothing re-emitted
    sjobs.run_available(start(read_event_stream(spark, "files", f"{root}/source"), root, f"{root}/checkpoint"))
    return f"{root}/raw"


def q_stream_raw_archive(spark, sf):
    archive = spark.read.parquet(_raw_archive(spark, sf)).withColumn("partition_key", key_from_path(F.col("_metadata.file_path")))
    return decode_wire(archive.select("value", "arrival_ts", "arrival_seq", "partition_key"))


def q_replay_from_raw(spark, sf):
    """The stored raw lines through the engine again."""
    wire = read_raw_archive(spark, _raw_archive(spark, sf))
    return process_events(sjobs.decode_stream(wire)).select(*ROUTE_COLS)


def q_reconcile_stored(spark, sf):
    """Stored raw lines against stored outputs, per arrival hour."""
    raw = read_raw_archive(spark, _raw_archive(spark, sf))
    out = validation.read_fanout(spark, f"{_validated(spark, sf, 'reconcile')}/out")
    return analytics.reconcile(raw, {r: out.where(F.col("route") == r) for r in ("valid", "invalid", "duplicate", "quarantine")})


def q_stream_validate_keyed(spark, sf):
    """Validation in Spark's state store, a restart per slice."""
    root = _replay(spark, sf, "stream-keyed", lambda st, r, ck: keyed.start_keyed_validation(
        st, f"{r}/out", ck, trigger={"availableNow": True}))
    return spark.read.parquet(f"{root}/out").select(*ROUTE_COLS)


def q_stream_running_totals(spark, sf):
    """Totals of closed windows, carried over a restart per slice."""
    root = _replay(spark, sf, "stream-totals", lambda st, r, ck: windows.start_running_totals(
        sjobs.count_stream(sjobs.decode_stream(st), 30), f"{r}/totals", ck, trigger={"availableNow": True}), close_windows=True)
    return spark.read.parquet(f"{root}/totals")


def q_stream_late_events(spark, sf):
    """Counts per event-time window, and the rows that came too late for theirs."""
    root = _replay(spark, sf, "stream-late", lambda st, r, ck: windows.start_counts_with_late(
        sjobs.decode_stream(st), f"{r}/counts", ck, trigger={"availableNow": True}), close_windows=True)
    counted = windows.read_counts(spark, f"{root}/counts").select(
        F.lit("counted").alias("kind"), "window_start", "event_type", "n", F.lit(None).cast("long").alias("arrival_seq"))
    late = windows.read_late(spark, f"{root}/counts").select(
        "kind", "window_start", "event_type", F.lit(1).cast("long").alias("n"), "arrival_seq")
    return counted.unionByName(late)


def q_stream_clean_source(spark, sf):
    """The raw archive from a source that moves the files it has read: a
    restart reads what is new, and all lines are archived once."""
    root = _replay(spark, sf, "stream-clean", lambda st, r, ck: sjobs.start_raw_archive(
        st, f"{r}/raw", ck, trigger={"availableNow": True}), archive=True)
    assert list_files(spark, f"{root}/done").where(F.col("file_path").endswith(".parquet")).count() > 0
    archive = spark.read.parquet(f"{root}/raw").withColumn("partition_key", key_from_path(F.col("_metadata.file_path")))
    return decode_wire(archive.select("value", "arrival_ts", "arrival_seq", "partition_key"))


def q_replay_from_point(spark, sf):
    """The last slice of the raw archive once more, from the states as of its
    start, beside what the first run had stored before it."""
    root = scratch_path(spark, "replay-from")
    wire = clickstream_wire(table(spark, sf, "events"))
    with_partition_columns(wire).repartitionByRange("arrival_ts").write.partitionBy(*PARTITION_COLS).parquet(f"{root}/raw")
    first = _routed_once(spark, sf)
    start = arrival_slice(wire).where(F.col("slice") == SLICES - 1).agg(F.min("arrival_ts")).first()[0]
    again = replay.replay_from(sjobs.decode_stream(read_raw_archive(spark, f"{root}/raw", start)), first, start)
    return first.where(F.col("arrival_ts") < F.lit(start)).select(*ROUTE_COLS).unionByName(again.select(*ROUTE_COLS))


SWAPPED_EVERY = 997  # rows whose stored copy is another one


def q_reconcile_content(spark, sf):
    """Stored routes against the raw events, by content: here and there a
    stored row has been exchanged, which counts cannot tell."""
    raw = clickstream_events(spark, sf)
    swapped = F.pmod("arrival_seq", F.lit(SWAPPED_EVERY)) == 0
    stored = _routed_once(spark, sf).withColumn("customer_id", F.when(swapped, F.lit("C-other")).otherwise(F.col("customer_id")))
    return fingerprint.reconcile_content(raw, stored)


def q_validate_incremental_indexed(spark, sf):
    """Arrival slices one after another; each finds its orders' long-term state
    and its ids' last sightings in tables indexed by key."""
    root = scratch_path(spark, "state")
    ranks = StateTable(spark, f"{root}/ranks", ["order_id"], "prior_rank", "int")
    seen = StateTable(spark, f"{root}/seen", ["order_id", "event_id"], "last_seen_ts", "timestamp_ntz")
    events = materialize(arrival_slice(clickstream_events(spark, sf)), "incremental")
    out = None
    for k in range(SLICES):
        part = events.where(F.col("slice") == k)
        done = materialize(process_events(part, "drop", prior=ranks.lookup(part.select("order_id"), k),
                                          prior_seen=seen.lookup(part.select("order_id", "event_id"), k)), "indexed-slice")
        ranks.append(prior_state(done), k)
        seen.append(done.where(F.col("event_id").isNotNull()).withColumn("last_seen_ts", F.col("arrival_ts")), k)
        ranks.compact(k, min_files=2)
        out = done if out is None else out.unionByName(done)
    return out.select(*ROUTE_COLS)


def q_load_then_compact(spark, sf):
    """Two loads of small files, merged into one load of sized files."""
    r = _routed_once(spark, sf)
    wh, landing = _setup(spark, "compact")
    for first in (True, False):
        _write_slice(r, landing, first=first)
        for ds in DATASETS:
            loader.load(spark, wh, landing[ds], ds)
    for ds in DATASETS:
        compaction.compact_loads(spark, wh, ds)
        assert loader.load(spark, wh, landing[ds], ds)["files"] == 0   # still known as loaded
    out = wh.events("valid").withColumn("dataset", F.lit("valid")).unionByName(wh.events("invalid").withColumn("dataset", F.lit("invalid")))
    return out.select("dataset", *EVENT_OUT)


def _tables(spark, name):
    where = scratch_path(spark, name)
    tables = Tables(spark, "ordwise_" + where.rsplit("-", 1)[1], where)
    tables.create_tables()
    return tables


def q_orders_upsert_bucketed(spark, sf):
    """Two increments merged into the bucketed table of the catalog."""
    tables, ev = _tables(spark, "orders-tables"), order_lineitem_events(spark, sf)
    tables.upsert_orders(ev.where(F.col("event_type").isin(SLICE1_TYPES)))
    tables.upsert_orders(ev.where(~F.col("event_type").isin(SLICE1_TYPES)))
    return tables.orders().select(*ORDER_OUT)


def q_sql_invalid_events_of_a_day(spark, sf):
    """Analyst SQL on the stored, partitioned table: only the day's folders are read."""
    tables = _tables(spark, "event-tables")
    tables.insert_events("invalid_order_events", routed(spark, sf).where(F.col("route") == "invalid"))
    return spark.sql(f"""SELECT event_id, order_id, event_type, timestamp, hr, partition_key
        FROM {tables.name('invalid_order_events')} WHERE dt = (SELECT max(dt) FROM {tables.name('invalid_order_events')})
        ORDER BY timestamp DESC""")


def _shipped(fn):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: _shipped(fn) for name, fn in globals().items()
            if name.startswith("q_") and callable(fn)}
