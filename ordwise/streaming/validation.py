"""Keyed stateful validation of a stream, as a ``foreachBatch`` sink.

Each micro-batch goes through the batch operators (``process_events``: one
exchange, JVM windows, hot orders split), continued from stored state:

* per order, the rank (and arrival) of its last valid event;
* per (order, event id), its last sighting.

A batch reads the state of the batches before it, writes its routed rows and
its own state changes into folders named by its number, and publishes a commit
file last. Both states merge by maximum, so changes are small append-only
tables; every ``compact_every`` batches they are merged into a base, which
drops sightings older than the dedup TTL before the newest arrival and, when
states expire, expired states: what is kept is bounded by the traffic of one
TTL (and, without state expiry, one row per order).

Exactly once: a batch that is run again sees the same earlier commits and
overwrites its own folders; readers take committed batches only. Arrival order
must not go back across batches, which a source in arrival order ensures.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.codec import EVENT_COLUMNS, ISO_FORMAT, decode_wire, with_rank
from ..operators import metrics
from ..operators.scan import DEFAULT_HOT_ROWS, detect_hot_keys
from ..operators.validate import (ROUTES, prior_expiring_state, prior_state, process_events)
from ..plans.archive import PARTITION_COLS, with_partition_columns
from ..plans.orders_store import OrdersStore
from ..sources.files import delete_path, list_names, path_exists, read_text, rename_new, write_text

RANKS = "order_id string, prior_rank int, prior_arrival_ts timestamp_ntz"
SIGHTINGS = "order_id string, event_id string, last_seen_ts timestamp_ntz"
ROUTED = ("event_id string, order_id string, event_type string, timestamp timestamp_ntz, customer_id string, "
          "product_id string, quantity int, price double, arrival_ts timestamp_ntz, arrival_seq long, malformed boolean, "
          "rk int, prev_seen_ts timestamp_ntz, is_dup boolean, quarantine_reason string, prev_rank int, "
          "batch_id long, route string, dt string, hr string")


class ValidationSink:
    """``foreachBatch`` function over wire records; ``out_root`` holds outputs,
    state and commits. ``prior`` and ``prior_seen`` are the states of earlier
    loads (see ``process_events``), used by every batch. With ``csv_root`` valid
    and invalid events also go there in the loader's CSV form, at most
    ``max_records_per_file`` rows a file; with ``orders_root`` valid events are
    merged into that orders store."""

    def __init__(self, out_root: str, on_duplicate: str = "drop", dedup_ttl_seconds: int | None = 600,
                 state_ttl_seconds: int | None = None, prior: DataFrame | None = None,
                 prior_seen: DataFrame | None = None, csv_root: str | None = None, orders_root: str | None = None,
                 max_records_per_file: int = 0, hot_rows: int = DEFAULT_HOT_ROWS, compact_every: int = 16):
        self.root, self.on_duplicate = out_root.rstrip("/"), on_duplicate
        self.dedup_ttl, self.state_ttl = dedup_ttl_seconds, state_ttl_seconds
        self.prior, self.prior_seen = prior, prior_seen
        self.csv_root, self.orders_root = csv_root, orders_root
        self.max_records, self.hot_rows, self.compact_every = max_records_per_file, hot_rows, compact_every

    def _state(self, spark: SparkSession, done: list[dict], kind: str, schema: str, first: DataFrame | None) -> DataFrame | None:
        """The stored state before a batch: latest base, then later changes."""
        base = max((c["base"] for c in done), default=-1)
        paths = [f"{self.root}/_state/base={base}/{kind}"] if base >= 0 else []
        paths += [f"{self.root}/_state/batch_id={c['batch_id']}/{kind}" for c in done if c["batch_id"] > base]
        stored = spark.read.schema(schema).parquet(*paths) if paths else None
        if first is None:
            return stored
        names = [f.split()[0] for f in schema.split(", ")]
        for n in names:
            if n not in first.columns:
                first = first.withColumn(n, F.lit(None).cast("timestamp_ntz"))
        first = first.select(*names)
        return first.unionByName(stored) if stored is not None else first

    def _write(self, df: DataFrame, path: str) -> None:
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if self.max_records:
            w = w.option("maxRecordsPerFile", self.max_records)
        return w.partitionBy(*[c for c in ("route", *PARTITION_COLS) if c in df.columns]).parquet(path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # a row without an arrival has no place in the order: quarantined, no state
        events = with_rank(decode_wire(batch)).withColumn(
            "malformed", F.col("malformed") | F.col("arrival_ts").isNull()).persist(StorageLevel.MEMORY_AND_DISK)
        routed = None
        try:
            span = events.agg(F.min("arrival_ts").alias("lo"), F.max("arrival_ts").alias("hi"), F.count(F.lit(1)).alias("n")).first()
            if not span["n"]:
                return
            done = [c for c in committed(spark, self.root) if c["batch_id"] < batch_id]
            ranks = self._state(spark, done, "ranks", RANKS, self.prior)
            seen = self._state(spark, done, "sightings", SIGHTINGS, self.prior_seen)
            if seen is not None and self.dedup_ttl is not None and span["lo"] is not None:
                seen = seen.where(F.col("last_seen_ts") > F.lit(span["lo"]).cast("timestamp_ntz")
                                  - F.make_dt_interval(secs=F.lit(self.dedup_ttl)))
            here = events.select("order_id").where(F.col("order_id").isNotNull()).distinct()
            ranks, seen = (s if s is None else s.join(here, "order_id", "left_semi") for s in (ranks, seen))
            if ranks is not None and self.state_ttl is None:
                ranks = ranks.drop("prior_arrival_ts")
            routed = process_events(
                events, self.on_duplicate, self.dedup_ttl, self.state_ttl, prior=ranks, prior_seen=seen,
                plan=detect_hot_keys(events, hot_rows=self.hot_rows)).persist(StorageLevel.MEMORY_AND_DISK)

            # contiguous arrival ranges per task: few files an hour, a busy hour over several tasks
            hourly = with_partition_columns(routed).repartitionByRange("route", "arrival_ts", "arrival_seq")
            self._write(hourly, f"{self.root}/batch_id={batch_id}")
            self._write(metrics.duplicate_counts(routed), f"{self.root}/_duplicate_counts/batch_id={batch_id}")
            if self.csv_root:
                self._write_csv(hourly, batch_id)
            if self.orders_root:
                OrdersStore(spark, self.orders_root).upsert(routed.where(F.col("route") == "valid"))
            self._save_state(spark, routed, done, batch_id, span["hi"])
        finally:
            events.unpersist()
            if routed is not None:
                routed.unpersist()

    def _write_csv(self, hourly: DataFrame, batch_id: int) -> None:
        for route in ("valid", "invalid"):
            w = (hourly.where(F.col("route") == route).select(*EVENT_COLUMNS, *PARTITION_COLS).write.mode("overwrite")
                 .option("partitionOverwriteMode", "static").partitionBy(*PARTITION_COLS)
                 .option("header", "false").option("timestampNTZFormat", ISO_FORMAT))
            if self.max_records:
                w = w.option("maxRecordsPerFile", self.max_records)
            w.csv(f"{self.csv_root.rstrip('/')}/{route}-events/batch_id={batch_id}")

    def _save_state(self, spark: SparkSession, routed: DataFrame, done: list[dict], batch_id: int, newest) -> None:
        at = f"{self.root}/_state/batch_id={batch_id}"
        last = prior_expiring_state(routed) if self.state_ttl is not None else \
            prior_state(routed).withColumn("prior_arrival_ts", F.lit(None).cast("timestamp_ntz"))
        last.write.mode("overwrite").parquet(f"{at}/ranks")
        (routed.where(F.col("order_id").isNotNull() & F.col("event_id").isNotNull() & F.col("arrival_ts").isNotNull()).groupBy("order_id", "event_id")
         .agg(F.max("arrival_ts").alias("last_seen_ts")).write.mode("overwrite").parquet(f"{at}/sightings"))
        base = max((c["base"] for c in done), default=-1)
        if batch_id - base >= self.compact_every and newest is not None:
            self._compact(spark, [*done, {"batch_id": batch_id, "base": base}], batch_id, newest)
            base = batch_id
        commit(spark, self.root, {"batch_id": batch_id, "base": base})

    def _compact(self, spark: SparkSession, done: list[dict], batch_id: int, newest) -> None:
        at, newest = f"{self.root}/_state/base={batch_id}", F.lit(newest).cast("timestamp_ntz")
        live = lambda ts, ttl: F.col(ts) > newest - F.make_dt_interval(secs=F.lit(ttl))
        ranks = self._state(spark, done, "ranks", RANKS, None)
        if self.state_ttl is None:
            ranks = ranks.groupBy("order_id").agg(F.max("prior_rank").alias("prior_rank")).withColumn(
                "prior_arrival_ts", F.lit(None).cast("timestamp_ntz"))
        else:
            ranks = ranks.where(live("prior_arrival_ts", self.state_ttl)).groupBy("order_id").agg(
                F.max(F.struct("prior_arrival_ts", "prior_rank")).alias("s")).select("order_id", "s.prior_rank", "s.prior_arrival_ts")
        seen = self._state(spark, done, "sightings", SIGHTINGS, None)
        if self.dedup_ttl is not None:
            seen = seen.where(live("last_seen_ts", self.dedup_ttl))
        seen = seen.groupBy("order_id", "event_id").agg(F.max("last_seen_ts").alias("last_seen_ts"))
        ranks.write.mode("overwrite").parquet(f"{at}/ranks")
        seen.write.mode("overwrite").parquet(f"{at}/sightings")


def commit(spark: SparkSession, root: str, record: dict) -> None:
    """Publish a batch; a batch that runs again finds its commit and keeps it."""
    name = f"{root}/_commits/{record['batch_id']:012d}"
    tmp = f"{root}/_commits/.tmp-{record['batch_id']}"
    delete_path(spark, tmp)
    write_text(spark, tmp, json.dumps(record))
    if not rename_new(spark, tmp, name):
        delete_path(spark, tmp)


def committed(spark: SparkSession, root: str) -> list[dict]:
    """Commit records in order (one small file per micro-batch)."""
    names = sorted(n for n in list_names(spark, f"{root.rstrip('/')}/_commits") if not n.startswith("."))
    return [json.loads(read_text(spark, f"{root.rstrip('/')}/_commits/{n}")) for n in names]


def start_validation(wire: DataFrame, out_root: str, checkpoint: str, trigger: dict | None = None, **options) -> StreamingQuery:
    """Start the validating sink on wire records (options: ``ValidationSink``)."""
    return (wire.writeStream.foreachBatch(ValidationSink(out_root, **options))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 minute"})).start())


def read_fanout(spark: SparkSession, out_root: str, routes=tuple(ROUTES)) -> DataFrame:
    """Routed rows of all committed batches."""
    root = out_root.rstrip("/")
    paths = [f"{root}/batch_id={c['batch_id']}" for c in committed(spark, root)]
    if not paths:
        return spark.createDataFrame([], ROUTED)
    return (spark.read.schema(ROUTED).option("basePath", root).parquet(*paths)
            .where(F.col("route").isin(*routes)))


def read_duplicate_counts(spark: SparkSession, out_root: str) -> DataFrame:
    """Per-window duplicate counts summed over committed micro-batches (a
    window can span batches, so partial counts are added)."""
    root = out_root.rstrip("/")
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, n long"
    paths = [p for c in committed(spark, root) if path_exists(spark, p := f"{root}/_duplicate_counts/batch_id={c['batch_id']}")]
    parts = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return parts.groupBy("window_start", "window_end").agg(F.sum("n").alias("n"))
