"""Exactly-once batch load of archived hour partitions into event tables.

One job per run, for all new files at once:

1. *Discover* every file under the landing root (metadata only).
2. *Gate*: a partition is ready when it holds at least one non-empty
   ``.csv`` file and nothing else (an in-progress, temporary or empty file
   blocks it). Checksum files and ``_SUCCESS`` markers are ignored.
3. *Pending*: files of ready partitions ``(path, length, mtime)`` that the
   tracker has not recorded (a ``left_anti`` join). A file that lands in an
   hour which was loaded, or loaded and promoted, is loaded alone.
4. *Load*: one multi-file CSV scan of the pending files. An hour with a line
   that is too short or long, a bad number or a bad timestamp fails alone:
   it is reported and retried in the next run. Rows without an order id go to
   the quarantine table. All other rows are appended under
   ``load_id=<id>/dt=/hr=``, a folder of this run's own.
5. *Upsert* the latest state per order (``plans.orders_store``).
6. *Commit*: the tracker rows, which name the ``load_id``, are written last in
   one file. Readers see committed loads only, so a run that dies before this
   point leaves nothing visible, and undoing a load removes its folder and no
   other row. The orders upsert before it is idempotent.
7. Optionally *promote* loaded files from the landing root to a loaded root.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codec import EVENT_COLUMNS, RAW_CSV_SCHEMA, clean_staging
from ..sources.files import delete_path, list_files, move_files, path_exists
from .archive import PARTITION_COLS, key_from_path
from .orders_store import OrdersStore

TRACKER_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("mtime", T.LongType()),
    T.StructField("partition_key", T.StringType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()),
])

EVENT_TABLE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("partition_key", T.StringType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("dt", T.StringType()),
    T.StructField("hr", T.StringType()),
])

IGNORED_SUFFIXES = (".crc",)
IGNORED_NAMES = ("_SUCCESS",)


def _name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


@dataclass
class Warehouse:
    """Locations of the event tables, the tracker and the orders store."""
    spark: SparkSession
    root: str
    tables: dict = field(default_factory=lambda: {"valid": "order_events",
                                                  "invalid": "invalid_order_events",
                                                  "quarantine": "quarantined_order_events"})

    def table_path(self, dataset: str) -> str:
        return f"{self.root.rstrip('/')}/{self.tables[dataset]}"

    @property
    def tracker_path(self) -> str:
        return f"{self.root.rstrip('/')}/load_tracker"

    @property
    def orders(self) -> OrdersStore:
        return OrdersStore(self.spark, f"{self.root.rstrip('/')}/orders")

    def setup(self) -> None:
        """Create empty tables when absent."""
        if not path_exists(self.spark, self.tracker_path):
            self.spark.createDataFrame([], TRACKER_SCHEMA).write.parquet(self.tracker_path)
        for ds in self.tables:
            p = self.table_path(ds)
            if not path_exists(self.spark, p):
                (self.spark.createDataFrame([], EVENT_TABLE_SCHEMA)
                 .write.partitionBy("load_id", *PARTITION_COLS).parquet(p))

    def tracker(self) -> DataFrame:
        """Rows of the loads that count: committed and not undone."""
        log = self.spark.read.schema(TRACKER_SCHEMA).parquet(self.tracker_path)
        undone = log.where("status = 'UNDONE'").select("load_id").distinct()
        return log.where("status = 'SUCCESS'").join(undone, "load_id", "left_anti").select(*TRACKER_SCHEMA.names)

    def events(self, dataset: str = "valid") -> DataFrame:
        """Rows of committed loads."""
        rows = self.spark.read.schema(EVENT_TABLE_SCHEMA).parquet(self.table_path(dataset))
        return rows.join(self.tracker().select("load_id").distinct(), "load_id", "left_semi").select(*EVENT_TABLE_SCHEMA.names)


def discover(spark: SparkSession, landing_root: str, dataset: str) -> DataFrame:
    """Listing of a landing root with the gate flags per file."""
    files = list_files(spark, landing_root)
    name = _name(F.col("file_path"))
    ignored = name.isin(*IGNORED_NAMES)
    for suf in IGNORED_SUFFIXES:
        ignored = ignored | name.endswith(suf)
    return (files.where(~ignored)
            .withColumn("dataset", F.lit(dataset))
            .withColumn("partition_key", key_from_path(F.col("file_path")))
            .withColumn("partition_path", F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1))
            .where(F.col("partition_key").isNotNull())
            .withColumn("loadable", name.endswith(".csv") & (F.col("length") > 0)))


def partition_status(files: DataFrame) -> DataFrame:
    """Per hour partition: file counts and the completeness gate. An hour may
    span several folders (e.g. one per streaming micro-batch); it is ready
    only when all of them are."""
    return files.groupBy("dataset", "partition_key").agg(
        F.countDistinct("partition_path").alias("n_folders"),
        F.count(F.lit(1)).alias("n_files"),
        F.count_if(F.col("loadable")).alias("n_loadable"),
        (F.bool_and("loadable") & (F.count_if(F.col("loadable")) > 0)).alias("ready"))


def pending_files(files: DataFrame, tracker: DataFrame) -> DataFrame:
    """Loadable files of ready partitions that the tracker has not seen."""
    ready = partition_status(files).where("ready").select("dataset", "partition_key")
    return (files.where("loadable").join(ready, ["dataset", "partition_key"], "left_semi")
            .join(tracker.select("dataset", "file_path", "length", "mtime"),
                  ["dataset", "file_path", "length", "mtime"], "left_anti"))


def pending_partitions(files: DataFrame, tracker: DataFrame) -> DataFrame:
    """Ready partitions with at least one file the tracker has not seen."""
    new = pending_files(files, tracker).select("dataset", "partition_key").distinct()
    return partition_status(files).join(new, ["dataset", "partition_key"], "left_semi")


def _nonblank(c: Column) -> Column:
    return F.coalesce(F.trim(c) != "", F.lit(False))


def read_landed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw CSV rows of landed files with ``partition_key`` and ``bad_line``:
    a line with too few or too many fields, or with text where a number or a
    timestamp belongs."""
    raw = (spark.read.schema(f"{RAW_CSV_SCHEMA}, _corrupt string").option("header", "false")
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").csv(paths)
           .withColumn("partition_key", key_from_path(F.col("_metadata.file_path"))))
    typed = clean_staging(raw.select("*", *(F.col(c).alias(f"_raw_{c}") for c in ("quantity", "price", "timestamp"))), strict=False)
    bad = F.col("_corrupt").isNotNull()
    for c in ("quantity", "price", "timestamp"):
        bad = bad | (_nonblank(F.col(f"_raw_{c}")) & F.col(c).isNull())
    return typed.withColumn("bad_line", bad).select(*EVENT_COLUMNS, "partition_key", "bad_line")


def load(spark: SparkSession, wh: Warehouse, landing_root: str, dataset: str,
         update_orders: bool | None = None, now: Column | None = None,
         promote_to: str | None = None) -> dict:
    """Load every pending file of ``landing_root`` into the event table of
    ``dataset`` (``valid`` or ``invalid``). Returns a summary with the
    ``load_id`` (None when nothing was loaded)."""
    wh.setup()
    files = discover(spark, landing_root, dataset)
    pending = pending_files(files, wh.tracker().where(F.col("dataset") == dataset)).persist()
    # the driver listed these files; only the paths of the pending ones are
    # handed to the CSV reader
    pending_rows = pending.select("file_path", "partition_key").collect()
    summary = {"dataset": dataset, "load_id": None, "partitions": 0, "files": len(pending_rows), "failed": []}
    if not pending_rows:
        return summary

    # The increment is scanned for bad lines, the table write and the orders
    # merge: keep it for the duration of this load (memory, spilling to disk).
    rows = read_landed(spark, [r.file_path for r in pending_rows]).persist(StorageLevel.MEMORY_AND_DISK)
    load_id = uuid.uuid4().hex[:16]
    try:
        # one row per hour of the run
        failed = sorted(r.partition_key for r in rows.where("bad_line").select("partition_key").distinct().collect())
        summary["failed"] = failed
        done = sorted({r.partition_key for r in pending_rows} - set(failed))
        if not done:
            return summary
        hours = spark.createDataFrame([(k,) for k in failed], "partition_key string")
        good = rows.join(hours, "partition_key", "left_anti") if failed else rows
        typed = good.select(
            *EVENT_COLUMNS, "partition_key",
            F.concat(F.substring("partition_key", 1, 7), F.lit("-"),
                     F.substring("partition_key", 9, 2)).alias("dt"),
            F.substring("partition_key", 12, 2).alias("hr"))
        keyed = F.col("order_id").isNotNull()
        for part, where in ((dataset, keyed), ("quarantine", ~keyed)):
            typed.where(where).write.partitionBy(*PARTITION_COLS).parquet(f"{wh.table_path(part)}/load_id={load_id}")
        if update_orders if update_orders is not None else dataset == "valid":
            wh.orders.upsert(typed.drop("partition_key", *PARTITION_COLS), now)

        # Commit point: tracker rows for the loaded files, in one file.
        loaded = pending.join(hours, "partition_key", "left_anti") if failed else pending
        (loaded.select("dataset", "file_path", "length", "mtime", "partition_key", F.lit(load_id).alias("load_id"),
                       F.lit("SUCCESS").alias("status"), F.current_timestamp().alias("loaded_at"))
         .coalesce(1).write.mode("append").parquet(wh.tracker_path))
        summary |= {"partitions": len(done), "load_id": load_id}
        if promote_to:
            skip = set(failed)
            promote(spark, [r.file_path for r in pending_rows if r.partition_key not in skip], landing_root, promote_to)
    except Exception:
        for part in (dataset, "quarantine"):
            if load_id not in {r.load_id for r in wh.tracker().select("load_id").distinct().collect()}:
                delete_path(spark, f"{wh.table_path(part)}/load_id={load_id}")
        raise
    finally:
        rows.unpersist()
        pending.unpersist()
    return summary


def undo_load(spark: SparkSession, wh: Warehouse, load_id: str) -> None:
    """Take back one load's event rows: recorded first, then its folders go.
    Rows of other loads, in the same hours too, stay. Its files are pending
    again wherever they are found. ``orders`` keeps what it learnt."""
    gone = wh.tracker().where(F.col("load_id") == load_id).withColumn("status", F.lit("UNDONE"))
    gone.coalesce(1).write.mode("append").parquet(wh.tracker_path)
    for dataset in wh.tables:
        delete_path(spark, f"{wh.table_path(dataset)}/load_id={load_id}")


def promote(spark: SparkSession, paths: list[str], landing_root: str, loaded_root: str) -> int:
    """Move loaded files from the landing root to the loaded root, keeping
    their relative paths (metadata operations)."""
    src_root = landing_root.rstrip("/")
    moves = []
    for p in paths:
        if src_root not in p:
            raise ValueError(f"{p} is not below {landing_root}")
        moves.append((p, loaded_root.rstrip("/") + p[p.find(src_root) + len(src_root):]))
    return move_files(spark, moves)
