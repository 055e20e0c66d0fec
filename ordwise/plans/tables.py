"""The warehouse as tables of the session catalog.

``create_tables`` declares the five tables by DDL, below one location: event
tables partitioned by hour, so that SQL on ``dt`` and ``hr`` reads those folders
only, and ``orders`` clustered and sorted by order id. With a shared metastore
they outlive the session; the in-memory catalog of tests holds them as long as
it lives.

``upsert_orders`` joins an increment with the bucketed table: the stored side is
read bucket by bucket without an exchange, the increment is exchanged once,
after its partial aggregation. Every merge writes a new bucketed table, and the
view ``orders`` then names it: readers see one whole version or the next.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import EVENT_COLUMNS
from ..operators.upsert import ORDERS_SCHEMA, merge_orders
from .archive import PARTITION_COLS, with_partition_columns

DEFAULT_BUCKETS = 16
KEEP_VERSIONS = 2

_EVENTS = ("event_id STRING, order_id STRING, event_type STRING, timestamp TIMESTAMP_NTZ, customer_id STRING, "
           "product_id STRING, quantity INT, price DOUBLE, partition_key STRING, dt STRING, hr STRING")
_ORDERS = ("order_id STRING, latest_event_id STRING, order_status STRING, latest_event_time TIMESTAMP_NTZ, customer_id STRING, "
           "product_id STRING, quantity INT, price DECIMAL(10,2), updated_at TIMESTAMP")
_TRACKER = "partition_path STRING, dataset STRING, status STRING, loaded_at TIMESTAMP"


class Tables:
    def __init__(self, spark: SparkSession, database: str, location: str, buckets: int = DEFAULT_BUCKETS):
        self.spark, self.database, self.location, self.buckets = spark, database, location.rstrip("/"), buckets

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def create_tables(self) -> None:
        """Declare what is absent; calling it again changes nothing."""
        run, at = self.spark.sql, self.location
        run(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{at}'")
        for t in ("order_events", "invalid_order_events"):
            run(f"CREATE TABLE IF NOT EXISTS {self.name(t)} ({_EVENTS}) USING parquet PARTITIONED BY (dt, hr) LOCATION '{at}/{t}'")
        run(f"CREATE TABLE IF NOT EXISTS {self.name('load_tracker')} ({_TRACKER}) USING parquet LOCATION '{at}/load_tracker'")
        if not self._versions():
            self._create_orders(0)
            self._show(0)

    def _create_orders(self, version: int) -> str:
        table = self.name(f"orders_v{version}")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ORDERS}) USING parquet CLUSTERED BY (order_id) SORTED BY (order_id) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.location}/orders_v{version}'")
        return table

    def _show(self, version: int) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name('orders')} AS SELECT * FROM {self.name(f'orders_v{version}')}")

    def _versions(self) -> list[int]:
        rows = self.spark.sql(f"SHOW TABLES IN {self.database} LIKE 'orders_v*'").collect()
        return sorted(int(r["tableName"].removeprefix("orders_v")) for r in rows)

    def insert_events(self, table: str, routed: DataFrame) -> None:
        """Append routed events to an event table, hour by hour."""
        rows = with_partition_columns(routed).withColumn("partition_key", F.date_format("arrival_ts", "yyyy-MM/dd/HH"))
        (rows.repartitionByRange("arrival_ts").select(*EVENT_COLUMNS, "partition_key", *PARTITION_COLS)
         .write.mode("append").insertInto(self.name(table)))

    def orders(self) -> DataFrame:
        return self.spark.table(self.name("orders"))

    def merged_orders(self, events: DataFrame, now: Column | None = None) -> DataFrame:
        """The stored orders with an increment merged in, as a plan."""
        return merge_orders(self.spark.table(self.name(f"orders_v{self._versions()[-1]}")), events, now)

    def upsert_orders(self, events: DataFrame, now: Column | None = None) -> int:
        """Merge an event increment into ``orders``; returns the version."""
        version = self._versions()[-1] + 1
        with aligned_shuffles(self.spark, self.buckets):
            merged = self.merged_orders(events, now).select(*ORDERS_SCHEMA.names)
            table = self._create_orders(version)
            merged.write.mode("append").insertInto(table)
        self._show(version)
        for old in self._versions()[:-KEEP_VERSIONS]:
            self.spark.sql(f"DROP TABLE {self.name(f'orders_v{old}')}")
            from ..sources.files import delete_path
            delete_path(self.spark, f"{self.location}/orders_v{old}")
        return version


@contextmanager
def aligned_shuffles(spark: SparkSession, partitions: int):
    """Exchanges go to as many partitions as a bucketed table has buckets, so
    that joining it needs no exchange of the table."""
    wanted = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.sources.bucketing.enabled": "true",
              "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
