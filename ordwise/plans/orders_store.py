"""The ``orders`` table: hash buckets sorted by order id, behind a manifest.

A commit rewrites only the buckets its increment touches, into a folder of its
own attempt, and then publishes a manifest that names a folder per bucket. A
manifest appears by one rename and never changes, so readers see whole
versions, an unfinished attempt is never seen and never blocks a retry, and of
two writers that take the same version number one fails. Folders that no kept
manifest names are removed.
"""

from __future__ import annotations

import json
import uuid
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import ORDERS_SCHEMA, empty_orders, merge_orders
from ..sources.files import delete_path, list_dirs, list_names, read_text, rename_new, write_text

DEFAULT_BUCKETS = 16
KEEP_VERSIONS = 2


class OrdersStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def versions(self) -> list[int]:
        return sorted(int(n[1:]) for n in list_names(self.spark, f"{self.root}/manifests") if n.startswith("v"))

    def _manifest(self, version: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.root}/manifests/v{version:08d}"))

    def manifest(self) -> dict:
        """``{"buckets": n, "folders": {bucket: folder}}`` of the newest version."""
        v = self.versions()
        return self._manifest(v[-1]) if v else {"buckets": self.buckets, "folders": {}}

    @staticmethod
    def bucket_of(order_id: Column, buckets: int) -> Column:
        return (F.crc32(order_id.cast("binary")) % F.lit(buckets)).cast("int")

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return empty_orders(self.spark)
        return self.spark.read.schema(ORDERS_SCHEMA).parquet(*(f"{self.root}/data/{f}" for f in folders))

    def current(self) -> DataFrame:
        return self._read(sorted(self.manifest()["folders"].values()))

    def lookup(self, order_id: str) -> DataFrame:
        """One order: reads one bucket, sorted by the id the filter is pushed on."""
        m = self.manifest()
        folder = m["folders"].get(str(zlib.crc32(order_id.encode()) % m["buckets"]))
        return self._read([folder] if folder else []).where(F.col("order_id") == F.lit(order_id))

    def upsert(self, events: DataFrame, now: Column | None = None) -> int:
        """Merge an event increment; returns the version. Merging the same
        increment again changes no row. Events without an order are left out."""
        m = self.manifest()
        n, folders = m["buckets"], dict(m["folders"])
        bucket = self.bucket_of(F.col("order_id"), n)
        keyed = events.where(F.col("order_id").isNotNull())
        # at most one row per bucket
        touched = [r[0] for r in keyed.select(bucket.alias("b")).distinct().collect()]
        if not touched:
            return (self.versions() or [0])[-1]
        stored = self._read(sorted(folders[str(b)] for b in touched if str(b) in folders))
        attempt = f"attempt-{uuid.uuid4().hex[:12]}"
        (merge_orders(stored, keyed, now).withColumn("bucket", bucket)
         .repartition(len(touched), "bucket").sortWithinPartitions("bucket", "order_id")
         .select(*ORDERS_SCHEMA.names, "bucket")
         .write.partitionBy("bucket").parquet(f"{self.root}/data/{attempt}"))
        folders |= {str(b): f"{attempt}/bucket={b}" for b in touched}
        version = (self.versions() or [0])[-1] + 1
        tmp = f"{self.root}/manifests/.tmp-{attempt}"
        write_text(self.spark, tmp, json.dumps({"buckets": n, "folders": folders}))
        if not rename_new(self.spark, tmp, f"{self.root}/manifests/v{version:08d}"):
            raise RuntimeError(f"another writer published version {version}")
        self._clean()
        return version

    def _clean(self) -> None:
        """Drop old manifests and the bucket folders no kept one names."""
        versions = self.versions()
        for v in versions[:-KEEP_VERSIONS]:
            delete_path(self.spark, f"{self.root}/manifests/v{v:08d}")
        named = {f for v in versions[-KEEP_VERSIONS:] for f in self._manifest(v)["folders"].values()}
        newest = max((int(v) for v in versions), default=0)
        if newest % 8:  # every eighth version: listing the folders costs a call each
            return
        for attempt in list_dirs(self.spark, f"{self.root}/data"):
            for b in list_dirs(self.spark, f"{self.root}/data/{attempt}"):
                if b.startswith("bucket=") and f"{attempt}/{b}" not in named:
                    delete_path(self.spark, f"{self.root}/data/{attempt}/{b}")
