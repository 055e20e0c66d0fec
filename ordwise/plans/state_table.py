"""Long-term state that is found by key.

State rows lie in hash buckets (``bucket=<k>/``, plain parquet folders), sorted
by their key, with parquet bloom filters on it. A batch reads the folders of
its own keys' buckets only; with few keys these are pushed to the scan as well,
where sorted row groups and bloom filters leave out what cannot hold them.

Values merge by maximum and every row carries the number of the batch that
wrote it. That makes the table safe without a commit log: appending a batch
again changes nothing, a batch reads rows of earlier batches only and so never
its own first attempt, and compaction first appends merged rows and then
deletes the files it has merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import delete_path, list_files, path_exists

DEFAULT_BUCKETS = 64
#: Up to so many keys are pushed to the scan by value.
PUSHED_KEYS = 500
#: Distinct keys that a bloom filter of a file is sized for.
BLOOM_KEYS = 1_000_000


class StateTable:
    """``keys`` are strings; ``value`` is one comparable column (a struct
    compares field by field), of which the greatest per key holds."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], value: str, value_type: str,
                 buckets: int = DEFAULT_BUCKETS):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.value, self.value_type, self.buckets = value, value_type, buckets

    @property
    def schema(self) -> T.StructType:
        keys = ", ".join(f"{k} string" for k in self.keys)
        return T.StructType.fromDDL(f"{keys}, {self.value} {self.value_type}, batch_id long")

    def bucket(self) -> Column:
        return F.pmod(F.crc32(F.col(self.keys[0]).cast("binary")), F.lit(self.buckets)).cast("int")

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema).drop("batch_id")

    def append(self, changes: DataFrame, batch_id: int) -> None:
        """Add a batch's values: one row per key, whatever rows it has of it."""
        rows = (changes.where(F.col(self.keys[0]).isNotNull()).groupBy(*self.keys)
                .agg(F.max(F.col(self.value).cast(self.value_type)).alias(self.value))
                .withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("bucket", self.bucket()))
        # a bucket goes to few tasks and a large one to several
        self._write(rows.repartition("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(4))))

    def _write(self, rows: DataFrame) -> None:
        (rows.sortWithinPartitions("bucket", *self.keys).write.mode("append").partitionBy("bucket")
         .option(f"parquet.bloom.filter.enabled#{self.keys[0]}", "true")
         .option(f"parquet.bloom.filter.expected.ndv#{self.keys[0]}", str(BLOOM_KEYS))
         .option("parquet.bloom.filter.adaptive.enabled", "true").parquet(self.root))

    def lookup(self, wanted: DataFrame, before_batch: int) -> DataFrame:
        """``keys, value`` of the keys in ``wanted`` (its columns are the first
        key or more of them) as of the batches before ``before_batch``."""
        on = [k for k in self.keys if k in wanted.columns]
        wanted = wanted.select(*on).where(F.col(on[0]).isNotNull()).distinct()
        # at most one row per bucket, and a bounded number of keys, reach the driver
        touched = sorted(r[0] for r in wanted.select(self.bucket().alias("b")).distinct().collect())
        paths = [p for b in touched if path_exists(self.spark, p := f"{self.root}/bucket={b}")]
        if not paths:
            return self._empty()
        stored = self.spark.read.schema(self.schema).parquet(*paths).where(F.col("batch_id") < before_batch)
        few = wanted.select(on[0]).distinct().limit(PUSHED_KEYS + 1).collect()
        if len(few) <= PUSHED_KEYS:
            stored = stored.where(F.col(on[0]).isin([r[0] for r in few]))
        return (stored.join(wanted, on, "left_semi").groupBy(*self.keys).agg(F.max(self.value).alias(self.value)))

    def compact(self, before_batch: int, live: Column | None = None, min_files: int = 8) -> int:
        """Merge the rows of batches before ``before_batch`` in buckets of
        ``min_files`` files or more, leaving out values that are not ``live``.
        Returns the number of buckets."""
        files = list_files(self.spark, self.root).where(F.col("file_path").endswith(".parquet"))
        files = files.withColumn("bucket", F.regexp_extract("file_path", r"/bucket=(\d+)/", 1))
        # one row per bucket
        full = [r["bucket"] for r in files.groupBy("bucket").count().where(F.col("count") >= min_files).collect()]
        for b in full:
            folder = f"{self.root}/bucket={b}"
            old = [r["file_path"] for r in list_files(self.spark, folder).where(F.col("file_path").endswith(".parquet")).collect()]
            rows = self.spark.read.schema(self.schema).parquet(*old)
            if rows.where(F.col("batch_id") >= before_batch).limit(1).count():
                continue  # a batch that may run again has rows here
            merged = rows.groupBy(*self.keys).agg(F.max(self.value).alias(self.value), F.max("batch_id").alias("batch_id"))
            if live is not None:
                merged = merged.where(live)
            self._write(merged.withColumn("bucket", F.lit(int(b))).repartitionByRange(*self.keys))
            for path in old:
                delete_path(self.spark, path)
        return len(full)
