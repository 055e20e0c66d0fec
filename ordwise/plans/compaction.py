"""Files of a wanted size.

``sized`` lets Spark's rebalance step cut an output into partitions of about
the bytes a file should have: an hour with little is one file, a busy hour is
cut into several, whatever number of tasks made its rows.

``compact_loads`` takes loads whose files are small on average, found from the
listing alone, writes their rows together as one new load and swaps it in by
one tracker file: it retires the old loads and names the new one in the same
write. Until then readers see the old loads, from then on the new one, and a
run that dies before it leaves nothing visible.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import delete_path, list_files, path_exists
from .archive import PARTITION_COLS
from .loader import EVENT_TABLE_SCHEMA, TRACKER_SCHEMA, Warehouse

TARGET_BYTES = 128 << 20
#: Bytes of shuffled rows that make a byte of parquet, about.
SHUFFLE_RATIO = 3.0


@contextmanager
def sized_partitions(spark: SparkSession, target_bytes: int, ratio: float = SHUFFLE_RATIO):
    """Rebalanced partitions hold about what a file of ``target_bytes`` needs."""
    wanted = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(target_bytes * ratio)),
              "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_sized(df: DataFrame, path: str, target_bytes: int = TARGET_BYTES, partition_by: tuple[str, ...] = tuple(PARTITION_COLS),
                mode: str = "append", ratio: float = SHUFFLE_RATIO) -> None:
    """Write parquet under ``partition_by`` folders in files of about
    ``target_bytes`` (less where a folder has less)."""
    with sized_partitions(df.sparkSession, target_bytes, ratio):
        df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def small_loads(spark: SparkSession, wh: Warehouse, dataset: str, small_bytes: int) -> DataFrame:
    """``load_id, n_files, bytes`` of the committed loads whose data files have
    less than ``small_bytes`` on average: a listing, no data is read."""
    files = list_files(spark, wh.table_path(dataset)).where(F.col("file_path").endswith(".parquet"))
    files = files.withColumn("load_id", F.regexp_extract("file_path", r"/load_id=([^/]+)/", 1))
    sizes = files.groupBy("load_id").agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))
    known = wh.tracker().where(F.col("dataset") == dataset).select("load_id").distinct()
    return sizes.join(known, "load_id", "left_semi").where(F.col("bytes") < F.col("n_files") * small_bytes)


def compact_loads(spark: SparkSession, wh: Warehouse, dataset: str, target_bytes: int = TARGET_BYTES,
                  small_bytes: int | None = None, ratio: float = SHUFFLE_RATIO) -> str | None:
    """Merge the small loads of a dataset; returns the new ``load_id`` (None if
    fewer than two are small). Their rows in the quarantine table go along."""
    # one row per small load
    old = sorted(r["load_id"] for r in small_loads(spark, wh, dataset, small_bytes or target_bytes // 2).collect())
    if len(old) < 2:
        return None
    new, folders = uuid.uuid4().hex[:16], {}
    for part in (dataset, "quarantine"):
        base = wh.table_path(part)
        folders[base] = [p for i in old if path_exists(spark, p := f"{base}/load_id={i}")]
        if folders[base]:
            rows = spark.read.schema(EVENT_TABLE_SCHEMA).option("basePath", base).parquet(*folders[base])
            write_sized(rows.drop("load_id"), f"{base}/load_id={new}", target_bytes, ratio=ratio)
    kept = wh.tracker().where((F.col("dataset") == dataset) & F.col("load_id").isin(old))
    retired = kept.withColumn("status", F.lit("UNDONE"))
    named = kept.withColumn("load_id", F.lit(new))
    (retired.unionByName(named).select(*TRACKER_SCHEMA.names)
     .coalesce(1).write.mode("append").parquet(wh.tracker_path))
    for path in (p for paths in folders.values() for p in paths):
        delete_path(spark, path)
    return new
