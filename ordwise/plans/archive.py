"""Date/hour archives of routed events.

Layout: ``<root>/dt=yyyy-MM-dd/hr=HH/part-*.csv`` (or ``.parquet`` / ``.txt``).
The hour comes from the arrival time (processing time upstream). A ``/``
inside a partition value would be escaped, so the reference-style key
``yyyy-MM/dd/HH`` is kept as a column and derived from ``dt``/``hr``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import EVENT_COLUMNS, ISO_FORMAT
from ..sources.streams import WIRE_FILE_SCHEMA

PARTITION_COLS = ["dt", "hr"]


def with_partition_columns(df: DataFrame, ts_col: str = "arrival_ts") -> DataFrame:
    return (df.withColumn("dt", F.date_format(ts_col, "yyyy-MM-dd"))
              .withColumn("hr", F.date_format(ts_col, "HH")))


def key_from_path(path: Column) -> Column:
    """Partition key from a file path in either layout:
    ``.../dt=2024-01-05/hr=07/...`` or ``.../2024-01/05/07/...``."""
    hive = F.regexp_extract(path, r"dt=(\d{4}-\d{2})-(\d{2})/hr=(\d{2})/", 0)
    plain = F.regexp_extract(path, r"(\d{4}-\d{2}/\d{2}/\d{2})/[^/]*$", 1)
    hive_key = F.concat(F.regexp_extract(path, r"dt=(\d{4}-\d{2})-(\d{2})/", 1), F.lit("/"),
                        F.regexp_extract(path, r"dt=(\d{4}-\d{2})-(\d{2})/", 2), F.lit("/"),
                        F.regexp_extract(path, r"hr=(\d{2})/", 1))
    return F.when(hive != "", hive_key).when(plain != "", plain)


def write_csv_archive(df: DataFrame, root: str, mode: str = "append",
                      ts_col: str = "arrival_ts", max_records_per_file: int = 0) -> None:
    """Staging-format CSV (8 columns, no header), one folder per hour.

    Rows are range-partitioned on the arrival time before the write: each
    task covers a contiguous time range, so an hour is written by few tasks
    (few files), and a hot hour is still split over several tasks.
    """
    out = with_partition_columns(df, ts_col).repartitionByRange(ts_col)
    out = out.select(*EVENT_COLUMNS, *PARTITION_COLS)
    w = (out.write.mode(mode).partitionBy(*PARTITION_COLS)
         .option("header", "false").option("timestampNTZFormat", ISO_FORMAT))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.csv(root)


def read_raw_archive(spark: SparkSession, root: str, since: dt.datetime | None = None) -> DataFrame:
    """Wire records of a raw archive, for replay; with ``since`` those that
    arrived then or later, from the folders of that day on."""
    raw = spark.read.schema(WIRE_FILE_SCHEMA).parquet(root)
    if since is not None:
        raw = raw.where((F.col("dt").cast("date") >= F.lit(since.date())) & (F.col("arrival_ts") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")))
    return raw.select(*WIRE_FILE_SCHEMA.names)
