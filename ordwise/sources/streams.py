"""Event sources for batch and streaming.

Every source yields wire records ``(value string, arrival_ts timestamp_ntz,
arrival_seq long)``: the raw JSON text plus a total arrival order.

* ``files``: parquet files holding those three columns (what tests use, and
  the replayable form of the raw archive, see ``plans.archive``).
* ``kafka``: topic ``order_events``; ``timestamp`` gives ``arrival_ts`` and
  ``(partition, offset)`` gives ``arrival_seq`` (needs the Kafka connector
  on the classpath, which this environment does not ship).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIRE_FILE_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("arrival_ts", T.TimestampNTZType()),
    T.StructField("arrival_seq", T.LongType()),
])

KAFKA_TOPIC = "order_events"
PARTITION_BITS = 40  # arrival_seq = partition << 40 | offset


def read_event_stream(spark: SparkSession, kind: str = "files", path: str | None = None,
                      bootstrap_servers: str | None = None, topic: str = KAFKA_TOPIC,
                      max_files_per_trigger: int | None = None,
                      max_offsets_per_trigger: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """``archive_dir``: the source itself moves the files of a committed batch
    there (below their own path) while a later batch runs, so a long-lived
    landing folder stays short to list."""
    if kind == "files":
        r = spark.readStream.schema(WIRE_FILE_SCHEMA)
        if archive_dir:
            r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.parquet(path)
    if kind == "kafka":
        r = (spark.readStream.format("kafka")
             .option("kafka.bootstrap.servers", bootstrap_servers)
             .option("subscribe", topic)
             .option("startingOffsets", "earliest"))
        if max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        try:
            df = r.load()
        except Exception as ex:  # connector missing
            raise RuntimeError("Kafka source needs the spark-sql-kafka connector on the "
                               "classpath") from ex
        return kafka_to_wire(df)
    raise ValueError(f"unknown source kind {kind!r}")


def kafka_to_wire(df: DataFrame) -> DataFrame:
    """Kafka rows -> wire records (value only, UTF-8)."""
    return df.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").cast("timestamp_ntz").alias("arrival_ts"),
        (F.shiftleft(F.col("partition").cast("long"), PARTITION_BITS) + F.col("offset")).alias("arrival_seq"),
    )


def write_wire_files(wire: DataFrame, path: str, mode: str = "append") -> None:
    """Land wire records as parquet files, range-partitioned on arrival so
    each file covers a contiguous arrival range."""
    wire.repartitionByRange("arrival_ts", "arrival_seq").write.mode(mode).parquet(path)
