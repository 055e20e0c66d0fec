"""Streaming jobs beside validation: raw archive and windowed counts.

Batch and streaming share the decode and metric transforms. Exactly-once:
every query has its own checkpoint; file sinks commit through their manifest,
and ``foreachBatch`` sinks write each micro-batch into its own ``batch_id=N``
folder in overwrite mode, so a retried batch replaces exactly its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.codec import decode_wire, with_rank
from ..operators import metrics
from ..plans.archive import PARTITION_COLS, with_partition_columns


def decode_stream(wire: DataFrame) -> DataFrame:
    return with_rank(decode_wire(wire))


def start_raw_archive(wire: DataFrame, root: str, checkpoint: str, fmt: str = "parquet",
                      trigger: dict | None = None,
                      max_records_per_file: int | None = None) -> StreamingQuery:
    """Every input line, unmodified, into ``dt=/hr=`` folders (file sink:
    exactly once through its manifest and the checkpoint). ``parquet`` keeps
    the arrival columns, so a replay sees the arrival order; ``text`` keeps the
    lines only."""
    out = with_partition_columns(wire)
    out = out.select("value", *PARTITION_COLS) if fmt == "text" else out
    w = (out.writeStream.format(fmt).partitionBy(*PARTITION_COLS)
         .option("checkpointLocation", checkpoint).option("path", root))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    return w.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def count_stream(decoded: DataFrame, seconds: int = metrics.COUNT_WINDOW_SECONDS,
                 ts_col: str = "arrival_ts", watermark: str = "0 seconds") -> DataFrame:
    """Tumbling counts by event type. The watermark closes windows, which
    bounds the state, and drops rows of closed windows as late."""
    # Watermarks need TIMESTAMP; event columns are TIMESTAMP_NTZ. Count on a
    # shadow column and give the window bounds back as NTZ.
    src = (decoded.withColumn("_wm_ts", F.col(ts_col).cast("timestamp"))
           .withWatermark("_wm_ts", watermark))
    c = metrics.counts_tumbling(src, seconds, "_wm_ts")
    return (c.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
             .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


def start_counts(counts: DataFrame, out_path: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Append the windows each micro-batch closes, under ``batch_id=N``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{out_path}/batch_id={batch_id}"))
    return (counts.writeStream.outputMode("append").foreachBatch(sink)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def run_available(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query to finish; re-raise its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
