"""Windowed counts whose late rows are kept, and running totals, on a stream.

Both hold their state in Spark's state store and write with the file sink, so
a restart on the same checkpoint neither repeats nor misses a row.

``counts_with_late`` counts events per event-time window and type. A window is
closed by a timer once the watermark passes its end; a row of a closed window
is not dropped but comes out as it is, as ``kind = 'late'`` (and as
``untimed`` without an event time). Every row is counted or comes out. The
windows of an hour are a page: one state of open counts and one timer, set to
the first end among them, so that the calls to the state store follow the
hours of the events and not their windows or rows. A page is split over
``salts`` keys, so that a busy hour is counted by several tasks;
``read_counts`` adds the parts up.

``running_totals`` carries, per key, the count of all windows closed so far and
puts it on every window as it closes. What is shuffled is the table of closed
windows, not events.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.codec import EVENT_COLUMNS
from ..operators import metrics
from .keyed import rocksdb_state

DEFAULT_SALTS = 8
#: The window key of rows without an event time (keys are never null).
UNTIMED = -(1 << 62)
#: A page of windows spans about so much.
PAGE_MS = 3_600_000
_LATE = [*EVENT_COLUMNS, "arrival_ts", "arrival_seq"]
_COUNTED = ("kind string, window_ms long, series string, n long, event_id string, order_id string, event_type string, "
            "timestamp timestamp_ntz, customer_id string, product_id string, quantity int, price double, "
            "arrival_ts timestamp_ntz, arrival_seq long")
_COUNTED_COLS = [f.split()[0] for f in _COUNTED.split(", ")]
_TOTALS = "series string, window_start timestamp_ntz, window_end timestamp_ntz, n long, running_n long"


def _series(by: Column) -> Column:
    """A key that tells a missing value from an empty one."""
    return F.coalesce(F.concat(F.lit("="), by), F.lit(""))


def _value(series: Column) -> Column:
    return F.when(series != "", F.substring(series, 2, 1 << 30))


class WindowCounts(StatefulProcessor):
    """Counts of one page of windows."""

    def __init__(self, millis: int):
        self.millis = millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "window_ms array<long>, series array<string>, n array<long>")

    def _held(self) -> dict[tuple, int]:
        got = self.open.get()
        return {} if got is None else {(w, s): n for w, s, n in zip(*got)}

    def _hold(self, counts: dict[tuple, int]) -> None:
        if not counts:
            return self.open.clear()
        self.open.update(([w for w, _ in counts], [s for _, s in counts], list(counts.values())))
        self.handle.registerTimer(min(w for w, _ in counts) + self.millis)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark, found = timerValues.getCurrentWatermarkInMs(), Counter()
        for chunk in rows:
            start = chunk["window_ms"]
            untimed = start == UNTIMED
            told = untimed | (start + self.millis <= watermark)
            if told.any():
                rest = chunk[told]
                yield rest[_LATE].assign(kind=np.where(untimed[told], "untimed", "late"), series=rest["series"], n=1,
                                         window_ms=rest["window_ms"].astype("Int64").mask(untimed[told]))[_COUNTED_COLS]
            found.update(chunk[~told].groupby(["window_ms", "series"], sort=False).size().to_dict())
        if found:
            counts = self._held()
            for (w, s), n in found.items():
                counts[int(w), s] = counts.get((w, s), 0) + int(n)
            self._hold(counts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, counts = timerValues.getCurrentWatermarkInMs(), self._held()
        closed = [(w, s, n) for (w, s), n in counts.items() if w + self.millis <= watermark]
        if not closed:
            return
        self._hold({(w, s): n for (w, s), n in counts.items() if w + self.millis > watermark})
        out = pd.DataFrame(closed, columns=["window_ms", "series", "n"]).assign(kind="counted")
        yield out.assign(**{c: pd.Series([None] * len(out), dtype="datetime64[us]" if c in ("timestamp", "arrival_ts") else object)
                            for c in _LATE})[_COUNTED_COLS]

    def close(self) -> None:
        pass


def counts_with_late(decoded: DataFrame, seconds: int = metrics.COUNT_WINDOW_SECONDS, ts_col: str = "timestamp",
                     watermark: str = "5 seconds", by: str = "event_type", salts: int = DEFAULT_SALTS) -> DataFrame:
    """``kind`` (``counted``, ``late``, ``untimed``), window bounds, ``by``, ``n``
    and, for rows that are not counted, the event itself."""
    millis = seconds * 1000
    # the watermark column itself goes no further: the operator would drop
    # the rows behind it before its code sees them
    marked = decoded.withColumn("_wm_ts", F.col(ts_col).cast("timestamp")).withWatermark("_wm_ts", watermark)
    ms = F.unix_millis(F.col(ts_col).cast("timestamp"))
    page = millis * max(1, PAGE_MS // millis)
    keyed = marked.select(*_LATE, F.coalesce(F.floor(ms / millis) * millis, F.lit(UNTIMED)).alias("window_ms"), _series(F.col(by)).alias("series"),
                          F.coalesce(F.floor(ms / page), F.lit(UNTIMED)).alias("page"),
                          F.pmod(F.xxhash64("arrival_seq"), F.lit(salts)).cast("int").alias("salt"))
    out = keyed.groupBy("page", "salt").transformWithStateInPandas(
        WindowCounts(millis), _COUNTED, "append", "eventTime")
    start = F.timestamp_millis("window_ms").cast("timestamp_ntz")
    return out.select("kind", start.alias("window_start"), (start + F.make_dt_interval(secs=F.lit(seconds))).alias("window_end"),
                      _value(F.col("series")).alias("counted_type"), "n", *_LATE)


def start_counts_with_late(decoded: DataFrame, out_root: str, checkpoint: str, trigger: dict | None = None,
                           **options) -> StreamingQuery:
    """Write closed windows and the rows that came too late, under ``kind=``."""
    with rocksdb_state(decoded.sparkSession):
        return (counts_with_late(decoded, **options).writeStream.format("parquet").outputMode("append").partitionBy("kind")
                .option("checkpointLocation", checkpoint).option("path", out_root)
                .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def read_counts(spark: SparkSession, out_root: str) -> DataFrame:
    """Counts of closed windows, their salted parts added up."""
    return (spark.read.parquet(out_root).where(F.col("kind") == "counted")
            .groupBy("window_start", "window_end", F.col("counted_type").alias("event_type")).agg(F.sum("n").alias("n")))


def read_late(spark: SparkSession, out_root: str) -> DataFrame:
    """Rows that no window counted, with the window they came too late for."""
    return spark.read.parquet(out_root).where(F.col("kind") != "counted").drop("counted_type", "n")


class RunningTotal(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("window_start")
        held = self.total.get()
        running = pdf["n"].cumsum() + (held[0] if held is not None else 0)
        self.total.update((int(running.iloc[-1]),))
        yield pdf.assign(running_n=running)[["series", "window_start", "window_end", "n", "running_n"]]

    def close(self) -> None:
        pass


def running_totals(counts: DataFrame, by: str | None = "event_type") -> DataFrame:
    """``counts`` (windows as an append-mode stream closes them) with the total
    of all closed windows of their key, or of all (``by=None``)."""
    series = _series(F.col(by)) if by else F.lit("")
    out = (counts.select(series.alias("series"), "window_start", "window_end", "n")
           .groupBy("series").transformWithStateInPandas(RunningTotal(), _TOTALS, "append", "none"))
    keys = [_value(F.col("series")).alias(by)] if by else []
    return out.select("window_start", "window_end", *keys, "n", "running_n")


def start_running_totals(counts: DataFrame, out_root: str, checkpoint: str, by: str | None = "event_type",
                         trigger: dict | None = None) -> StreamingQuery:
    with rocksdb_state(counts.sparkSession):
        return (running_totals(counts, by).writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint).option("path", out_root)
                .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def duplicate_count_stream(routed: DataFrame, seconds: int = metrics.DUP_WINDOW_SECONDS) -> DataFrame:
    """Closed windows that hold duplicates, of a stream of routed events. All
    rows move the watermark, so a quiet spell without duplicates closes windows
    as well."""
    src = routed.withColumn("_wm_ts", F.col("arrival_ts").cast("timestamp")).withWatermark("_wm_ts", "0 seconds")
    return (src.groupBy(F.window("_wm_ts", f"{seconds} seconds").alias("w")).agg(F.count_if("is_dup").alias("n")).where(F.col("n") > 0)
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n"))
