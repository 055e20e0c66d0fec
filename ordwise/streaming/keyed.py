"""Keyed validation of a stream in Spark's own state store.

``transformWithStateInPandas`` holds the state (RocksDB, changelog
checkpoints), the checkpoint orders the batches and the file sink commits the
output: there is no state folder and no commit log of our own. One query has
one stateful operator and one write.

Orders are dealt to ``buckets``; a bucket is the grouping key and the orders in
it are keys of map states, so a call handles many orders at once. The entries
of a map lie in pages of a few dozen (``PagedMap``); a call reads and writes
only the pages that its rows touch:

* ``ranks``: order -> rank and arrival of its last valid event;
* ``seen_0..2``: (order, event id) -> last sighting, one map per generation.
  A generation is one TTL of arrival time. A sighting can flag a duplicate in
  its own and in the next generation only, so two maps are read. The newest
  three generations are kept, and a timer clears a map as a whole once the
  watermark is three TTLs past its start: every id is evicted once;
* ``owners`` (value state): which generation each map holds. A map that an
  older one has left is cleared before it is used again.

Expiring ranks (``state_ttl_seconds``) are judged by arrival time and removed
by the same timers. Without expiry a rank stays, one entry per order.

Rows of one micro-batch are put in arrival order inside the bucket; a bucket
holds its share of one micro-batch in memory, which the source's limits (files
or offsets per trigger) and the number of buckets bound. Rows without an order
id belong to no order: their bucket is drawn from their arrival.

Routed rows are dealt out by hour before they are written, so that a batch
writes a few files an hour and route, however many tasks validated it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.codec import decode_wire, with_rank
from ..operators.validate import check_mode
from ..plans.archive import PARTITION_COLS, with_partition_columns

DEFAULT_BUCKETS = 64
#: Entries of a page of a map state, at most on average.
PAGE = 64
#: Tasks that an arrival hour of a batch is written by, and so its files per route.
FILES_PER_HOUR = 4
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_INPUT = ["bucket", "order_id", "event_id", "rk", "malformed", "us", "value", "arrival_ts", "arrival_seq"]
_OUTPUT = ("value string, arrival_ts timestamp_ntz, arrival_seq long, prev_seen_us long, is_dup boolean, "
           "quarantine_reason string, prev_rank int, route string")
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB with changelogs; the
    session's own settings come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class PagedMap:
    """Entries ``key -> values`` of a map state in pages, by the hash of the key:
    what a call to the state store moves is a page. A map that outgrows its
    pages gets twice as many (or more) and its entries are dealt anew, page by
    page. Call ``begin`` once per grouping key."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, values: str):
        """``values``: name and type of each value."""
        self.width = len(values.split(", "))
        arrays = ", ".join("{} array<{}>".format(*v.split()) for v in values.split(", "))
        self.map = handle.getMapState(name, "page int", f"keys array<string>, {arrays}")
        self.size = handle.getValueState(f"{name}_size", "pages int, entries long")

    def begin(self) -> None:
        got = self.size.get()
        self.pages, self.entries = (1, 0) if got is None else (got[0], got[1])
        self.read: dict[int, dict] = {}

    def _at(self, key: str, pages: int) -> int:
        return zlib.crc32(key.encode("utf-8", "surrogatepass")) % pages

    def _page(self, at: int) -> dict[str, tuple]:
        if at not in self.read:
            got = self.map.getValue((at,)) if self.entries else None
            self.read[at] = {} if got is None else {k: v for k, *v in zip(*got)}
        return self.read[at]

    def _write(self, at: int, page: dict[str, tuple]) -> None:
        if page:
            self.map.updateValue((at,), (list(page), *([v[i] for v in page.values()] for i in range(self.width))))
        else:
            self.map.removeKey((at,))

    def get(self, key: str) -> tuple | None:
        return self._page(self._at(key, self.pages)).get(key) if self.entries else None

    def put(self, found: dict[str, tuple]) -> None:
        if not found:
            return
        touched = {}
        for key, value in found.items():
            at = self._at(key, self.pages)
            page = touched[at] = self._page(at)
            self.entries += key not in page
            page[key] = value
        pages = self.pages
        while self.entries > PAGE * pages:
            pages *= 2
        if pages > self.pages:
            for old in range(self.pages):
                parts: dict[int, dict] = {old: {}}
                for key, value in self._page(old).items():
                    parts.setdefault(self._at(key, pages), {})[key] = value
                del self.read[old]
                for at, page in parts.items():
                    self._write(at, page)
            self.pages, self.read = pages, {}
        else:
            for at, page in touched.items():
                self._write(at, page)
        self.size.update((self.pages, self.entries))

    def discard(self, gone: Callable[[tuple], bool]) -> None:
        """Remove the entries whose values are ``gone``."""
        before = self.entries
        for at in range(self.pages if before else 0):
            page = self._page(at)
            kept = {k: v for k, v in page.items() if not gone(v)}
            if len(kept) < len(page):
                self._write(at, kept)
                self.entries -= len(page) - len(kept)
            del self.read[at]
        if self.entries < before:
            self.size.update((self.pages, self.entries))

    def clear(self) -> None:
        self.map.clear()
        self.size.clear()
        self.pages, self.entries, self.read = 1, 0, {}


def _pair(order: str, event: str) -> str:
    """Order and event id as one key."""
    return f"{len(order)}:{order}{event}"


class LifecycleProcessor(StatefulProcessor):
    """Duplicates and lifecycle of the orders of a bucket, in arrival order."""

    def __init__(self, on_duplicate: str, dedup_ttl_seconds: int | None, state_ttl_seconds: int | None):
        self.drop = on_duplicate == "drop"
        self.dedup_us = None if dedup_ttl_seconds is None else dedup_ttl_seconds * 1_000_000
        self.state_us = None if state_ttl_seconds is None else state_ttl_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ranks = PagedMap(handle, "ranks", "rk int, us long")
        self.seen = [PagedMap(handle, f"seen_{k}", "us long") for k in range(1 if self.dedup_us is None else 3)]
        self.owners = handle.getValueState("owners", "generations array<long>")

    def _begin(self) -> None:
        for m in (self.ranks, *self.seen):
            m.begin()

    def _generation(self, us: int) -> int:
        return 0 if self.dedup_us is None else us // self.dedup_us

    def _owners(self) -> list:
        got = self.owners.get()
        return list(got[0]) if got is not None else [None] * len(self.seen)

    def _last_seen(self, key: str, us: int, held: dict, owners: list) -> int | None:
        if key in held:
            return held[key]
        g = self._generation(us)
        for k in (g, g - 1):
            if owners[k % len(owners)] == k:
                got = self.seen[k % len(owners)].get(key)
                if got is not None:
                    return got[0]
        return None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf = pdf.iloc[np.lexsort((pdf["arrival_seq"].to_numpy(), pdf["us"].to_numpy()))]
        self._begin()
        owners = self._owners()
        sighted: dict[str, int] = {}
        ranks: dict[str, tuple | None] = {}
        changed: set[str] = set()
        last_seen, dup, prev, route, reason = [], [], [], [], []
        for order, event, rk, bad, us in zip(pdf["order_id"].tolist(), pdf["event_id"].tolist(), pdf["rk"].tolist(),
                                             pdf["malformed"].tolist(), pdf["us"].tolist()):
            before = None
            if order is not None and event is not None:
                pair = _pair(order, event)
                before = self._last_seen(pair, us, sighted, owners)
                sighted[pair] = us
            is_dup = before is not None and (self.dedup_us is None or us - before < self.dedup_us)
            state = None
            if order is not None:
                if order not in ranks:
                    ranks[order] = self.ranks.get(order)
                state = ranks[order]
                if state is not None and self.state_us is not None and us - state[1] >= self.state_us:
                    state = None
            why = "malformed" if bad or order is None or event is None else "unknown_type" if rk != rk else None
            if why:
                way = "quarantine"
            elif self.drop and is_dup:
                way = "duplicate"
            elif state is None or rk >= state[0]:
                way, ranks[order] = "valid", (int(rk), us)
                changed.add(order)
            else:
                way = "invalid"
            last_seen.append(before)
            dup.append(is_dup)
            prev.append(None if state is None else state[0])
            route.append(way)
            reason.append(why)
        self._save(sighted, ranks, changed, owners)
        yield pd.DataFrame({
            "value": pdf["value"].to_numpy(), "arrival_ts": pdf["arrival_ts"].to_numpy(), "arrival_seq": pdf["arrival_seq"].to_numpy(),
            "prev_seen_us": pd.array(last_seen, "Int64"), "is_dup": dup, "quarantine_reason": pd.Series(reason, dtype=object),
            "prev_rank": pd.array(prev, "Int32"), "route": route})

    def _save(self, sighted: dict, ranks: dict, changed: set, owners: list) -> None:
        self.ranks.put({order: ranks[order] for order in changed})
        made = {key: self._generation(us) for key, us in sighted.items()}
        newest = max([*made.values(), *(g for g in owners if g is not None)], default=None)
        before = list(owners)
        found: list[dict] = [{} for _ in owners]
        for key, g in made.items():
            if g <= newest - len(owners):
                continue  # nothing that may still arrive is near it
            at = g % len(owners)
            if owners[at] != g:
                if owners[at] is not None:
                    self.seen[at].clear()
                owners[at] = g
                if self.dedup_us is not None:
                    self.handle.registerTimer((g + len(owners)) * self.dedup_us // 1000)
            found[at][key] = (sighted[key],)
        for held, entries in zip(self.seen, found):
            held.put(entries)
        if owners != before:
            self.owners.update((owners,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        us = expiredTimerInfo.getExpiryTimeInMs() * 1000
        self._begin()
        owners = self._owners()
        g = us // self.dedup_us - len(owners)
        if owners[g % len(owners)] == g:
            self.seen[g % len(owners)].clear()
            owners[g % len(owners)] = None
            self.owners.update((owners,))
        if self.state_us is not None:
            self.ranks.discard(lambda state: us - state[1] >= self.state_us)
        return iter([])

    def close(self) -> None:
        pass


def validate_stream(wire: DataFrame, on_duplicate: str = "drop", dedup_ttl_seconds: int | None = 600,
                    state_ttl_seconds: int | None = None, buckets: int = DEFAULT_BUCKETS,
                    arrival_skew: str = "1 minute") -> DataFrame:
    """Routed events of a stream of wire records, row for row what
    ``process_events`` gives. ``arrival_skew``: how far arrivals may go back
    between micro-batches (of several topic partitions); evictions wait as long."""
    check_mode(on_duplicate)
    events = with_rank(decode_wire(wire.withColumn("_text", F.col("value"))))
    spread = F.coalesce(F.xxhash64("order_id"), F.xxhash64("arrival_ts", "arrival_seq"))
    rows = (events.withColumn("value", F.col("_text")).withColumn("bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
            .withColumn("us", F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, arrival_ts)"))
            .withColumn("_wm_ts", F.col("arrival_ts").cast("timestamp")).withWatermark("_wm_ts", arrival_skew))
    # the watermark column itself goes no further: the operator would drop rows behind it
    routed = rows.select(*_INPUT).groupBy("bucket").transformWithStateInPandas(
        LifecycleProcessor(on_duplicate, dedup_ttl_seconds, state_ttl_seconds), _OUTPUT, "append", "eventTime")
    seen = F.expr(f"timestampadd(MICROSECOND, prev_seen_us, {_EPOCH})")
    return with_rank(decode_wire(routed)).withColumn("prev_seen_ts", seen).drop("prev_seen_us")


def start_keyed_validation(wire: DataFrame, out_root: str, checkpoint: str, trigger: dict | None = None,
                           **options) -> StreamingQuery:
    """Write routed events under ``route=/dt=/hr=`` with the file sink
    (options: ``validate_stream``). Read them back as parquet: the sink's
    manifest shows whole batches only."""
    out = with_partition_columns(validate_stream(wire, **options)).repartition(
        *PARTITION_COLS, F.pmod(F.xxhash64("arrival_seq"), F.lit(FILES_PER_HOUR)))
    with rocksdb_state(wire.sparkSession):
        return (out.writeStream.format("parquet").outputMode("append").partitionBy("route", *PARTITION_COLS)
                .option("checkpointLocation", checkpoint).option("path", out_root)
                .trigger(**(trigger or {"processingTime": "1 minute"})).start())
