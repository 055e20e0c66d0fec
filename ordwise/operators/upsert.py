"""Latest state per order and the ``orders`` upsert.

The latest event per order is a ``max_by`` aggregate: partial (map-side)
aggregation collapses a hot order to one row per task before the shuffle. Its
buffers hold strings, so Spark sorts for it on both sides of the exchange. The
``row_number`` form (one sort after the exchange, one task per order) is kept
for parity.

Upsert rules (per order, new increment ``s`` against stored row ``o``):

* not stored: insert the increment's latest event (price as decimal(10,2));
* stored: status, latest id and time move only when the increment's latest
  event time is strictly later, or the stored time is null; customer,
  product, quantity and price keep their first-loaded values;
* stored but absent from the increment: unchanged.

Only the increment is aggregated (not the whole event history); for status,
id and time, merging increments equals recomputing from all events when an
order's event times are distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER_COLUMNS = ["order_id", "latest_event_id", "order_status", "latest_event_time",
                 "customer_id", "product_id", "quantity", "price", "updated_at"]

ORDERS_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("latest_event_id", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("latest_event_time", T.TimestampNTZType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("updated_at", T.TimestampType()),
])

# Total order of events within an order: event time (nulls lowest), then id,
# then the payload, so ties never depend on task order.
_ORDER_KEY = ["timestamp", "event_id", "product_id", "quantity", "price"]


def latest_per_order(events: DataFrame) -> DataFrame:
    """One row per order: its latest event by event time (``max_by``)."""
    payload = F.struct("event_id", "event_type", "timestamp", "customer_id",
                       "product_id", "quantity", "price")
    latest = events.groupBy("order_id").agg(
        F.max_by(payload, F.struct(*_ORDER_KEY)).alias("_l"))
    return latest.select(
        "order_id",
        F.col("_l.event_id").alias("latest_event_id"),
        F.col("_l.event_type").alias("order_status"),
        F.col("_l.timestamp").alias("latest_event_time"),
        F.col("_l.customer_id").alias("customer_id"),
        F.col("_l.product_id").alias("product_id"),
        F.col("_l.quantity").alias("quantity"),
        F.col("_l.price").cast("decimal(10,2)").alias("price"),
    )


def latest_per_order_rn(events: DataFrame) -> DataFrame:
    """Same result through ``row_number() ... = 1`` (planned as a
    ``WindowGroupLimit`` + window; one task per order)."""
    w = Window.partitionBy("order_id").orderBy(
        F.col("timestamp").desc_nulls_last(), F.col("event_id").desc(),
        F.col("product_id").desc(), F.col("quantity").desc(), F.col("price").desc())
    return (events.withColumn("rn", F.row_number().over(w)).where("rn = 1")
            .select("order_id", F.col("event_id").alias("latest_event_id"),
                    F.col("event_type").alias("order_status"),
                    F.col("timestamp").alias("latest_event_time"),
                    "customer_id", "product_id", "quantity",
                    F.col("price").cast("decimal(10,2)").alias("price")))


def empty_orders(spark) -> DataFrame:
    return spark.createDataFrame([], ORDERS_SCHEMA)


def merge_orders(orders: DataFrame, increment: DataFrame,
                 now: Column | None = None) -> DataFrame:
    """New ``orders`` snapshot = stored rows upserted with an event increment.

    ``now`` stamps ``updated_at`` of changed rows (``current_timestamp()``
    by default; a literal in tests).
    """
    now = F.current_timestamp() if now is None else now
    # a null id never equals a stored one: it would add a row with every load
    s = latest_per_order(increment.where(F.col("order_id").isNotNull())).alias("s")
    o = orders.alias("o")
    j = o.join(s, F.col("o.order_id") == F.col("s.order_id"), "full_outer")
    stored = F.col("o.order_id").isNotNull()
    fresh = F.col("s.order_id").isNotNull()
    newer = fresh & (F.col("o.latest_event_time").isNull()
                     | (F.col("s.latest_event_time") > F.col("o.latest_event_time")))

    def pick(c):  # moving columns: increment when newer
        return (F.when(~stored, F.col(f"s.{c}"))
                 .when(newer, F.col(f"s.{c}"))
                 .otherwise(F.col(f"o.{c}")))

    def sticky(c):  # first-loaded columns
        return F.when(stored, F.col(f"o.{c}")).otherwise(F.col(f"s.{c}"))

    return j.select(
        F.coalesce(F.col("o.order_id"), F.col("s.order_id")).alias("order_id"),
        pick("latest_event_id").alias("latest_event_id"),
        pick("order_status").alias("order_status"),
        pick("latest_event_time").alias("latest_event_time"),
        sticky("customer_id").alias("customer_id"),
        sticky("product_id").alias("product_id"),
        sticky("quantity").alias("quantity"),
        sticky("price").cast("decimal(10,2)").alias("price"),
        F.when(~stored | newer, now).otherwise(F.col("o.updated_at")).alias("updated_at"),
    )


def lookup_order(orders: DataFrame, order_id: str) -> DataFrame:
    """Point lookup; the equality filter reaches the parquet scan."""
    return orders.where(F.col("order_id") == F.lit(order_id))
