"""Adapters from the given parquet tables to order events.

A. ``events`` (clickstream) -> wire records ``(value, arrival_ts, arrival_seq)``
   with injected unknown types and re-sent duplicates. Used by every
   arrival-order operator (dedup, validation, routing, streaming).
B. ``orders`` + ``lineitem`` -> flat order events. Large volume with natural
   duplicates; used by event-time operators (latest state, upsert, milestones).

Both are column expressions over the scans; the shuffles are the one that deals
the events of adapter A to all cores and the ``lineitem``/``orders`` equi-join
of adapter B.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import decode_wire, encode_wire, with_rank


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- Fixed adapter parameters (shared with the SQL oracles) -----------------
UNKNOWN_EVERY = 97          # every 97th event gets an unknown type
DUP_EVERY = 20              # every 20th event is sent a second time
DUP_DELAY_MIN = 5           # ... 5 + (n % 40) minutes later
TRUNCATED_EVERY = 101       # every 101st event's JSON text is cut in half
BAD_PAYLOAD_EVERY = 103     # every 103rd event's quantity is a word
NO_ID_EVERY = 107           # every 107th event has no event id
EVENT_TIME_SHIFT_MUL = 7919  # event time = arrival - (n * 7919 % 3600) s
CLICK_TYPES = {
    "signup": "ORDER_PENDING",
    "view": "ORDER_PAID",
    "click": "ORDER_SHIPPED",
    "purchase": "ORDER_DELIVERED",
}
ERROR_TYPES = ["ORDER_CANCELLED", "ORDER_PAID_CANCELLED", "ORDER_RETURNED", "ORDER_REFUNDED"]
# -----------------------------------------------------------------------------


def _click_event_type(n, etype, k):
    e = F.when(n % UNKNOWN_EVERY == 0, F.lit("ORDER_LOST"))
    for src, dst in CLICK_TYPES.items():
        e = e.when(etype == src, F.lit(dst))
    for i, dst in enumerate(ERROR_TYPES):
        e = e.when((etype == "error") & (k % 4 == i), F.lit(dst))
    return e


def clickstream_flat(events: DataFrame) -> DataFrame:
    """Adapter A as flat columns plus arrival columns (before duplication)."""
    events = events.select("*", F.get_json_object("props", "$.k").cast("int").alias("_k"))
    n = F.col("event_id")
    k = F.col("_k")
    return events.select(
        n.cast("string").alias("event_id"),
        F.concat(F.lit("O"), F.col("user_id").cast("string"), F.lit("-"),
                 F.date_format("ts", "yyyyMMdd")).alias("order_id"),
        _click_event_type(n, F.col("event_type"), k).alias("event_type"),
        F.timestamp_add("SECOND", -((n * EVENT_TIME_SHIFT_MUL) % 3600), F.col("ts")).alias("timestamp"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("customer_id"),
        F.concat(F.lit("P"), k.cast("string")).alias("product_id"),
        (F.lit(1) + k % 5).cast("int").alias("quantity"),
        F.col("value").alias("price"),
        F.col("ts").alias("arrival_ts"),
        (n * 2).alias("arrival_seq"),
        n.alias("_n"),
    )


def spread(events: DataFrame) -> DataFrame:
    """The rows dealt to all cores: a file of few row groups is read by as few
    tasks, and encoding and decoding JSON costs far more than the shuffle."""
    return events.repartition(events.sparkSession.sparkContext.defaultParallelism, "event_id", "ts", "user_id")


def clickstream_wire(events: DataFrame) -> DataFrame:
    """Adapter A as wire records: JSON ``value`` + Kafka-like arrival columns.

    Duplicates are the same JSON text re-sent later with a new offset.
    """
    flat = clickstream_flat(spread(events))
    # one scan and one JSON encode per event; the re-sent copy is a second
    # arrival of the same text, generated in the same pass
    arrivals = F.array(
        F.struct(F.col("arrival_ts").alias("ts"), F.col("arrival_seq").alias("seq")),
        F.when(F.col("_n") % DUP_EVERY == 0, F.struct(
            F.timestamp_add("MINUTE", F.lit(DUP_DELAY_MIN) + F.col("_n") % 40,
                            F.col("arrival_ts")).alias("ts"),
            (F.col("arrival_seq") + 1).alias("seq"))))
    n, text = F.col("_n"), encode_wire(flat)
    value = (F.when(n % TRUNCATED_EVERY == 0, F.substring(text, F.lit(1), (F.length(text) / 2).cast("int")))
             .when(n % BAD_PAYLOAD_EVERY == 0, F.regexp_replace(text, r'"quantity":\d+', '"quantity":"many"'))
             .when(n % NO_ID_EVERY == 0, F.regexp_replace(text, r'"event_id":"[^"]*",', ""))
             .otherwise(text))
    return (flat.select(value.alias("value"), F.explode(arrivals).alias("_a"))
            .where(F.col("_a").isNotNull())
            .select("value", F.col("_a.ts").alias("arrival_ts"), F.col("_a.seq").alias("arrival_seq")))


SLICES = 3


def arrival_slice(wire: DataFrame, slices: int = SLICES) -> DataFrame:
    """Add ``slice`` (0, 1, ...): equal parts of the time from the first to the
    last arrival, in arrival order whatever the span."""
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', arrival_ts)")
    span = wire.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    lo, width = span["lo"] or 0, (span["hi"] or 0) - (span["lo"] or 0) + 1
    return wire.withColumn("slice", F.floor((us - F.lit(lo)) * slices / F.lit(width)).cast("int"))


def clickstream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded, ranked order events of adapter A (the engine's input frame)."""
    wire = clickstream_wire(table(spark, sf_dir, "events"))
    return with_rank(decode_wire(wire))


def order_lineitem_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter B: lifecycle events derived from ``orders`` and ``lineitem``."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    ok = F.col("o_orderkey").cast("string")
    cust = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    day = F.make_dt_interval(F.lit(1))

    # pending (all orders) and paid (status F or P) from one scan of orders
    okind = F.explode(F.array(
        F.lit("N"), F.when(F.col("o_orderstatus").isin("F", "P"), F.lit("A")))).alias("_kind")
    order_events = o.select("*", okind).where(F.col("_kind").isNotNull()).select(
        F.concat(ok, F.lit("-"), F.col("_kind")).alias("event_id"), ok.alias("order_id"),
        F.when(F.col("_kind") == "N", "ORDER_PENDING").otherwise("ORDER_PAID").alias("event_type"),
        F.when(F.col("_kind") == "N", F.col("o_orderdate"))
         .otherwise(F.col("o_orderdate") + hour).alias("timestamp"),
        cust.alias("customer_id"), F.lit(None).cast("string").alias("product_id"),
        F.lit(None).cast("int").alias("quantity"), F.col("o_totalprice").alias("price"))

    lines = li.join(o.select("o_orderkey", "o_custkey"),
                    F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    lok = F.col("l_orderkey").cast("string")

    # One pass over the joined lines emits the three line-level events.
    exploded = lines.select(
        "*", F.explode(F.array(
            F.lit("S"),
            F.when(F.col("l_linestatus") == "F", F.lit("D")),
            F.when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R"), F.lit("R")),
        )).alias("_kind")).where(F.col("_kind").isNotNull())
    kind = F.col("_kind")
    line_events = exploded.select(
        F.concat(lok, F.lit("-"), F.col("l_linenumber").cast("string"), F.lit("-"), kind).alias("event_id"),
        lok.alias("order_id"),
        F.when(kind == "S", "ORDER_SHIPPED").when(kind == "D", "ORDER_DELIVERED")
         .otherwise("ORDER_RETURNED").alias("event_type"),
        F.when(kind == "S", F.col("l_shipdate"))
         .when(kind == "D", F.col("l_shipdate") + day * 3)
         .otherwise(F.col("l_shipdate") + day * 30).alias("timestamp"),
        cust.alias("customer_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    return with_rank(order_events.unionByName(line_events))
