"""Reconciliation by content.

Counts cannot see that a row was exchanged for another. A multiset of rows has
an additive fingerprint: the exact sum of a hash of each row. Two tables with
equal counts and equal sums hold the same rows, but for a chance of about one
in 2^60 a row; sums of parts add up, so each route is fingerprinted by itself,
map-side, and nothing but one row per hour and route is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .analytics import partition_key

ROUTES = ("valid", "invalid", "duplicate", "quarantine")
#: Columns that the wire record fixes: equal before and after routing.
CONTENT = ("event_id", "order_id", "event_type", "timestamp", "customer_id", "product_id", "quantity", "price", "arrival_seq")


def row_hash(df: DataFrame, columns: tuple[str, ...] = CONTENT) -> Column:
    """60 bits of the md5 of the columns' texts; a null differs from any text,
    and lengths keep neighbouring columns apart. Times count in microseconds,
    doubles in ten-thousandths."""
    parts = []
    for name, kind in ((c, df.schema[c].dataType.typeName()) for c in columns):
        c = F.col(name)
        if kind == "timestamp_ntz":
            c = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {name})")
        elif kind == "double":
            c = F.round(c * 10_000).cast("long")
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.conv(F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")


def hourly_fingerprints(df: DataFrame, by: tuple[str, ...] = (), columns: tuple[str, ...] = CONTENT) -> DataFrame:
    """``partition_key``, ``by``, ``n`` and the exact sum ``h`` of row hashes."""
    return df.groupBy(partition_key().alias("partition_key"), *by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_hash(df, columns)).alias("h"))


def reconcile_content(raw: DataFrame, routed: DataFrame, routes: tuple[str, ...] = ROUTES) -> DataFrame:
    """Per arrival hour: rows and fingerprint of the raw events against those
    of all routes together. ``counts_agree`` is what counting can tell,
    ``balanced`` also needs equal content."""
    stored = hourly_fingerprints(routed, ("route",))
    parts = [F.coalesce(F.sum(F.when(F.col("route") == r, F.col("n"))), F.lit(0)).alias(r) for r in routes]
    out = stored.groupBy("partition_key").agg(F.sum("n").alias("n_out"), F.sum("h").alias("h_out"), *parts)
    both = (hourly_fingerprints(raw).withColumnsRenamed({"n": "raw", "h": "h_raw"}).join(out, "partition_key", "full_outer")
            .fillna(0, subset=["raw", "n_out", *routes]))
    same = F.col("raw") == F.col("n_out")
    return both.select("partition_key", "raw", *routes, F.col("h_raw").cast("string").alias("raw_fingerprint"),
                       F.col("h_out").cast("string").alias("out_fingerprint"), same.alias("counts_agree"),
                       (same & F.col("h_raw").eqNullSafe(F.col("h_out"))).alias("balanced"))
