"""Wire and file codecs: JSON event decode, CSV line encode, CSV cleanup.

Everything here is a column expression (JVM-side, whole-stage codegen); no
Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lifecycle import rank_of

PAYLOAD_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
])

# JSON object on the wire. Unknown keys (generator internals) are ignored.
WIRE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("payload", PAYLOAD_SCHEMA),
    T.StructField("_corrupt_record", T.StringType()),
])

# Flat event columns (staging table order).
EVENT_COLUMNS = ["event_id", "order_id", "event_type", "timestamp",
                 "customer_id", "product_id", "quantity", "price"]

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _try_ntz(c: Column) -> Column:
    """Lenient ISO parse to TIMESTAMP_NTZ: 'T' or space, optional fraction,
    optional trailing 'Z'. Unparseable text gives null."""
    stripped = F.regexp_replace(F.trim(c), "Z$", "")
    return stripped.try_cast(T.TimestampNTZType())


def format_timestamp(c: Column) -> Column:
    return F.date_format(c, ISO_FORMAT)


def encode_wire(df: DataFrame) -> Column:
    """JSON text of an event from flat columns (inverse of ``decode_wire``)."""
    return F.to_json(F.struct(
        F.col("event_id"), F.col("order_id"), F.col("event_type"),
        format_timestamp(F.col("timestamp")).alias("timestamp"),
        F.struct("customer_id", "product_id", "quantity", "price").alias("payload"),
    ))


def decode_wire(df: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON decode + flatten (one ``from_json``; malformed lines are kept
    with ``malformed = true`` instead of failing the job)."""
    parsed = F.from_json(F.col(value_col), WIRE_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    j = df.withColumn("_j", parsed)
    malformed = (F.col("_j").isNull() | F.col("_j._corrupt_record").isNotNull()
                 | F.col("_j.event_id").isNull() | F.col("_j.order_id").isNull())
    cols = [c for c in df.columns if c != value_col]
    return j.select(
        F.col("_j.event_id").alias("event_id"),
        F.col("_j.order_id").alias("order_id"),
        F.col("_j.event_type").alias("event_type"),
        _try_ntz(F.col("_j.timestamp")).alias("timestamp"),
        F.col("_j.payload.customer_id").alias("customer_id"),
        F.col("_j.payload.product_id").alias("product_id"),
        F.col("_j.payload.quantity").alias("quantity"),
        F.col("_j.payload.price").alias("price"),
        *[F.col(c) for c in cols],
        malformed.alias("malformed"),
    )


def with_rank(df: DataFrame, type_col: str = "event_type") -> DataFrame:
    return df.withColumn("rk", rank_of(type_col))


def csv_line(df: DataFrame) -> Column:
    """One CSV line per event in staging column order. Unlike a plain comma
    join, values holding a comma or quote are quoted, so columns never shift."""
    return F.to_csv(F.struct(
        "event_id", "order_id", "event_type",
        format_timestamp(F.col("timestamp")).alias("timestamp"),
        "customer_id", "product_id", "quantity", "price"))


def _blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t == "", None).otherwise(t)


RAW_CSV_SCHEMA = "event_id string, order_id string, event_type string, timestamp string, " \
                 "customer_id string, product_id string, quantity string, price string"


def clean_staging(df: DataFrame, strict: bool = True) -> DataFrame:
    """Typed staging columns from raw CSV text columns.

    Empty and blank fields become null, text is trimmed, invalid UTF-8 is
    replaced by U+FFFD, timestamps parse leniently (null when unparseable).
    Numbers use ANSI casts when ``strict`` so a bad number fails the load;
    otherwise they become null.
    """
    def num(c, typ):
        v = _blank_to_null(F.col(c))
        return v.cast(typ) if strict else v.try_cast(typ)

    txt = lambda c: _blank_to_null(F.make_valid_utf8(F.col(c)))
    keep = [c for c in df.columns if c not in EVENT_COLUMNS]
    return df.select(
        txt("event_id").alias("event_id"),
        txt("order_id").alias("order_id"),
        txt("event_type").alias("event_type"),
        _try_ntz(_blank_to_null(F.col("timestamp"))).alias("timestamp"),
        txt("customer_id").alias("customer_id"),
        txt("product_id").alias("product_id"),
        num("quantity", "int").alias("quantity"),
        num("price", "double").alias("price"),
        *[F.col(c) for c in keep],
    )


def parse_csv_lines(df: DataFrame, line_col: str = "line", strict: bool = True) -> DataFrame:
    """Staging columns from CSV text lines (same rules as the file loader)."""
    raw = df.withColumn("_r", F.from_csv(F.col(line_col), RAW_CSV_SCHEMA,
                                         {"ignoreLeadingWhiteSpace": "false",
                                          "ignoreTrailingWhiteSpace": "false"}))
    keep = [c for c in df.columns if c != line_col]
    flat = raw.select(*[F.col(f"_r.{c}").alias(c) for c in EVENT_COLUMNS], *keep)
    return clean_staging(flat, strict=strict)
