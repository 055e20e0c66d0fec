"""Analyst entry point: temp views over the tables and plain Spark SQL.

The reference documents three example queries over its warehouse tables.
Here the same questions run through ``spark.sql`` on temp views; Catalyst
plans them exactly like the DataFrame forms in ``operators``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The average delivery time uses the milestones view: the reference's query
# names paid/delivered columns that its orders table does not have. Its sum is
# a decimal, since that of some 300,000 orders passes the range of a BIGINT.
ANALYST_SQL = {
    "latest_order_state": "SELECT * FROM orders WHERE order_id = :order_id",
    "avg_delivery_time": """
        SELECT count(*) AS n_orders,
               sum(CAST(timestampdiff(MICROSECOND, paid_at, delivered_at) AS DECIMAL(19, 0))) AS total_delivery_micros,
               round(CAST(sum(CAST(timestampdiff(MICROSECOND, paid_at, delivered_at) AS DECIMAL(19, 0))) AS DOUBLE)
                     / count(*) / 3.6e9D, 6) AS avg_delivery_hours
        FROM order_milestones
        WHERE delivered_at IS NOT NULL AND paid_at IS NOT NULL""",
    "invalid_lifecycle_events": "SELECT * FROM invalid_order_events ORDER BY timestamp DESC",
}


def register_views(spark: SparkSession, **tables: DataFrame) -> None:
    """``register_views(spark, orders=..., order_milestones=..., ...)``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run(spark: SparkSession, name: str, **params) -> DataFrame:
    return spark.sql(ANALYST_SQL[name], args=params)
