"""ordwise: order-lifecycle event processing on Spark.

Batch and streaming share the same ``DataFrame -> DataFrame`` transforms:

* ``sources``   - readers (JSON lines, Kafka, staged CSV, file listings) and
                  adapters that turn the given tables into order events.
* ``functions`` - column-level helpers: lifecycle ranks and edges, codecs.
* ``operators`` - dedup, validation, routing, upsert, metrics, analytics.
* ``plans``     - multi-step jobs: date/hour archive, partition loader,
                  the registered query catalog and its SQL oracles.
* ``streaming`` - stateful validation sink, raw archive, windowed counts.
"""

__version__ = "0.1.0"
