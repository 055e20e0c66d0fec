"""Mixing sources to target weights by Poisson replication.

A source with share ``w`` of the target mixture and ``n`` of the ``N``
documents has mean repetition rate ``rate = w * N / n``. Each document's
number of copies inverts the Poisson distribution of that rate at a uniform
number hashed from the seed and its id (without an id: from its content and
its number among equal rows), so a rerun or a lost executor gives the same
mixture and no source is ever gathered. Copies come from
``explode``; a second hash of (id, copy) deals them to partitions and orders
them inside: a global shuffle in one exchange.

Everything is built-in functions. The table of rates has a row per source;
it is broadcast below ``BROADCAST_SOURCES`` rows, else joined by shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column_names, materialize, prepare, sided

BROADCAST_SOURCES = 10_000
#: 52 bits of an md5 digest make a uniform number.
_BITS = 52


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 digest of the parts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("double") / F.lit(float(1 << _BITS))


def poisson_cdf(rate: Column, last: Column) -> Column:
    """``[P(X <= 0), P(X <= 1), ..., P(X <= last)]`` by the term recurrence,
    in logarithms so that large rates do not underflow."""
    ks = F.sequence(F.lit(0), last)
    state = F.struct(F.lit(0.0).alias("logp"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        logp = F.when(k == 0, -rate).otherwise(acc["logp"] + F.log(rate) - F.log(k.cast("double")))
        total = acc["sum"] + F.exp(logp)
        return F.struct(logp.alias("logp"), total.alias("sum"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    return F.aggregate(ks, state, step, lambda acc: acc["cdf"])


def rates(docs: DataFrame, weights: dict | None = None, source: str = "source") -> DataFrame:
    """``source, n, rate, cdf`` per source. ``weights``: target weight per
    source (others, and a null source, weigh 0); None: equal weights."""
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counts = counts.withColumn("w", F.lit(1.0))
    else:
        bad = {k: v for k, v in weights.items() if not math.isfinite(v) or v < 0}
        if bad:
            raise ValueError(f"weights must be finite and not negative: {bad}")
        # one lookup per source row, not per document
        known = F.map_from_arrays(F.array(*map(F.lit, weights)), F.array(*(F.lit(float(v)) for v in weights.values()))) \
            if weights else F.create_map().cast("map<string,double>")
        counts = counts.withColumn("w", F.coalesce(F.when(F.col("source").isNotNull(), known[F.col("source")]), F.lit(0.0)))
    counts = materialize(counts, "mix-counts")
    total = counts.agg(F.sum("n").alias("n"), F.sum("w").alias("w")).first()
    n, w = float(total["n"] or 0), float(total["w"] or 0)
    rate = F.col("w") / F.lit(w) * F.lit(n) / F.col("n") if w > 0 else F.lit(0.0)
    with_rate = counts.withColumn("rate", rate).where(F.col("rate") > 0)
    # beyond this many copies the distribution's tail is under 2**-53
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    return with_rate.select("source", "n", "rate", poisson_cdf(F.col("rate"), last).alias("cdf"))


def _identified(docs: DataFrame, key: str, ident: str) -> DataFrame:
    """``docs`` with ``ident``, what a row draws by: its id, or for a null id
    the digest of the row and its number among equal rows. Those are numbered
    inside the partitions they were stored by, so no task gets all of them."""
    named = docs.where(F.col(key).isNotNull()).withColumn(ident, F.col(key).cast("string"))
    nameless = docs.where(F.col(key).isNull())
    if nameless.isEmpty():
        return named
    digest, part, n, before = column_names(named, "mix_digest", "mix_part", "mix_n", "mix_before")
    stored = materialize(nameless.withColumn(digest, F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns))), 256))
                         .withColumn(part, F.spark_partition_id()), "mix-nameless")
    counts = stored.groupBy(digest, part).agg(F.count(F.lit(1)).alias(n))
    earlier = Window.partitionBy(digest).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0))).drop(n)
    number = F.col(before) + F.row_number().over(Window.partitionBy(digest, part).orderBy(part))
    numbered = stored.join(counts, [digest, part]).withColumn(
        ident, F.concat_ws(":", F.lit("no id"), F.col(digest), number.cast("string")))
    return named.unionByName(numbered.drop(digest, part, before))


def mix(docs: DataFrame, weights: dict | None = None, seed: int = 17, source: str = "source",
        key: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """The mixture: every column of ``docs`` plus ``mix_rate, copy`` (from 1)
    and ``mix_order`` (uniform; ascending inside a partition).

    Documents of null or unweighted sources get no copy (with equal weights a
    null source is a source like any other). Rows of one id draw the same
    number; rows without an id draw one each. Empty tables give no rows. New
    columns get leading underscores where names clash."""
    prepare(docs.sparkSession)
    rate, copy, order, cdf, src, own = column_names(docs, "mix_rate", "copy", "mix_order", "mix_cdf", "mix_source", "mix_ident")
    table = sided(materialize(rates(docs, weights, source), "mix-rates").select(
        F.col("source").alias(src), F.round("rate", 9).alias(rate), F.col("cdf").alias(cdf)), BROADCAST_SOURCES)
    joined = _identified(docs, key, own).join(table, F.col(source).eqNullSafe(F.col(src)))
    ident = F.col(own)
    draw = uniform(F.lit(f"copies:{seed}"), ident)
    count = F.size(F.filter(F.col(cdf), lambda p: p <= draw))
    drawn = joined.withColumn(copy, F.explode(F.when(count > 0, F.sequence(F.lit(1), count)))).drop(src, cdf)
    placed = drawn.withColumn(order, uniform(F.lit(f"order:{seed}"), ident, F.col(copy).cast("string"))).drop(own)
    n = partitions or max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return placed.repartition(n, F.col(order)).sortWithinPartitions(order)


def oracle(weighted_equally_seed: int = 17) -> str:
    """The same mixture with equal weights as DuckDB SQL over ``documents``.
    It holds for tables without null ids: here those draw as the text ''."""
    s = weighted_equally_seed
    number = "CAST(('0x' || substr(md5({}), 1, 13)) AS BIGINT) / 4503599627370496.0"
    draw = number.format(f"concat('copies:{s}:', coalesce(CAST(doc_id AS VARCHAR), ''))")
    order = number.format(f"concat('order:{s}:', coalesce(CAST(doc_id AS VARCHAR), ''), ':', CAST(copy AS VARCHAR))")
    return f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM counts)
                 * (SELECT sum(n) FROM counts)::DOUBLE / n AS rate FROM counts),
cdf AS (
  SELECT source, rate, 0 AS k, -rate AS logp, exp(-rate) AS total FROM rates
  UNION ALL
  SELECT source, rate, k + 1, logp + ln(rate) - ln((k + 1)::DOUBLE),
         total + exp(logp + ln(rate) - ln((k + 1)::DOUBLE)) FROM cdf
  WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
tables AS (SELECT source, rate, list(total ORDER BY k) AS totals FROM cdf GROUP BY source, rate),
drawn AS (
  SELECT d.*, rate, len(list_filter(totals, lambda p: p <= {draw})) AS copies
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
copied AS (SELECT * EXCLUDE (copies), unnest(range(1, copies + 1)) AS copy FROM drawn WHERE copies > 0)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS mix_rate, CAST(copy AS INTEGER) AS copy,
       {order} AS mix_order FROM copied"""
