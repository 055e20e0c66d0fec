"""Shared helpers: table access, word rules, model sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize, scratch_path, ship_package

__all__ = ["append_columns", "column_names", "crc_mod", "labelled_sample", "materialize",
           "prepare", "release", "scratch_path", "sided", "table", "words"]

#: Rows per Arrow batch handed to a Python worker; texts can be long.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session set-up every operator needs: package on the workers, shared
    checkpoint folder, small Arrow batches."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def release(*stored: DataFrame) -> None:
    """Delete the folders of materialised tables that no later step reads. A
    collection in the driver's JVM lets Spark's cleaner drop the shuffle files
    of finished jobs at once instead of at some later collection."""
    for df in stored:
        files = df.inputFiles()
        if files:
            path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    if stored:
        stored[0].sparkSession.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8: everything between the six ASCII white-space
    characters, A-Z lower-cased (what ``bytes`` methods do by definition)."""
    return text.encode().lower().split() if text else []


def column_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` names that ``df`` does not have yet, made unique with a
    leading underscore where an input column clashes."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def crc_mod(col: str, m: int = 4) -> Column:
    """crc32 of the value's text modulo ``m``; null for null."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(m)


def sided(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows (the
    count is taken here), unchanged for a shuffle join beyond that."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int,
                    fold: bool) -> DataFrame:
    """About ``max_rows`` labelled documents ``(doc_id, text, y)``, chosen by a
    hash of the id. ``fold``: leave out ids whose crc32 mod 4 is 2. The hash
    threshold comes from the count of usable labels, so the sample is bounded
    whatever the table holds. Ids with more than one label row, null labels
    and null ids are not used."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if fold:
        usable = usable.where(crc_mod("doc_id") != 2)
    n = usable.count()
    share = 1.0 if n <= max_rows else max_rows / n
    picked = (usable.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
                           < F.lit(int(share * (1 << 30)) + 1))
              .groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("_hi"))
              .where(F.col("y") == F.col("_hi")).drop("_hi"))
    # at most max_rows plus hash noise: small enough to send to every task
    return (docs.select("doc_id", "text").join(sided(picked, 2 * max_rows), "doc_id")
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y"))


def append_columns(df: DataFrame, fields: str, make, text: str = "text") -> DataFrame:
    """``df`` with more columns made from its text column, batch by batch:
    ``make(texts)`` gives one Arrow array per field. Other columns pass
    through as they are, whatever their names and types."""
    from pyspark.sql import types as T
    schema = T.StructType(df.schema.fields + T.StructType.fromDDL(fields).fields)
    names, at = schema.names, df.columns.index(text)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, *make(b.column(at).to_pylist())], names=names)

    return df.mapInArrow(run, schema)
