"""Token counts by source, language and tokenizer version, kept up to date by
signed deltas.

A batch of changes (inserts, deletes, revised texts) is counted in one pass
and compared with the stored count of each document it names; the difference
is one signed row per (source, lang, tokenizer), so totals are plain sums and
never need the corpus again. A document is counted by one tokenizer version
at a time: a revision under another version moves it.

A batch writes its deltas and new document counts into a folder of its own
attempt; the commit record, written last under the batch's id, names that
folder. Readers use committed attempts only. Applying a committed batch again
does nothing, and an attempt that died leaves files nobody reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare

#: Document counts are stored in buckets of the key's hash.
BUCKETS = 32

_STATE = "key string, bucket int, source string, lang string, tokenizer string, n_tokens long, copies long, batch_no long"
_DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
_COMMIT = "batch_id string, batch_no long, attempt string"


def counted(changes: DataFrame, tokenizer_path: str) -> DataFrame:
    """``changes`` with ``n_tokens`` in place of ``text`` (null text: 0 tokens)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from ordwise.llm import tokens
        tok = tokens.byte_bpe(tokenizer_path) if tokenizer_path.endswith(".tiktoken") else tokens.word_bpe(tokenizer_path)
        for b in batches:
            n = [tok.count(t) if t else 0 for t in b["text"]]
            yield b.drop(columns="text").assign(n_tokens=n)

    fields = ", ".join(f"`{n}` {t}" for n, t in changes.drop("text").dtypes)
    return changes.mapInPandas(count, f"{fields}, n_tokens long")


class TokenRollup:
    """A rollup stored under ``root`` (a folder all executors share)."""

    def __init__(self, spark: SparkSession, root: str):
        prepare(spark)
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def commits(self) -> list:
        """Commit records, oldest first: one small row per batch."""
        if not self._exists(f"{self.root}/commits"):
            return []
        rows = self.spark.read.schema(_COMMIT).parquet(f"{self.root}/commits/*").collect()
        return sorted(rows, key=lambda r: r["batch_no"])

    def _taken(self) -> list[int]:
        """Numbers of all commit folders, those of writers that died included."""
        if not self._exists(f"{self.root}/commits"):
            return []
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits")
        names = [st.getPath().getName() for st in p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
        return [int(n) for n in names if n.isdigit()]

    def _committed(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/attempts/{c['attempt']}/{kind}" for c in self.commits()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/attempts").parquet(*paths)

    def documents(self) -> DataFrame:
        """The live count of every document: its row of the latest batch.
        ``copies`` is 1, for a text without id the number of its rows."""
        last = F.max_by(F.struct("source", "lang", "tokenizer", "n_tokens", "copies"), "batch_no").alias("s")
        return (self._committed("state", _STATE).groupBy("bucket", "key").agg(last)
                .select("bucket", "key", "s.*").where("copies > 0"))

    def apply(self, batch_id: str, changes: DataFrame, tokenizer: str, tokenizer_path: str) -> bool:
        """Apply one batch; False if it was committed before. ``changes`` has
        ``op`` ('insert', 'delete', 'revise'), ``doc_id, text, source, lang``
        and optionally ``seq``: of several rows for a document the largest seq
        counts (ties: the delete, then the smallest row in text order). Insert
        and revise both set a document's count, deleting an unknown document
        changes nothing. Rows without an id are documents by their text, source
        and language (nulls differ from any value), and each row counts: an
        insert or revise adds one, a delete takes one of them away. Unknown ops
        raise; other columns are ignored. One writer at a time; what a writer
        that died has left, a commit folder without a record included, is
        never read and blocks no later batch."""
        done = self.commits()
        if any(c["batch_id"] == batch_id for c in done):
            return False
        number = max([c["batch_no"] for c in done] + self._taken(), default=-1) + 1
        attempt = f"{number:08d}-{uuid.uuid4().hex[:12]}"
        at = f"{self.root}/attempts/{attempt}"

        op = F.lower("op")
        known = F.when(op.isin("insert", "delete", "revise"), op == "delete").otherwise(
            F.raise_error(F.concat(F.lit("unknown op: "), F.coalesce("op", F.lit("null")))))
        marked = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in ("source", "lang", "text")]
        null_key = F.concat(F.lit("text:"), F.sha2(F.concat(*marked), 256))
        key = F.coalesce(F.concat(F.lit("id:"), F.col("doc_id").cast("string")), null_key)
        rows = changes.select(
            key.alias("key"), "source", "lang", known.alias("gone"),
            (F.col("seq").cast("long") if "seq" in changes.columns else F.lit(0).cast("long")).alias("seq"),
            F.when((op == "delete") & F.col("doc_id").isNotNull(), None).otherwise(F.col("text")).alias("text"))
        rank = F.struct("seq", "gone", F.struct(*(F.coalesce(c, F.lit("")) for c in ("source", "lang")), "n_tokens"))
        lone = F.col("key").startswith("text:")
        new = (counted(rows, tokenizer_path).groupBy("key")
               .agg(F.max_by(F.struct("source", "lang", "n_tokens", "gone"), rank).alias("s"),
                    F.sum(F.when(F.col("gone"), -1).otherwise(1)).alias("change"))
               .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int")))
        # an id is there or not; of a text without id the rows are counted on
        held = self.documents() if done else self.spark.createDataFrame([], _STATE)
        before = held.where(lone).select("bucket", "key", F.col("copies").alias("before")).hint("merge")
        new = new.join(before, ["bucket", "key"], "left")
        copies = F.when(lone, F.greatest(F.lit(0), F.coalesce("before", F.lit(0)) + F.col("change"))) \
            .otherwise(F.when(F.col("s.gone"), 0).otherwise(1))
        new = new.select("key", "bucket", "s.source", "s.lang", F.lit(tokenizer).alias("tokenizer"), "s.n_tokens",
                         copies.cast("long").alias("copies"), F.lit(number).cast("long").alias("batch_no"))
        new.write.parquet(f"{at}/state")
        new = self.spark.read.schema(_STATE).parquet(f"{at}/state")

        def signed(rows: DataFrame, sign: int) -> DataFrame:
            return rows.select("source", "lang", "tokenizer", (sign * F.col("copies")).alias("n_docs"),
                               (sign * F.col("copies") * F.col("n_tokens")).alias("n_tokens"))

        deltas = signed(new.where("copies > 0"), 1)
        if done:
            old = held.join(new.select("bucket", "key").hint("merge"), ["bucket", "key"], "left_semi")
            deltas = deltas.unionByName(signed(old, -1))
        (deltas.groupBy("source", "lang", "tokenizer")
         .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
         .write.parquet(f"{at}/deltas"))
        record = self.spark.createDataFrame([(batch_id, number, attempt)], _COMMIT).coalesce(1)
        record.write.mode("error").parquet(f"{self.root}/commits/{number:08d}")  # one writer can take a number
        return True

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, n_docs, n_tokens`` of the live documents:
        the sum of the committed deltas, without groups that hold none."""
        return (self._committed("deltas", _DELTA).groupBy("source", "lang", "tokenizer")
                .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .where((F.col("n_docs") != 0) | (F.col("n_tokens") != 0)))
