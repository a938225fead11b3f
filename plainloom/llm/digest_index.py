"""Exact dedup against a persistent index of digests.

The index is a Parquet table of (digest, keep_id, batch), bucketed and sorted by digest, in
a folder that outlives the application: ``DigestIndex.open`` finds it again. A new batch
is reduced to one row per text before anything is shuffled, anti-joined with the index
bucket by bucket (a sort-merge join; the index is not shuffled), and only its unknown
digests are appended. Every append adds one file per bucket; ``compact`` merges them.

Texts are equal when identical; two texts with one SHA-256 are taken as identical. Of the
rows of a batch that share a new text the one with the largest doc_id stays (null ids are
smallest; of repeated rows one stays), and a text that an earlier batch brought stays
there: no row of the new batch does. Null texts count as empty. An empty batch appends
nothing and gives no rows. Other columns are not read, whatever their names.

A text repeated in a third of all rows costs one row per task in the shuffle. Its rows
find their verdict by a broadcast of the most repeated digests, of which there are at most
``MOST_HOT`` at any size, since each has more than a ``MOST_HOT``-th of the rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plainloom.llm.common import whole
from plainloom.session import stage

#: Rows of 48 bytes that a bucket of a new index is meant to hold.
BUCKET_ROWS = 4_000_000
#: A digest is hot with more than one row in so many.
MOST_HOT = 10_000
_COLUMNS = "digest BINARY, keep_id BIGINT, batch STRING"


def digest_of(text: str | Column) -> Column:
    """SHA-256 of the text in UTF-8, 32 bytes; of the empty text for null."""
    return F.unhex(F.sha2(whole(text), 256))


def buckets_for(docs: DataFrame) -> int:
    """A number of buckets for an index of the texts of ``docs``; counts rows by the files' footers."""
    return max(16, docs.count() // BUCKET_ROWS)


class DigestIndex:
    """The digests of all texts seen so far, at a path every executor can reach."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, name: str):
        self.spark, self.path, self.buckets, self.name = spark, path, buckets, name

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int) -> DigestIndex:
        """The index at ``path``, made if there is none; ``buckets`` must be what it was made with."""
        name = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {name} ({_COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return cls(spark, path, buckets, name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forget the table's name; its files stay."""
        self.spark.sql(f"DROP TABLE {self.name}")

    def _write(self, rows: DataFrame, name: str, mode: str, path: str) -> None:
        # Dealt by the bucket's own hash, so that every bucket is one file.
        dealt = rows.repartition(self.buckets, "digest")
        writer = dealt.write.format("parquet").mode(mode).option("path", path)
        writer.bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(name)

    def add(self, docs: DataFrame, batch: str = "") -> DataFrame:
        """Append the new texts of ``docs``; doc_id, keep_id, group_size, kept, text_sha256 of every row.

        keep_id is the row that stays, of this batch or an earlier one; group_size counts
        the rows of this batch with the text. A batch that was added twice keeps nothing.
        """
        rows = docs.select("doc_id", digest_of("text").alias("digest"))
        rows = stage(rows.withColumn("row", F.monotonically_increasing_id()))
        last = F.max(F.struct("doc_id", "row")).alias("last")
        groups = stage(rows.groupBy("digest").agg(last, F.count(F.lit(1)).alias("group_size")))
        new = groups.join(self.read().hint("merge"), "digest", "left_anti")
        new = stage(new.select("digest", "last"))
        self._write(new.select("digest", F.col("last.doc_id").alias("keep_id"), F.lit(batch).alias("batch")), self.name, "append", self.path)
        self.spark.catalog.refreshTable(self.name)
        # Of a digest that the index had, only its id is known: no row of this batch has that number.
        known = self.read().select("digest", "keep_id").join(groups.hint("merge"), "digest")
        known = known.join(new.select("digest", F.col("last.row").alias("keep_row")).hint("merge"), "digest", "left")
        return self._verdicts(rows, stage(known.select("digest", "keep_id", "keep_row", "group_size")))

    def _verdicts(self, rows: DataFrame, known: DataFrame) -> DataFrame:
        hot = F.col("group_size") * MOST_HOT > known.agg(F.sum("group_size")).scalar()
        marked = rows.join(F.broadcast(known.where(hot)), "digest", "left")
        found = marked.where(F.col("group_size").isNotNull())
        others = marked.where(F.col("group_size").isNull()).select("doc_id", "digest", "row")
        found = found.unionByName(others.join(known.where(~hot), "digest"))
        return found.select(
            "doc_id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def compact(self) -> None:
        """One file per bucket again. Not while others add."""
        merged = stage(self.read())
        self._write(merged, self.name, "overwrite", self.path)
        self.spark.catalog.refreshTable(self.name)
