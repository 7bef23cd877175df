"""Exact dedup through a persistent digest index, bucketed and sorted by digest.

Texts are equal when they are identical after A-Z became a-z; a null text counts as
empty, so null and empty are copies of each other.  Of equal texts the row with the
largest doc_id stays.  Rows without a doc_id never stay beside a row that has one; rows
that share both doc_id and text are one document and all report ``kept`` (``unique``
returns one row of them).  An empty table gives an empty result and leaves the index
as it is.  Other columns are carried as they are, whatever their names.

A batch may be run again, also after its digests were stored: the index knows which batch brought a
digest, and a batch's own digests are new to it."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.scratch import Scratch
from sluice.llm.texts import ascii_lower

#: Of an index made without saying how many.
BUCKETS = 32


def digest(text):
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256))


class DigestIndex:
    """Known texts: (digest, keep_id, batch), one row per digest, in files bucketed and sorted by
    digest.  The folder outlives the session; a new session names the same folder.  The number of buckets is chosen when
    the folder is made, for the size the index is to reach, and stands beside the rows: another number is refused."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark, self.folder = spark, folder
        self.buckets = self._agreed(buckets)
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{folder}/rows'")

    def _agreed(self, buckets: int | None) -> int:
        settings = f"{self.folder}/settings"
        try:
            stored = self.spark.read.schema("buckets int").parquet(settings).first().buckets
        except AnalysisException:  # a new folder
            stored = buckets or BUCKETS
            self.spark.range(0, 1, 1, 1).select(F.lit(stored).alias("buckets")).write.parquet(settings)
        if buckets not in (None, stored):
            raise ValueError(f"the index in {self.folder} has {stored} buckets, not {buckets}")
        return stored

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, digests: DataFrame, batch: str | None = None) -> DataFrame:
        """Takes (doc_id, digest) rows, appends the digests that no batch brought before and returns
        (digest, keep_id) of those that ``batch`` brought, now or in an earlier run of it.  A batch without a name is named
        by its contents.  The index side of the anti-join needs no shuffle and no sort beyond its buckets."""
        scratch = Scratch(self.spark, "new-digests")
        found = scratch.keep(digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id")), "batch")
        batch = batch or _fingerprint(found)
        new = scratch.keep(found.join(self.rows().select("digest").hint("merge"), "digest", "left_anti"), "new")
        (new.withColumn("batch", F.lit(batch)).repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.bucketBy(self.buckets, "digest").sortBy("digest").mode("append").format("parquet")
         .saveAsTable(self.table))
        return self.rows().where(F.col("batch") == batch).select("digest", "keep_id")


def _fingerprint(found: DataFrame) -> str:
    """The same for the same (digest, keep_id) rows."""
    ids = F.coalesce("keep_id", F.lit(-1))
    row = found.agg(F.count("*").alias("n"), *(F.bit_xor(F.xxhash64(F.lit(i), "digest", ids, F.col("keep_id").isNull())).alias(f"h{i}") for i in (0, 1))).first()
    return f"{row.n}/{row.h0}/{row.h1}"


def new_index(spark: SparkSession, buckets: int = BUCKETS) -> DigestIndex:
    """An empty index in the shared folder."""
    return DigestIndex(spark, Scratch(spark, "digest-index").root, buckets)


def _ranges(rows: DataFrame, batches: int) -> list[DataFrame]:
    """``rows`` by ranges of doc_id, highest first; rows without one are in the last."""
    ends = rows.agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).first()
    if batches == 1 or ends.most is None:
        return [rows]
    cuts = [ends.least + (ends.most - ends.least) * i // batches for i in range(batches - 1, 0, -1)]
    parts = []
    for i, cut in enumerate(cuts):
        above = rows.where(F.col("doc_id") >= cut)
        parts.append(above.where(F.col("doc_id") < cuts[i - 1]) if i else above)
    return [*parts, rows.where(F.col("doc_id").isNull() | (F.col("doc_id") < cuts[-1]))]


def decide(docs: DataFrame, index: DigestIndex, batches: int = 1) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.
    ``group_size`` counts the rows of this batch; a text that the index knew before
    keeps the index's document, so none of its rows here is kept.  With several ``batches`` the rows enter the index
    by ranges of doc_id, highest first, so that the result is that of one batch."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    rows = scratch.keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest")), "rows")
    new = reduce(DataFrame.unionByName, [index.add(part) for part in _ranges(rows, batches)]).select("digest", F.lit(True).alias("is_new"))
    groups = (rows.groupBy("digest").agg(F.count("*").alias("group_size"))
              .join(index.rows().hint("merge"), "digest").join(new, "digest", "left"))
    return rows.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size",
        (F.col("is_new").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def unique(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: one per text that is new."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       digest(F.col("text")).alias("digest"))
    new = index.add(rows.select("doc_id", "digest")).withColumnRenamed("keep_id", "k")
    kept = rows.join(new, (rows.digest == new.digest) & rows.doc_id.eqNullSafe(new.k), "left_semi")
    return kept.dropDuplicates(["digest"]).select("row.*")
