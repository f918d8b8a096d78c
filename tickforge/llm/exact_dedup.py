"""Exact deduplication against a persistent digest index (method 3).

The index is a table bucketed and sorted by digest.  A batch is reduced to one
candidate per digest, candidates already in the index are removed by a
sort-merge anti-join that reads the index without a shuffle, and the rest is
appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, stored, whole_text, work_dir

INDEX_DDL = "digest binary, keep_id bigint, batch string"


def normalised(text: Column) -> Column:
    """The text without any ASCII white space."""
    return F.regexp_replace(text, f"[{SPACE_CLASS}]+", "")


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


def _rank(points: Column, doc_id: Column) -> Column:
    """Sorts the row to keep first: most code points, then smallest id, null ids last."""
    return F.struct((-points).alias("p"), doc_id.isNull().alias("n"), doc_id.alias("id"))


class DigestIndex:
    """Digests seen so far, bucketed and sorted by digest under ``path``.

    The folder outlives the session: opening it again with the same number of
    buckets registers the same files.  ``buckets`` defaults to the session's
    shuffle partitions, so that a batch shuffled by digest meets the index
    bucket by bucket; give the stored number when reopening.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(
            f"CREATE TABLE {self.name} ({INDEX_DDL}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def close(self) -> None:
        """Forgets the table's name in this session; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, candidates: DataFrame, batch: str | None = None) -> DataFrame:
        """Candidates (one row per digest) that the index does not hold yet, but for entries of ``batch``."""
        return candidates.hint("merge").join(self._others(batch).select("digest"), "digest", "left_anti")

    def _others(self, batch: str | None) -> DataFrame:
        entries = self.entries()
        return entries if batch is None else entries.where(~F.col("batch").eqNullSafe(F.lit(batch)))

    def append(self, entries: DataFrame, batch: str | None = None) -> None:
        """Adds rows of unseen digests; each bucket is written by one task.  What an earlier attempt at
        the same batch has entered is not entered again."""
        if batch is not None:
            own = self.entries().where(F.col("batch") == batch).select("digest")
            entries = entries.hint("merge").join(own, "digest", "left_anti")
        (
            entries.select("digest", "keep_id", F.lit(batch).cast("string").alias("batch"))
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def add(self, digests: DataFrame, path: str, batch: str | None = None) -> DataFrame:
        """Enters a batch (digest, doc_id, points) and returns per digest of the batch
        (digest, keep_id, group_size, fresh).  ``fresh`` is false where an earlier
        batch holds the digest; keep_id is then the earlier document.

        With the name of the ``batch``, a stage may be run again after a failure: its own entries do
        not count as seen, so the same batch gets the same answer as before, however far the first
        attempt came and whatever batches came after it.  Without a name, a second run of a batch
        finds all its texts seen."""
        groups = stored(
            digests.groupBy("digest").agg(
                F.min(_rank(F.col("points"), F.col("doc_id"))).getField("id").alias("keep_id"), F.count("*").alias("group_size")
            ),
            f"{path}/groups",
        )
        fresh = stored(self.unseen(groups, batch), f"{path}/fresh")
        seen = groups.select("digest", "group_size").hint("merge").join(self._others(batch).select("digest", "keep_id"), "digest")
        out = stored(
            fresh.select("digest", "keep_id", "group_size", F.lit(True).alias("fresh")).unionByName(
                seen.select("digest", "keep_id", "group_size", F.lit(False).alias("fresh"))
            ),
            f"{path}/decided",
        )
        self.append(fresh, batch)
        return out


def assign(spark: SparkSession, docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; all empty or white-space-only texts are equal.
    Of rows that repeat both id and text exactly one is kept.  Null ids sort
    last; if all ids of a group are null, keep_id is null and one row is kept.
    With an index that already holds a text, no row of the batch is kept; ``batch`` names the batch,
    so that it can be run again (see ``DigestIndex.add``).
    """
    path = work_dir(spark, "exact-dedup")
    own = None if index else DigestIndex(spark, f"{path}/index")
    index = index or own
    text = whole_text()
    digests = stored(
        docs.select("doc_id", text_digest(text).alias("digest"), F.length(text).cast("long").alias("points")), f"{path}/digests"
    )
    decided = index.add(digests, path, batch)
    if own:
        own.close()
    # Rows that repeat id and text meet here, so that one of them can stay.
    cells = digests.groupBy("digest", "doc_id").agg(F.count("*").alias("_n"), F.max("points").alias("_p"))
    rows = cells.join(decided, "digest").withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_i") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(spark: SparkSession, docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """The rows that stay, with all columns of ``docs``: one per distinct text."""
    path = work_dir(spark, "exact-keep")
    own = None if index else DigestIndex(spark, f"{path}/index")
    index = index or own
    text = whole_text()
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text_digest(text).alias("digest"), F.length(text).cast("long").alias("points"), F.col("doc_id").alias("_id"))
    digests = stored(keyed.select("digest", F.col("_id").alias("doc_id"), "points"), f"{path}/digests")
    decided = index.add(digests, path, batch).where("fresh")
    if own:
        own.close()
    # One row per digest leaves each task, so a group of copies is thin before the shuffle.
    best = keyed.groupBy("digest").agg(F.min_by("_row", _rank(F.col("points"), F.col("_id"))).alias("_row"))
    return best.join(decided.select("digest"), "digest", "left_semi").select("_row.*")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[{SPACE_CLASS}]+', '', 'g')) AS h
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept,
       h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST)
"""


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import table

    return assign(spark, table(spark, sf_dir, "documents"))
