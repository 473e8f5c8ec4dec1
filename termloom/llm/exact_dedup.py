"""Exact deduplication against a persistent index of digests.

The index is a table bucketed and sorted by digest. New data is reduced to one row per
digest, joined to the index by a sort-merge anti-join that moves only the new side, and
what is left is appended. An index grows batch by batch; it is never rewritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.llm.common import ascii_lower
from termloom.operators.staging import new_path, stage

BUCKETS = 64


class DigestIndex:
    """Digests seen so far, with the id of the document that stands for each.

    `name` is a table of the session's catalog, `path` its folder; both are kept by the
    cluster, so a later session finds the index again.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = BUCKETS):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets

    def append(self, rows: DataFrame) -> None:
        """Rows are dealt by their bucket, so a bucket is one file, however many tasks write them."""
        (
            rows.select("digest", "keep_id")
            .repartition(F.pmod(F.hash("digest"), F.lit(self.buckets)))
            .write.bucketBy(self.buckets, "digest").sortBy("digest")
            .option("path", self.path).mode("append").format("parquet").saveAsTable(self.name)
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def ingest(self, groups: DataFrame) -> DataFrame:
        """Add the digests of `groups(digest, keep_id)` that are not there yet; returns them.

        `groups` has one row per digest. The returned rows are staged before the append, so
        they are what was added even if the job is repeated.
        """
        if not self.exists():
            new = stage(groups.select("digest", "keep_id"), "new-digests")
        else:
            known = self.table().select("digest").hint("merge")
            new = stage(groups.select("digest", "keep_id").join(known, "digest", "left_anti"), "new-digests")
        self.append(new)
        return new


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of the text in UTF-8 with A-Z lower-cased; null counts as empty."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))


def groups(hashed: DataFrame) -> DataFrame:
    """(digest, keep_id, rows): one row per text; the largest id stands for it.

    Counted per task before the shuffle, so a text that a third of all rows share sends one
    row per task. A text that occurs in rows without an id only keeps the id null.
    """
    return hashed.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("rows"))


def deduplicate(docs: DataFrame, order: Sequence[Column] = (), index: DigestIndex | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of `docs`.

    Without `index` a new one is made in the staging folder. Against an index that already
    has a text, `keep_id` is the older document's id and no row of the group is kept.
    `order` lists conditions on `doc_id`: the rows that meet the first are one batch, then
    those that meet the second, and so on; an earlier batch keeps its text. Every row should
    meet one of them.

    Defined cases: null and empty texts are one group; of rows with the same id and text one
    is kept; a group whose ids are all null keeps one of its rows; an empty table gives no
    row; further columns of `docs` are ignored.
    """
    spark = docs.sparkSession
    if index is None:
        name = f"digests_{uuid.uuid4().hex}"
        index = DigestIndex(spark, name, new_path(spark, name))
    hashed = stage(digests(docs, id_col, text_col), "digests")
    for condition in order or [F.lit(True)]:
        index.ingest(groups(hashed.filter(condition)))
    known = index.table().hint("merge")
    # read back from a plain table: with an exchange on both sides, the next join may split a hot digest
    sizes = groups(hashed).select("digest", F.col("rows").alias("group_size"))
    resolved = stage(sizes.join(known, "digest"), "resolved")
    same = Window.partitionBy("digest", "doc_id").orderBy("doc_id")
    return (
        hashed.withColumn("copy", F.row_number().over(same))
        .join(resolved, "digest")
        .select(
            "doc_id", "keep_id", "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )
