"""From raw documents to token ids in five stages, each working on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import line_dedup, mixing, ngram_join, toxicity
from termloom.llm.catalog import MIX_FACTOR, MIX_MOST, TOXIC, WEIGHTS, held_out, token_digests
from termloom.llm.common import table
from termloom.operators.staging import new_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None  # training, packing and token ids have no SQL form; tests/llm has brute-force versions


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labelled documents of its input."""
    labels = toxicity.sample(table(spark, sf_dir, "labels"), ~held_out(), "doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), out="toxicity: score")
    return scored.filter(F.col("toxicity: score") < TOXIC).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; documents stay, if need be with an empty text."""
    cleaned = line_dedup.drop_boilerplate(docs, F.col("source"), "text")
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, of those with the smallest id.

    Rows are told by a 64-bit hash of id and text: rows that share an id and are in different
    groups stay both, equal rows with words are one. Documents without words are nobody's
    copy, and documents without an id always stay.
    """
    rows = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("near: row"))
    groups = ngram_join.near_duplicates(rows, "near: row").select(F.col("doc_id").alias("near: row"), "n_shingles", "component_id").distinct()
    named = rows.filter("doc_id IS NOT NULL").select("near: row", "doc_id").distinct().join(groups, "near: row")
    kept = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "near: row", "n_shingles")).alias("first"))
    kept = kept.select(F.col("first")["near: row"].alias("near: row"), F.col("first")["n_shingles"].alias("near: size"))
    known = rows.filter("doc_id IS NOT NULL").join(kept, "near: row")
    worded, blank = known.filter(F.col("near: size") > 0).dropDuplicates(["near: row"]), known.filter(F.col("near: size") == 0)
    return worded.select(*COLUMNS).union(blank.select(*COLUMNS)).union(rows.filter("doc_id IS NULL").select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a row is the part of a document that one block of the mix holds."""
    mixed = mixing.mixed_texts(docs, WEIGHTS, MIX_FACTOR, MIX_MOST)
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what the mix holds, encoded and decoded again."""
    return token_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near duplicates", drop_near_copies),
    ("mixing", mix),
    ("token ids", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
