"""Evaluation: confusion-matrix measures and ranking measures.

Rankings are (query_id, rank, doc_id), judgments (query_id, doc_id, relevance), relevant
documents (query_id, doc_id). Ranking measures return (query_id, value).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.operators.joins import running_count

RANK_BLOCK = 65_536

Measure = Callable[[DataFrame, DataFrame], DataFrame]


# ---- classification --------------------------------------------------------------------

def aligned(actual: DataFrame, predicted: DataFrame, key: str = "id") -> DataFrame:
    """Pair actual with predicted classes by key; items on one side only drop out."""
    return actual.join(predicted, key)


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """(tn, fp, fn, tp) of `pairs(actual, predicted)`; anything but 1, also NULL, counts as negative.

    Every pair is in one cell: a NULL class is a class that equals NULL only.
    """
    hit, said = F.col("actual").eqNullSafe(F.col("predicted")), F.col("predicted").eqNullSafe(1)
    return pairs.agg(
        F.count_if(hit & ~said).alias("tn"),
        F.count_if(~hit & said).alias("fp"),
        F.count_if(~hit & ~said).alias("fn"),
        F.count_if(hit & said).alias("tp"),
    )


def binary_measures(matrix: DataFrame) -> DataFrame:
    """All measures of a confusion matrix; a measure without a denominator is NULL."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    precision, recall = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return matrix.select(
        F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.try_divide(fp, fp + tn).alias("false_positive_rate"),
        F.try_divide(fn, fn + tp).alias("false_negative_rate"),
    )


def evaluate(pairs: DataFrame) -> DataFrame:
    """Recall, precision, F1 and accuracy, in this order."""
    return binary_measures(confusion_matrix(pairs)).select("recall", "precision", "f1", "accuracy")


# ---- rankings --------------------------------------------------------------------------

def relevant(judgments: DataFrame) -> DataFrame:
    """Distinct pairs judged relevant (1) or highly relevant (2)."""
    return judgments.filter(F.col("relevance").isin(1, 2)).select("query_id", "doc_id").distinct()


def _hits(rankings: DataFrame, truth: DataFrame) -> DataFrame:
    return rankings.select("query_id", "rank", "doc_id").join(
        truth.select("query_id", "doc_id").distinct(), ["query_id", "doc_id"], "left_semi"
    )


def _per_query(rankings: DataFrame, found: DataFrame) -> DataFrame:
    """`found(query_id, value)` completed with 0 for ranked queries without a hit."""
    ranked = rankings.select("query_id").distinct()
    return ranked.join(found, "query_id", "left").select(
        "query_id", F.coalesce("value", F.lit(0.0)).alias("value")
    )


def precision_at(k: int = 100) -> Measure:
    """Relevant documents among the first `k`, divided by `k` even if fewer were ranked."""

    def measure(rankings: DataFrame, truth: DataFrame) -> DataFrame:
        hits = _hits(rankings.filter(F.col("rank") <= k), truth)
        found = hits.groupBy("query_id").agg((F.count("*") / F.lit(float(k))).alias("value"))
        return _per_query(rankings, found)

    return measure


def average_precision(rankings: DataFrame, truth: DataFrame) -> DataFrame:
    """Sum of the precision at each relevant rank over the number of relevant documents.

    Hits are numbered in blocks of ranks, so a query with a very long ranking is not
    sorted in one task.
    """
    block: Column = F.floor((F.col("rank") - 1) / RANK_BLOCK)
    numbered = running_count(_hits(rankings, truth), ["query_id"], [block], [F.col("rank")])
    sums = numbered.groupBy("query_id").agg(F.sum(F.col("n") / F.col("rank")).alias("precisions"))
    judged = truth.select("query_id", "doc_id").distinct().groupBy("query_id").agg(
        F.count("*").alias("relevant")
    )
    found = sums.join(judged, "query_id").select(
        "query_id", (F.col("precisions") / F.col("relevant")).alias("value")
    )
    return _per_query(rankings, found)


def reciprocal_rank(rankings: DataFrame, truth: DataFrame) -> DataFrame:
    """1 / rank of the first relevant document; 0 without one."""
    found = _hits(rankings, truth).groupBy("query_id").agg(
        (F.lit(1.0) / F.min("rank")).alias("value")
    )
    return _per_query(rankings, found)


def mean_measure(rankings: DataFrame, truth: DataFrame, measure: Measure) -> DataFrame:
    """Mean of any measure over the ranked queries; a query without judgments scores 0."""
    return measure(rankings, truth).agg(F.avg("value").alias("mean"))


def randomisation_test(before: DataFrame, after: DataFrame, rounds: int = 1000, seed: int = 7) -> DataFrame:
    """One row (n, gain, p): the mean gain of paired values, and how likely it is without a difference.

    `before` and `after` are (query_id, value); queries that both have count. In each round
    every query's values change sides or stay, by a hash of query, round and seed; `p` is the
    share of rounds, the real one included, whose mean differs from 0 as much as the real one.
    """
    paired = before.select("query_id", F.col("value").alias("b")).join(after.select("query_id", F.col("value").alias("a")), "query_id")
    differences = paired.select("query_id", (F.col("a") - F.col("b")).alias("d"))
    tried = differences.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds))))
    coin = F.pmod(F.xxhash64(F.col("query_id"), F.col("round"), F.lit(seed)), F.lit(2)) == 0
    means = tried.groupBy("round").agg(
        F.count("*").alias("n"), F.avg(F.when((F.col("round") == 0) | coin, F.col("d")).otherwise(-F.col("d"))).alias("mean")
    )
    real = F.max(F.when(F.col("round") == 0, F.col("mean")))
    summed = means.agg(F.max("n").alias("n"), real.alias("gain"), F.collect_list("mean").alias("means"))  # a number per round
    as_far = F.size(F.filter("means", lambda m: F.abs(m) >= F.abs(F.col("gain")) - 1e-12))
    return summed.select("n", "gain", (as_far / F.size("means")).alias("p"))
