"""Counting over plain lists and bags of words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.analysis import plain_words


def unique_elements(elements: DataFrame, n: int = 1) -> DataFrame:
    """(elem, occurrences, first_pos) of the elements that occur at least `n` times.

    `elements(pos, elem)`; `first_pos` gives the order of first appearance.
    """
    return (
        elements.groupBy("elem")
        .agg(F.count("*").alias("occurrences"), F.min("pos").alias("first_pos"))
        .filter(F.col("occurrences") >= n)
    )


def occurrences(elements: DataFrame, item) -> DataFrame:
    """One row: how often `item` occurs."""
    return elements.agg(F.count_if(F.col("elem") == item).alias("occurrences"))


def word_frequencies(docs: DataFrame) -> DataFrame:
    """(doc_id, term, tf) of plain words."""
    return (
        docs.select("doc_id", F.explode(plain_words(F.col("text"))).alias("term"))
        .groupBy("doc_id", "term")
        .agg(F.count("*").alias("tf"))
    )


def feature_vectors(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """(doc_id, vector): counts over a given vocabulary, in its order.

    The words of one text are in one row, so counting needs no shuffle; words outside the
    vocabulary are ignored.
    """
    def count(term: str) -> Column:
        return F.size(F.filter("known", lambda w: w == F.lit(term)))

    known = F.filter(plain_words(F.col("text")), lambda w: w.isin(list(vocabulary)))
    return docs.select("doc_id", known.alias("known")).select(
        "doc_id", F.array(*[count(t) for t in vocabulary]).alias("vector")
    )


def word_map(terms: DataFrame) -> DataFrame:
    """(doc_id, frequencies) with the words of a document as one map."""
    return terms.groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "tf"))).alias("frequencies")
    )


def vector_from_map(frequencies: Column, vocabulary: Sequence[str]) -> Column:
    return F.array(*[F.coalesce(F.try_element_at(frequencies, F.lit(t)), F.lit(0)) for t in vocabulary])
