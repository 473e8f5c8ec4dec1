"""Exact top-k search by distributed histogram selection.

Queries are taken in blocks of a fixed size; a block goes to all tasks and every vector is
scored against it. In each round a task adds its scores to a histogram per query, the
histograms are summed, and the bin that holds the k-th best score becomes the next round's
range, until it is one score wide. Then the k-th score is known, a last pass returns the
better scores and the first of its ties, and ranks are given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.staging import new_path, stage

QUERY_BLOCK, BINS = 2048, 64


def whole_numbers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of every component; null for vectors that are null, empty or hold a null, NaN or infinity."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    usable = F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))
    return F.when(usable, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def _scored(rows: DataFrame, queries: np.ndarray, query_ids: np.ndarray, use, schema: str) -> DataFrame:
    """`use(scores, ids)` over every batch: scores of all queries (rows) with its vectors (columns).

    A query's score with its own row is lowered below all others. Sums of products are exact
    in doubles below 2 to the power of 53.
    """
    shared = rows.sparkSession.sparkContext.broadcast((queries, query_ids))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, own_ids = shared.value

        def scores() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                for at in range(0, len(batch), 1024):
                    part = batch.iloc[at : at + 1024]
                    ids = part["id"].to_numpy()
                    found = own @ np.stack(part["vector"].to_numpy()).astype(np.float64).T
                    found[own_ids[:, None] == ids[None, :]] = -np.inf
                    yield found, ids

        yield from use(scores())

    return rows.mapInPandas(run, schema)


def _kth_scores(rows: DataFrame, queries: np.ndarray, ids: np.ndarray, k: int, bound: np.ndarray) -> np.ndarray:
    """The k-th best score of every query; less than all scores for a query with fewer than k.

    The driver holds a range a query, and one histogram a query and round; a query block's
    size bounds both.
    """
    low, width, few = -bound, 2 * bound + 1, np.zeros(len(ids), dtype=bool)
    while (width > 1).any():
        step = -(-width // BINS)

        def histogram(scores: Iterator, low=low, step=step) -> Iterator[pd.DataFrame]:
            counts = np.zeros(len(low) * (BINS + 1), dtype=np.int64)
            for found, _ in scores:
                q, c = np.nonzero(found >= low[:, None])
                # the last bin is for scores above the range
                place = np.minimum((found[q, c] - low[q]) // step[q], BINS).astype(np.int64)
                counts += np.bincount(q * (BINS + 1) + place, minlength=len(counts))
            at = np.flatnonzero(counts)
            yield pd.DataFrame({"query": at // (BINS + 1), "bin": (at % (BINS + 1)).astype(np.int32), "times": counts[at]})

        summed = _scored(rows, queries, ids, histogram, "query long, bin int, times long").groupBy("query", "bin").agg(
            F.sum("times").alias("times")
        ).toPandas()
        counts = np.zeros((len(ids), BINS + 1), dtype=np.int64)
        counts[summed["query"].to_numpy(), summed["bin"].to_numpy()] = summed["times"].to_numpy()
        from_here = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]  # scores in this bin or a higher one
        few |= from_here[:, 0] < k
        best = BINS - np.argmax(from_here[:, ::-1] >= k, axis=1)
        low, width = np.where(few, low, low + best * step), np.where(few, 1, step)
    return np.where(few, -np.inf, low)


def _first_ties(query: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest ids of every query."""
    order = np.lexsort((own, query))
    query, own = query[order], own[order]
    new = np.flatnonzero(np.diff(query, prepend=-1))
    place = np.arange(len(query)) - np.repeat(new, np.diff(np.append(new, len(query))))
    return query[place < k], own[place < k]


def search(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k best other rows by inner product, ties to the smaller id.

    Defined cases: vectors that are null, empty or hold a null or non-finite component take
    no part, nor do rows without an id; vectors of other lengths than a query's are not
    scored with it; of rows with the same id all are candidates, but none for a query of that
    id, and of query rows with the same id the one with the smallest vector, compared number by number, asks; a query with fewer than k candidates gets all; an empty table gives no row; further
    columns are ignored.
    """
    rows = stage(vectors.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), whole_numbers(F.col(vector_col), scale).alias("vector"), is_query.alias("asks"),
    ).filter("vector IS NOT NULL"), "vectors")
    sizes = rows.groupBy(F.size("vector").alias("size"), "asks").agg(
        F.count("*").alias("rows"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("norm"),
        F.min("id").alias("low"), F.max("id").alias("high"),
    ).collect()
    path = new_path(vectors.sparkSession, "nearest")
    schema = "query_id long, rank int, vec_id long, score long"
    vectors.sparkSession.createDataFrame([], schema).write.parquet(path)
    for size in sorted({r["size"] for r in sizes}):
        same = rows.filter(F.size("vector") == size).select("id", "vector", "asks")
        longest = max(r["norm"] for r in sizes if r["size"] == size)
        for asked in _query_blocks(same.filter("asks").select("id", "vector"), sum(r["rows"] for r in sizes if r["size"] == size and r["asks"])):
            _search_block(same.select("id", "vector"), asked, k, longest).write.mode("append").parquet(path)
    return vectors.sparkSession.read.schema(schema).parquet(path)


def _query_blocks(queries: DataFrame, count: int) -> Iterator[pd.DataFrame]:
    """The queries, at most about `QUERY_BLOCK` at a time, by ranges of their ids."""
    blocks = -(-count // QUERY_BLOCK)
    if blocks <= 1:
        ranges = [(None, None)] if count else []
    else:
        cuts = queries.approxQuantile("id", [i / blocks for i in range(1, blocks)], 0.1 / blocks)
        edges = [None, *sorted({int(c) for c in cuts}), None]
        ranges = list(zip(edges[:-1], edges[1:]))
    for low, high in ranges:
        part = queries
        part = part if low is None else part.filter(F.col("id") >= low)
        part = part if high is None else part.filter(F.col("id") < high)
        yield part.groupBy("id").agg(F.min("vector").alias("vector")).toPandas()


def _search_block(rows: DataFrame, asked: pd.DataFrame, k: int, longest: float) -> DataFrame:
    ids = asked["id"].to_numpy()
    queries = np.stack(asked["vector"].to_numpy()).astype(np.float64)
    # no score is larger than the product of the two lengths
    bound = np.floor(np.sqrt((queries**2).sum(axis=1)) * np.sqrt(longest)).astype(np.int64) + 1
    kth = _kth_scores(rows, queries, ids, k, bound)

    def kept(scores: Iterator) -> Iterator[pd.DataFrame]:
        """Scores above the k-th, and of its ties the k smallest ids: ties never pile up."""
        tied = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for found, own in scores:
            q, c = np.nonzero((found == kth[:, None]) & np.isfinite(found))
            tied = _first_ties(np.concatenate([tied[0], q]), np.concatenate([tied[1], own[c]]), k)
            q, c = np.nonzero(found > kth[:, None])
            yield pd.DataFrame({"query_id": ids[q], "vec_id": own[c], "score": found[q, c].astype(np.int64)})
        yield pd.DataFrame({"query_id": ids[tied[0]], "vec_id": tied[1], "score": kth[tied[0]].astype(np.int64)})

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        _scored(rows, queries, ids, kept, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
