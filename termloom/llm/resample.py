"""Importance resampling: documents drawn towards the n-gram distribution of a target collection.

Texts are folded byte by byte and split into words; the checksum of an n-gram is the seed of the
next longer one, and its remainder is the feature's bucket. One pass over each side counts the
buckets, with a counter per task and the sums in Spark. Only these tables, one number per bucket,
pass the driver. A second pass adds up each document's gains, and seeded Gumbel noise turns
"the highest scores" into a draw without replacement.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import folded_runs, give_back
from termloom.operators.joins import positions
from termloom.operators.staging import stage

BUCKETS = 10_000
LONGEST = 3
MIN_WORDS = 20
SEED = 42


def features(text: bytes | None, buckets: int = BUCKETS, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray]]:
    """(new words, buckets of the n-grams that end in them) of a text, piece by piece."""
    for _, old, words in folded_runs(text or b"", longest - 1):
        sums = list(map(crc32, words))
        found = [sums[old:]]
        spaced = [b" " + w for w in words] if longest > 1 else []
        for n in range(2, longest + 1):
            sums = list(map(crc32, spaced[n - 1 :], sums))
            found.append(sums[max(0, old - n + 1) :])
        codes = np.fromiter((c for part in found for c in part), dtype=np.uint32, count=sum(map(len, found)))
        yield len(words) - old, codes % buckets


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, hits) over all texts; buckets without a feature have no row, null texts have no features."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counted: Counter[int] = Counter()
        for batch in batches:
            for text in batch["data"]:
                for _, codes in features(text, buckets, longest):
                    counted.update(codes.tolist())
        yield pd.DataFrame({"bucket": list(counted), "hits": list(counted.values())}).astype({"bucket": "int32", "hits": "int64"})
        give_back()

    raw = texts.select(F.col(text_col).cast("binary").alias("data")).mapInPandas(count, "bucket int, hits long")
    return raw.groupBy("bucket").agg(F.sum("hits").alias("hits"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down; a number per bucket."""
    s, t = ({r.bucket: r.hits for r in side.collect()} for side in (source, target))  # `buckets` rows at most
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    ratios = [(float(t.get(b, 0) + 1) * all_s) / (float(s.get(b, 0) + 1) * all_t) for b in range(buckets)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise from a hash of the id, rounded down; no id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, longest: int = LONGEST) -> DataFrame:
    """(id, n_words, n_features, weight) of every document."""
    gain_of = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = gain_of.value
        for batch in batches:
            rows = []
            for text in batch["data"]:
                words = found = weight = 0
                for new, codes in features(text, len(table), longest):
                    words, found, weight = words + new, found + len(codes), weight + int(table[codes].sum())
                rows.append((words, found, weight))
            n_words, n_features, weights = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"id": batch["id"], "n_words": n_words, "n_features": n_features, "weight": weights})
        give_back()

    data = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("data"))
    found = data.mapInPandas(weigh, "id string, n_words long, n_features long, weight long")
    return found.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = (5, 100),
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(id_col, n_features, weight, score, rank): one row per row of `docs`; drawn rows have a rank, from 1.

    Features are all runs of 1 to `longest` words, hashed to `buckets`. Of the N documents with at least `min_words` words,
    `share` of N, rounded down, with the highest scores are drawn; equal scores go by id, those without an id last, then by
    the number of features. Rows that are equal in all of these are interchangeable.

    A null or empty text has no features and weight 0, and is not drawn unless `min_words` is 0. Repeated rows are documents
    of their own. An empty target makes rare features gain; empty `docs` give no rows. Further columns are ignored.
    """
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_col, buckets, longest), buckets)
    noisy = weighed(docs, gain, id_col, text_col, longest).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    scored = stage(noisy, "scored")
    fit = scored.filter(F.col("n_words") >= min_words)
    drawn = share[0] * fit.count() // share[1]
    by = fit.withColumns({"low": -F.col("score"), "no_id": F.col("id").isNull()})
    ranked = positions(by, [], ["low", "no_id", "id", "n_features"]).select(
        "id", "n_features", "weight", "score", F.when(F.col("pos") <= drawn, F.col("pos").cast("long")).alias("rank")
    )
    others = scored.filter(F.col("n_words") < min_words).select("id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.union(others).withColumnRenamed("id", id_col)
