"""Joins and running counts that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.staging import stage

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16
ROW_OVERHEAD = 64


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure `df` with one aggregate over it: does it stay below `limit` bytes?

    Nested columns count as long as they are written out, numbers are part of a row's overhead.
    """
    width = F.lit(ROW_OVERHEAD)
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith("array<string"):
            width = width + F.coalesce(F.octet_length(F.array_join(name, " ")), F.lit(0))
            width = width + 8 * F.greatest(F.size(name), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(name)))), F.lit(0))
    return (df.agg(F.sum(width.cast("long"))).first()[0] or 0) <= limit


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    small: bool,
    how: str = "inner",
    spread_by: str = "doc_id",
) -> DataFrame:
    """Join `rows` with a table that describes its keys.

    `small` says that `lookup` was measured to fit a broadcast. Otherwise every key of
    `rows` is split over `SALTS` parts by a hash of `spread_by`, so a key that owns a third
    of the rows still lands in many tasks, and `lookup` is repeated once per part. Both then meet
    sorted: Spark would judge `lookup` by the size of its files, which packed text keeps far below its rows.
    """
    on = list(on)
    if small:
        return rows.join(F.broadcast(lookup), on, how)
    parts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    return salted.join(lookup.withColumn("salt", F.explode(parts)).hint("merge"), [*on, "salt"], how).drop("salt")


def hot_key_join(
    rows: DataFrame, lookup: DataFrame, key: str, hot: Column, spread_by: str = "doc_id"
) -> DataFrame:
    """Inner join with a table of unique keys that is too large to repeat as a whole.

    `hot` picks the rows of `lookup` whose keys are frequent. Only those keys are split
    over `SALTS` parts. `lookup` should be staged: its hot keys are read on their own.
    """
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    frequent = lookup.filter(hot).select(key, F.lit(True).alias("is_hot"))
    part = F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int")
    if fits_broadcast(frequent):
        salted = rows.join(F.broadcast(frequent), key, "left").withColumn(
            "salt", F.when(F.col("is_hot"), part).otherwise(0)
        ).drop("is_hot")
        repeated = lookup.withColumn("salt", F.explode(F.when(hot, every).otherwise(F.array(F.lit(0)))))
    else:
        salted = rows.withColumn("salt", part)
        repeated = lookup.withColumn("salt", F.explode(every))
    return salted.join(repeated, [key, "salt"]).drop("salt")


def running_count(
    rows: DataFrame, keys: Sequence[str], block: Sequence[Column], order: Sequence[Column]
) -> DataFrame:
    """Number the rows of each key 1, 2, ... in (block, order) as column `n`.

    Counting runs inside blocks first and then over the block totals, so no task has to
    sort all rows of one key.
    """
    keys = list(keys)
    names = [f"block_{i}" for i in range(len(block))]
    rows = rows.withColumns(dict(zip(names, block)))
    totals = rows.groupBy(*keys, *names).agg(F.count("*").alias("block_rows"))
    before = totals.withColumn(
        "before",
        F.coalesce(
            F.sum("block_rows").over(
                Window.partitionBy(*keys).orderBy(*names).rowsBetween(
                    Window.unboundedPreceding, -1
                )
            ),
            F.lit(0),
        ),
    ).drop("block_rows")
    inside = F.row_number().over(Window.partitionBy(*keys, *names).orderBy(*order))
    return (
        rows.withColumn("inside", inside)
        .join(before, [*keys, *names])
        .withColumn("n", F.col("before") + F.col("inside"))
        .drop("before", "inside", *names)
    )


def positions(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number the rows of each key 1, 2, ... by `order`, as column `pos`.

    Rows are cut by ranges of key and order, equal ones by chance, so a key with a third of
    all rows lies in many ranges. The ranges are staged, since counting reads them twice.
    """
    ranged = rows.withColumn("tie", F.rand(7)).repartitionByRange(*keys, *order, "tie")
    cut = stage(ranged.withColumn("range", F.spark_partition_id()), "ranges")
    numbered = running_count(cut, keys, [F.col("range")], [*map(F.col, order), F.col("tie")])
    return numbered.withColumnRenamed("n", "pos").drop("range", "tie")


def top_k(scores: DataFrame, k: int, decimals: int = 6) -> DataFrame:
    """Best `k` documents per query by (score, doc_id), both descending, with their rank.

    The score is rounded first so that a tie is a tie on every engine. Spark cuts each
    task's rows to `k` per query before the shuffle, so a query matching a third of all
    documents sends at most `k` rows per task.
    """
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("doc_id"))
    return (
        scores.withColumn("score", F.round("score", decimals))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "doc_id", "score")
    )
