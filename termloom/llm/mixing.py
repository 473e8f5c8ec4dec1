"""Mixing sources to target weights.

The words of a source are packed into blocks of fixed length: its documents, in an order
drawn by hash, are laid end to end and cut every `block_words` words. The mix is made of
shards of `shard_blocks` blocks. For each shard the number of blocks from each source is
drawn from a multinomial, conditioned on every source's total: a seeded binary tree over
the shards splits the totals in two at each node, so any task finds the counts of its
shards, and how many blocks of each source come before them, without asking another one.
The source's k-th slot then takes the block that a pseudorandom permutation of the source's
block numbers maps k to, a new permutation for each time the source is gone through. Blocks
are joined to the slots by source and number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.llm.common import WORD
from termloom.operators.staging import stage

BLOCK_WORDS, SHARD_BLOCKS, SEED = 256, 1024, 20
#: Above so many slots a node of the tree is split in proportion; the draw would change nothing visible.
DRAWN = 500_000_000
#: A word and the blanks after it.
BLANKS = " \t\n\x0b\x0c\r"
SPACED = WORD + r"[\x20\x09-\x0D]*"


@dataclass(frozen=True)
class Source:
    """A source with its size and target, in words, and its blocks and slots."""

    name: str | None
    size: int
    target: float
    block_words: int

    @property
    def blocks(self) -> int:
        return -(-self.size // self.block_words)

    @property
    def words(self) -> int:
        return math.floor(self.target + 0.5)

    def short_place(self, number: int, turn: int, seed: int) -> int:
        """Where in a round the block comes that is shorter than the others."""
        return int(permute(np.array([self.blocks - 1]), self.blocks, _round_key(seed, number, turn), back=True)[0])

    def slots(self, number: int, seed: int) -> int:
        """Slots that hold `words` words, the source being gone through whole again and again."""
        if not self.size:
            return 0
        rounds, rest = divmod(self.words, self.size)
        more = -(-rest // self.block_words)
        short = self.blocks * self.block_words - self.size
        if more * self.block_words - short < rest and self.short_place(number, rounds, seed) < more:
            more += 1
        return rounds * self.blocks + more


def share_out(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Targets in proportion to the weights, none above `most` times its size.

    What a source can't take is shared out by weight among those below their limit, until
    none is above.
    """
    targets, full = [0.0] * len(sizes), [n == 0 for n in sizes]
    while not all(full):
        left = total - sum(most * n for n, f in zip(sizes, full) if f)
        open_weight = sum(w for w, f in zip(weights, full) if not f)
        targets = [most * n if f else left * w / open_weight for n, w, f in zip(sizes, weights, full)]
        above = [not f and t > most * n for n, t, f in zip(sizes, targets, full)]
        if not any(above):
            return targets
        full = [f or a for f, a in zip(full, above)]
    return [most * n for n in sizes]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plan(sized: DataFrame, weights: Sequence[float], factor: float, most: float, block_words: int = BLOCK_WORDS) -> list[Source]:
    """The sources of `sized(source, size)` in order of code point, null last, with their targets.

    `weights` repeat over the sources. One row per source comes to the driver: like the
    weights, that is the recipe of a mix, not its data.
    """
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows = sorted(((r["source"], int(r["size"])) for r in rows), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [n for _, n in rows]
    own = [weights[i % len(weights)] for i in range(len(rows))]
    targets = share_out(sizes, own, factor * sum(sizes), most)
    return [Source(name, n, t, block_words) for (name, n), t in zip(rows, targets)]


def source_table(spark: SparkSession, sources: Sequence[Source]) -> DataFrame:
    """(number, source, source_size, target), a row per source."""
    rows = [(i, s.name, s.size, float(s.target)) for i, s in enumerate(sources)]
    return spark.createDataFrame(rows, "number int, source string, source_size long, target double")


def _draw(totals: np.ndarray, slots: int, node: Sequence[int], seed: int) -> np.ndarray:
    """How many of each source's slots fall to the first `slots` of a node's slots."""
    every = int(totals.sum())
    if every > DRAWN:
        share = np.floor(totals * (slots / every)).astype(np.int64)
        order = np.argsort(-(totals * (slots / every) - share), kind="stable")
        share[order[: slots - int(share.sum())]] += 1
        return share
    rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, *node])))
    return rng.multivariate_hypergeometric(totals, slots, method="marginals")


def shard_counts(totals: np.ndarray, shard_blocks: int, first: int, last: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, blocks of each source before it, blocks of each source in it) for shards first..last-1."""
    shards = -(-int(totals.sum()) // shard_blocks)

    def walk(low: int, high: int, before: np.ndarray, own: np.ndarray):
        if high <= first or low >= last:
            return
        if high - low == 1:
            yield low, before, own
            return
        middle = (low + high) // 2
        left = _draw(own, (middle - low) * shard_blocks, (low, high), seed)
        yield from walk(low, middle, before, left)
        yield from walk(middle, high, before + left, own - left)

    if shards:
        yield from walk(0, shards, np.zeros_like(totals), totals)


def _scramble(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permute(numbers: np.ndarray, size: int, key: int, back: bool = False) -> np.ndarray:
    """Images of `numbers` under a pseudorandom permutation of 0..size-1, or what they are images of.

    Four Feistel rounds permute the next even power of two; numbers that leave the range
    are sent on until they come back to it.
    """
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & low
        for turn in range(3, -1, -1) if back else range(4):
            if back:
                left, right = right ^ (_scramble(left, key * 4 + turn) & low), left
            else:
                left, right = right, left ^ (_scramble(right, key * 4 + turn) & low)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def _round_key(seed: int, number: int, turn: int) -> int:
    return (seed * 1_000_003 + int(number)) * 1_000_003 + int(turn)


def slots(spark: SparkSession, sources: Sequence[Source], shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """(shard, slot, number, block, words): the mix as a list of block numbers.

    `words` is how many words of the block are taken: all of them, but for the last slot of
    a source, which stops at the source's target.
    """
    totals = np.array([s.slots(i, seed) for i, s in enumerate(sources)], dtype=np.int64)
    shards = -(-int(totals.sum()) // shard_blocks)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            first, last = int(batch["id"].min()), int(batch["id"].max()) + 1
            for shard, before, own in shard_counts(totals, shard_blocks, first, last, seed):
                parts = []
                for i in np.flatnonzero(own):
                    source = sources[i]
                    k = np.arange(before[i], before[i] + own[i])
                    block = np.empty(len(k), dtype=np.int64)
                    for turn in np.unique(k // source.blocks):
                        at = k // source.blocks == turn
                        block[at] = permute(k[at] % source.blocks, source.blocks, _round_key(seed, i, turn))
                    parts.append(_taken(source, i, k, block, seed))
                rows = pd.concat(parts, ignore_index=True)
                order = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, shard]))).permutation(len(rows))
                yield rows.assign(shard=shard, slot=order)[["shard", "slot", "number", "block", "words"]]

    shard_ids = spark.range(0, shards, 1, max(1, min(shards, spark.sparkContext.defaultParallelism * 4)))
    return shard_ids.mapInPandas(fill, "shard long, slot int, number int, block long, words int")


def _taken(source: Source, number: int, k: np.ndarray, block: np.ndarray, seed: int) -> pd.DataFrame:
    """Words taken by a source's slots k, which hold these blocks."""
    last = source.blocks - 1
    words = np.where(block == last, source.size - last * source.block_words, source.block_words)
    end = source.slots(number, seed) - 1
    if k[0] <= end <= k[-1]:
        # the slots before the last one hold whole blocks; is the short one among this round's?
        turn, in_round = divmod(end, source.blocks)
        short = source.blocks * source.block_words - source.size
        before = turn * source.size + in_round * source.block_words
        before -= short if source.short_place(number, turn, seed) < in_round else 0
        words = np.where(k == end, np.clip(source.words - before, 0, words), words)
    return pd.DataFrame({"number": np.int32(number), "block": block, "words": words.astype(np.int32)})


def placed(docs: DataFrame, sources: Sequence[Source]) -> DataFrame:
    """Adds `start`: the place of a document's first word among the words of its source.

    `docs` has number, size and the document's columns `doc_id` and `text_hash`. Places are
    running sums in two steps, within buckets drawn by hash and over the buckets; with the
    square root of the rows for the number of buckets, no task sorts more than about that
    many rows of one source, however large it is.
    """
    spark = docs.sparkSession
    rows = docs.count()
    buckets = max(1, math.isqrt(rows // 4))
    drawn = docs.withColumn("drawn", F.xxhash64("doc_id", "text_hash", F.lit(SEED))).withColumn("bucket", F.pmod("drawn", F.lit(buckets)).cast("int"))
    totals = drawn.groupBy("number", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumn("before", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))).drop("bucket_size")
    inside = Window.partitionBy("number", "bucket").orderBy("drawn", "doc_id", "text_hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        drawn.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(before, ["number", "bucket"])
        .withColumn("start", F.col("before") + F.col("inside"))
        .drop("drawn", "bucket", "before", "inside")
    )


def pieces(places: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and block it reaches into: `block`, and its words' `low` and `high` in it."""
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    edge = F.col("block") * block_words
    return (
        places.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
        .withColumn("low", F.greatest(F.col("start") - edge, F.lit(0)).cast("int"))
        .withColumn("high", F.least(F.col("start") + F.col("size") - edge, F.lit(block_words)).cast("int"))
    )


def prepared(docs: DataFrame, source_col: str, text_col: str, id_col: str) -> DataFrame:
    """(doc_id, source, size, text_hash) of every row, staged: the small side of everything below."""
    return stage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.xxhash64(text_col).alias("text_hash"),
    ), "sized")


def mixed_counts(docs: DataFrame, weights: Sequence[float], factor: float, most: float, source_col: str = "source",
                 text_col: str = "text", id_col: str = "doc_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row: the words the mix takes from each document.

    Defined cases: null and empty texts, and texts of blanks, have size 0 and are taken 0
    times; a null source is a source; equal rows are documents of their own, and a mix of
    them is the same on every run as they are alike; an empty table gives no row; further
    columns are ignored. A source's words add up to its target, rounded to a word.
    """
    spark = docs.sparkSession
    sized = prepared(docs, source_col, text_col, id_col)
    sources = plan(sized, weights, factor, most, block_words)
    known = F.broadcast(source_table(spark, sources))  # a row per source, as collected by `plan`
    numbered = sized.join(known, sized["source"].eqNullSafe(known["source"])).drop("source")
    places = stage(placed(numbered, sources), "places")
    drawn = slots(spark, sources).groupBy("number", "block").agg(F.collect_list("words").alias("draws"))
    cut = pieces(places.select("doc_id", "text_hash", "number", "start", "size"), block_words)
    # a block is drawn at most `most` times, rounded up
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda sum_, words: sum_ + F.greatest(
        F.least(words, F.col("high")) - F.col("low"), F.lit(0)).cast("long"))
    # the slots come from a range, so Spark takes them for few rows: they must not be broadcast
    found = cut.join(drawn.hint("merge"), ["number", "block"]).groupBy("number", "start", "doc_id").agg(F.sum(taken).alias("taken"))
    key = (F.col("p.number") == F.col("t.number")) & (F.col("p.start") == F.col("t.start")) & (F.col("p.size") > 0)
    return places.alias("p").join(found.hint("merge").alias("t"), key, "left").select(
        F.col("p.doc_id").alias("doc_id"), "p.size", "p.source_size", "p.target", F.coalesce("t.taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_texts(docs: DataFrame, weights: Sequence[float], factor: float, most: float, source_col: str = "source",
                text_col: str = "text", id_col: str = "doc_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix itself: a row per slot and document in it, with all columns of `docs`.

    `text_col` is the part of the text that the slot takes, blanks within it unchanged;
    `shard`, `slot` and `low` (the part's place in the block) put the mix in order. A column
    of `docs` with one of these names is replaced. Texts are moved twice: to their place in
    the source and, cut into pieces, to the slots.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ("shard", "slot", "low")]
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in own if c != text_col]).alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(source_col).alias("source"), F.col(text_col).alias("text"), word_count(F.col(text_col)).alias("size"))
    sources = plan(kept.select("source", "size"), weights, factor, most, block_words)
    known = F.broadcast(source_table(spark, sources))
    numbered = kept.filter("size > 0").join(known, kept["source"].eqNullSafe(known["source"])).select(
        "row", "doc_id", "text", "size", F.xxhash64("text").alias("text_hash"), "number")

    # words with the blanks after them, found once per text and bound to a name, so that no part of a text looks for them again
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)

    def part(words: Column, block: Column) -> Column:
        low = F.greatest(F.col("start") - block * block_words, F.lit(0)).cast("int")
        high = F.least(F.col("start") + F.col("size") - block * block_words, F.lit(block_words)).cast("int")
        place = (block * block_words + low - F.col("start") + 1).cast("int")
        return F.struct(block.alias("block"), low.alias("low"), high.alias("high"), joined_words(F.slice(words, place, high - low)).alias("text"))

    words = F.regexp_extract_all("text", F.lit(SPACED), F.lit(0))

    def joined_words(found: Column) -> Column:
        return F.rtrim(F.array_join(found, ""), F.lit(BLANKS))

    cut = F.transform(F.array(words), lambda w: F.transform(F.sequence(first, last), lambda b: part(w, b)))
    parts = placed(numbered, sources).select("row", "number", F.explode(cut[0]).alias("part")).select("row", "number", "part.*")
    drawn = slots(spark, sources)
    room = F.least("words", F.col("high")) - F.col("low")
    joined = parts.join(drawn.hint("merge"), ["number", "block"]).withColumn("room", room).filter("room > 0")
    shortened = joined_words(F.slice(words, F.lit(1), F.col("room").cast("int")))
    whole = F.when(F.col("room") == F.col("high") - F.col("low"), F.col("text")).otherwise(shortened)
    names = [F.col("taken_text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in own]
    return joined.withColumn("taken_text", whole).select(*names, "shard", "slot", "low")
