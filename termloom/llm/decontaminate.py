"""Benchmark decontamination by winnowing.

Of every `SPAN` neighbouring k-grams the one with the smallest hash is kept, the rightmost of
equal ones. Two texts that share `WINDOW` words thus keep the same k-gram inside them. Kept
hashes of documents and of benchmark items are joined; a match fixes a diagonal, along which the
words of both are compared, so hits are extended as far as they go and chance matches fall away.

Items are cut into overlapping pieces, equal pieces are one, and documents with equal texts are
compared once: what moves is fingerprints, and the texts that hold a match.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import folded_runs, give_back
from termloom.operators.joins import fits_broadcast, lookup_join
from termloom.operators.staging import stage

WINDOW = 10
GRAM = 6
#: Words of a piece of an item; pieces overlap by all but one word of a window.
PIECE = 256
KEY = ["k1", "k2"]


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every `k` neighbouring words, from their checksums; `k` is part of the hash."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
        hashed ^= hashed >> np.uint64(29)
    return hashed * np.uint64(0xBF58476D1CE4E5B9)


def winnow(hashes: np.ndarray, span: int) -> np.ndarray:
    """Positions of the smallest hash of every `span` neighbours, rightmost of equal ones, each once."""
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best, where = hashes[:n].copy(), np.arange(n)
    for i in range(1, span):
        other = hashes[i : i + n]
        less = other <= best
        best[less] = other[less]
        where[less] = np.flatnonzero(less) + i
    return where[np.append(True, where[1:] != where[:-1])]


def fingerprints(words: list[bytes], window: int, gram: int, short: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) by which runs of `window` words, and of the shorter lengths in `short`, are found."""
    codes = np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words))
    grams = gram_hashes(codes, gram)
    at = winnow(grams, window - gram + 1)
    found, places = [grams[at]], [at]
    for n in short:
        whole = gram_hashes(codes, n) ^ np.uint64(0x5555555555555555)
        found.append(whole)
        places.append(np.arange(len(whole)))
    return np.concatenate(found).view(np.int64), np.concatenate(places).astype(np.int32)


def piece_fingerprints(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The same of a piece, for the first occurrence of each of its windows; a short piece has one, for its whole."""
    if len(words) < window:
        hashes, at = fingerprints(words, window, gram, [len(words)])
        return hashes, at
    codes = np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words))
    grams = gram_hashes(codes, gram)
    span, seen, kept = window - gram + 1, set(), set()
    for i in range(len(words) - window + 1):
        own = tuple(words[i : i + window])
        if own not in seen:
            seen.add(own)
            kept.add(i + int(winnow(grams[i : i + span], span)[0]))
    at = np.array(sorted(kept), dtype=np.int64)
    return grams[at].view(np.int64), at.astype(np.int32)


def pieces_of(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, words, n): the pieces of every item, words joined by spaces; an item without words has none."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = PIECE - window + 1
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["data"]):
                words = [w for _, _, run in folded_runs(text or b"", 0) for w in run]
                parts = [words[i : i + PIECE] for i in range(0, max(1, len(words) - window + 1), step)] if words else []
                rows += [(item, b" ".join(p), len(p)) for p in parts]
            yield pd.DataFrame(rows, columns=["item", "words", "n"])

    raw = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("data"))
    return raw.mapInPandas(cut, "item string, words binary, n int")


def keyed(docs: DataFrame, text_col: str) -> tuple:
    """128 bits that tell a text."""
    return F.xxhash64(text_col).alias("k1"), F.xxhash64(F.lit(1), text_col).alias("k2")


def extend(words: list[bytes], found: list, window: int) -> tuple[int, list[int]]:
    """(hit words, pieces with an occurring window) of a text, given (piece, diagonal, words of the piece)."""
    hit, held = bytearray(len(words)), set()
    for piece, diagonal, text in found:
        other = text.split(b" ")
        need, low = min(window, len(other)), max(0, diagonal)
        same = bytes(map(eq, words[low : diagonal + len(other)], other[low - diagonal :]))
        start = same.find(b"\1" * need)
        while start >= 0:
            end = same.find(b"\0", start)
            end = len(same) if end < 0 else end
            hit[low + start : low + end] = b"\1" * (end - start)
            held.add(piece)
            start = same.find(b"\1" * need, end)
    return sum(hit), sorted(held)


def text_hits(docs: DataFrame, pieces: DataFrame, text_col: str, window: int, gram: int) -> DataFrame:
    """(k1, k2, n_hit, pieces): distinct texts of `docs` that hold a window of one of `pieces(piece, words, n)`."""
    # fewer numbers than a window has words
    short = sorted(r.n for r in pieces.filter(F.col("n") < window).select("n").distinct().collect())

    def of_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for piece, words in zip(batch["piece"], batch["words"]):
                hashes, at = piece_fingerprints(words.split(b" "), window, gram)
                yield pd.DataFrame({"hash": hashes, "piece": piece, "q": at})

    def of_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k1, k2, hashes, places = [], [], [], []
            for a, b, text in zip(batch["k1"], batch["k2"], batch["data"]):
                for first, _, words in folded_runs(text, window - 1):
                    found, at = fingerprints(words, window, gram, short)
                    k1.append(a), k2.append(b), hashes.append(found), places.append(at + np.int32(first))
            yield pd.DataFrame({"k1": k1, "k2": k2, "hashes": hashes, "places": places})
        give_back()

    asked = stage(pieces.select("piece", "words").mapInPandas(of_pieces, "hash long, piece long, q int"), "asked")
    texts = docs.filter(F.col(text_col).isNotNull()).select(*keyed(docs, text_col), F.col(text_col).cast("binary").alias("data"))
    marks = texts.mapInPandas(of_texts, "k1 long, k2 long, hashes array<long>, places array<int>").select(
        *KEY, F.inline(F.arrays_zip(F.col("hashes").alias("hash"), F.col("places").alias("p")))
    )
    # one row per text, piece and diagonal, however many fingerprints agree on it and however often the text occurs
    met = marks.join(F.broadcast(asked) if fits_broadcast(asked) else asked, "hash")
    diagonals = met.select(*KEY, "piece", (F.col("p") - F.col("q")).alias("diagonal")).distinct()
    spelled = lookup_join(diagonals, pieces.select("piece", "words"), ["piece"], fits_broadcast(pieces), spread_by="k1")
    listed = stage(spelled.groupBy(*KEY).agg(F.collect_list(F.struct("piece", "diagonal", "words")).alias("found")), "candidates")
    keys = listed.select(*KEY)
    own = texts.join(F.broadcast(keys) if fits_broadcast(keys) else keys, KEY, "left_semi").dropDuplicates(KEY)

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, found in zip(batch["data"], batch["found"]):
                words = [w for _, _, run in folded_runs(text, 0) for w in run]
                rows.append(extend(words, [(int(f["piece"]), int(f["diagonal"]), f["words"]) for f in found], window))
            yield pd.DataFrame({
                "k1": batch["k1"], "k2": batch["k2"], "n_hit": [n for n, _ in rows], "pieces": [p for _, p in rows],
            })

    schema = "k1 long, k2 long, n_hit long, pieces array<long>"
    return own.join(listed, KEY).mapInPandas(compared, schema).filter("n_hit > 0")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """(id_col, n_words, n_hit, n_items, items, contaminated): one row per row of `docs`.

    A window is `window` consecutive words of an item, or all of a shorter one that has any. `n_hit` counts the words inside
    an occurrence of a window, `items` has the ids of the items with an occurring window as strings, sorted, each once.

    A null text has no words. Items without an id mark words, but are not counted among the items; rows with one item id and
    different texts are one item. Repeated documents get a row each. Empty tables, of either kind, give no hits. Texts are
    told by 128-bit hashes. The items of one set of pieces are listed in one row, as the result has them.
    """
    cut = stage(pieces_of(items, item_col, item_text_col, window), "cut")
    pieces = stage(cut.select("words", "n").distinct().withColumn("piece", F.monotonically_increasing_id()), "pieces")
    found = stage(text_hits(docs, pieces, text_col, window, gram), "hits")
    holders = cut.join(pieces.select("words", "piece"), "words").select("piece", "item").distinct()
    sets = found.select("pieces").distinct()
    named = (
        sets.select("pieces", F.explode("pieces").alias("piece")).join(holders, "piece")
        .groupBy("pieces").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    known = stage(found.join(named, "pieces").select(*KEY, "n_hit", "items"), "known")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = [sum(len(run) for _, _, run in folded_runs(text or b"", 0)) for text in batch["data"]]
            yield batch[["id", *KEY]].assign(n_words=sizes)
        give_back()

    counted = docs.select(
        F.col(id_col).cast("string").alias("id"), *keyed(docs, text_col), F.col(text_col).cast("binary").alias("data")
    ).mapInPandas(count, "id string, k1 long, k2 long, n_words long")
    rows = counted.join(F.broadcast(known) if fits_broadcast(known) else known, KEY, "left")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"), items_of.alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
