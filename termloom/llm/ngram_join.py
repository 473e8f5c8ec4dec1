"""Similarity join on sets of word n-grams by token-combination prefixes.

Tokens of a set are put in one global order, by the number of documents that hold their
rarest word (an upper bound for the token's own) and then by hash. Two sets of at least
the wanted similarity agree somewhere in their prefixes. A prefix is as long as it must be
for that when a rare token counts by itself, and the frequent ones of a class (a part of
the hash space) only in combinations of two: it ends where the rare tokens plus, for each
class, its tokens less one reach the number of tokens that the other set may lack, plus
one. So rare tokens are indexed alone and frequent ones in pairs. A token whose rarest word
occurs in one document can't be shared and is not indexed at all.

Sets that share an index key are pairs to look at: first each with one set of its key, then,
once what is linked has been joined, any two of still different groups. Sizes and short
sketches rule most pairs out; the others are verified on their whole sets.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm import blocks
from termloom.operators.staging import stage

WORDS, SIMILARITY = 5, 0.8
#: Tokens whose rarest word more documents hold are frequent: indexed in pairs.
FREQUENT = 64
#: Tokens of a set in each class of frequent tokens, about, before the set is cut to its prefix.
CLASS_TOKENS = 16

MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def split_words(text: str) -> list[bytes]:
    """A-Z lower-cased; `bytes.split` cuts at space and the ASCII controls from tab to return only."""
    return text.encode().lower().split()


def tokens_of(codes: np.ndarray, hashes: np.ndarray, docs_with: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct token hashes of a document, ascending, and the bound on the documents that hold each."""
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    width = min(words, len(codes))
    token = np.full(len(codes) - width + 1, width, dtype=np.uint64)
    rarest = np.full(len(token), np.iinfo(np.int64).max)
    for k in range(width):
        part = codes[k : k + len(token)]
        token = (token ^ hashes[part]) * MIX
        token ^= token >> np.uint64(32)
        token *= STEP
        rarest = np.minimum(rarest, docs_with[part])
    token ^= token >> np.uint64(29)
    distinct, first = np.unique(token, return_index=True)
    return distinct, rarest[first]


def _size_class(n: int) -> int:
    return n.bit_length() - 1


def index_keys(tokens: np.ndarray, bound: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys under which a set is indexed, and for each the most tokens it leaves to have in common.

    The room of a key holds for a pair's first key: the one whose last token comes first in
    the order. Common tokens before that one are at most one for each class of frequent
    tokens, so the overlap is at most those and the tokens from there on.

    Sets are compared within a size class, that of the larger one; so a set is indexed for
    its own class and for that of the largest set it can be similar to. Sets of one token
    are similar to equal sets only, which are one set here, and need no key.
    """
    n = len(tokens)
    if n < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    must_have = n - math.ceil(round(similarity * n, 9)) + 1
    order = np.lexsort((tokens, bound))
    tokens, bound = tokens[order], bound[order]
    frequent = bound > FREQUENT
    keys, rooms = [], []
    for size_class in sorted({_size_class(n), _size_class(int(n / similarity))}):
        classes = max(1, (1 << size_class) // CLASS_TOKENS)
        counts = np.ones(n, dtype=np.int64)
        kind = (tokens % np.uint64(classes)).astype(np.int64)
        places = np.flatnonzero(frequent)
        _, first = np.unique(kind[places], return_index=True)
        counts[places[first]] = 0  # the first of a class adds no pair
        end = int(np.searchsorted(np.cumsum(counts), must_have)) + 1
        own = tokens[:end]
        rare = np.flatnonzero(~frequent[:end] & (bound[:end] > 1))
        keys.append(own[rare])
        rooms.append(n - rare)
        places = np.flatnonzero(frequent[:end])
        by_class = places[np.argsort(kind[places], kind="stable")]
        for group in np.split(by_class, np.flatnonzero(np.diff(kind[by_class])) + 1):
            if len(group) > 1:
                a, b = np.triu_indices(len(group), 1)
                x, y = own[group[a]], own[group[b]]
                keys.append((((x ^ (y * MIX)) * STEP) ^ np.uint64(size_class + 1)) * MIX)
                rooms.append(n - group[b] + classes)
    keys, rooms = np.concatenate(keys), np.concatenate(rooms)
    order = np.lexsort((-rooms, keys))
    keys, rooms = keys[order], rooms[order]
    first = np.diff(keys, prepend=keys[:1] ^ np.uint64(1)) != 0
    return keys[first], np.minimum(rooms[first], n)


def _sums(words: list[bytes], docs_with: np.ndarray, _: int) -> list[bytes]:
    return [n.tobytes() for n in docs_with.astype("<i8")]


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, comp): the smallest node that can be reached over `edges(a, b)`.

    Labels are lowered to the smallest of the neighbours' and then to their label's own
    label, which halves the distance to it; every round is a staged table.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = stage(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("comp")).withColumnRenamed("a", "node"), f"{name}-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        lower = stage(
            labels.join(near.withColumnRenamed("a", "node"), "node")
            .select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp")), f"{name}-lower"
        )
        jumped = stage(
            lower.join(lower.select(F.col("node").alias("comp"), F.col("comp").alias("next")), "comp")
            .select("node", F.least("comp", "next").alias("comp"), (F.least("comp", "next") != F.col("was")).alias("moved")),
            f"{name}-labels",
        )
        labels = jumped.select("node", "comp")
        if not jumped.filter("moved").limit(1).count():
            return labels


def sketch(tokens: np.ndarray) -> bytes:
    """A bit per token, flipped by every token that hashes to it; about as many bits as tokens.

    Two sketches differ in at most as many bits as the sets have tokens of their own, so
    they give a bound on the similarity for a fraction of the bytes.
    """
    bits = 1 << max(6, (len(tokens) - 1).bit_length())
    return np.packbits((np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def sketches_differ(left: bytes, right: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the length of the other."""
    a, b = np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)
    while len(a) != len(b):
        if len(a) > len(b):
            a, b = b, a
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _maybe_similar(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out.

    Of two sets with similarity s, at most (1 - s) / (1 + s) of the sum of their sizes are
    tokens of one set only.
    """
    share = round(similarity * 100)

    @F.pandas_udf("int")
    def differ(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([sketches_differ(a, b) for a, b in zip(left, right)], dtype="int32")

    left = sketches.select(F.col("loc").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("left"))
    right = sketches.select(F.col("loc").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("right"))
    fitting = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * share)
    return (
        pairs.join(right, "b").join(left, "a").filter(fitting)
        .filter(differ("left", "right") * (100 + share) <= (100 - share) * (F.col("n_a") + F.col("n_b")))
        .select("a", "b")
    )


def _verified(pairs: DataFrame, packed: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity; sizes and overlap are compared as whole numbers.

    Only the sets of these pairs are made, again from their blocks.
    """
    ends = pairs.select(F.col("a").alias("loc")).union(pairs.select("b")).distinct()
    sets = stage(_sets(packed, ends, words), "sets")
    share = round(similarity * 100)
    left, right = (sets.select(F.col("loc").alias(end), F.col("tokens").alias(name)) for end, name in (("a", "left"), ("b", "right")))
    both = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(right, "b").join(left, "a")
        .select("a", "b", both.alias("both"), (F.size("left") + F.size("right")).alias("sum"))
        .filter(100 * F.col("both") >= share * (F.col("sum") - F.col("both")))
        .select("a", "b")
    )


def _sets(packed: DataFrame, locs: DataFrame, words: int) -> DataFrame:
    """(loc, tokens) of the documents at `locs(loc)`."""

    def rows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"loc": pd.Series(dtype="int64"), "tokens": pd.Series(dtype="object")})
        block, found = left.iloc[0], []
        hashes = blocks.word_hashes(blocks.unpack_words(block["words"]))
        ones = np.ones(len(hashes), dtype=np.int64)
        codes = blocks.unpack_numbers(block["codes"])
        ends = np.cumsum(np.asarray(block["lens"], dtype=np.int64))
        for loc in right["loc"]:
            number = loc & ((1 << blocks.DOC_BITS) - 1)
            own = codes[ends[number] - block["lens"][number] : ends[number]]
            found.append((loc, tokens_of(own, hashes, ones, words)[0].view(np.int64)))
        return pd.DataFrame(found, columns=["loc", "tokens"])

    placed = locs.withColumn("block", F.shiftright("loc", blocks.DOC_BITS))
    return packed.groupBy("block").cogroup(placed.groupBy("block")).applyInPandas(rows, "loc long, tokens array<long>")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`.

    `component_id` is the smallest id that can be reached over pairs of rows whose sets have
    at least `similarity` of their union in common. Rows with equal sets are one set from the
    start, so copies are never paired.

    Defined cases: texts of fewer than `words` words are one shingle; null and empty texts
    have none, are linked with nothing and get their own id; rows with the same id and text
    are equal rows; rows without an id are linked like others, and a component without any
    id has none; an empty table gives no row; further columns are ignored, whatever their
    names.
    """
    packed = blocks.pack(docs, id_col, text_col, split_words)
    answers = blocks.exchange(packed, _sums)

    def sets_of(number_of_block: int, block: blocks.Opened) -> pd.DataFrame:
        docs_with = np.frombuffer(b"".join(block.answers), dtype="<i8")
        rows, seen = [], set()
        for number, doc_id, codes in block.documents():
            tokens, bound = tokens_of(codes, block.hashes, docs_with, words)
            key = xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None
            keys, rooms, bits = None, None, None
            if key is not None and key not in seen:
                seen.add(key)
                keys, rooms = index_keys(tokens, bound, similarity)
                keys, rooms, bits = keys.view(np.int64), rooms.astype(np.int32), sketch(tokens)
            rows.append((number_of_block << blocks.DOC_BITS | number, doc_id, key, len(tokens), keys, rooms, bits))
        found = pd.DataFrame(rows, columns=["loc", "doc_id", "key", "n", "keys", "rooms", "sketch"])
        return found.assign(doc_id=found["doc_id"].astype("Int64"))

    made = stage(
        blocks.unpack(packed, answers, sets_of, "loc long, doc_id long, key binary, n long, keys array<long>, rooms array<int>, sketch binary"), "token-sets",
    )
    # one place stands for each set, wherever it occurs
    first = stage(made.filter("keys IS NOT NULL").groupBy("key").agg(F.min("loc").alias("loc")), "places")
    chosen = made.select("loc", "n", "keys", "rooms").filter(F.size("keys") > 0).join(first.select("loc"), "loc", "left_semi")
    postings = chosen.select("loc", F.col("n").cast("int").alias("n"), F.inline(F.arrays_zip(F.col("keys").alias("sig"), F.col("rooms").alias("room"))))
    # keys with one set go; keys with the same sets, told by count and two digests of the places, are one list
    mark = F.xxhash64("loc")
    lists = postings.groupBy("sig").agg(
        F.count("*").alias("sets"), F.bit_xor(mark).alias("mark"), F.sum(F.shiftrightunsigned(mark, 32)).alias("total"), F.min("loc").alias("pivot")
    ).filter("sets > 1").select("sig", F.xxhash64("sets", "mark", "total").alias("list"), "pivot")
    postings = stage(postings.join(lists, "sig").groupBy("list", "loc", "n", "pivot").agg(F.max("room").alias("room")), "postings")
    sketches = stage(made.select("loc", "n", "sketch").join(postings.select("loc").distinct(), "loc", "left_semi"), "sketches")

    star = postings.filter("loc <> pivot").select(F.col("pivot").alias("a"), F.col("loc").alias("b")).distinct()
    near = stage(_maybe_similar(star, sketches, similarity), "near")
    links = stage(_verified(near, packed, words, similarity), "links")
    found = components(links, "groups")

    # what is left: sets that share a key and are in different groups
    grouped = stage(postings.join(found.withColumnRenamed("node", "loc"), "loc", "left").select(
        "list", "loc", "n", "room", F.coalesce("comp", "loc").alias("comp")
    ), "grouped")
    mixed = grouped.groupBy("list").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("list")
    still = grouped.join(mixed, "list", "left_semi")
    left, right = (still.select("list", *[F.col(c).alias(f"{c}_{side}") for c in ("loc", "n", "room", "comp")]) for side in "ab")
    # sets of fitting sizes only, whose keys leave room for the overlap that the similarity takes
    share = round(similarity * 100)
    fitting = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * share) & (
        F.least("room_a", "room_b") * (100 + share) >= (F.col("n_a") + F.col("n_b")) * share)
    rest = left.join(right, "list").filter("loc_a < loc_b AND comp_a <> comp_b").filter(fitting).select(
        F.col("loc_a").alias("a"), F.col("loc_b").alias("b")).distinct()
    near = stage(_maybe_similar(rest, sketches, similarity), "near")
    more = stage(_verified(near, packed, words, similarity), "more-links")
    every = components(links.union(more), "components")

    members = made.select("doc_id", F.col("n").alias("n_shingles"), "key")
    by_set = members.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first_id"))
    labelled = by_set.join(first, "key").join(every.withColumnRenamed("node", "loc"), "loc", "left").select(
        "key", "first_id", F.coalesce("comp", "loc").alias("comp"))
    smallest = labelled.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    # read back from a plain table, so that the next join may split a set that many rows have
    resolved = stage(labelled.join(smallest, "comp").select("key", "component_id"), "resolved-sets")
    linked = members.filter("key IS NOT NULL").join(resolved, "key").select("doc_id", "n_shingles", "component_id")
    alone = members.filter("key IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone)
