"""Byte-level BPE: every distinct pre-token is encoded once, over all documents.

Texts are cut into pre-tokens, whose positions are kept as numbers into the word list of
their block (see `blocks`). The distinct words of all blocks meet in a global shuffle, each
is merged once, its ids go back to the blocks that have it, and documents are put together
by position. Decoding looks every id up in the table of token bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm import blocks
from termloom.llm.common import give_back

#: Up to this many bytes a word is merged by looking at all pairs each time, above by a queue.
SHORT = 48


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file, one base64 token and its rank a line.

    Read by the driver and sent along with the code: a vocabulary has a bounded size, a
    megabyte or two.
    """
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def splitter(pattern: str) -> Callable[[str], list[bytes]]:
    """Cuts a text into pre-tokens; white space is Unicode's, as in the tokenizer's own engine."""
    pattern = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")

    def split(text: str) -> list[bytes]:
        # compiled patterns are cached by the module
        return [t.encode() for t in regex.compile(pattern).findall(text)]

    return split


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token: the pair of lowest rank, leftmost first, is joined until none has a rank."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(word) > SHORT:
        parts = _merge_long(parts, ranks)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _merge_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[bytes]:
    """The same with a queue of pairs, for words of thousands of bytes."""
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    queue: list[tuple[int, int, bytes]] = []

    def offer(i: int) -> None:
        if after[i] < len(parts) and (rank := ranks.get(pair := parts[i] + parts[after[i]])) is not None:
            heapq.heappush(queue, (rank, i, pair))

    for i in range(len(parts) - 1):
        offer(i)
    while queue:
        _, i, pair = heapq.heappop(queue)
        if not parts[i] or after[i] >= len(parts) or parts[i] + parts[after[i]] != pair:
            continue
        gone = after[i]
        parts[i], parts[gone], after[i] = pair, b"", after[gone]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [p for p in parts if p]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) with the token ids of every row's whole text, without special tokens.

    Defined cases: null and empty texts have no ids; rows with the same id, or none, are
    encoded each for itself; further columns are ignored, whatever their names; an empty
    table gives no row.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ranks)

    def ids_of(words: list[bytes], *_) -> list[bytes]:
        known = shared.value
        return [np.array(merge(w, known), dtype="<u4").tobytes() for w in words]

    def documents(_: int, block: blocks.Opened) -> pd.DataFrame:
        sizes = np.fromiter(map(len, block.answers), dtype=np.int64, count=len(block.answers)) // 4
        flat = np.frombuffer(b"".join(block.answers), dtype="<u4").astype(np.int32)
        starts = np.cumsum(sizes) - sizes
        found = []
        for _, _, codes in block.documents():
            own = sizes[codes]
            # place of every id: where its word's ids start, plus its number within the word
            inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            found.append(flat[np.repeat(starts[codes], own) + inside])
        return pd.DataFrame({"doc_id": pd.array(block.ids, dtype="Int64"), "ids": found})

    packed = blocks.pack(docs, id_col, text_col, splitter(pattern))
    return blocks.unpack(packed, blocks.exchange(packed, ids_of), documents, "doc_id long, ids array<int>")


def token_table(ranks: dict[bytes, int]) -> list[bytes]:
    """Token bytes by id."""
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of `encoded` and the bytes its ids stand for.

    The table of token bytes is bounded by the vocabulary and goes to every task.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(token_table(ranks))

    @F.pandas_udf("binary")
    def look_up(batch: pd.Series) -> pd.Series:
        give_back()
        table = shared.value
        return batch.map(lambda ids: None if ids is None else b"".join([table[i] for i in ids.tolist()]))

    return encoded.withColumn(out, look_up(F.col(ids_col)))


def ids_digest(ids: Column) -> Column:
    """SHA-256, in lowercase hex, of the ids as little-endian unsigned 32-bit integers.

    Taken where the ids are packed, so that they don't go back as bytes; null ids have none.
    """

    @F.pandas_udf("string")
    def digest(batch: pd.Series) -> pd.Series:
        give_back()
        return batch.map(lambda own: None if own is None else hashlib.sha256(np.asarray(own, dtype="<u4").tobytes()).hexdigest())

    return digest(ids)
