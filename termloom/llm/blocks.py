"""Documents packed into blocks with a dictionary each, and a global exchange of distinct words.

A block holds ten megabytes of text as numbers into its own list of distinct words.
Only those lists travel: every part of the hash space gets each block's words that fall
into it, answers each distinct word once, and sends the answers back in the same order.
What moves is thus a block's vocabulary, not its positions, which stay where they are in a
table bucketed by block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import give_back, partitions
from termloom.operators.staging import new_path

#: A block is closed when its texts have this many bytes.
BLOCK_BYTES = 10_000_000
#: A block has fewer documents than 2 to the power of this, so that `block << DOC_BITS | number` tells a document.
DOC_BITS = 20
#: A part of the exchange gets about this many words, over all blocks.
PART_WORDS = 250_000
BLOCK_SCHEMA = "block long, ids array<long>, lens array<int>, n_words long, codes binary, words binary, docs_with binary"


def squeeze(data: bytes) -> bytes:
    return zstandard.compress(data, 3)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.decompress(data)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """32-bit numbers, byte by byte apart, compressed."""
    return squeeze(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def pack_words(words: Sequence[bytes]) -> bytes:
    lens = pack_numbers(np.fromiter(map(len, words), dtype=np.uint32, count=len(words)))
    return len(lens).to_bytes(4, "little") + lens + squeeze(b"".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    size = int.from_bytes(data[:4], "little")
    ends = np.cumsum(unpack_numbers(data[4 : 4 + size]), dtype=np.int64).tolist()
    text = unsqueeze(data[4 + size :])
    return [text[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


@dataclass
class Block:
    """A block being filled: words by first use, and per document its words' numbers."""

    copies_once: bool = True

    def __post_init__(self) -> None:
        self.words: dict[bytes, int] = {}
        self.docs: list[np.ndarray] = []
        self.ids: list = []
        self.size = 0

    def add(self, doc_id, tokens: list[bytes], size: int) -> None:
        number = self.words
        self.docs.append(np.fromiter([number.setdefault(t, len(number)) for t in tokens], dtype=np.uint32, count=len(tokens)))
        self.ids.append(doc_id)
        self.size += size

    def row(self, block: int) -> pd.DataFrame:
        """The block as one row; words are numbered anew by falling frequency, which packs better."""
        n = len(self.words)
        flat = np.concatenate(self.docs) if self.docs else np.zeros(0, np.uint32)
        order = np.argsort(-np.bincount(flat, minlength=n), kind="stable")
        place = np.empty(n, dtype=np.uint32)
        place[order] = np.arange(n, dtype=np.uint32)
        names = list(self.words)
        seen, docs_with = set(), np.zeros(n, dtype=np.uint32)
        for codes in self.docs:
            key = xxhash.xxh3_128_digest(codes.tobytes())
            if not self.copies_once or key not in seen:
                seen.add(key)
                docs_with[np.unique(place[codes])] += 1
        return pd.DataFrame({
            "block": [block], "ids": [self.ids], "lens": [[len(d) for d in self.docs]], "n_words": [n],
            "codes": [pack_numbers(place[flat])], "words": [pack_words([names[i] for i in order])],
            "docs_with": [pack_numbers(docs_with)],
        })


def pack(docs: DataFrame, id_col: str, text_col: str, split: Callable[[str], list[bytes]], copies_once: bool = True) -> DataFrame:
    """A table of blocks over `docs`, written once and bucketed by block.

    `split` turns a text into its words in UTF-8; null texts have none. `docs_with` counts
    the block's documents that hold a word, equal documents as one if `copies_once`.
    """
    spark = docs.sparkSession

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, number, open_block = TaskContext.get().partitionId() << 16, 0, Block(copies_once)
        for batch in batches:
            for doc_id, text in zip(batch["id"].array, batch["text"].array):
                missing = text is None or text is pd.NA
                open_block.add(None if pd.isna(doc_id) else int(doc_id), [] if missing else split(text), 0 if missing else len(text))
                if open_block.size >= BLOCK_BYTES or len(open_block.docs) == (1 << DOC_BITS) - 1:
                    yield open_block.row(first + number)
                    number, open_block = number + 1, Block(copies_once)
        if open_block.docs:
            yield open_block.row(first + number)
        del open_block
        give_back()

    name = f"blocks_{uuid.uuid4().hex}"
    (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .mapInPandas(blocks, BLOCK_SCHEMA)
        .write.bucketBy(partitions(spark), "block").option("path", new_path(spark, name)).option("compression", "none")
        .format("parquet").saveAsTable(name)
    )
    return spark.table(name)


def exchange(blocks: DataFrame, answer: Callable[[list[bytes], np.ndarray, int], list[bytes]]) -> DataFrame:
    """(block, part, answers): `answer(words, docs_with, part)` for the distinct words of each part.

    `docs_with` sums the documents that hold the word over all blocks. Answers come back per
    block and part, in the order of the words' hashes. A word comes at most once from each
    block, however frequent it is, and the number of parts grows with the words.
    """
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    parts = max(partitions(blocks.sparkSession), -(-total // PART_WORDS))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, words, docs_with in zip(batch["block"], batch["words"], batch["docs_with"]):
                words, docs_with = unpack_words(words), unpack_numbers(docs_with)
                hashes = word_hashes(words)
                order = np.argsort(hashes, kind="stable")
                part = (hashes[order] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
                ends = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
                rows = [(p, order[ends[p] : ends[p + 1]]) for p in range(parts) if ends[p] < ends[p + 1]]
                yield pd.DataFrame({
                    "block": block, "part": [p for p, _ in rows],
                    "words": [pack_words([words[i] for i in own]) for _, own in rows],
                    "docs_with": [pack_numbers(docs_with[own]) for _, own in rows],
                })
        give_back()

    def answered(rows: pd.DataFrame) -> pd.DataFrame:
        give_back()
        lists = [unpack_words(w) for w in rows["words"]]
        place: dict[bytes, int] = {}
        where = [np.fromiter([place.setdefault(w, len(place)) for w in own], dtype=np.int64, count=len(own)) for own in lists]
        sums = np.zeros(len(place), dtype=np.int64)
        for own, docs_with in zip(where, rows["docs_with"]):
            sums[own] += unpack_numbers(docs_with)
        found = answer(list(place), sums, int(rows["part"].iloc[0]))
        return pd.DataFrame({
            "block": rows["block"], "part": rows["part"], "answers": [pack_words([found[i] for i in own]) for own in where],
        })

    dealt = blocks.select("block", "words", "docs_with").mapInPandas(deal, "block long, part int, words binary, docs_with binary")
    return dealt.groupBy("part").applyInPandas(answered, "block long, part int, answers binary")


@dataclass
class Opened:
    """A block with its words' hashes and the answers to them, as `unpack` gives it to a function."""

    ids: list
    lens: np.ndarray
    codes: np.ndarray
    hashes: np.ndarray
    answers: list[bytes]

    def documents(self) -> Iterator[tuple[int, object, np.ndarray]]:
        """(number in the block, id, codes) of each document."""
        ends = np.cumsum(self.lens, dtype=np.int64)
        for k, (doc_id, end, size) in enumerate(zip(self.ids, ends, self.lens)):
            yield k, doc_id, self.codes[end - size : end]


def open_block(left: pd.DataFrame, right: pd.DataFrame) -> Opened:
    """A block's row and the rows of its answers, put together."""
    block = left.iloc[0]
    hashes = word_hashes(unpack_words(block["words"]))
    answers_of: list[bytes] = [b""] * len(hashes)
    order = iter(np.argsort(hashes, kind="stable").tolist())
    for own in right.sort_values("part")["answers"]:
        for found in unpack_words(own):
            answers_of[next(order)] = found
    ids = [None if pd.isna(i) else int(i) for i in block["ids"]]
    return Opened(ids, np.asarray(block["lens"], dtype=np.int64), unpack_numbers(block["codes"]), hashes, answers_of)


def answer_table(hashes: np.ndarray, right: pd.DataFrame, width: int) -> np.ndarray:
    """Answers of `width` 64-bit numbers each, a row per word of a block."""
    raw = []
    for own in right.sort_values("part")["answers"]:
        raw.append(unsqueeze(own[4 + int.from_bytes(own[:4], "little") :]))
    table = np.empty((len(hashes), width), dtype=np.int64)
    table[np.argsort(hashes, kind="stable")] = np.frombuffer(b"".join(raw), dtype="<i8").reshape(-1, width)
    return table


def unpack(blocks: DataFrame, answers: DataFrame, rows_of: Callable[[int, Opened], pd.DataFrame], schema: str) -> DataFrame:
    """Bring each block and its answers together; `rows_of(block, opened)` makes the rows.

    Blocks lie in buckets, so only the answers are shuffled.
    """

    def together(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        give_back()
        return rows_of(int(left["block"].iloc[0]), open_block(left, right))

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(together, schema)
