"""Alignment of the tokens of two tokenizers by the bytes that they cover.

Both tokenizers start anew where a single blank or line break stands between two other
characters, so texts are cut there and each block of documents encodes its distinct chunks once.
The spans that the libraries give, in characters, are coarse cuts; tokens that end inside a
character, and byte-fallback tokens, are placed by the lengths of their decoded bytes. Cuts that
both tokenizers share bound the groups; the cuts of either give the links.

Links are counted per block over its documents, then over all blocks in Spark, and each block
gets back the counts of its own pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import sentencepiece
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termloom.llm.blocks import pack_numbers, unpack_numbers
from termloom.llm.common import give_back
from termloom.operators.staging import stage

BLOCK_BYTES = 16_000_000
#: Chunks that are encoded at once.
TOGETHER = 200
#: Links of a block's documents, repeats counted, that are looked at together, about; a document's are.
LINKS_TOGETHER = 1_000_000
#: A single blank or line break between other characters starts a chunk.
CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
BLANK = "▁"

BLOCK_SCHEMA = (
    "block long, ids array<string>, n_a array<int>, n_b array<int>, n_groups array<int>, n_links array<int>, groups array<string>, "
    "lens binary, codes binary, link_lens binary, links binary, first binary, second binary, docs_with binary"
)
ROW_SCHEMA = "id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_loaded: dict[str, Tokenizers] = {}


def byte_of_symbol() -> dict[str, int]:
    """The symbols by which byte-level vocabularies spell bytes: visible Latin-1 stands for itself, others from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Tokenizers:
    """A byte-level tokenizer and a SentencePiece model, with the bytes of all their tokens."""

    first_file: str
    second_file: bytes
    bytes_a: list[bytes] = field(default_factory=list)
    bytes_b: list[bytes] = field(default_factory=list)

    def __post_init__(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.first = Tokenizer.from_str(self.first_file)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=self.second_file)
        spelled, vocabulary = byte_of_symbol(), self.first.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes_a[number] = bytes(spelled[c] for c in token) if all(c in spelled for c in token) else token.encode()
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.len_a, self.len_b = (np.fromiter(map(len, t), dtype=np.int64, count=len(t)) for t in (self.bytes_a, self.bytes_b))
        # no merge may cross a cut: byte-level splitting is by rule, pieces are looked through
        splits = json.loads(self.first_file).get("pre_tokenizer") or {}
        self.cuttable = (
            splits.get("type") == "ByteLevel" and splits.get("use_regex", True) and self.first.normalizer is None
            and not any(re.search(f"[^{BLANK}]{BLANK}", p) or "\n" in p for p in pieces)
        )
        # a token's text at twice its id, and the next place if it ends its side of a group; the second's after the first's
        self.spelled = [f"{i}{end}" for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for i in range(n) for end in ends]

    def chunks(self, text: str) -> list[str]:
        """A text with a blank before it, cut where both tokenizers start anew."""
        return CUT.split(" " + text) if self.cuttable else [" " + text]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """(ids, byte ends) by either tokenizer of a text that starts with a blank or line break; None if the bytes differ."""
        data = text.encode()
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        at = np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])
        first = self.first.encode(text, add_special_tokens=False)
        ids_a, spans_a = first.ids, spans(first.offsets)
        # the model puts a blank before the text: it takes the place of the text's own, or goes if that is a line break
        own = text[1:] if text[0] == " " else text
        second = self.second.encode_as_offset_mapping(own)
        ids_b, spans_b = second["ids"], spans(second["offsets"])
        if text[0] == " ":
            spans_b = spans_b + 1
            spans_b[:1, 0] = 0
        else:
            if not ids_b or self.bytes_b[ids_b[0]] != b" ":
                return None
            ids_b, spans_b = ids_b[1:], spans_b[1:]
        joined = (b"".join(map(table.__getitem__, ids)) for table, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b)))
        if any(j != data for j in joined):
            return None
        ids_a, ids_b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        return ids_a, refine(at, spans_a, self.len_a[ids_a]), ids_b, refine(at, spans_b, self.len_b[ids_b])


def spans(offsets: list[tuple[int, int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(offsets), dtype=np.int64, count=2 * len(offsets)).reshape(-1, 2)


def distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted, each once; sorting is faster here than the hashing of `numpy.unique`."""
    found = np.sort(numbers)
    return found[np.append(True, found[1:] != found[:-1])] if len(found) else found


def refine(at: np.ndarray, spans: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from their spans in characters; `at` has the first byte of each character.

    A span is a sure cut where it isn't empty and the next one starts at its end or later. Tokens between sure cuts share a
    character, or lie apart from it (a blank put first, fallback bytes), and are placed by their bytes' lengths.
    """
    starts, ends = spans[:, 0], spans[:, 1]
    sure = ends > starts
    sure[:-1] &= (starts[1:] >= ends[:-1]) & (ends[1:] > starts[1:])
    total = np.cumsum(lens)
    last = np.maximum.accumulate(np.where(sure, np.arange(len(lens)), -1))
    base = np.where(last >= 0, at[ends[last]] - total[last], 0)
    return base + total


@dataclass
class Chunks:
    """What a block's distinct chunks give; the links of chunk i are at link_ends[i - 1] to link_ends[i]."""

    n_a: list[int] = field(default_factory=list)
    n_b: list[int] = field(default_factory=list)
    n_groups: list[int] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    links: list[np.ndarray] = field(default_factory=list)
    n_links: list[int] = field(default_factory=list)

    def fail(self) -> None:
        for numbers in (self.n_a, self.n_b, self.n_groups, self.n_links):
            numbers.append(0)
        self.text.append(None)

    def add(self, known: Tokenizers, chunks: list[str]) -> None:
        """Encode neighbours that start with a blank or line break as one text; one by one if their bytes differ."""
        found = known.encode("".join(chunks))
        if found is None:
            if len(chunks) == 1:
                self.fail()
                return
            for chunk in chunks:
                self.add(known, [chunk])
            return
        ids_a, ends_a, ids_b, ends_b = found
        bounds = np.cumsum([len(c.encode()) for c in chunks])
        every = distinct(np.concatenate([ends_a, ends_b]))
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        pairs = ids_a[np.searchsorted(ends_a, every)] << 32 | ids_b[np.searchsorted(ends_b, every)]
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        places_a = 2 * ids_a + (shared[group_a] == ends_a)
        places_b = 2 * (len(known.bytes_a) + ids_b) + (shared[group_b] == ends_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        texts = list(map(known.spelled.__getitem__, np.concatenate([places_a, places_b])[order].tolist()))
        upto = [np.searchsorted(e, bounds, side="right") for e in (ends_a, ends_b, shared, every)]
        a, b, groups, links = (np.diff(u, prepend=0).tolist() for u in upto)
        self.n_a += a
        self.n_b += b
        self.n_groups += groups
        self.n_links += links
        self.links.append(pairs)
        start = 0
        for end in (upto[0] + upto[1]).tolist():
            self.text.append("".join(texts[start:end]))
            start = end


class Block:
    """Documents of about `BLOCK_BYTES`, as numbers of their chunks."""

    def __init__(self, known: Tokenizers) -> None:
        self.known, self.number, self.size = known, {}, 0
        self.ids: list[str | None] = []
        self.texts: list[str] = []
        self.codes: list[list[int]] = []

    def add(self, doc_id: str | None, text: str | None) -> None:
        """Null and empty texts have no chunks."""
        number, text = self.number, text or ""
        self.ids.append(doc_id)
        self.texts.append(text)
        self.codes.append([number.setdefault(c, len(number)) for c in self.known.chunks(text)] if text else [])
        self.size += len(text)

    def encoded(self) -> Chunks:
        """The chunks, and whole texts as further chunks where one of theirs does not give its own bytes."""
        found, waiting = Chunks(), []
        for chunk in self.number:
            alone = chunk[-1].isspace() or chunk[0] not in " \n"
            if waiting and (alone or len(waiting) == TOGETHER):
                found.add(self.known, waiting)
                waiting = []
            if alone:
                found.add(self.known, [chunk])
            else:
                waiting.append(chunk)
        if waiting:
            found.add(self.known, waiting)
        bad = {i for i, t in enumerate(found.text) if t is None}
        if bad:
            for k, codes in enumerate(self.codes):
                if not bad.isdisjoint(codes):
                    whole = " " + self.texts[k]
                    if whole not in self.number:
                        self.number[whole] = len(self.number)
                        found.add(self.known, [whole])
                    code = self.number[whole]
                    self.codes[k] = [] if found.text[code] is None else [code]
        return found

    def row(self, block: int) -> pd.DataFrame:
        found = self.encoded()
        lens = np.fromiter(map(len, self.codes), dtype=np.int64, count=len(self.codes))
        codes = np.fromiter(chain.from_iterable(self.codes), dtype=np.int32, count=int(lens.sum()))
        link_lens = np.array(found.n_links, dtype=np.int32)
        linked = np.concatenate(found.links) if found.links else np.zeros(0, np.int64)
        found.links.clear()
        pairs = distinct(linked)
        links = np.searchsorted(pairs, linked).astype(np.int32)
        del linked
        docs_with = count_holders(lens, codes, link_lens, links, len(pairs))
        groups = []
        for own in self.codes:
            text = "".join([found.text[c] for c in own])[:-1]
            groups.append(hashlib.sha256(text.encode()).hexdigest() if own else "")

        def per_document(numbers: list[int]) -> np.ndarray:
            before = np.concatenate([[0], np.cumsum(np.array(numbers, dtype=np.int64)[codes])])
            ends = np.cumsum(lens)
            return (before[ends] - before[ends - lens]).astype(np.int32)

        return pd.DataFrame({
            "block": [block], "ids": [self.ids], "n_a": [per_document(found.n_a)], "n_b": [per_document(found.n_b)],
            "n_groups": [per_document(found.n_groups)], "n_links": [per_document(found.n_links)], "groups": [groups],
            "lens": [pack_numbers(lens)], "codes": [pack_numbers(codes)], "link_lens": [pack_numbers(link_lens)],
            "links": [pack_numbers(links)], "first": [pack_numbers(pairs >> 32)], "second": [pack_numbers(pairs & 0xFFFFFFFF)],
            "docs_with": [pack_numbers(docs_with)],
        })


def spread(lens: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the members of the `chosen` groups, whose members lie one after another, `lens` of each group."""
    ends, sizes = np.cumsum(lens), lens[chosen]
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(ends[chosen] - sizes - before, sizes)


def count_holders(lens: np.ndarray, codes: np.ndarray, link_lens: np.ndarray, links: np.ndarray, n_pairs: int) -> np.ndarray:
    """Documents that hold each pair linked; one counts a pair once, whichever of its chunks hold it.

    Chunks of the documents lie one after another in `codes`, `lens` of each, and links of the chunks in `links`. Documents are
    looked at in runs of about `LINKS_TOGETHER`, since their links written out are many times the block.
    """
    docs_with, ends, n_chunks = np.zeros(n_pairs, dtype=np.int64), np.cumsum(lens), max(1, len(link_lens))
    upto = np.concatenate([[0], np.cumsum(link_lens[codes], dtype=np.int64)])[ends]
    first, seen = 0, 0
    while first < len(lens):
        last = max(first + 1, int(np.searchsorted(upto, seen + LINKS_TOGETHER, side="right")))
        own, doc = codes[ends[first] - lens[first] : ends[last - 1]], np.repeat(np.arange(last - first), lens[first:last])
        doc, own = np.divmod(distinct(doc * n_chunks + own), n_chunks)
        held = links[spread(link_lens, own)] + np.repeat(doc, link_lens[own]) * max(1, n_pairs)
        docs_with += np.bincount(distinct(held) % max(1, n_pairs), minlength=n_pairs)
        first, seen = last, upto[last - 1]
    return docs_with


def blocks_of(docs: DataFrame, id_col: str, text_col: str, files: Broadcast) -> DataFrame:
    """Blocks over all documents."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = hashlib.sha256(files.value[0].encode() + files.value[1]).hexdigest()
        if name not in _loaded:
            _loaded.clear()
            _loaded[name] = Tokenizers(*files.value)
        known, first, number = _loaded[name], TaskContext.get().partitionId() << 24, 0
        block = Block(known)
        for batch in batches:
            for doc_id, text in zip(batch["id"].array, batch["text"].array):
                block.add(None if pd.isna(doc_id) else doc_id, None if pd.isna(text) else text)
                if block.size >= BLOCK_BYTES:
                    yield block.row(first + number)
                    number, block = number + 1, Block(known)
        if block.ids:
            yield block.row(first + number)
        del block
        give_back()

    return docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInPandas(pack, BLOCK_SCHEMA)


def pair_rows(blocks: DataFrame) -> DataFrame:
    """(block, pair, docs): the id pairs of each block, with the documents that hold them linked."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, a, b, docs in zip(batch["block"], batch["first"], batch["second"], batch["docs_with"]):
                pairs = unpack_numbers(a).astype(np.int64) << 32 | unpack_numbers(b)
                yield pd.DataFrame({"block": block, "pair": pairs, "docs": unpack_numbers(docs).astype(np.int64)})
        give_back()

    return blocks.select("block", "first", "second", "docs_with").mapInPandas(rows, "block long, pair long, docs long")


def summed(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The rows of a block's documents, from the block and the counts of its pairs."""
    give_back()
    block, known = left.iloc[0], right.sort_values("pair")
    counts, best = known["count"].to_numpy(np.int64), known["best"].to_numpy(np.int64)
    links, link_lens = unpack_numbers(block["links"]).astype(np.int64), unpack_numbers(block["link_lens"]).astype(np.int64)
    codes, lens = unpack_numbers(block["codes"]).astype(np.int64), unpack_numbers(block["lens"]).astype(np.int64)

    def per_document(values: np.ndarray) -> np.ndarray:
        of_links = np.concatenate([[0], np.cumsum(values[links])])
        ends = np.cumsum(link_lens)
        of_chunks = np.concatenate([[0], np.cumsum((of_links[ends] - of_links[ends - link_lens])[codes])])
        ends = np.cumsum(lens)
        return of_chunks[ends] - of_chunks[ends - lens]

    return pd.DataFrame({
        "id": block["ids"], "n_a": block["n_a"], "n_b": block["n_b"], "n_groups": block["n_groups"], "n_links": block["n_links"],
        "n_best": per_document(best), "count_sum": per_document(counts), "groups_sha256": block["groups"],
    })


def align(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row per row of `docs`.

    `first` is the path of a byte-level BPE of the library tokenizers, which encodes the text with a blank before it;
    `second` that of a SentencePiece model, which adds the blank itself. Special tokens' strings inside texts are plain text.
    Groups lie between byte offsets where tokens of both end; a link is a token of the first and one of the second whose
    bytes overlap. A pair of ids counts the documents that hold it linked; `n_best` counts the links whose pair has the
    highest count of its first id, ties included, and `count_sum` adds up the counts of all links.

    Null and empty texts, and texts that one of the tokenizers does not give back byte for byte, have no tokens: zeros and an
    empty digest. Repeated rows are documents of their own, with or without an id. Texts may be of any length; an empty table
    gives no rows. Further columns are ignored.
    """
    with open(first, encoding="utf-8") as a, open(second, "rb") as b:
        files = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    blocks = stage(blocks_of(docs, id_col, text_col, files), "token-blocks")
    counts = pair_rows(blocks).groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", 32))
    counts = stage(counts, "pair-counts")
    tops = counts.groupBy("a").agg(F.max("count").alias("top"))
    known = counts.join(tops, "a").select("pair", "count", (F.col("count") == F.col("top")).cast("int").alias("best"))
    answers = pair_rows(blocks).select("block", "pair").join(known, "pair").select("block", "pair", "count", "best")
    rows = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(summed, ROW_SCHEMA)
    return rows.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), *rows.columns[1:])
