"""Repeated word windows by FM-indexes, one per shard of the corpus.

Every window of `WINDOW` words is sent to the shard of its rarest word, together with its
neighbours that have the same rarest word: a segment of at most 2 * WINDOW - 1 words. So all
windows with the same words are in one shard, and windows with a word that one document only
has are nowhere. A shard lays its segments end to end and builds a compressed FM-index:
the Burrows-Wheeler transform of the sequence in a wavelet matrix, a bit per level and symbol
with counts per 64 bits. Its documents are then streamed against it: backward search extends
the match at every place word by word, places that match nothing else drop out, and those
that reach the threshold report the interval of their occurrences, whose smallest document
id says whether the window is a repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm import blocks
from termloom.llm.common import partitions
from termloom.operators.staging import stage

WINDOW = 13
#: Words of segments a shard gets, about; there are as many shards as that takes.
SHARD_WORDS = 400_000
#: Segments hold about this many words per word of text.
SPREAD = 1.6
#: Stands for the id of rows without one, which come after all others.
LAST = np.iinfo(np.int64).max
PART_BITS = 22
#: A block has fewer words than 2 to the power of this: a text has less than 2 GB, and a block closes when it has ten megabytes.
PLACE_BITS = 31
#: Places that go down the levels of a wavelet matrix together.
TOGETHER = 8192
#: The bits below each of the 64 of a number.
BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


def split_words(text: str) -> list[bytes]:
    """`bytes.split` cuts at space and the ASCII controls from tab to return only."""
    return text.encode().split()


def _numbered(words: list[bytes], docs_with: np.ndarray, part: int) -> list[bytes]:
    """A number for every word, the same in all blocks, and how many documents have it."""
    table = np.empty((len(words), 2), dtype="<i8")
    table[:, 0] = (part << PART_BITS) + np.arange(len(words)) + 1
    table[:, 1] = docs_with
    return [row.tobytes() for row in table]


# ---- FM-index ----------------------------------------------------------------------------

class WaveletMatrix:
    """Ranks of symbols in a sequence, from one bit per symbol and level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = max(1, int(symbols - 1).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        starts = np.zeros(symbols, dtype=np.int64)
        names = np.arange(symbols)
        for level in range(self.levels - 1, -1, -1):
            bit = (sequence >> level) & 1
            packed = np.packbits(np.append(bit, 0).astype(np.uint8), bitorder="little")
            words = np.zeros(-(-len(packed) // 8) * 8, dtype=np.uint8)
            words[: len(packed)] = packed
            words = words.view(np.uint64)
            self.bits.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            starts = self._down(len(self.bits) - 1, starts, -((names >> level) & 1))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        self.starts = starts

    def _down(self, step: int, place: np.ndarray, one: np.ndarray) -> np.ndarray:
        """Places a level further down; `one` has all bits set where the symbol's bit is, and none elsewhere."""
        word = place >> 6
        own = self.bits[step].take(word)
        own &= BELOW.take(place & 63)
        ones = self.before[step].take(word)
        ones += np.bitwise_count(own)
        down = place - ones
        ones += self.zeros[step]
        ones -= down
        ones &= one
        down += ones
        return down

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol occurs before its two places; so few at a time that they stay in a processor's cache."""
        found = np.empty((2, len(symbol)), dtype=np.int64)
        for at in range(0, len(symbol), TOGETHER):
            own = symbol[at : at + TOGETHER]
            a, b = low[at : at + TOGETHER], high[at : at + TOGETHER]
            for step in range(self.levels):
                one = -((own >> (self.levels - 1 - step)) & 1)
                a, b = self._down(step, a, one), self._down(step, b, one)
            found[:, at : at + TOGETHER] = (a, b) - self.starts[own]
        return found[0], found[1]


class FMIndex:
    """Backward search over a sequence of symbols from 1 on; 0 separates segments.

    Suffixes are sorted by their first `depth` symbols, which is enough for the search of
    patterns shorter than that.
    """

    def __init__(self, sequence: np.ndarray, depth: int):
        n = len(sequence)
        rank, length, order = sequence.astype(np.int64), 1, np.arange(n)
        while length < depth:
            after = np.zeros(n, dtype=np.int64)
            after[:-length] = rank[length:] + 1
            key = rank * (n + 2) + after
            order = np.argsort(key)
            ordered = key[order]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            length *= 2
        self.order = order
        symbols = int(sequence.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=symbols))])
        self.wavelet = WaveletMatrix(sequence[order - 1], symbols)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol in front."""
        first = self.first[symbol]
        low, high = self.wavelet.rank(symbol, low, high)
        return first + low, first + high


def repeated(sequence: np.ndarray, doc: np.ndarray, places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the places start a window that occurs again, and the smallest document it starts in.

    `sequence` has symbols from 1 on and 0 between segments, `doc` the document of each symbol.
    """
    depth = 1
    while depth <= window:
        depth *= 2
    index = FMIndex(sequence, depth)
    last = sequence[places + window - 1]
    low, high, alive = index.first[last], index.first[last + 1], np.arange(len(places))
    for k in range(window - 2, -1, -1):
        keep = high - low > 1  # what matches itself only can't become a repeat
        low, high, alive = low[keep], high[keep], alive[keep]
        low, high = index.extend(sequence[places[alive] + k], low, high)
    keep = high - low > 1
    low, high, alive = low[keep], high[keep], alive[keep]
    if not len(alive):
        return alive, np.zeros(0, dtype=np.int64)
    starts, back = np.unique(low, return_inverse=True)
    ends = np.zeros(len(starts), dtype=np.int64)
    ends[back] = high
    # intervals of different windows don't overlap; every other piece is one of them
    docs = np.append(doc[index.order], LAST)
    smallest = np.minimum.reduceat(docs, np.column_stack([starts, ends]).ravel())[::2]
    return alive, smallest[back]


# ---- segments ----------------------------------------------------------------------------

def segments_of(rarity: np.ndarray, docs_with: np.ndarray, lens: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, place of their rarest word) of the segments of documents laid end to end.

    Windows that hold a word of one document only are left out, and those that reach into
    the next document. The rarest word is the first of those with the least `rarity`.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(rarity) < window:
        return none, none, none
    # the smallest of (rarity, place) over windows of 1, 2, 4, ... words, then of two that overlap
    smallest, width = rarity << PLACE_BITS | np.arange(len(rarity)), 1
    while 2 * width <= window:
        smallest, width = np.minimum(smallest[:-width], smallest[width:]), 2 * width
    if width < window:
        smallest = np.minimum(smallest[: width - window], smallest[window - width :])
    rarest = smallest & ((1 << PLACE_BITS) - 1)
    ends = np.cumsum(lens)
    usable = (docs_with[rarest] > 1) & (np.arange(len(rarest)) + window <= np.repeat(ends, lens)[: len(rarest)])
    new = np.flatnonzero(np.diff(np.where(usable, rarest, -1), prepend=-2) != 0)
    sizes = np.diff(np.append(new, len(rarest)))
    good = usable[new]
    return new[good], sizes[good], rarest[new][good]


def _spread_bits(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class BlockSegments:
    """Distinct segments of a block, ordered by shard, and where they occur.

    Equal segments, wherever in the block, are one: they are told by a 64-bit digest of
    words, length and place of the rarest word, from running sums over the block.
    """

    def __init__(self, left: pd.DataFrame, right: pd.DataFrame, shards: int, window: int):
        block = left.iloc[0]
        self.words = blocks.unpack_words(block["words"])
        table = blocks.answer_table(blocks.word_hashes(self.words), right, 2)
        self.codes = blocks.unpack_numbers(block["codes"])
        self.lens = np.asarray(block["lens"], dtype=np.int64)
        self.ids = [None if pd.isna(i) else int(i) for i in block["ids"]]
        self.number = table[:, 0][self.codes]
        # words by the documents that have them and then by number
        rarity = np.empty(len(table), dtype=np.int64)
        rarity[np.lexsort((table[:, 0], table[:, 1]))] = np.arange(len(table))
        start, windows, center = segments_of(rarity[self.codes], table[:, 1][self.codes], self.lens, window)
        own = np.array([LAST if i is None else i for i in self.ids], dtype=np.int64)
        self.id_of = np.repeat(own, self.lens)
        size = windows + window - 1
        # sum of the words' bits times powers of an odd base; dividing by a power moves it to the segment's start
        base, n = 0x9E6C63D0676A9A99, len(self.number)
        powers, inverse = np.ones(n + 1, dtype=np.uint64), np.ones(n + 1, dtype=np.uint64)
        powers[1:], inverse[1:] = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        powers, inverse = np.cumprod(powers), np.cumprod(inverse)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_spread_bits(self.number) * powers[:-1])])
        digest = (sums[start + size] - sums[start]) * inverse[start]
        digest = _spread_bits(digest ^ _spread_bits(size * 64 + center - start))
        _, first, back = np.unique(digest, return_index=True, return_inverse=True)
        smallest = np.full(len(first), LAST, dtype=np.int64)
        np.minimum.at(smallest, back, self.id_of[start])
        shard = ((_spread_bits(self.number[center[first]]) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        first = first[order]
        self.shard, self.smallest = shard[order], smallest[order]
        self.start, self.size, self.center = start[first], size[first], (center - start)[first]
        self.at, self.segment = start, place[back]  # every occurrence and its segment

    def by_shard(self) -> Iterator[tuple[int, slice]]:
        edges = [0, *(np.flatnonzero(np.diff(self.shard)) + 1).tolist(), len(self.shard)]
        for a, b in zip(edges[:-1], edges[1:]):
            if b > a:
                yield int(self.shard[a]), slice(a, b)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each range, one after another."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _numbers(values) -> bytes:
    return blocks.squeeze(np.asarray(values, dtype="<i8").tobytes())


def _back(data: bytes) -> np.ndarray:
    return np.frombuffer(blocks.unsqueeze(data), dtype="<i8")


def _pack_words(words: np.ndarray) -> bytes:
    """Word numbers as numbers into the list of distinct ones."""
    names, codes = np.unique(words, return_inverse=True)
    low = blocks.pack_numbers((names & 0xFFFFFFFF).astype(np.uint32))
    high = blocks.pack_numbers((names >> 32).astype(np.uint32))
    head = np.array([len(low), len(high)], dtype="<u4").tobytes()
    return head + low + high + blocks.pack_numbers(codes.astype(np.uint32))


def _unpack_words(data: bytes) -> np.ndarray:
    low, high = np.frombuffer(data[:8], dtype="<u4").tolist()
    names = blocks.unpack_numbers(data[8 : 8 + low]).astype(np.int64) | blocks.unpack_numbers(data[8 + low : 8 + low + high]).astype(np.int64) << 32
    return names[blocks.unpack_numbers(data[8 + low + high :])]


def _shared(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, center: np.ndarray, window: int) -> np.ndarray:
    """Segments that may share a window with another one.

    A window holds its rarest word with half a window behind or before it, so segments that
    share a window have the same words there.
    """
    half = (window - 1) // 2
    found = np.zeros(len(starts), dtype=bool)
    for first in (0, -half):
        fits = np.flatnonzero((center + first >= 0) & (center + first + half < sizes))
        key = np.zeros(len(fits), dtype=np.uint64)
        for k in range(half + 1):
            key = (key ^ words[starts[fits] + center[fits] + first + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        _, back, times = np.unique(key, return_inverse=True, return_counts=True)
        found[fits[times[back] > 1]] = True
    return found


def _answer_shard(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    """For each window of the shard's segments the smallest document it starts in, where that is another segment's; else -1."""
    parts = [(_unpack_words(w), _back(s), _back(c), _back(d)) for w, s, c, d in zip(rows["words"], rows["sizes"], rows["centers"], rows["docs"])]
    words, sizes, center, doc = (np.concatenate([p[i] for p in parts]) for i in range(4))
    starts = np.cumsum(sizes) - sizes
    answers = np.full(int((sizes - window + 1).sum()), -1, dtype=np.int64)
    first_answer = np.cumsum(sizes - window + 1) - (sizes - window + 1)
    some = np.flatnonzero(_shared(words, starts, sizes, center, window))
    if len(some):
        own = sizes[some]
        inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        gap = np.repeat(np.arange(len(some)), own)  # a separator after every segment
        place = np.arange(own.sum()) + gap
        sequence = np.zeros(own.sum() + len(some), dtype=np.int64)
        _, sequence[place] = np.unique(words[np.repeat(starts[some], own) + inside], return_inverse=True)
        sequence[place] += 1
        docs = np.full(len(sequence), LAST, dtype=np.int64)
        docs[place] = np.repeat(doc[some], own)
        is_window = inside <= np.repeat(own - window, own)
        target = (np.repeat(first_answer[some], own) + inside)[is_window]
        alive, smallest = repeated(sequence, docs, place[is_window], window)
        answers[target[alive]] = smallest
    ends = np.cumsum([int((p[1] - window + 1).sum()) for p in parts])
    return pd.DataFrame({"block": rows["block"], "shard": rows["shard"], "found": [_numbers(a) for a in np.split(answers, ends[:-1])]})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept_text) for every row of `docs`.

    A word goes if a window of `window` words that covers it has the words of a window that
    starts in a row with a smaller id; `removed` lists the runs of words that go, as pairs of
    first word and word after the last, and `kept_text` joins the others by a blank.

    Defined cases: null and empty texts have no words; texts shorter than a window lose
    none; rows with the same id don't take words from each other; rows without an id lose
    what a row with an id has, and take nothing; an empty table gives no row; further
    columns are ignored, whatever their names.
    """
    packed = blocks.pack(docs, id_col, text_col, split_words, copies_once=False)
    numbered = stage(blocks.exchange(packed, _numbered), "word-numbers")
    total = packed.agg(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda s, n: s + n))).first()[0] or 0
    shards = max(partitions(docs.sparkSession), int(total * SPREAD // SHARD_WORDS) + 1)

    def send(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = BlockSegments(left, right, shards, window)
        rows = [(
            left["block"].iloc[0], shard, _pack_words(found.number[_ranges(found.start[own], found.size[own])]),
            _numbers(found.size[own]), _numbers(found.center[own]), _numbers(found.smallest[own]),
        ) for shard, own in found.by_shard()]
        return pd.DataFrame(rows, columns=["block", "shard", "words", "sizes", "centers", "docs"])

    sent = packed.groupBy("block").cogroup(numbered.groupBy("block")).applyInPandas(
        send, "block long, shard int, words binary, sizes binary, centers binary, docs binary")
    answered = sent.groupBy("shard").applyInPandas(lambda rows: _answer_shard(rows, window), "block long, shard int, found binary")

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = BlockSegments(left, right[right["shard"] < 0], shards, window)
        answers = {s: _back(a) for s, a in zip(right["shard"], right["answers"]) if s >= 0}
        windows = found.size - window + 1
        smallest = np.repeat(found.smallest, windows)
        values = np.concatenate([answers[s] for s, _ in found.by_shard()] or [np.zeros(0, np.int64)])
        smallest = np.where(values < 0, smallest, np.minimum(values, smallest))
        # every occurrence's windows, against its own document
        times = windows[found.segment]
        first_window = (np.cumsum(windows) - windows)[found.segment]
        place = _ranges(found.at, times)
        place = place[smallest[_ranges(first_window, times)] < found.id_of[place]]
        edges = np.bincount(place, minlength=len(found.codes) + window + 1) - np.bincount(place + window, minlength=len(found.codes) + window + 1)
        gone = np.cumsum(edges)[: len(found.codes)] > 0
        rows, end = [], 0
        for doc_id, size in zip(found.ids, found.lens.tolist()):
            mask, codes = gone[end : end + size], found.codes[end : end + size]
            end += size
            changes = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
            kept = b" ".join([found.words[c] for c in codes[~mask].tolist()])
            rows.append((doc_id, size, int(mask.sum()), changes.reshape(-1, 2).tolist(), kept.decode()))
        out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "removed", "kept_text"])
        return out.assign(doc_id=out["doc_id"].astype("Int64"))

    answers = numbered.select("block", "part", F.lit(-1).alias("shard"), "answers").union(
        answered.select("block", F.lit(0).alias("part"), "shard", F.col("found").alias("answers")))
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        finish, "doc_id long, n_words long, n_removed long, removed array<array<int>>, kept_text string")
