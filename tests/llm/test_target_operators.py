"""Operators 11 to 13 against brute force."""

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from termloom.llm import catalog, decontaminate, resample, token_alignment, topk_search, warc
from termloom.llm.common import folded_runs
from termloom.operators.staging import new_path

from .conftest import CLASHING

FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PATHS = [public_tokenizers.path(name) for name in catalog.TOKENIZERS]


def folded(text):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return FOLDED.findall((text or "").translate(str.maketrans(upper, upper.lower())))


def rows_of(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


# ---- words and features ----------------------------------------------------------------

@given(st.text(alphabet="aB9 \n-é漢.", max_size=60), st.integers(0, 3), st.integers(1, 20))
def test_runs_cover_all_words(text, carry, size):
    words, at = folded(text), 0
    for first, old, run in folded_runs(text.encode(), carry, size):
        assert [w.decode() for w in run] == words[first : first + len(run)]
        assert first + old == at and old == min(carry, at)
        at = first + len(run)
    assert at == len(words)


def all_features(text):
    words = folded(text)
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("size", [7, 1000])
def test_features(monkeypatch, size):
    monkeypatch.setattr(folded_runs, "__defaults__", (size,))
    text = "One two, THREE é4 five one two three  " * 5
    found = [c for _, codes in resample.features(text.encode()) for c in codes.tolist()]
    assert sorted(found) == sorted(crc32(f.encode()) % 10_000 for f in all_features(text))
    assert sum(n for n, _ in resample.features(text.encode())) == 40


def resampled(docs, target, least=20, share=(5, 100)):
    """Scores and draws of (doc_id, text) rows by the plain formulas."""
    s, t = (Counter(crc32(f.encode()) % 10_000 for x in side for f in all_features(x)) for side in ([x for _, x in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    scored = []
    for doc_id, text in docs:
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
            for b in (crc32(f.encode()) % 10_000 for f in all_features(text))
        ]
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((doc_id, len(gains), sum(gains), sum(gains) + noise, len(folded(text))))
    fit = sorted((r for r in scored if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {i: n for n, i in enumerate(map(id, fit[: share[0] * len(fit) // share[1]]), 1)}
    return sorted(((*r[:4], rank.get(id(r))) for r in scored), key=str)


COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def test_resample(spark, make_docs, odd_rows):
    texts = [(100 + i, " ".join(f"w{(i * k) % 17}" for k in range(i % 60))) for i in range(120)]
    rows = [(d, t, "a") for d, t in [(r[0], r[1]) for r in odd_rows] + texts]
    target = ["w3 w5 w7 w9", "w5 w7 w1", None, "", "other W400"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    docs = make_docs(rows, extra=[*CLASHING, "id", "low", "no_id", "pos", "range", "tie", "bucket", "hits", "weight", "score"])
    for share in ((5, 100), (1, 2)):
        got = rows_of(resample.resample(docs, frame, share), *COLUMNS)
        assert got == resampled([(d, t) for d, t, _ in rows], target, share=share)


def test_resample_of_nothing(spark, make_docs):
    none = spark.createDataFrame([], "item_id int, text string")
    assert resample.resample(make_docs([]), none).count() == 0
    docs = [(1, "one " * 30), (2, "two " * 30), (3, None)]
    got = rows_of(resample.resample(make_docs([(*d, "a") for d in docs]), none, (1, 1)), *COLUMNS)
    assert got == resampled(docs, [], share=(1, 1))


# ---- decontamination -------------------------------------------------------------------

def contaminated(docs, items):
    """Every window of every item against every document."""
    windows = {}
    for item, text in items:
        words = folded(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    found = []
    for doc_id, text in docs:
        words, hit, held = folded(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                own = windows.get(tuple(words[i : i + n]))
                if own is not None:
                    hit.update(range(i, i + n))
                    held |= own
        ids = sorted(str(i) for i in held if i is not None)
        found.append((doc_id, len(words), len(hit), len(ids), tuple(ids), bool(hit)))
    return sorted(found, key=str)


def found_in(frame):
    return sorted(
        ((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), r.contaminated) for r in frame.collect()), key=str
    )


def passages():
    """Items and documents that share passages of many lengths, at ends and in repetitive runs."""
    word = [f"v{i % 91}x{i * i % 89}" for i in range(2000)]
    long_item = word[:700]
    items = [
        ("a", " ".join(long_item)), ("b", " ".join(long_item[200:260])), ("b", "second text of b " + " ".join(word[900:915])),
        ("c", "la " * 40), ("d", "Short Item, of six-words!"), ("e", "lone"), (None, " ".join(word[1000:1030])), ("f", None), ("g", ""),
        ("h", " ".join(long_item[200:260])), ("i", " ".join(word[1200:1210])), ("j", " ".join(word[1300:1309])), ("10", "la " * 12),
    ]
    docs = [
        (1, " ".join(word[190:215]).upper()), (2, "x " + " ".join(word[245:256])), (3, " ".join(word[247:256])), (4, "LA! " * 300),
        (5, "a short item of six words"), (6, "no lone, alone lonely"), (7, " ".join(word[:1999])), (7, " ".join(word[:1999])),
        (8, " ".join(word[1000:1015]) + " gap " + " ".join(word[1015:1030])), (9, None), (10, ""), (None, " ".join(word[1200:1210])),
        (11, " ".join(word[1200:1209]) + " x"), (12, " ".join(word[1299:1312])), (13, "clean text " * 30), (14, " ".join(word[905:915])),
    ]
    return docs, items


@pytest.mark.parametrize("broadcast", [True, False])
def test_contamination(spark, make_docs, odd_rows, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "fits_broadcast", lambda df: False)
    docs, items = passages()
    docs = docs + [(r[0], r[1]) for r in odd_rows]
    items = items + [("o", odd_rows[0][1]), ("o2", odd_rows[7][1][-300:])]
    frame = spark.createDataFrame(items, "item_id string, text string").selectExpr("*", "'x' AS piece", "'x' AS words", "'x' AS item")
    extra = [*CLASHING, "id", "k1", "k2", "data", "hash", "piece", "p", "q", "found", "pieces", "items", "n_hit"]
    got = decontaminate.contamination(make_docs([(*d, "a") for d in docs], extra=extra), frame)
    assert found_in(got) == contaminated(docs, items)


def test_contamination_of_nothing(spark, make_docs):
    items = spark.createDataFrame([("a", "one two three")], "item_id string, text string")
    assert decontaminate.contamination(make_docs([]), items).count() == 0
    docs = [(1, "one two three", "a"), (2, None, None)]
    got = found_in(decontaminate.contamination(make_docs(docs), items.limit(0)))
    assert got == contaminated([d[:2] for d in docs], [])


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40), st.integers(10, 14))
def test_windows_of_equal_words_keep_an_equal_gram(words, window):
    """The guarantee: whatever surrounds a window, one kept gram lies inside it at the same place."""
    hashes, at = decontaminate.fingerprints(words, window, 6, [])
    kept = dict(zip(at.tolist(), hashes.tolist()))
    for i in range(len(words) - window + 1):
        own, place = decontaminate.piece_fingerprints(words[i : i + window], window, 6)
        assert len(own) == 1 and kept[i + int(place[0])] == int(own[0])


# ---- alignment -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PATHS[1]), token_alignment.Tokenizers(
        open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read()
    )


def whole(libraries, text):
    """(ids, ends) by both tokenizers of a whole text, from the bytes of the tokens alone."""
    if not text:
        return None
    first, second, known = libraries
    data = (" " + text).encode()
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    found = []
    for ids, table in ((a, known.bytes_a), (b, known.bytes_b)):
        if b"".join(table[i] for i in ids) != data:
            return None
        found.append((ids, np.cumsum([len(table[i]) for i in ids]).tolist()))
    return found


def linked(found):
    """(groups, links) of a text."""
    (a, ends_a), (b, ends_b) = found
    shared = sorted(set(ends_a) & set(ends_b))
    groups, start = [], 0
    for end in shared:
        sides = [[i for i, e in zip(ids, ends) if start < e <= end] for ids, ends in found]
        groups.append("|".join(",".join(map(str, side)) for side in sides))
        start = end
    links = []
    for i, end in zip(a, ends_a):
        start = ends_a[bisect_left(ends_a, end) - 1] if end != ends_a[0] else 0
        for j, other in zip(b, ends_b):
            low = ends_b[bisect_left(ends_b, other) - 1] if other != ends_b[0] else 0
            if max(start, low) < min(end, other):
                links.append((i, j))
    return groups, links


def aligned(libraries, docs):
    parts = [(doc_id, whole(libraries, text)) for doc_id, text in docs]
    parts = [(doc_id, found, *(linked(found) if found else ([], []))) for doc_id, found in parts]
    counts = Counter(pair for *_, links in parts for pair in set(links))
    top = {}
    for (a, _), n in counts.items():
        top[a] = max(n, top.get(a, 0))
    rows = []
    for doc_id, found, groups, links in parts:
        rows.append((
            doc_id, len(found[0][0]) if found else 0, len(found[1][0]) if found else 0, len(groups), len(links),
            sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if found else "",
        ))
    return sorted(rows, key=str)


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
HARD = [
    "a é 漢字 😀 x", "  two  blanks ", "\nline\n\n  next \n x", "<s> </s> <unk> <0x41> <|endoftext|>", "a▁b c d", "▁", "\x00\x01 z", "ﬁ ½ ㎏",
    "tab\tand\r\nreturn {\r\n}", "don't they'll 'S", "　wide gap​", "👩‍👩‍👧 flags 🇩🇪", "x" * 300, " ", "\n", "؀ ظلم ไทย", "1234567 3.14",
]


def test_alignment(make_docs, odd_rows, libraries):
    rows = [(r[0], (r[1] or "")[:3000] or r[1]) for r in odd_rows] + [(200 + i, t) for i, t in enumerate(HARD)]
    rows += [(300 + i, " ".join(HARD)) for i in range(3)] + [(310, "\n".join(HARD))]
    docs = make_docs([(*r, "a") for r in rows], extra=[*CLASHING, "id", "ids", "block", "pair", "count", "best", "docs"])
    assert rows_of(token_alignment.align(docs, *PATHS), *ALIGNED) == aligned(libraries, rows)


def test_alignment_over_blocks(spark, make_docs, libraries, monkeypatch):
    """Counts go over blocks: each batch of this table makes several."""
    rows = [(i, f"{HARD[i % 7]} and some words {i % 5} more\nof them") for i in range(40)]
    docs = make_docs([(*r, "a") for r in rows])
    files = spark.sparkContext.broadcast((open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read()))
    assert token_alignment.blocks_of(docs, "doc_id", "text", files).count() == 3
    assert rows_of(token_alignment.align(docs, *PATHS), *ALIGNED) == aligned(libraries, rows)


def test_alignment_of_nothing(make_docs):
    assert token_alignment.align(make_docs([]), *PATHS).count() == 0
    got = token_alignment.align(make_docs([(1, None, "a"), (None, "", None)]), *PATHS)
    assert rows_of(got, *ALIGNED) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]


def test_links_of_documents_are_counted_in_runs(libraries, monkeypatch):
    """Counts don't depend on the runs, and links of many documents are never written out together."""
    rows = [(i, " ".join(HARD[i % 5 : i % 5 + 1 + i % 9])) for i in range(60)] + [(60, None), (61, "")]

    def packed():
        block = token_alignment.Block(libraries[2])
        for doc_id, text in rows:
            block.add(str(doc_id), text)
        row = block.row(0).iloc[0]
        first, second, docs = (token_alignment.unpack_numbers(row[n]).tolist() for n in ("first", "second", "docs_with"))
        # chunks that do not give their own bytes are replaced, and leave pairs that no document holds
        return {(a, b): n for a, b, n in zip(first, second, docs) if n}

    texts = [found for _, text in rows if text and (found := whole(libraries, text))]
    held = [(set(pairs), len(pairs)) for pairs in ([(int(a), int(b)) for a, b in linked(found)[1]] for found in texts)]
    expected = Counter(pair for pairs, _ in held for pair in pairs)
    assert packed() == expected
    together, spread = [], token_alignment.spread
    monkeypatch.setattr(token_alignment, "LINKS_TOGETHER", 100)
    monkeypatch.setattr(token_alignment, "spread", lambda lens, chosen: together.append(int(lens[chosen].sum())) or spread(lens, chosen))
    assert packed() == expected
    assert len(together) > 1 and max(together) <= max(100, max(n for _, n in held))


TEXT = st.text(alphabet=st.sampled_from(list(" \n\n  \t\rab.,'sé漢😀▁<0>xA1　 ü—")), max_size=80)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_chunks_give_what_whole_texts_give(libraries, texts):
    block = token_alignment.Block(libraries[2])
    for i, text in enumerate(texts):
        block.add(str(i), text)
    row = block.row(0).iloc[0]
    for k, text in enumerate(texts):
        found = whole(libraries, text)
        groups, links = linked(found) if found else ([], [])
        assert row["groups"][k] == (hashlib.sha256(";".join(groups).encode()).hexdigest() if found else "")
        assert (row["n_groups"][k], row["n_links"][k]) == (len(groups), len(links))


@settings(max_examples=200, deadline=None)
@given(TEXT.filter(bool))
def test_spans_with_refined_cuts_are_byte_ends(libraries, text):
    found = libraries[2].encode(" " + text)
    expected = whole(libraries, text)
    if expected is None:
        assert found is None
    else:
        assert [x.tolist() for x in found] == [x for side in expected for x in side]


# ---- archives of repeated rows, and near copies by row ----------------------------------

def test_archives_of_repeated_rows_when_joins_are_split(spark):
    """Equal rows are records of their own with ids of their own, one of them the response, however Spark deals them out."""
    payload = "p" * 200_000
    rows = [(7, None, payload)] * 25 + [(7, "http://a", payload)] * 15 + [(i, "u", f"page {i}") for i in range(300)]
    rows += [(None, None, "same")] * 5 + [(None, "u", None)] * 3
    split = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k", "spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    usual = {k: spark.conf.get(k) for k in split}
    folder = new_path(spark, "warc")
    try:
        for k, v in split.items():
            spark.conf.set(k, v)
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(16)
        index = warc.write_bundles(pages, folder)
        found = warc.page_digests(spark, folder).collect()
        assert warc.lookup(index, folder).count() == len(rows)
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)
    types = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found)
    assert types[7, 200_000, "response", None] == 1 and types[7, 200_000, "revisit", 7] == 39
    assert types[None, 4, "response", None] == 1 and types[None, 4, "revisit", None] == 4
    assert sum(types.values()) == len(rows) and sum(n for t, n in types.items() if t[2] == "response") == 303
    assert index.select("record_id").distinct().count() == len(rows)


def test_small_equal_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "x")] * 3 + [(2, "v", "x"), (3, None, "long payload"), (3, None, "long payload")], "page_id long, url string, html string")
    folder = new_path(spark, "warc")
    index = warc.write_bundles(pages, folder, 5)
    found = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.page_digests(spark, folder).collect())
    assert found == {(1, "response", None): 3, (2, "response", None): 1, (3, "response", None): 1, (3, "revisit", 3): 1}
    assert index.select("record_id").distinct().count() == 6


def test_near_copies_of_rows_that_share_an_id(spark, tmp_path):
    """Clean documents with one id and different texts both stay; of each group one row does."""
    words = [f"w{i}" for i in range(80)]
    one, two, three = " ".join(words[:30]), " ".join(words[30:60]), " ".join(words[50:80])
    rows = [(5, one), (5, two), (9, one), (2, two), (2, two), (7, three), (None, three), (8, None), (8, None), (8, "")]
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(path)
    kept = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(path), "").collect()
    assert Counter((r.doc_id, r.text) for r in kept) == {(5, one): 1, (2, two): 1, (7, three): 1, (None, three): 1, (8, None): 2, (8, ""): 1}


def test_of_query_rows_with_one_id_the_smallest_vector_asks(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.0, 0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for part in (1, 3):
        found = topk_search.search(vectors.repartition(part), F.col("vec_id") % 50 == 0, 1).collect()
        assert [(r.query_id, r.vec_id, r.score) for r in found] == [(50, 2, 256 * 128)]
