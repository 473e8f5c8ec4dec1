"""Mixing, WARC, search, toxicity, URL filter and BPE against brute force, odd inputs included."""

import base64
import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from termloom.llm import bpe, mixing, topk_search, toxicity, url_filter, warc
from termloom.operators.staging import new_path

from .conftest import CLASHING

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- mixing ------------------------------------------------------------------------------

def test_share_out_fills_small_sources_first():
    assert mixing.share_out([10, 1000], [5, 1], 900, 2) == [20, 880]
    assert mixing.share_out([100, 100], [3, 1], 100, 2) == [75, 25]
    assert mixing.share_out([10, 0, 10], [1, 1, 1], 40, 2) == [20, 0, 20]
    assert mixing.share_out([], [], 0, 2) == []


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000])
def test_permutation(size):
    images = mixing.permute(np.arange(size), size, 9)
    assert sorted(images) == list(range(size))
    assert (mixing.permute(images, size, 9, back=True) == np.arange(size)).all()


def test_shards_share_the_totals_whoever_asks():
    totals = np.array([700, 0, 90, 3000])
    everything = list(mixing.shard_counts(totals, 128, 0, 99, 1))
    assert sum(own for _, _, own in everything).tolist() == totals.tolist()
    assert all(own.sum() == 128 for _, _, own in everything[:-1])
    for shard, before, own in itertools.chain(*[mixing.shard_counts(totals, 128, s, s + 1, 1) for s in range(len(everything))]):
        assert (before == everything[shard][1]).all() and (own == everything[shard][2]).all()
    # no source sits in one place: its share of a shard is about its share of the mix
    assert all(70 < own[3] < 125 for _, _, own in everything[:-1])


@pytest.mark.parametrize("block_words", [7, 256])
def test_mix_of_odd_rows(make_docs, odd_rows, block_words):
    docs = make_docs(odd_rows, CLASHING)
    found = mixing.mixed_counts(docs, (5, 2, 1), 1.5, 2, block_words=block_words).collect()
    sizes = [len(WORD.findall(t or "")) for _, t, _ in odd_rows]
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((d, n) for (d, _, _), n in zip(odd_rows, sizes))
    by_source = defaultdict(int)
    for (_, _, s), n in zip(odd_rows, sizes):
        by_source[s] += n
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    targets = dict(zip(names, mixing.share_out([by_source[s] for s in names], [[5, 2, 1][i % 3] for i in range(len(names))], 1.5 * sum(sizes), 2)))
    assert {(r["source_size"], r["target"]) for r in found} == {(by_source[s], targets[s]) for s in names}
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    taken = defaultdict(int)
    for r in found:
        taken[r["source_size"], r["target"]] += r["taken"]
    for (_, target), n in taken.items():
        assert abs(n - target) <= 0.5 + 1e-9
    texts = mixing.mixed_texts(docs, (5, 2, 1), 1.5, 2, block_words=block_words)
    assert set(CLASHING) - {"low", "shard", "slot"} <= set(texts.columns)
    words = Counter()
    for r in texts.select("doc_id", "text").collect():
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    expected = Counter()
    for r in found:
        expected[r["doc_id"]] += r["taken"]
    assert +words == +expected


def test_mix_of_nothing(make_docs):
    assert mixing.mixed_counts(make_docs([]), (5, 2, 1), 1.5, 2).count() == 0
    assert mixing.mixed_texts(make_docs([(1, None, "a")]), (5, 2, 1), 1.5, 2).count() == 0


# ---- WARC --------------------------------------------------------------------------------

def page_rows():
    rng = random.Random(2)
    html = ["<p>same</p>", "", None, "é" * 10, "\r\n\r\nWARC/1.1\r\n\r\n", "".join(rng.choice("abc<>\n") for _ in range(3_000_000))]
    return [(i, f"http://h/{i}\r\nx: y" if i == 3 else f"http://h/{i}", html[i % len(html)]) for i in range(5, 40)] + [(None, None, "<p>same</p>"), (None, None, "lone"), (2, None, "<p>same</p>")]


@pytest.mark.parametrize("least", [0, 12])
def test_warc_round_trip(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "FRAME_BYTES", 1000)
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).withColumn("payload", F.lit("clash"))
    folder = new_path(spark, "warc")
    index = warc.write_bundles(pages, folder, least)
    first = {}
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault((html or "").encode(), i)
    expected = Counter()
    for i, _, html in rows:
        payload = (html or "").encode()
        sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        response = first[payload] == i or len(payload) < least
        expected[(i, len(payload), sha, "response" if response else "revisit", None if response else first[payload])] += 1
    found = warc.page_digests(spark, folder)
    assert Counter(map(tuple, found.drop("url").collect())) == expected
    assert "http://h/9" in {r["url"] for r in found.collect()}
    some = index.filter("page_id IN (5, 10, 39)")
    by_lookup = {(r["record_id"], bytes(r["payload"])) for r in warc.lookup(some, folder).collect()}
    by_reading = {(r["record_id"], bytes(r["payload"])) for r in warc.read_bundles(spark, folder).filter("page_id IN (5, 10, 39)").collect()}
    assert by_lookup == by_reading and len(by_lookup) == 3
    assert index.select("record_id").distinct().count() == len(rows)


def test_equal_ids_and_payloads_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (2, "u", "x")], "page_id long, url string, html string")
    folder = new_path(spark, "warc")
    warc.write_bundles(pages, folder)
    found = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.page_digests(spark, folder).collect())
    assert found == {(1, "response", None): 1, (1, "revisit", 1): 1, (2, "revisit", 1): 1}
    assert warc.write_bundles(pages.limit(0), new_path(spark, "warc")).count() == 0


def test_frames_are_plain_zstandard():
    import zstandard

    bundle = warc.Bundle()
    for i in range(50):
        bundle.add(warc.record({"WARC-Record-ID": f"<{i}>"}, b"x" * 100_000))
    content = bundle.content()
    whole = b"".join(zstandard.ZstdDecompressor().decompress(content[s : s + n], max_output_size=size) for s, n, size in warc.seek_table(content))
    assert len(warc.seek_table(content)) > 3 and len(list(warc.parse(whole))) == 50


# ---- search ------------------------------------------------------------------------------

def brute_search(rows, k):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = Counter()
    for q in usable:
        if q % 50 == 0:
            found = sorted((-sum(map(int.__mul__, usable[q][0], v)), i) for i, own in usable.items() for v in own if i != q and len(v) == len(usable[q][0]))
            out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k]))
    return out


@pytest.mark.parametrize("block", [2048, 2])
def test_search(spark, monkeypatch, block):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", block)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.4, 8).tolist()) for i in range(300)]
    rows += [(1000 + i, [0.5] * 8) for i in range(40)] + [(50 * i, [0.5] * 8) for i in range(7, 10)]  # ties
    rows += [(2000, None), (2050, []), (2100, [1.0, None]), (2150, [float("nan")] * 8), (2200, [float("inf")] * 8), (None, [0.1] * 8)]
    rows += [(3000, [1.0, 2.0]), (3001, [3.0, -1.0]), (4000, [1.0]), (310, [0.0] * 8), (311, [0.2] * 8), (311, [0.2] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).withColumn("id", F.lit("x")).withColumn("vector", F.lit(1))
    found = topk_search.search(vectors, F.col("vec_id") % 50 == 0, 5)
    assert Counter(map(tuple, found.select("query_id", "rank", "vec_id", "score").collect())) == brute_search(rows, 5)


def test_search_of_nothing(spark):
    assert topk_search.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True), 5).count() == 0


# ---- toxicity ----------------------------------------------------------------------------

def brute_kernel(a, b, n=toxicity.ORDER, decay=toxicity.DECAY):
    def features(s):
        out = defaultdict(float)
        for c in itertools.combinations(range(len(s)), n):
            out[tuple(s[i] for i in c)] += decay ** (c[-1] - c[0] + 1)
        return out

    x, y = features(a), features(b)
    return sum(v * y[k] for k, v in x.items() if k in y)


@pytest.mark.parametrize("pair", [("idiot", "id-iot"), ("banana", "ananas"), ("abc", "abc"), ("ab", "abab"), ("xyz", "zyx")])
def test_kernel(pair):
    a, b = pair
    assert toxicity.kernel(toxicity._codes([a], 9), toxicity._codes([b], 12))[0] == pytest.approx(brute_kernel(a, b))


def toxic_rows(n=400, seed=3):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(3, 9))) for _ in range(600)]
    insults, rows = ["grumblok", "zorfwit", "quixbane"], []
    for i in range(n):
        words, bad = [rng.choice(plain) for _ in range(rng.randrange(3, 60))], i % 4 == 0
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_held_out_accuracy_gaps_and_odd_texts(spark, make_docs):
    rows = toxic_rows()
    docs = make_docs([(i, t, None) for i, t, _ in rows], CLASHING)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5000, None), (3, 0)], "doc_id long, toxic int")
    usable = F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False))
    model = toxicity.fit(docs, toxicity.sample(labels, usable, "doc_id", "toxic"))
    held = docs.filter("doc_id % 3 = 1")
    found = {r["doc_id"]: r["score"] for r in toxicity.score(held, model).collect()}
    truth = {i: y for i, _, y in rows}
    caught = [found[i] >= 0.7 for i in found if truth[i]]
    wrong = [found[i] >= 0.7 for i in found if not truth[i]]
    print("recall", np.mean(caught), "false alarms", np.mean(wrong))
    assert np.mean(caught) > 0.95 and np.mean(wrong) < 0.02
    texts = ["grum-blok", "g r u m b l o k", "GRUMBLOK!", "grumxblok", "", None, " \n", "rain " * 40_000, "x" * 100_000]
    odd = make_docs([(i, t, None) for i, t in enumerate(texts)], ["score"])
    scores = [r["score"] for r in toxicity.score(odd, model).orderBy("doc_id").collect()]
    assert scores[2] >= 0.7 and min(scores[0], scores[3]) >= 0.5  # one letter in between costs a part of the score
    assert scores[1] > 5 * scores[4] and scores[4] == scores[5] == scores[6] < 0.3
    assert max(scores[7:]) < 0.5 and all(0 <= s <= 1 for s in scores)


def test_one_gapped_insult_passes_the_bar(spark, make_docs):
    rows, rng = toxic_rows(), random.Random(8)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3 != 1], "doc_id long, toxic int")
    model = toxicity.fit(make_docs([(i, t, None) for i, t, _ in rows]), toxicity.sample(labels, F.lit(True), "doc_id", "toxic"))
    clean = [t for i, t, y in rows if i % 3 == 1 and not y]
    gapped = [gap.join(w) for w in ("grumblok", "zorfwit", "quixbane") for gap in ("-", "--", ".....", "*_*", "1", " ", "  ", " - ")]
    for word in ("grumblok", "zorfwit", "quixbane"):
        gapped += [word[:2] + "-" + word[2:], word[:2] + "-" + word[2:4] + "-" + word[4:], word[:4] + "x" + word[4:], word[:3] + "y" + word[3:5] + "k" + word[5:]]
    planted = [f"{rng.choice(clean)} {w} {rng.choice(clean)}" for w in gapped]
    docs = make_docs([(i, t, None) for i, t in enumerate(planted + clean)])
    scores = [r["score"] for r in toxicity.score(docs, model).orderBy("doc_id").collect()]
    low = [w for w, s in zip(gapped, scores) if s < 0.7]
    assert not low
    assert sum(s >= 0.7 for s in scores[len(planted):]) <= 0.02 * len(clean)


@pytest.mark.parametrize("pair", [("^idiot", "^idxixot", 2), ("abc", "xaxbxc", 2), ("abcd", "acbd", None)])
def test_whole_landmarks(pair):
    landmark, word, between = pair
    marks = toxicity.Landmarks([landmark])
    numbers = marks.number[toxicity._codes([word], 12).T]
    whole = toxicity._in_order(numbers, marks.places[0], len(landmark))[0] == len(landmark)
    assert whole == (between is not None)
    value = marks.values([word.removeprefix("^")])[0, 0]
    if whole:
        assert value == pytest.approx(toxicity.WHOLE_DECAY**between, abs=1e-6)


def test_landmarks_of_a_group_do_not_touch():
    rng = random.Random(4)
    names = list(dict.fromkeys("".join(rng.choice("^abcd") for _ in range(rng.randrange(3, 12))) for _ in range(40)))
    words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 50))) for _ in range(200)]
    together = toxicity.Landmarks(names)
    assert 1 < len(together.groups) < len(names)
    alone = np.hstack([toxicity.Landmarks([n]).values(words) for n in names])
    assert (together.values(words) == alone).all() and alone.any()
    whole = toxicity.whole_kernel(toxicity._codes(["abc"], 3)[0], toxicity._codes(["xaxbbxc", "acb"], 9), 0.9)
    assert whole == pytest.approx([brute_kernel("abc", w, 3, 0.9) / 0.9**6 for w in ("xaxbbxc", "acb")])


def test_one_class_gives_its_share(spark, make_docs):
    docs = make_docs([(1, "a b", None), (2, None, None)])
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, toxicity.sample(labels, F.lit(True), "doc_id", "toxic"))
    assert all(r["score"] < 1e-5 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(docs.limit(0), model).count() == 0


# ---- URLs --------------------------------------------------------------------------------

RULES = [url_filter.Rule("org/", True), url_filter.Rule("bad.org/x/", False), url_filter.Rule("com/de/", False)]


def test_rules_and_odd_urls(spark):
    urls = {
        "http://WWW.Bad.ORG/x/1": ("www.bad.org", "/x/1", "bad.org/x/", "block"), "http://bad.org/x": ("bad.org", "/x", "org/", "allow"),
        "http://notbad.org/x/": ("notbad.org", "/x/", "org/", "allow"), "http://org": ("org", "", None, None), "http://a.com/de/?q": ("a.com", "/de/", "com/de/", "block"),
        "http://a.com?x=/de/": ("a.com", "", None, None), "none": ("", "", None, None), None: ("", "", None, None), "x://h/a://b#c": ("h", "/a://b", None, None),
        "http://a.org/" + "y" * 20_000: ("a.org", "/" + "y" * 20_000, "org/", "allow"), "": ("", "", None, None),
    }
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] * 2, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    found = url_filter.judge(pages, RULES).collect()
    assert len(found) == 2 * len(urls)
    for r in found:
        host, path, rule, verdict = list(urls.values())[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ([verdict] if verdict else ["allow", "block"])
    assert url_filter.judge(pages.limit(0), RULES).count() == 0


def test_models_agree_with_rules_on_urls_they_have_not_seen(spark):
    rng = random.Random(6)
    good = [f"http://site{rng.randrange(99)}.org/news/{rng.choice(['paper', 'story', 'report'])}{i}" for i in range(300)]
    bad = [f"http://shop{rng.randrange(99)}.com/de/{rng.choice(['pills', 'casino', 'xxx'])}{i}" for i in range(300)]
    fresh = [f"http://a.net/news/story{i}" for i in range(50)] + [f"http://b.net/de/casino{i}" for i in range(50)]
    pages = spark.createDataFrame(list(enumerate(good + bad + fresh)), "page_id long, url string")
    found = {r["page_id"]: r for r in url_filter.judge(pages, RULES).collect()}
    right = [found[600 + i]["verdict"] == ("allow" if i < 50 else "block") for i in range(100)]
    assert np.mean(right) > 0.9


def test_probabilities_add_up_and_match_the_recursion():
    rng = np.random.default_rng(1)
    counts = np.zeros(url_filter.SIZE ** 4)
    counts[rng.integers(0, len(counts), 3000)] += rng.integers(1, 9, 3000)
    p = url_filter._probabilities(counts)
    assert np.allclose(p.sum(axis=-1), 1)
    table = counts.reshape([url_filter.SIZE] * 4)

    def brute(context, symbol):
        seen = table.sum(axis=tuple(range(3 - len(context))))
        for c in context:
            seen = seen[c]
        lower = brute(context[1:], symbol) if context else 1 / url_filter.SIZE
        kinds = (seen > 0).sum()
        return (seen[symbol] + kinds * lower) / (seen.sum() + kinds) if kinds else lower

    for at in zip(*np.unravel_index(rng.integers(0, len(counts), 50), table.shape)):
        assert p[at] == pytest.approx(brute(at[:3], at[3]))


# ---- BPE ---------------------------------------------------------------------------------

def test_ids_and_bytes_as_the_library_gives_them(make_docs, odd_rows):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [" \x1c\x1d x\x85y  \xa0z", "  \n\n it's  12345 \t", "🎉🎉 \u3000 ok", "a" * 700 + "the" * 300, "<|endoftext|>", "ﬀ İ ß 一二三"]
    rows = odd_rows + [(200 + i, t, "t") for i, t in enumerate(texts)]
    found = bpe.decode(bpe.encode(make_docs(rows, CLASHING + ["ids", "decoded", "doc"]), ranks, public_tokenizers.PATTERN), ranks).collect()
    expected = Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t, _ in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in found) == expected


def test_no_documents_to_encode(make_docs):
    ranks = {bytes([i]): i for i in range(256)}
    assert bpe.encode(make_docs([]), ranks, public_tokenizers.PATTERN).count() == 0


def test_digests_of_ids_are_taken_where_ids_are_packed(spark, capsys):
    """Only digests leave Python, not the ids as bytes again; null ids have no digest."""
    rows = spark.createDataFrame([(1, [0, 1, 70_000]), (2, []), (3, None)], "doc_id long, ids array<int>")
    found = rows.select("doc_id", bpe.ids_digest(F.col("ids")).alias("digest"))
    packed = {1: (0).to_bytes(4, "little") + (1).to_bytes(4, "little") + (70_000).to_bytes(4, "little"), 2: b""}
    assert dict(found.collect()) == {i: hashlib.sha256(b).hexdigest() for i, b in packed.items()} | {3: None}
    found.explain()
    assert "sha2" not in capsys.readouterr().out


def test_long_words_merge_like_short_ones(monkeypatch):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(8)
    words = ["".join(rng.choice("abehnrst") for _ in range(rng.randrange(2, 90))).encode() for _ in range(200)]
    by_pairs = [bpe.merge(w, ranks) for w in words if len(w) <= bpe.SHORT]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert by_pairs == [bpe.merge(w, ranks) for w in words if len(w) <= 48]
