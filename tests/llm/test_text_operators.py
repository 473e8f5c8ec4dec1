"""Deduplication and similarity operators against brute force, odd inputs included."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from termloom.llm import exact_dedup, line_dedup, ngram_join, substring_dedup
from pyspark.sql import functions as F

from .conftest import CLASHING

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, k=5):
    words = WORD.findall(ascii_lower(text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(rows):
    """(doc_id, set size, smallest reachable id) of all rows."""
    sets = [shingles(t) for _, t, _ in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group[top(i)] = top(j)
    ids = defaultdict(list)
    for i, (doc_id, _, _) in enumerate(rows):
        ids[top(i)] += [doc_id] if doc_id is not None else []
    return Counter((r[0], len(s), min(ids[top(i)], default=None)) for i, (r, s) in enumerate(zip(rows, sets)))


def near_rows(seed, n=60):
    """Texts in groups of near copies of many degrees, of words that few or many texts have."""
    rng = random.Random(seed)
    common, rows = [f"c{i}" for i in range(12)], []
    for doc_id in range(n):
        if rows and rng.random() < 0.7:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(common + [f"r{rng.randrange(50)}"])
            if rng.random() < 0.3:
                words = words[: max(1, len(words) - rng.randrange(12))]
        else:
            words = [rng.choice(common) if rng.random() < 0.8 else f"r{rng.randrange(300)}" for _ in range(rng.choice([3, 5, 9, 40, 90, 160]))]
        rows.append((doc_id, " ".join(words), "s"))
    return rows


def test_similarity_join_of_odd_rows(make_docs, odd_rows):
    found = ngram_join.near_duplicates(make_docs(odd_rows, CLASHING)).collect()
    assert Counter(map(tuple, found)) == brute_components(odd_rows)


@pytest.mark.parametrize("frequent", [0, 3])
def test_similarity_join_with_frequent_words(make_docs, monkeypatch, frequent):
    """Tokens in pairs from the first or fourth document on: the prefixes must still meet."""
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rows = near_rows(frequent)
    found = ngram_join.near_duplicates(make_docs(rows)).collect()
    assert Counter(map(tuple, found)) == brute_components(rows)


def test_index_keys_meet_for_similar_sets():
    """Whatever the frequencies, two sets of similarity 0.8 or more share a key."""
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(4, 300))
        universe = rng.choice(2**60, size=2 * n + 10, replace=False).astype(np.uint64)
        bound = dict(zip(universe.tolist(), rng.choice([2, 5, 70, 900], size=len(universe), p=rng.dirichlet([1, 1, 1, 1])).tolist()))
        left = set(universe[:n].tolist())
        drop = set(rng.choice(sorted(left), size=int(rng.integers(0, n // 5 + 1)), replace=False).tolist())
        right = (left - drop) | set(universe[n : n + int(rng.integers(0, n // 8 + 1))].tolist())
        if left == right or 100 * len(left & right) < 80 * len(left | right):
            continue
        keys = []
        for own in (left, right):
            tokens = np.array(sorted(own), dtype=np.uint64)
            found, rooms = ngram_join.index_keys(tokens, np.array([bound[t] for t in tokens.tolist()]), 0.8)
            keys.append(dict(zip(found.tolist(), rooms.tolist())))
        # and one of these keys leaves them the overlap they have
        shared = [min(keys[0][k], keys[1][k]) for k in keys[0].keys() & keys[1].keys()]
        assert max(shared, default=0) >= len(left & right)
        a, b = (ngram_join.sketch(np.array(sorted(s), dtype=np.uint64)) for s in (left, right))
        assert ngram_join.sketches_differ(a, b) <= len(left ^ right)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(7, 9)], "a long, b long")
    found = dict(map(tuple, ngram_join.components(edges, "chain").collect()))
    assert found == {**{i: 100 for i in range(100, 161)}, 7: 7, 9: 7}


def brute_windows(rows, window=13):
    words = [WORD.findall(t or "") for _, t, _ in rows]
    first = {}
    for (doc_id, _, _), own in zip(rows, words):
        for i in range(len(own) - window + 1):
            key, at = tuple(own[i : i + window]), float("inf") if doc_id is None else doc_id
            first[key] = min(first.get(key, at), at)
    out = []
    for (doc_id, _, _), own in zip(rows, words):
        gone = set()
        for i in range(len(own) - window + 1):
            if first[tuple(own[i : i + window])] < (float("inf") if doc_id is None else doc_id):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((doc_id, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_repeated_windows_of_odd_rows(make_docs, odd_rows):
    rng = random.Random(5)
    passage = " ".join(f"p{rng.randrange(30)}" for _ in range(70))
    rows = odd_rows + [(100 + i, f"start{i} {passage[rng.randrange(40):]} end{i} " + "la " * rng.randrange(40), "x") for i in range(12)]
    found = substring_dedup.remove_repeats(make_docs(rows, CLASHING)).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256), "removed").collect()
    assert Counter(tuple(r)[:4] for r in found) == brute_windows(rows)
    assert all(sum(b - a for a, b in r["removed"]) == r["n_removed"] for r in found)


def test_fm_index_counts_and_documents():
    import numpy as np

    rng = np.random.default_rng(0)
    sequence = rng.integers(1, 4, size=500)
    sequence[[100, 250, 251, 499]] = 0
    doc = np.cumsum(sequence == 0)
    places = np.array([i for i in range(496) if 0 not in sequence[i : i + 4]])
    alive, smallest = substring_dedup.repeated(sequence, doc, places, 4)
    windows = defaultdict(list)
    for i in places:
        windows[tuple(sequence[i : i + 4])].append(i)
    expected = {i: min(doc[j] for j in windows[tuple(sequence[i : i + 4])]) for i in places if len(windows[tuple(sequence[i : i + 4])]) > 1}
    assert dict(zip(places[alive].tolist(), smallest.tolist())) == expected


def test_exact_dedup_of_odd_rows(make_docs, odd_rows):
    found = exact_dedup.deduplicate(make_docs(odd_rows, CLASHING)).collect()
    groups = defaultdict(list)
    for doc_id, text, _ in odd_rows:
        groups[ascii_lower(text or "")].append(doc_id)
    expected = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected.update([(keep, keep, len(ids), True, sha)])
        rest = list(ids)
        rest.remove(keep)
        expected.update((i, keep, len(ids), False, sha) for i in rest)
    assert Counter(map(tuple, found)) == expected


def test_index_keeps_what_it_has_and_takes_what_is_new(spark, make_docs):
    from termloom.operators.staging import new_path

    index = exact_dedup.DigestIndex(spark, "digests_of_test", new_path(spark, "index"), buckets=4)
    first = exact_dedup.deduplicate(make_docs([(1, "a", None), (2, "b", None)]), index=index).collect()
    assert {(r["doc_id"], r["kept"]) for r in first} == {(1, True), (2, True)}
    second = exact_dedup.deduplicate(make_docs([(8, "A", None), (9, "c", None)]), index=index).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in second} == {(8, 1, False), (9, 9, True)}
    assert index.table().count() == 3
    assert spark.sql("DESCRIBE EXTENDED digests_of_test").filter("col_name = 'Bucket Columns'").first()["data_type"] == "[`digest`]"


def test_a_bucket_of_the_index_is_one_file(spark, make_docs, monkeypatch):
    """However many tasks a cluster deals keys to, a batch adds a file per bucket, not one per bucket and task."""
    from termloom.operators.staging import new_path

    frame = type(spark.range(0))
    dealt = frame.repartition

    def raised(df, first, *keys):
        return dealt(df, max(first, 37), *keys) if isinstance(first, int) and keys else dealt(df, first, *keys)

    monkeypatch.setattr(frame, "repartition", raised)
    index = exact_dedup.DigestIndex(spark, "digests_in_files", new_path(spark, "index"), buckets=4)
    found = exact_dedup.deduplicate(make_docs([(i, f"text {i}", None) for i in range(200)]), index=index)
    assert found.filter("kept").count() == 200
    assert len(index.table().inputFiles()) == 4


def line_rows():
    rows = [(i, f"menu \nown {i}\nmenu", "big") for i in range(30)] + [(100 + i, "rare" if i < 2 else f"x{i}", "big") for i in range(30)]
    return rows + [(200 + i, "menu\nsmall", "tiny") for i in range(3)] + [(300, None, "big"), (301, "", None), (302, "menu\n\nother", None)]


@pytest.mark.parametrize("small", [True, False])
def test_line_dedup(make_docs, monkeypatch, small):
    monkeypatch.setattr(line_dedup, "fits_broadcast", lambda df: small)
    found = line_dedup.drop_boilerplate(make_docs(line_rows(), CLASHING), F.col("source"), "text")
    assert set(CLASHING) <= set(found.columns)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in found.collect()}
    assert got[0] == ("own 0", 3, 2) and got[29] == ("own 29", 3, 2)
    assert got[100] == ("rare", 1, 0) and got[200] == ("menu\nsmall", 2, 0)
    assert got[300] == (None, 0, 0) and got[301] == ("", 1, 0) and got[302] == ("menu\n\nother", 3, 0)
    assert len(got) == len(line_rows())


def test_line_dedup_runs_no_python(make_docs):
    found = line_dedup.drop_boilerplate(make_docs(line_rows()), F.col("source"), "text")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_hosts(spark):
    urls = ["http://WWW.A.org/x", "https://b.net?q=1", "c.org/x", None, "x://y://z/", "http://É.com#f"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(line_dedup.host_of(F.col("url")))
    assert [r[0] for r in df.collect()] == ["www.a.org", "b.net", "", "", "y:", "É.com"]


def test_empty_tables(make_docs):
    none = make_docs([])
    assert ngram_join.near_duplicates(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    assert exact_dedup.deduplicate(none).count() == 0
    assert line_dedup.drop_boilerplate(none, F.col("source"), "text").count() == 0
