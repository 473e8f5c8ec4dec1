"""Stored indexes: pairs from positions, and an index that grows."""

import random

import pytest

from termloom.operators import dependence, scorers
from termloom.operators.index import build_index, query_units, restrict
from termloom.operators.joins import top_k
from termloom.operators.positional import paired
from termloom.sources import segments, sinks

FIELDS = ["title", "body"]
RNG = random.Random(11)
DOCS = {
    i: {"title": " ".join(RNG.choices("abc", k=RNG.randint(0, 4))), "body": " ".join(RNG.choices("abcdef", k=RNG.randint(0, 25)))}
    for i in range(40)
}
QUERIES = {"q1": "a b a", "q2": "c c", "q3": "f e d c b a", "q4": "b x", "q5": "a"}


def entries_of(index):
    return sorted((r.doc_id, tuple(r.lens), r.kind, r.unit, tuple(r.tf)) for r in index.entries.filter("unit <> ''").collect())


def stats_of(index):
    units = sorted((r.kind, r.unit, tuple(r.df), tuple(r.ttf)) for r in index.unit_stats.collect())
    return units, sorted(tuple(r) for r in index.field_stats.select("field", "n_docs", "doc_count", "total_len").collect())


@pytest.fixture(scope="module")
def stored(term_docs, tmp_path_factory, spark):
    path = str(tmp_path_factory.mktemp("positions") / "index")
    sinks.save_index(build_index(term_docs(DOCS, FIELDS), FIELDS, staged=False, places=True), path)
    return sinks.load_index(spark, path)


@pytest.mark.parametrize("window", [1, 2, 3, 5])
@pytest.mark.parametrize("rule", ["pairs", "anchored"])
def test_pairs_from_positions(stored, term_docs, term_queries, window, rule):
    """One stored index gives what an index built for the window and rule gives."""
    units = query_units(term_queries(QUERIES), "TOU", rule)
    built = build_index(term_docs(DOCS, FIELDS), FIELDS, "TOU", window, rule, units)
    found = paired(stored, units, window, rule)
    assert entries_of(found) == entries_of(built)
    if window == 3:
        assert stats_of(found) == stats_of(built)
        left, right = (sorted(tuple(r) for r in top_k(dependence.sdm(i, units), 50).collect()) for i in (found, built))
        assert left == right


def test_positions_are_kept_of_single_terms_only(term_docs):
    with pytest.raises(ValueError):
        build_index(term_docs(DOCS, FIELDS), FIELDS, "TO", places=True)


def part(term_docs, ids, changed=()):
    docs = {i: {"title": "a a", "body": "old text f"} if i in changed else DOCS[i] for i in ids}
    return build_index(term_docs(docs, FIELDS), FIELDS, staged=False, places=True)


def test_growing_index(spark, term_docs, term_queries, tmp_path):
    """Two additions, a replacement in each of them, and a merge: always the rows of a fresh build."""
    path = str(tmp_path / "grown")
    fresh = build_index(term_docs(DOCS, FIELDS), FIELDS)
    units = query_units(term_queries(QUERIES))

    def same_as_fresh(index):
        assert entries_of(index) == entries_of(fresh) and stats_of(index) == stats_of(fresh)
        assert sorted(r.doc_id for r in index.documents.collect()) == sorted(DOCS)
        cut = restrict(index, units)
        left, right = (sorted(tuple(r) for r in top_k(scorers.bm25f(i, units), 5).collect()) for i in (cut, restrict(fresh, units)))
        assert left == right

    segments.append(part(term_docs, range(0, 25), changed=(3, 4, 20)), path)
    first = segments.load(spark, path)
    segments.append(part(term_docs, [*range(25, 33), 3, 20], changed=(20, 30)), path)
    segments.append(part(term_docs, [*range(33, 40), 4, 20, 30]), path)
    assert segments.versions(spark, path) == [1, 2, 3]
    grown = segments.load(spark, path)
    same_as_fresh(grown)
    # an older version is still what it was
    assert segments.load(spark, path, 1).documents.count() == first.documents.count() == 25
    merged = segments.merge(spark, path)
    assert segments.segments(spark, path) == [merged]
    same_as_fresh(segments.load(spark, path))
    # positions survive
    pairs = query_units(term_queries(QUERIES), "TOU")
    assert entries_of(paired(segments.load(spark, path), pairs)) == entries_of(build_index(term_docs(DOCS, FIELDS), FIELDS, "TOU", units=pairs))
    assert len(segments.remove_unused(spark, path)) == 3
    segments.append(part(term_docs, [5], changed=(5,)), path)
    assert segments.load(spark, path).documents.count() == 40


def test_growing_index_of_nothing(spark, term_docs, tmp_path):
    path = str(tmp_path / "empty")
    with pytest.raises(ValueError):
        segments.load(spark, path)
    segments.append(part(term_docs, [1, 2]), path)
    other = build_index(term_docs({1: {"body": "a"}}, ["body"]), ["body"], staged=False)
    with pytest.raises(ValueError):
        segments.append(other, path)
    assert segments.load(spark, path).documents.count() == 2
