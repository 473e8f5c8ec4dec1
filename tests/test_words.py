"""Plain lists, words, analyzers."""

import pytest
from pyspark.sql import functions as F

from termloom.functions import analysis
from termloom.operators import elements, index

ITEMS = "1 1 1 1 2 2 2 3 3 3 test1 test2 test2".split()


@pytest.fixture(scope="module")
def listed(spark):
    return spark.createDataFrame(list(enumerate(ITEMS)), "pos long, elem string")


@pytest.mark.parametrize(
    "n, expected",
    [(1, ["1", "2", "3", "test1", "test2"]), (2, ["1", "2", "3", "test2"]), (3, ["1", "2", "3"]), (10, [])],
)
def test_unique_elements(listed, n, expected):
    got = elements.unique_elements(listed, n).orderBy("first_pos").collect()
    assert [r.elem for r in got] == expected


def test_occurrences(listed):
    assert elements.occurrences(listed, "3").first()[0] == 3
    assert elements.unique_elements(listed.limit(0)).collect() == []


TEXTS = [
    (1, "and with great power\ncomes great responsibility\nand few vacations"),
    (2, "document.with, punctuation:   with?spaces\ttabs\nwith newslines\n\n\n"),
]


def test_word_frequencies(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id int, text string")
    freqs = elements.word_map(elements.word_frequencies(docs)).collect()
    by_doc = {r.doc_id: r.frequencies for r in freqs}
    assert by_doc[1] == dict(
        great=2, power=1, comes=1, responsibility=1, few=1, vacations=1, **{"and": 2, "with": 1}
    )
    assert by_doc[2] == dict(document=1, punctuation=1, spaces=1, tabs=1, newslines=1, **{"with": 3})


def test_feature_vectors(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id int, text string")
    first = sorted({"and", "with", "great", "power", "comes", "responsibility", "few", "vacations"})
    second = ["document", "spaces", "tabs", "with", "great", "power"]
    got = {r.doc_id: r.vector for r in elements.feature_vectors(docs, first).collect()}
    assert got[1] == [2, 1, 1, 2, 1, 1, 1, 1]
    got = {r.doc_id: r.vector for r in elements.feature_vectors(docs, second).collect()}
    assert got[2] == [1, 1, 1, 3, 0, 0]
    maps = elements.word_map(elements.word_frequencies(docs))
    got = maps.select("doc_id", elements.vector_from_map(F.col("frequencies"), second).alias("v"))
    assert {r.doc_id: r.v for r in got.collect()}[2] == [1, 1, 1, 3, 0, 0]


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x"))).first()[0]


def test_analyzers(spark):
    assert one(spark, analysis.index_terms, "The Été_of 2 cats' and DOGS!") == ["été", "2", "cats", "dogs"]
    assert one(spark, analysis.standard_terms, " The cat's_hat") == ["the", "cat", "s", "hat"]
    assert one(spark, analysis.english_terms, "The cat's hat isn't HIS") == ["cat", "hat", "isn", "t", "his"]
    assert one(spark, analysis.index_terms, "") == []
    assert one(spark, analysis.index_terms, None) == []
    assert one(spark, analysis.long_words, "A b_c dd, é éé") == ["b_c", "dd", "éé"]


def test_strip_punctuation(spark):
    assert one(spark, analysis.strip_punctuation, "a.b, c?! d;e:") == "ab c de"
    stopped = one(spark, lambda c: analysis.strip_punctuation(c, ["the", "of"]), "The end, of it.")
    assert stopped == "end it"


def test_scalars(spark):
    assert one(spark, analysis.resolve_uri, "http://x/resource/Category:Soul_singers") == "Soul singers"
    assert one(spark, analysis.resolve_uri, "http://x/resource/Al_Green") == "Al Green"
    assert one(spark, analysis.entity_key, "Simon & Garfunkel") == "Simon_and_Garfunkel"


def test_stem_map(spark):
    terms = spark.createDataFrame([(1, "singers"), (1, "soul")], "doc_id int, term string")
    stems = spark.createDataFrame([("singers", "singer")], "term string, stem string")
    got = analysis.stemmed(terms, stems).collect()
    assert sorted(r.term for r in got) == ["singer", "soul"]


def test_index_lookups(spark, term_docs, term_queries):
    docs = term_docs({"a": {"title": "x", "body": "x y x"}, "b": {"title": "", "body": "y"}}, ["title", "body"])
    idx = index.build_index(docs, ["title", "body"])
    postings = idx.postings
    rows = sorted((r.field, r.term, r.doc_id, r.tf, r.dl) for r in postings.collect())
    assert rows == [("body", "x", "a", 2, 3), ("body", "y", "a", 1, 3), ("body", "y", "b", 1, 1), ("title", "x", "a", 1, 1)]
    assert sorted(r.term for r in index.field_terms(postings, "body").collect()) == ["x", "y"]
    assert index.term_frequency(postings, "body", "x", "a").first()[0] == 2
    assert index.term_frequency(postings, "body", "x", "b").first()[0] == 0
    assert sorted(tuple(r) for r in idx.doc_len.collect()) == [
        ("a", "body", 3), ("a", "title", 1), ("b", "body", 1), ("b", "title", 0)
    ]
    assert idx.stats.doc_count == {"title": 1, "body": 2} and idx.stats.avg_len("body") == 2.0
    assert [r.doc_id for r in index.field_documents(docs, "title").collect()] == ["a"]
    seen = index.seen_terms(term_queries({"q": "y z y"}), postings, "body").orderBy("qpos").collect()
    assert [(r.qpos, r.term) for r in seen] == [(0, "y"), (2, "y")]
    lengths = {r.field: (r.total_len, r.avg_len) for r in index.field_lengths(docs, ["title", "body"]).collect()}
    assert lengths == {"title": (1, 0.5), "body": (4, 2.0)}
