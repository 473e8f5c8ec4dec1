"""Stems over the vocabulary, and entity indexes over given subjects."""

import random

import pytest
from pyspark.sql import functions as F

from termloom.functions import analysis
from termloom.operators import entities, joins
from termloom.operators import index as index_module
from termloom.operators.index import build_index, query_units
from termloom.operators.positional import paired

STEMS = {"runs": "run", "running": "run", "boxes": "box", "as": "a"}
RNG = random.Random(2)
WORDS = ["run", "runs", "running", "box", "boxes", "a", "as", "tree"]
DOCS = {i: {"title": " ".join(RNG.choices(WORDS, k=i % 4)), "body": " ".join(RNG.choices(WORDS, k=RNG.randint(0, 12)))} for i in range(25)}
FIELDS = ["title", "body"]


def stemmed(text):
    return " ".join(STEMS.get(w, w) for w in text.split())


def rows_of(index, *columns):
    return sorted(
        (r.doc_id, tuple(r.lens), r.kind, r.unit, *[tuple(map(str, r[c])) for c in columns]) for r in index.entries.filter("unit <> ''").collect()
    )


@pytest.fixture(scope="module")
def stems(spark):
    return spark.createDataFrame(list(STEMS.items()), "term string, stem string")


@pytest.mark.parametrize("small", [True, False])
def test_merged_postings_are_those_of_stemmed_texts(term_docs, stems, monkeypatch, small):
    if not small:
        monkeypatch.setattr(index_module, "fits_broadcast", lambda df: False)
    plain = {d: {f: stemmed(t) for f, t in v.items()} for d, v in DOCS.items()}
    built = build_index(term_docs(DOCS, FIELDS), FIELDS, places=True, stems=stems)
    assert rows_of(built, "tf", "places") == rows_of(build_index(term_docs(plain, FIELDS), FIELDS, places=True), "tf", "places")


def test_stemmed_queries(term_docs, term_queries, stems):
    """Queries and documents get the same stems; pairs of stems come from positions."""
    queries = {"q1": "running boxes", "q2": "as a tree", "q3": "runs runs missing"}
    plain_docs = {d: {f: stemmed(t) for f, t in v.items()} for d, v in DOCS.items()}
    plain = query_units(term_queries({q: stemmed(t) for q, t in queries.items()}), "TOU")
    units = query_units(term_queries(queries), "TOU", stems=stems)
    assert sorted(map(tuple, units.collect())) == sorted(map(tuple, plain.collect()))
    single = units.filter("kind = 'T'")
    cut = build_index(term_docs(DOCS, FIELDS), FIELDS, units=single, stems=stems)
    expected = build_index(term_docs(plain_docs, FIELDS), FIELDS, units=single)
    wanted = {r.unit for r in single.collect()}
    assert [r for r in rows_of(cut, "tf") if r[3] in wanted] == rows_of(expected, "tf")
    whole = build_index(term_docs(DOCS, FIELDS), FIELDS, places=True, stems=stems)
    assert rows_of(paired(whole, units), "tf") == rows_of(build_index(term_docs(plain_docs, FIELDS), FIELDS, "TOU", units=units), "tf")
    with pytest.raises(ValueError):
        build_index(term_docs(DOCS, FIELDS), FIELDS, "TOU", units=units, stems=stems)


def test_plural_stems(spark):
    terms = ["ponies", "pennies", "caresses", "cats", "bus", "glass", "toes", "trees", "movies", "gas", "s", "is", "étudies"]
    frame = spark.createDataFrame([(t,) for t in terms + terms], "term string")
    found = {r.term: r.stem for r in analysis.stem_table(frame).collect()}
    assert found == {"ponies": "pony", "pennies": "penny", "caresses": "caresse", "cats": "cat", "movies": "movy", "gas": "ga", "is": "i", "étudies": "étudy"}


def triples_of(spark):
    rows = []
    for i in range(300):
        subject = f"s{i}" if i else None
        rows += [(subject, entities.TYPE_PREDICATE, "T", "uri"), (subject, entities.NAME_PREDICATES[0], f"name runs {i}", "literal"), (subject, "p", "x/y_z", "uri")]
    return spark.createDataFrame(rows, "subject string, predicate string, object string, object_type string")


@pytest.mark.parametrize("small", [True, False])
def test_triples_about_given_subjects(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(entities, "fits_broadcast", lambda df: False)
    triples = triples_of(spark)
    for wanted in ([], ["s7"], ["s1", "s1", "s299", None, "none"], [f"s{i}" for i in range(1, 300, 3)]):
        subjects = spark.createDataFrame([(s,) for s in wanted], "subject string")
        found = entities.about(triples, subjects)
        assert found.columns == triples.columns
        expected = [tuple(r) for r in triples.collect() if r.subject is not None and r.subject in wanted]
        assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_the_bitmap_cuts_before_the_shuffle(spark):
    subjects = spark.createDataFrame([("s7",), ("s9",)], "subject string")
    plan = entities.about(triples_of(spark), subjects)._jdf.queryExecution().executedPlan().toString()
    assert "bitmap" in plan and "getbit" in plan.lower().replace("bit_get", "getbit")


def test_entity_index_with_stems_and_subjects(spark, term_queries, stems):
    triples = triples_of(spark)
    subjects = spark.createDataFrame([("s7",), ("s9",)], "subject string")
    units = query_units(term_queries({"q": "running name"}), stems=stems)
    found = entities.entity_index(triples, units, "T", stems=stems, subjects=subjects)
    got = {(r.doc_id, r.unit): r.tf["names"] for r in found.entries.filter("unit <> ''").collect()}
    assert got == {("s7", "name"): 1, ("s7", "run"): 1, ("s9", "name"): 1, ("s9", "run"): 1}
    assert {r.doc_id: r.lens["catch_all"] for r in found.documents.collect()}.keys() == {"s7", "s9"}


def test_measured_broadcasts_count_nested_columns(spark):
    frame = spark.range(100).select(F.sequence(F.lit(1000), F.lit(2000)).alias("a"), F.struct(F.lit("x" * 500).alias("t")).alias("s"), F.lit("y" * 500).cast("binary").alias("b"))
    assert joins.fits_broadcast(frame, 1_000_000) and not joins.fits_broadcast(frame, 400_000)
    assert not joins.fits_broadcast(frame.select("b"), 50_000)
    assert not joins.fits_broadcast(frame.select("s"), 50_000)
