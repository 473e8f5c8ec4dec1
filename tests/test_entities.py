"""Triples, fielded entities, field mapping."""

import math

import pytest

from termloom.operators import entities as e
from termloom.operators import prms
from termloom.operators.index import query_units
from termloom.operators.joins import lookup_join
from termloom.operators.scorers import search

LABEL, NAME = e.NAME_PREDICATES[:2]
TYPE, SUBJECT = e.TYPE_PREDICATES
ARTIST = e.MUSICAL_ARTIST
ABOUT = "http://x/property/about"

ROWS = [
    ("Al", LABEL, "Al Green", "literal"),
    ("Al", NAME, "Al", "literal"),
    ("Al", e.COMMENT_PREDICATE, "soul singer", "literal"),
    ("Al", TYPE, ARTIST, "uri"),
    ("Al", SUBJECT, "http://x/resource/Category:Soul_singers", "uri"),
    ("Al", ABOUT, "gospel soul", "literal"),
    ("Al", ABOUT, "http://x/resource/Quiet_Elegance", "uri"),
    ("Bo", LABEL, "Bo", "literal"),
    ("Bo", TYPE, ARTIST, "uri"),
    ("Bo", ABOUT, "gospel gospel", "literal"),
    ("Town", LABEL, "soul town", "literal"),
    ("Town", TYPE, "http://x/ontology/Place", "uri"),
]


@pytest.fixture(scope="module")
def triples(spark):
    return spark.createDataFrame(ROWS, "subject string, predicate string, object string, object_type string")


def test_entity_values(triples):
    got = {(r.subject, r.predicate, r.pos): (r.object, r.is_single) for r in e.entity_values(triples).collect()}
    assert len(got) == len(ROWS)
    assert got["Al", NAME, 1] == ("Al", True)
    assert got["Al", ABOUT, 1] == ("gospel soul", False)
    assert got["Al", ABOUT, 2] == ("http://x/resource/Quiet_Elegance", False)


def test_values_of_a_large_entity_are_numbered_in_order(triples):
    """A predicate with most of the values, many of them equal, still has one numbering."""
    rows = [("Al", ABOUT, f"{i % 40:02d}", "literal") for i in range(2000)]
    many = triples.sparkSession.createDataFrame(rows, triples.schema).union(triples.filter(f"predicate <> '{ABOUT}'"))
    got = {r.pos: r.object for r in e.entity_values(many).filter(f"predicate = '{ABOUT}'").collect()}
    assert [got[i + 1] for i in range(2000)] == sorted(r[2] for r in rows)
    assert e.entity_values(many).filter("is_single").count() == len([r for r in ROWS if r[1] != ABOUT])


def test_has_type(triples):
    assert sorted(r.subject for r in e.has_type(triples, ARTIST).collect()) == ["Al", "Bo"]


def test_entity_documents(triples):
    found = sorted((r.entity_id, r.field, r.pos, r.value) for r in e.entity_documents(triples).collect())
    assert {r[0] for r in found} == {"Al", "Bo"}
    al = {f: " ".join(r[3] for r in found if r[:2] == ("Al", f)) for f in {r[1] for r in found}}
    assert al["names"] == "Al Green Al"
    assert al["description"] == "soul singer"
    assert al["types"] == "Soul singers MusicalArtist"
    assert al["attributes"] == "gospel soul"
    assert al["related_entities"] == "Quiet Elegance"
    assert sorted(al["catch_all"].split()) == sorted(
        "Al Green Al soul singer Soul singers MusicalArtist gospel soul Quiet Elegance".split()
    )


@pytest.fixture(scope="module")
def found(triples, term_queries):
    units = query_units(term_queries({"q": "gospel soul soul", "r": "elegance nothing"}))
    return e.entity_index(triples, units), units


def test_entity_index_counts(found):
    index, _ = found
    lens = {r.doc_id: r.lens.asDict() for r in index.documents.collect()}
    assert lens["Al"] == dict(
        names=3, description=2, attributes=2, related_entities=2, types=3, catch_all=12
    )
    tf = {(r.doc_id, r.unit): r.tf.asDict() for r in index.entries.filter("unit <> ''").collect()}
    assert tf["Al", "soul"]["catch_all"] == 3 and tf["Al", "soul"]["description"] == 1
    assert tf["Bo", "gospel"] == dict(
        names=0, description=0, attributes=2, related_entities=0, types=0, catch_all=2
    )


def test_prms_follows_the_formula(found):
    index, units = found
    docs = {
        "Al": dict(names="al green al", description="soul singer", attributes="gospel soul",
                   related_entities="quiet elegance", types="soul singers musicalartist"),
        "Bo": dict(names="bo", description="", attributes="gospel gospel", related_entities="", types="musicalartist"),
    }
    words = {d: {f: t.split() for f, t in v.items()} for d, v in docs.items()}
    for v in words.values():
        v["catch_all"] = [w for f in list(v) for w in v[f]]
    total = {f: sum(len(v[f]) for v in words.values()) for f in prms.ENTITY_FIELDS}
    p = lambda t, f: sum(v[f].count(t) for v in words.values()) / total[f]

    def score(terms, doc):
        result = 0
        for t in terms:
            every = sum(p(t, f) for f in prms.ENTITY_FIELDS)
            if every:
                v = words[doc]
                result += math.log(sum(
                    p(t, f) / every * (v[f].count(t) + 100 * p(t, f)) / (100 + len(v[f]))
                    for f in prms.ENTITY_FIELDS
                ))
        return result

    got = {(r.query_id, r.doc_id): r.score for r in prms.prms(index, units).collect()}
    assert set(got) == {("q", "Al"), ("q", "Bo"), ("r", "Al")}
    assert got["q", "Al"] == pytest.approx(score(["gospel", "soul", "soul"], "Al"))
    assert got["q", "Bo"] == pytest.approx(score(["gospel", "soul", "soul"], "Bo"))
    assert got["r", "Al"] == pytest.approx(score(["elegance"], "Al"))
    ranked = {(r.query_id, r["rank"]): r.doc_id for r in prms.prms_search(index, units).collect()}
    assert ranked["q", 1] == max(("Al", "Bo"), key=lambda d: got["q", d])


def test_search_and_collection_lm(found):
    index, units = found
    first = search(index, units, ["catch_all"], 1).filter("query_id = 'q'").first()
    assert first.doc_id == "Al"
    lm = {(r.field, r.term): r.p for r in prms.collection_lm(index, units).collect()}
    assert lm["attributes", "gospel"] == pytest.approx(3 / 4)
    assert lm["names", "nothing"] == 0.0


def test_term_mapping_goldens(spark):
    # Known probabilities of the mapping.
    p = {
        "names": (1 / 9, 2 / 9), "types": (0.0, 0.0), "description": (4 / 10, 1 / 5),
        "attributes": (0.0, 0.0), "related_entities": (1 / 2, 1 / 8), "catch_all": (3 / 14, 4 / 14),
    }
    rows = [(f, t, v) for f, pair in p.items() for t, v in zip(("gospel", "soul"), pair)]
    rows += [(f, "unseen", 0.0) for f in p]
    lm = spark.createDataFrame(rows, "field string, term string, p double")
    got = {(r.field, r.term): r.p_field for r in prms.term_mapping(lm).collect()}
    assert got["description", "gospel"] == pytest.approx(0.32642, abs=1e-5)
    assert got["attributes", "gospel"] == 0
    assert got["related_entities", "gospel"] == pytest.approx(0.40803, abs=1e-5)
    assert got["names", "soul"] == pytest.approx(0.26679, abs=1e-5)
    assert got["types", "soul"] == 0
    assert got["catch_all", "soul"] == pytest.approx(0.34302, abs=1e-5)
    assert got["names", "unseen"] is None


def test_candidates(spark):
    rows = [("Lists", "List of A"), ("Lists", "Other"), ("List of A", "y"), ("List of A", "x"), ("Other", "z")]
    links = spark.createDataFrame(rows, "page string, link string")
    assert sorted(r.entity for r in e.candidates(links).collect()) == ["x", "y"]
    assert e.candidates(links, seed="Other").count() == 0
    assert sorted(r.entity for r in e.candidates(links, seed="Lists").collect()) == ["x", "y"]
    assert [r.entity for r in e.candidates(links, cap=1).collect()] == ["x"]


def test_tables_that_were_not_measured_small_are_never_broadcast(spark):
    """Files of a few MB can hold more subjects than the driver does; Spark alone would broadcast them."""
    triples = spark.range(3).selectExpr("'s' || id % 1 AS subject", f"'{TYPE}' AS predicate", "'T' AS object", "'uri' AS object_type")
    lookup = triples.select("subject").distinct()
    for joined in (e.of_type(triples, "T"), lookup_join(triples, lookup, ["subject"], False, "left_semi", spread_by="object")):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert joined.count() == 3
