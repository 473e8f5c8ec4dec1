"""Golden scores on the toy collections, all queries of a model in one run."""

import math

import pytest
from conftest import FIELDED, SINGLE

from termloom.operators import dependence, scorers
from termloom.operators import index as index_module
from termloom.operators.index import build_index, query_units, restrict
from termloom.operators.joins import top_k

THREE = ["title", "body", "anchors"]
MIX = {"title": 0.1, "body": 0.7, "anchors": 0.2}
# The toy queries that the golden values belong to.
TEXTS = [
    "t7 t3 t3", "t3", "t2 t1", "t6", "t3 t1 t3 t2", "t6 t2", "t5 t1", "t3 t5 t2", "t9", "t2 t4",
    "t2 t5 t4 t5", "t4", "t1 t2 t4", "t4 t1 t3", "t4 t3", "t2 t1 t3", "t1 t3 t3", "t2 t4 t4",
]


@pytest.fixture(scope="module")
def indexed(term_docs, term_queries):
    """Index and units for all queries, per collection and counting rule."""
    known = {}

    def get(name, rule="pairs"):
        if (name, rule) not in known:
            docs, fields = {"single": (SINGLE, ["body"]), "fielded": (FIELDED, THREE)}[name]
            units = query_units(term_queries({t: t for t in TEXTS}), "TOU", rule)
            index = build_index(term_docs(docs, fields), fields, "TOU", count_rule=rule, units=units)
            known[name, rule] = index, units
        return known[name, rule]

    return get


@pytest.fixture(scope="module")
def every(spark):
    return {
        "single": spark.createDataFrame([(t, d) for t in TEXTS for d in SINGLE], ["query_id", "doc_id"]),
        "fielded": spark.createDataFrame([(t, d) for t in TEXTS for d in FIELDED], ["query_id", "doc_id"]),
    }


def scores(frame):
    return {(r.query_id, r.doc_id): r.score for r in frame.collect()}


def of_terms(found):
    index, units = found
    return index, units.filter("kind = 'T'")


def best(found, query):
    return max((s, d) for (q, d), s in found.items() if q == query)[1]


def test_simple(indexed, every):
    got = scores(scorers.simple(*of_terms(indexed("single"))))
    assert {d: s for (q, d), s in got.items() if q == "t7 t3 t3"} == {"d1": 6, "d2": 4, "d3": 4, "d5": 2}
    full = scores(scorers.simple(*of_terms(indexed("single")), pairs=every["single"]))
    assert full["t7 t3 t3", "d4"] == 0.0 and len(full) == len(TEXTS) * len(SINGLE)


def test_bm25(indexed):
    got = scores(scorers.bm25(*of_terms(indexed("single"))))
    assert got["t3", "d1"] == pytest.approx(0.3406, rel=1e-3)
    assert got["t2 t1", "d2"] == pytest.approx(1.7357, rel=1e-3)
    assert best(got, "t6") == "d4"
    assert best(got, "t3 t1 t3 t2") == "d5"


def test_lm_scores_every_document(indexed, every):
    got = scores(scorers.lm(*of_terms(indexed("single")), pairs=every["single"]))
    assert got["t3", "d1"] == pytest.approx(math.log(0.576), rel=1e-2)
    assert got["t2 t1", "d2"] == pytest.approx(math.log(0.036), rel=1e-2)
    assert best(got, "t6") == "d4"
    assert best(got, "t3 t1 t3 t2") == "d2"
    # without the term a document keeps the background; an unknown term adds nothing
    assert got["t3", "d4"] == pytest.approx(math.log(0.1 * 8 / 22))
    assert {got["t9", d] for d in SINGLE} == {0.0}


def test_bm25f(indexed):
    got = scores(scorers.bm25f(*of_terms(indexed("fielded")), weights=MIX))
    assert got["t3", "d1"] == pytest.approx(0, abs=1e-3)
    assert got["t2 t4", "d1"] == pytest.approx(0.560, abs=1e-3)
    assert got["t2 t4", "d2"] == pytest.approx(0.7108, abs=1e-3)
    assert best(got, "t2 t5 t4 t5") == "d2"


def test_mixture_lm(indexed, every):
    got = scores(scorers.mixture_lm(*of_terms(indexed("fielded")), weights=MIX, pairs=every["fielded"]))
    assert got["t3", "d1"] == pytest.approx(math.log(0.2798), abs=1e-3)
    assert got["t2 t1", "d2"] == pytest.approx(math.log(0.00128), rel=1e-2)
    assert best(got, "t4") == "d2"
    assert best(got, "t1 t2 t4") == "d1"


# Golden scores of the dependence models on the toy collections.
SDM_GOLDEN = {
    ("T", "pairs"): {("t7 t3 t3", "d1"): -1.9622, ("t7 t3 t3", "d2"): -2.0137},
    ("O", "pairs"): {("t7 t3 t3", "d1"): -1.6492, ("t6 t2", "d4"): 0.0},
    ("U", "pairs"): {("t7 t3 t3", "d1"): -1.4064, ("t5 t1", "d3"): 0.0},
    ("U", "anchored"): {("t7 t3 t3", "d1"): -0.9811, ("t5 t1", "d3"): 0.0},
    ("TOU", "pairs"): {("t7 t3 t3", "d1"): -1.9031, ("t3 t5 t2", "d4"): -5.2229},
    ("TOU", "anchored"): {("t7 t3 t3", "d1"): -1.8818, ("t3 t5 t2", "d4"): -5.2229},
}
FSDM_GOLDEN = {
    ("T", "pairs"): {("t4 t1 t3", "d1"): -4.6721, ("t4 t3", "d2"): -3.4821},
    ("O", "pairs"): {("t2 t1 t3", "d1"): -1.97630, ("t6 t2", "d2"): 0.0},
    ("U", "pairs"): {("t1 t3 t3", "d1"): -5.1396, ("t5 t1", "d3"): -1.74725},
    ("U", "anchored"): {("t1 t3 t3", "d1"): -3.4478},
    ("TOU", "pairs"): {("t2 t1 t3", "d1"): -5.4979, ("t3 t5 t2", "d2"): -5.4874},
    ("TOU", "anchored"): {("t2 t1 t3", "d1"): -5.5363, ("t3 t5 t2", "d2"): -5.4906},
}


@pytest.mark.parametrize("kinds, rule", SDM_GOLDEN)
def test_sdm(indexed, every, kinds, rule):
    weights = {kinds: 1.0} if len(kinds) == 1 else None
    got = scores(dependence.sdm(*indexed("single", rule), kind_weights=weights, pairs=every["single"]))
    assert len(got) == len(TEXTS) * len(SINGLE)
    for key, golden in SDM_GOLDEN[kinds, rule].items():
        assert got[key] == pytest.approx(golden, abs=1e-4), key


@pytest.mark.parametrize("kinds, rule", FSDM_GOLDEN)
def test_fsdm(indexed, every, kinds, rule):
    got = scores(
        dependence.fsdm(
            *indexed("fielded", rule),
            field_weights={"body": 0.2, "title": 0.7, "anchors": 0.1},
            kind_weights={kinds: 1.0} if len(kinds) == 1 else None,
            pairs=every["fielded"],
        )
    )
    for key, golden in FSDM_GOLDEN[kinds, rule].items():
        assert got[key] == pytest.approx(golden, abs=1e-4), key


@pytest.mark.parametrize(
    "scorer, name, params",
    [
        (scorers.mixture_lm, "fielded", {"weights": MIX}),
        (dependence.sdm, "single", {}),
        (dependence.fsdm, "fielded", {}),
    ],
)
def test_matching_documents_score_the_same_as_in_the_full_list(indexed, every, scorer, name, params):
    full = scores(scorer(*indexed(name), pairs=every[name], **params))
    matching = scores(scorer(*indexed(name), **params))
    assert matching and len(matching) < len(full)
    for key, value in matching.items():
        assert value == pytest.approx(full[key], abs=1e-12)


def test_all_documents_of_one_query(indexed):
    index, _ = indexed("single")
    got = sorted(map(tuple, scorers.all_documents(index, "t3").collect()))
    assert got == [("t3", d) for d in SINGLE]


def test_feature_weights_must_sum_to_one():
    dependence.check_weights({"T": 0.85, "O": 0.1, "U": 0.05})
    with pytest.raises(ValueError):
        dependence.check_weights({"T": 0.85, "O": 0.1, "U": 0.1})


def test_top_k_breaks_ties_by_id(spark):
    rows = [("q", "a", 1.0), ("q", "b", 1.0), ("q", "c", 0.5), ("p", "a", 2.0)]
    got = top_k(spark.createDataFrame(rows, ["query_id", "doc_id", "score"]), 2)
    assert sorted((r.query_id, r["rank"], r.doc_id) for r in got.collect()) == [
        ("p", 1, "a"), ("q", 1, "b"), ("q", 2, "a"),
    ]


def test_salted_join_gives_the_same_scores(indexed, term_docs, monkeypatch):
    """Scores do not change when the queries are too large to broadcast."""
    _, units = indexed("fielded")
    expected = scores(dependence.fsdm(*indexed("fielded")))
    monkeypatch.setattr(index_module, "fits_broadcast", lambda df: False)
    index = build_index(term_docs(FIELDED, THREE), THREE, "TOU", units=units)
    assert not index.small_queries
    got = scores(dependence.fsdm(index, units))
    assert got.keys() == expected.keys()
    for key, value in got.items():
        assert value == pytest.approx(expected[key], abs=1e-9)


def test_restricted_full_index_gives_the_same_scores(indexed, term_docs):
    _, units = of_terms(indexed("single"))
    full = build_index(term_docs(SINGLE, ["body"]), ["body"])
    got = scores(scorers.bm25(restrict(full, units), units))
    assert got == pytest.approx(scores(scorers.bm25(*of_terms(indexed("single")))))
