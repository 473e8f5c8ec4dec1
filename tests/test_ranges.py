"""Exact best documents: the same as by scoring all, ranges that are skipped, documents without a match."""

import random

import pytest

from termloom.operators import dependence, ranges, scorers
from termloom.operators.index import build_index, query_units
from termloom.operators.joins import top_k

FIELDS = ["title", "body"]


@pytest.fixture(scope="module")
def collection(term_docs, term_queries):
    """Many documents of common words, few that hold the queries' rare ones."""
    rng = random.Random(3)
    docs = {
        i: {
            "title": " ".join(rng.choices("abcde", k=rng.randint(0, 3))),
            "body": " ".join(rng.choices("abcdefghij", k=rng.randint(3, 40))) + (" rare gem" if i % 50 == 0 else ""),
        }
        for i in range(300)
    }
    units = query_units(term_queries({"q1": "rare gem a", "q2": "b c", "q3": "gem", "q4": "nowhere"}), "TOU")
    return build_index(term_docs(docs, FIELDS), FIELDS, "TOU", units=units), units


MODELS = {
    "simple": (lambda idx, u: scorers.simple_model(u), lambda idx, u: scorers.simple(idx, u)),
    "bm25": (scorers.bm25_model, scorers.bm25),
    "bm25f": (scorers.bm25f_model, scorers.bm25f),
    "mixture": (scorers.lm_model, scorers.mixture_lm),
    "sdm": (dependence.sdm_model, dependence.sdm),
}


def ranked(frame):
    return sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in frame.collect())


@pytest.mark.parametrize("name", MODELS)
@pytest.mark.parametrize("direct", [0, 10**9])
def test_best_matches(collection, monkeypatch, name, direct):
    monkeypatch.setattr(ranges, "RANGE_DOCS", 4)
    index, units = collection
    model, scores = MODELS[name]
    assert ranked(ranges.best_matches(index, model(index, units), 5, direct)) == ranked(top_k(scores(index, units), 5))


def test_wide_queries_take_the_other_joins(collection, monkeypatch):
    monkeypatch.setattr(ranges, "fits_broadcast", lambda df: False)
    index, units = collection
    assert ranked(ranges.best_matches(index, scorers.bm25_model(index, units), 5, 0)) == ranked(top_k(scorers.bm25(index, units), 5))


def test_ranges_below_the_threshold_are_skipped(collection, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_DOCS", 4)
    index, units = collection
    plan = ranges.plan_ranges(index, scorers.bm25_model(index, units), 3)
    every = {(r.query_id, r.range) for r in plan.every.collect()}
    seen = {(r.query_id, r.range) for r in plan.first.union(plan.first.limit(0)).collect()}
    seen |= {(r.query_id, r.range) for r in plan.needed.collect()}
    of = {q: sum(x[0] == q for x in every) for q in ("q1", "q2", "q3")}
    kept = {q: sum(x[0] == q for x in seen) for q in of}
    assert kept["q1"] < of["q1"] / 2 and seen <= every


def test_pairs_are_not_exchanged(collection):
    index, units = collection
    plan = ranges.all_scores(index, scorers.bm25_model(index, units))._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(query_id" in line and "doc_id" in line]


def dense(docs, fields, score):
    """Best of all documents by a plain function."""
    return sorted(((round(score(d), 6), i) for i, d in docs.items()), reverse=True)


@pytest.mark.parametrize("direct", [0, 10**9])
def test_a_document_without_a_match_can_win(spark, term_docs, term_queries, direct):
    """Short documents without the term beat a long one with it; of equal ones the larger id wins."""
    docs = {i: {"title": "x", "body": "w " * 20 * (i == 0) + "pad " * (400 + i)} for i in range(30)}
    docs |= {100: {"title": "x y", "body": "pad pad"}, 101: {"title": "", "body": "pad pad pad"}, 102: {"title": "x", "body": "pad pad"}}
    docs |= {200: {"title": "x", "body": "w " + "pad " * 2000}, 201: {"title": "x", "body": ""}, 202: {"title": "x x", "body": "pad pad"}}
    units = query_units(term_queries({"q": "w", "none": "missing"}), "TOU")
    index = build_index(term_docs(docs, FIELDS), FIELDS, "TOU", units=units)
    pairs = spark.createDataFrame([("q", d) for d in docs], "query_id string, doc_id long")
    cases = [
        (dependence.sdm_model(index, units), dependence.sdm(index, units, pairs=pairs)),
        (dependence.fsdm_model(index, units, {"title": 0.3, "body": 0.7}), dependence.fsdm(index, units, {"title": 0.3, "body": 0.7}, pairs=pairs)),
    ]
    for model, scores in cases:
        best = ranked(ranges.best_of_all(index, model, 4, direct))
        assert best == ranked(top_k(scores, 4))
        found = [b[2] for b in best]
        assert found[:2] == [0, 201] and 200 not in found


def test_best_of_all_by_lengths_in_two_fields(term_docs, term_queries, spark):
    rng = random.Random(5)
    docs = {
        i: {"title": " ".join(rng.choices("abc", k=rng.randint(0, 12))), "body": " ".join(rng.choices("abcdefgh", k=rng.randint(0, 60)))}
        for i in range(300)
    }
    units = query_units(term_queries({"q1": "a b c", "q2": "h", "q3": "a h a h"}), "TOU")
    index = build_index(term_docs(docs, FIELDS), FIELDS, "TOU", units=units)
    weights = {"title": 0.4, "body": 0.6}
    pairs = spark.createDataFrame([(q, d) for d in docs for q in ("q1", "q2", "q3")], "query_id string, doc_id long")
    got = ranked(ranges.best_of_all(index, dependence.fsdm_model(index, units, weights), 20))
    assert got == ranked(top_k(dependence.fsdm(index, units, weights, pairs=pairs), 20))


@pytest.mark.parametrize("k", [1, 3])
def test_shortest_documents(spark, k):
    """All that k others do not undercut are kept."""
    rng = random.Random(k)
    rows = [(i, (rng.randint(0, 30), rng.randint(0, 30))) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, lens struct<a: int, b: int>")
    kept = {r.doc_id for r in ranges.shortest_documents(frame, ["a", "b"], k).collect()}
    for i, (a, b) in rows:
        better = sum((x, y) != (a, b) and x <= a and y <= b or (x, y) == (a, b) and j > i for j, (x, y) in rows)
        assert i in kept or better >= k
    assert len(kept) < 100


def test_scoring_all_takes_tasks_by_matches(collection, monkeypatch):
    """Queries in a broadcast: many matches mean more tasks over the same entries, not bounds, and no exchange of pairs."""
    index, units = collection
    model, expected = scorers.bm25_model(index, units), ranked(top_k(scorers.bm25(index, units), 5))
    pairs = ranges.pairs_to_score(index, model)
    monkeypatch.setattr(ranges, "DIRECT_PAIRS", 0)
    monkeypatch.setattr("termloom.operators.index.TASK_MATCHES", 100)
    monkeypatch.setattr(ranges, "plan_ranges", lambda *a: pytest.fail("bounds are written for broadcast queries"))
    parts = -(-pairs // 100)
    plan = ranges.all_scores(index, model)._jdf.queryExecution().executedPlan().toString()
    assert parts > 8 and f", {parts}), REPARTITION_BY_NUM" in plan
    assert ranked(ranges.best_matches(index, model, 5)) == expected


def test_scores_of_all_matches_move_entries_only(collection):
    index, units = collection
    plan = scorers.bm25(index, units)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(doc_id" in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(query_id" in line and "doc_id" in line]


@pytest.mark.parametrize("parts", [1, 8])
def test_fielded_scores_by_lengths(collection, monkeypatch, parts):
    """Backgrounds made once per query and lengths: the same scores, and no row per unit and scored document."""
    index, units = collection
    units = units.union(units.filter("query_id = 'q2'").selectExpr("CAST(NULL AS STRING) query_id", "kind", "unit", "qf"))
    weights = {"title": 0.4, "body": 0.6}
    expected = sorted((str(r.query_id), r.doc_id, round(r.score, 9)) for r in dependence.fsdm(index, units, weights).collect())
    monkeypatch.setattr(dependence, "LENGTH_GAIN", 0)
    monkeypatch.setattr(dependence, "LENGTH_PARTS", parts)
    found = dependence.fsdm(index, units, weights)
    assert sorted((str(r.query_id), r.doc_id, round(r.score, 9)) for r in found.collect()) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and not [x for x in plan.splitlines() if "Exchange hashpartitioning(query_id" in x and "doc_id" in x]
