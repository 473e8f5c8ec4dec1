"""Features of query-document pairs, re-ranking and text classification."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from termloom.operators import ltr, metrics, textclf
from termloom.operators.index import build_index, query_units
from termloom.plans import catalog

# Toy documents and queries with known features.
DOCS = {
    "d1": {"title": "t3 t6", "body": "t3 t3 t3 t6 t6"},
    "d2": {"title": "t1 t3", "body": "t1 t2 t3 t3 t6"},
    "d3": {"title": "t4 t3", "body": "t3 t3 t4 t5"},
    "d4": {"title": "t6 t6", "body": "t4 t5 t6 t6"},
    "d5": {"title": "t2", "body": "t1 t2 t3 t5"},
}
QUERIES = {"q0": "t1 t4", "q1": "t2", "q2": "t5 t7 t2", "q3": "t6 t6", "q9": "t9"}


@pytest.fixture(scope="module")
def found(term_docs, term_queries):
    units = query_units(term_queries(QUERIES))
    return build_index(term_docs(DOCS, ltr.FIELDS), ltr.FIELDS, units=units), units


@pytest.fixture(scope="module")
def matrix(spark, found):
    pairs = spark.createDataFrame([(q, d) for q in QUERIES for d in DOCS], ["query_id", "doc_id"])
    return {(r.query_id, r.doc_id): r for r in ltr.feature_matrix(*found, pairs).collect()}


def test_feature_goldens(matrix):
    vector = lambda q, d: list(matrix[q, d])[2:]
    assert vector("q0", "d1") == pytest.approx([2, 1.832581, 0.916291, 0.916291, 2, 5] + [0] * 8, abs=1e-5)
    assert vector("q1", "d2") == pytest.approx(
        [1, 0.916291, 0.916291, 0.916291, 2, 5, 0, 0, 0, 0, 1, 1, 1, 1], abs=1e-5
    )
    assert vector("q3", "d3") == pytest.approx([2, 1.021651, 0.510826, 0.510826, 2, 4] + [0] * 8, abs=1e-5)
    assert matrix["q2", "d1"].query_sum_idf == pytest.approx(1.4271, abs=1e-4)
    assert matrix["q0", "d2"].unique_query_terms_in_title == 1 and matrix["q0", "d2"].sum_TF_body == 1
    assert matrix["q0", "d3"].avg_TF_title == 0.5 and matrix["q0", "d3"].max_TF_body == 1
    assert matrix["q2", "d5"].unique_query_terms_in_body == 2 and matrix["q2", "d5"].avg_TF_body == 1.0
    assert matrix["q3", "d4"].sum_TF_title == 4
    assert matrix["q9", "d1"].query_length == 0 and matrix["q9", "d1"].query_sum_idf is None


def test_training_pairs_and_rerank(spark, found):
    truth = spark.createDataFrame([("q1", "d3"), ("q1", "d2"), ("q0", "d5")], ["query_id", "doc_id"])
    data = ltr.training_data(*found, truth).cache()
    pairs = {(r.query_id, r.doc_id): r.label for r in data.collect()}
    assert len(pairs) == data.count()
    assert pairs["q1", "d3"] == 1 and pairs["q1", "d2"] == 1 and pairs["q1", "d5"] == 0
    assert not any(q == "q9" for q, _ in pairs)
    from pyspark.ml.regression import DecisionTreeRegressor

    model = ltr.fit(data, DecisionTreeRegressor(maxDepth=2, seed=1))
    ranked = ltr.rerank(model, data.drop("label")).collect()
    assert len(ranked) == len(pairs)
    for query in {q for q, _ in pairs}:
        mine = sorted((r["rank"], -r.score, r.doc_id) for r in ranked if r.query_id == query)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert [m[1] for m in mine] == sorted(m[1] for m in mine)


def test_id_split(spark):
    ids = spark.range(1000).select(F.col("id").alias("query_id"))
    split = ltr.id_split(ids)
    share = split.filter("is_train").count()
    assert 740 < share < 860
    assert ltr.side_ids(split, False, 100).count() == 100
    assert ltr.side_ids(split, True, 10).join(split.filter("not is_train"), "query_id").count() == 0


def test_models_are_fitted_on_all_labelled_queries(spark, tmp_path):
    """More labelled queries than the 800 that were once the most."""
    items = spark.range(1200).select(F.col("id").alias("item_id"), F.concat(F.lit("words of item"), F.col("id")).alias("text"))
    docs = spark.createDataFrame([(1, "title\nwords of item1. more", "en", "web"), (2, "item2 words", "en", "web")], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for name, table in {"benchmark": items, "documents": docs, "labels": labels}.items():
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    _, _, _, labelled, held_out = catalog._sides(spark, str(tmp_path))
    is_train = {r.query_id: r.is_train for r in catalog.id_split(spark, str(tmp_path)).collect()}
    assert sum(is_train.values()) > 800
    for side, train in ((labelled, True), (held_out, False)):
        assert {r.query_id for r in side.select("query_id").distinct().collect()} == {q for q, t in is_train.items() if t == train}


TEXTS = [
    (1, "Win money now, win!", 1, True), (2, "meeting at noon", 0, True), (3, "win a prize", 1, True),
    (4, "lunch meeting today", 0, True), (5, "win money; meeting", 1, False), (6, "noon lunch zebra", 0, False),
]


@pytest.fixture(scope="module")
def mails(spark):
    return spark.createDataFrame(TEXTS, "doc_id int, text string, label int, is_train boolean")


@pytest.mark.parametrize("hot_df", [100_000, 1])
def test_tfidf(mails, monkeypatch, hot_df):
    monkeypatch.setattr(textclf, "HOT_DF", hot_df)
    words = {d: [w for w in t.lower().replace(",", "").replace("!", "").replace(";", "").split() if len(w) > 1]
             for d, t, _, _ in TEXTS}
    df = Counter(w for d, _, _, train in TEXTS if train for w in set(words[d]))
    got = {(r.doc_id, r.term): r.weight for r in textclf.tfidf(mails).collect()}
    expected = {}
    for d, listed in words.items():
        raw = {w: n * (math.log(5 / (1 + df[w])) + 1) for w, n in Counter(listed).items() if w in df}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        expected |= {(d, w): x / norm for w, x in raw.items()}
    assert got == pytest.approx(expected)


@pytest.mark.parametrize("limit", [0, 280, 1 << 26])
def test_tfidf_moves_few_rows(spark, monkeypatch, limit):
    # the terms all documents share fit the broadcast at 280, a document's own terms don't; ids repeat and are missing
    rows = [(None if d == 3 else d % 7, f"shared common common own{d} other{d}", True) for d in range(10)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, is_train boolean")
    monkeypatch.setattr(textclf, "BROADCAST_BYTES", limit)
    found = textclf.tfidf(docs)
    got = {(r.doc_id, r.term): r.weight for r in found.collect()}
    words, df = {}, Counter()
    for d, text, _ in rows:
        words.setdefault(d, Counter()).update(text.split())
    df.update(w for listed in words.values() for w in listed)
    expected = {}
    for d, listed in words.items():
        raw = {w: n * (math.log(11 / (1 + df[w])) + 1) for w, n in listed.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        expected |= {(d, w): x / norm for w, x in raw.items()}
    assert got == pytest.approx(expected)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # counts lie by document: with the vocabulary broadcast, no row per document and term is moved
    assert ("Exchange hashpartitioning" in plan) == (limit < 1 << 26)


def test_classifier(mails):
    model = textclf.train(mails.filter("is_train"), max_iter=20, num_features=64)
    predicted = textclf.predict(model, mails)
    got = metrics.evaluate(predicted).first()
    assert got.accuracy >= 0.8
