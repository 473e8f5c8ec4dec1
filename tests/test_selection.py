"""Classifier on the exact vocabulary, choice of a regressor, and the test of a gain."""

import random

import pytest
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from termloom.operators import hinge, ltr, metrics, textclf

RNG = random.Random(4)
TEXTS = [(i, f"{'cheap pills now' if i % 3 == 0 else 'minutes of the meeting'} {RNG.choice(['ab', 'cd', 'ef'])} w{i % 7}", int(i % 3 == 0)) for i in range(60)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string, label int")


def test_numbers_are_dense_and_weights_those_of_tfidf(spark, texts):
    stop = ["of", "the"]
    model = textclf.train_exact(texts, stop)
    number = {r.term: r.number for r in model.terms.collect()}
    assert sorted(number) == [t for t, _ in sorted(number.items(), key=lambda x: x[1])]
    assert sorted(number.values()) == list(range(model.size)) and not {"of", "the"} & set(number)
    weights = {(r.doc_id, number[r.term]): r.weight for r in textclf.tfidf(texts.withColumn("is_train", F.lit(True)), stop).collect()}
    found = {}
    for r in textclf.vectors(texts, model.terms, model.size, model.n_train, stop).collect():
        found |= {(r.doc_id, int(i)): v for i, v in zip(r.features.indices, r.features.values)}
    assert found.keys() == weights.keys()
    assert all(found[k] == pytest.approx(weights[k], abs=1e-12) for k in found)


def test_exact_classifier(spark, texts):
    model = textclf.train_exact(texts.filter("doc_id < 45"), ["of"])
    odd = spark.createDataFrame([(100, None, 0), (101, "", 0), (102, "unknown words only", 1)], "doc_id long, text string, label int")
    found = {r.doc_id: r for r in textclf.predict_exact(model, texts.filter("doc_id >= 45").union(odd)).collect()}
    assert set(found) == {*range(45, 60), 100, 101, 102}
    assert all(found[i].predicted == found[i].actual for i in range(45, 60))


def test_coefficients_in_tables_are_those_of_the_library(spark, texts, steps=12):
    """Ids that come twice, texts without words, and a word that all texts have; the losses and coefficients of `LinearSVC`."""
    docs = texts.filter("doc_id < 30").union(texts.filter("doc_id < 3")).union(spark.createDataFrame([(90, "", 1), (91, None, 0), (None, "cheap w1", 1)], texts.schema))
    docs = docs.withColumn("label", F.when(F.col("doc_id") % 5 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    model = textclf.train_exact(docs, ["of"], steps, 1e-9)
    cells = textclf.weighted(textclf.term_counts(docs.withColumn("is_train", F.lit(True)), ["of"]), model.terms, model.n_train)
    coefficients, intercept, losses = hinge.fit(cells, docs.select("doc_id", "label"), textclf.PENALTY, steps, 1e-9)
    assert losses == pytest.approx([*model.classifier.summary().objectiveHistory], rel=1e-9)
    assert len(losses) == steps + 1 and losses[-1] < losses[0] / 2
    expected = model.classifier.coefficients.toArray()
    got = {r.number: r.coefficient for r in coefficients.collect()}
    assert [got.get(i, 0.0) for i in range(model.size)] == pytest.approx([*expected], rel=1e-6, abs=1e-9)
    assert intercept == pytest.approx(model.classifier.intercept, rel=1e-6, abs=1e-9)


def test_a_vocabulary_too_large_for_the_driver(spark, texts, monkeypatch):
    """The driver never sees a number per term then, and predictions are the same."""
    train, others = texts.filter("doc_id < 45"), texts.filter("doc_id >= 45").union(spark.createDataFrame([(100, None, 0), (101, "unknown words", 1)], texts.schema))
    small = textclf.train_exact(train, ["of"], 3)
    expected = sorted(map(tuple, textclf.predict_exact(small, others).collect()))
    monkeypatch.setattr(textclf, "DRIVER_SHARE", 0.0)
    monkeypatch.setattr(textclf, "LinearSVC", None)
    large = textclf.train_exact(train, ["of"], 3)
    assert large.classifier is None and large.terms.columns == ["term", "df", "number", "coefficient"] and large.terms.count() == small.size
    assert sorted(map(tuple, textclf.predict_exact(large, others).collect())) == expected


def pairs(spark, n_queries=30):
    """Queries whose relevant document has the largest body length."""
    rows = []
    for q in range(n_queries):
        best = RNG.randrange(6)
        for d in range(6):
            values = {f: 0.0 for f in ltr.FEATURES} | {"max_TF_body": 5.0 if d == best else RNG.random()}
            rows.append((q, d, int(d == best), *[values[f] for f in ltr.FEATURES]))
    return spark.createDataFrame(rows, ["query_id", "doc_id", "label", *ltr.FEATURES])


def test_cross_validation(spark):
    training = pairs(spark)
    tried = {"good": LinearRegression(regParam=1e-3), "blind": DecisionTreeRegressor(maxDepth=0)}
    values = ltr.cross_validated(training, tried)
    of = {(r.regressor, r.query_id): r.value for r in values.collect()}
    assert len(of) == 2 * 30 and all(of["good", q] == 1 for q in range(30))
    assert ltr.best_regressor(training, tried)[0] == "good"
    assert ltr.best_regressor(training, {"b": tried["good"], "a": LinearRegression(regParam=1e-3)})[0] == "a"


def test_folds_are_whole_queries(spark):
    """Each query is ranked once, by a model that saw none of its pairs: its label is its own feature."""
    rows = [(q, d, int(d == 0), *[float(q == 0 and d == 0)] * len(ltr.FEATURES)) for q in range(6) for d in range(3)]
    values = ltr.cross_validated(spark.createDataFrame(rows, ["query_id", "doc_id", "label", *ltr.FEATURES]), {"t": DecisionTreeRegressor(maxDepth=2)}, 3)
    assert sorted(r.query_id for r in values.collect()) == list(range(6))


def test_randomisation(spark):
    def values(numbers):
        return spark.createDataFrame(list(enumerate(numbers)), "query_id long, value double")

    before = values([0.5] * 20)
    better = metrics.randomisation_test(before, values([0.7] * 20)).first()
    assert better.n == 20 and better.gain == pytest.approx(0.2) and better.p < 0.01
    same = metrics.randomisation_test(before, before).first()
    assert same.gain == 0 and same.p == 1
    mixed = metrics.randomisation_test(before, values([0.5 + (-1) ** i * 0.1 + (i == 0) * 0.05 for i in range(20)])).first()
    assert mixed.p > 0.3
    again = metrics.randomisation_test(before, values([0.7] * 20)).first()
    assert again == better
