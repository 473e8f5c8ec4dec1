"""Classification and ranking measures."""

import pytest
from pyspark.sql import functions as F

from termloom.operators import metrics
from termloom.operators.joins import running_count

ACTUAL = [1, 1, 0, 1, 1, 1, 0, 0, 1, 1]
PREDICTED = [0, 1, 0, 1, 0, 1, 0, 1, 0, 0]


@pytest.fixture(scope="module")
def matrix(spark):
    actual = spark.createDataFrame(list(enumerate(ACTUAL)), "id int, actual int")
    predicted = spark.createDataFrame(list(enumerate(PREDICTED)), "id int, predicted int")
    return metrics.confusion_matrix(metrics.aligned(actual, predicted))


def test_confusion_matrix(matrix):
    assert matrix.first().asDict() == {"tn": 2, "fp": 1, "fn": 4, "tp": 3}


def test_binary_measures(matrix):
    got = metrics.binary_measures(matrix).first().asDict()
    assert got == pytest.approx(
        dict(accuracy=1 / 2, precision=3 / 4, recall=3 / 7, f1=6 / 11,
             false_positive_rate=1 / 3, false_negative_rate=4 / 7)
    )


def test_pairs_with_null_classes_are_counted(spark):
    pairs = spark.createDataFrame([(None, 1), (1, None), (None, None), (1, 1)], "actual int, predicted int")
    got = metrics.confusion_matrix(pairs)
    assert got.first().asDict() == {"tn": 1, "fp": 1, "fn": 1, "tp": 1}
    errors = spark.createDataFrame([(1, 0), (0, 1)], "actual int, predicted int")
    assert metrics.evaluate(errors).first()["f1"] == 0


def test_no_denominator_is_null(spark):
    pairs = spark.createDataFrame([(0, 0)], "actual int, predicted int")
    got = metrics.evaluate(pairs)
    assert got.columns == ["recall", "precision", "f1", "accuracy"]
    assert tuple(got.first()) == (None, None, None, 1.0)


@pytest.fixture(scope="module")
def ranked(spark):
    rows = [("q1", r, d) for r, d in enumerate("abcde", 1)] + [("q2", 1, "a"), ("q3", 1, "z")]
    return spark.createDataFrame(rows, "query_id string, rank int, doc_id string")


@pytest.fixture(scope="module")
def truth(spark):
    rows = [
        ("q1", "b", 1), ("q1", "d", 2), ("q1", "x", 1), ("q1", "b", 2), ("q1", "a", 0), ("q2", "a", 1),
    ]
    return metrics.relevant(spark.createDataFrame(rows, "query_id string, doc_id string, relevance int"))


def values(frame):
    return {r.query_id: r.value for r in frame.collect()}


def test_ranking_measures(ranked, truth):
    assert truth.count() == 4
    assert values(metrics.precision_at(4)(ranked, truth)) == {"q1": 0.5, "q2": 0.25, "q3": 0.0}
    average = values(metrics.average_precision(ranked, truth))
    assert average == pytest.approx({"q1": (1 / 2 + 2 / 4) / 3, "q2": 1.0, "q3": 0.0})
    assert values(metrics.reciprocal_rank(ranked, truth)) == {"q1": 0.5, "q2": 1.0, "q3": 0.0}
    assert metrics.mean_measure(ranked, truth, metrics.reciprocal_rank).first()[0] == pytest.approx(0.5)


def test_running_count_over_blocks(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    got = running_count(rows, ["k"], [F.floor(F.col("v") / 7)], [F.col("v")]).collect()
    for key in range(3):
        mine = sorted((r.v, r.n) for r in got if r.k == key)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))
