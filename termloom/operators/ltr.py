"""Learning to rank: features of (query, document) pairs, training data, re-ranking."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators import metrics
from termloom.operators.index import UNIT, TextIndex
from termloom.operators.joins import lookup_join
from termloom.operators.scorers import PAIR, matches, search, unit_statistics
from termloom.operators.staging import stage

FIELDS = ["title", "body"]
FIRST_PASS = 100
TRAIN_SHARE = 80

# Names and order of the features.
QUERY_FEATURES = ["query_length", "query_sum_idf", "query_max_idf", "query_avg_idf"]
DOC_FEATURES = ["doc_length_title", "doc_length_body"]
PAIR_FEATURES = [
    "unique_query_terms_in_title", "sum_TF_title", "max_TF_title", "avg_TF_title",
    "unique_query_terms_in_body", "sum_TF_body", "max_TF_body", "avg_TF_body",
]
FEATURES = QUERY_FEATURES + DOC_FEATURES + PAIR_FEATURES


def body_units(index: TextIndex, units: DataFrame) -> DataFrame:
    """Query units that some body has, with their statistics."""
    return unit_statistics(index, units).filter(F.col("df")["body"] > 0)


def query_features(index: TextIndex, units: DataFrame) -> DataFrame:
    """Length and idf features of the terms found in bodies; NULL idf without any."""
    idf = F.log(F.lit(float(index.stats.doc_count["body"])) / F.col("df")["body"])
    found = body_units(index, units).select("query_id", "qf", idf.alias("idf"))
    features = found.groupBy("query_id").agg(
        F.sum("qf").alias("query_length"),
        F.sum(F.col("qf") * F.col("idf")).alias("query_sum_idf"),
        F.max("idf").alias("query_max_idf"),
        (F.sum(F.col("qf") * F.col("idf")) / F.sum("qf")).alias("query_avg_idf"),
    )
    return (
        units.select("query_id").distinct().join(features, "query_id", "left")
        .fillna(0, ["query_length"]).select("query_id", *QUERY_FEATURES)
    )


def doc_features(documents: DataFrame) -> DataFrame:
    """(doc_id, lengths) from `documents(doc_id, lens)`."""
    return documents.select(
        "doc_id", *[F.col("lens")[f].alias(f"doc_length_{f}") for f in FIELDS]
    )


def pair_features(index: TextIndex, units: DataFrame, pairs: DataFrame) -> DataFrame:
    """Matched terms and their counts per field, for the given pairs.

    Averages divide by all query terms; repeated query terms count as often as they occur.
    """
    rows = matches(index, body_units(index, units), FIELDS, pairs)
    sums = []
    for f in FIELDS:
        tf = F.col("tf")[f]
        sums += [
            F.count_if(tf > 0).alias(f"unique_query_terms_in_{f}"),
            F.sum(F.col("qf") * tf).alias(f"sum_TF_{f}"),
            F.max(tf).alias(f"max_TF_{f}"),
        ]
    found = rows.groupBy(*PAIR).agg(*sums)
    lengths = query_features(index, units).select("query_id", "query_length")
    counted = pairs.select(*PAIR).join(found, PAIR, "left").fillna(0)
    with_length = lookup_join(counted, lengths, ["query_id"], index.small_queries, "left")
    return with_length.select(
        *PAIR,
        *[
            F.coalesce(F.try_divide(f"sum_TF_{name[7:]}", "query_length"), F.lit(0.0)).alias(name)
            if name.startswith("avg") else F.col(name)
            for name in PAIR_FEATURES
        ],
    )


def feature_matrix(index: TextIndex, units: DataFrame, pairs: DataFrame) -> DataFrame:
    """(query_id, doc_id, 14 features in fixed order) of the given pairs."""
    by_pair = pair_features(index, units, pairs)
    by_query = lookup_join(by_pair, query_features(index, units), ["query_id"], index.small_queries, "left")
    return by_query.join(doc_features(index.documents), "doc_id").select(*PAIR, *FEATURES)


def first_pass(index: TextIndex, units: DataFrame, k: int = FIRST_PASS) -> DataFrame:
    """(query_id, rank, doc_id, score): query terms known to bodies, best of the fields."""
    known = units.join(body_units(index, units).select("query_id", *UNIT), ["query_id", *UNIT], "left_semi")
    return search(index, known, FIELDS, k)


def training_pairs(retrieved: DataFrame, truth: DataFrame) -> DataFrame:
    """(query_id, doc_id, label): first-pass results and judged documents, each pair once."""
    judged = truth.select(*PAIR).distinct()
    every = retrieved.select(*PAIR).union(judged).distinct()
    return every.join(judged.withColumn("label", F.lit(1)), PAIR, "left").fillna(0, ["label"])


def training_data(index: TextIndex, units: DataFrame, truth: DataFrame, k: int = FIRST_PASS) -> DataFrame:
    """(query_id, doc_id, label, 14 features) over the queries of `units`.

    The pairs are staged: matching, features and labels all start from them.
    """
    truth = truth.join(units.select("query_id").distinct(), "query_id", "left_semi")
    pairs = stage(training_pairs(first_pass(index, units, k), truth), "pairs")
    return feature_matrix(index, units, pairs).join(pairs, PAIR).select(*PAIR, "label", *FEATURES)


def fit(training: DataFrame, regressor: Estimator | None = None) -> Model:
    """Pointwise model; any regressor that reads `features` and `label` can be given.

    The training rows are staged because fitting reads them many times.
    """
    regressor = regressor or RandomForestRegressor(numTrees=50, maxDepth=8, seed=42)
    return regressor.fit(_assembled(stage(training, "training")))


def _assembled(features: DataFrame) -> DataFrame:
    known = features.fillna(0.0, QUERY_FEATURES)
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(known)


def rerank(model: Model, features: DataFrame) -> DataFrame:
    """(query_id, rank, doc_id, score) by (prediction, doc_id), both descending."""
    scored = model.transform(_assembled(features)).select(*PAIR, F.col("prediction").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("doc_id"))
    return scored.select("query_id", F.row_number().over(order).alias("rank"), "doc_id", "score")


def regressors() -> dict[str, Estimator]:
    """The regressors that are tried by default."""
    return {
        "linear": LinearRegression(regParam=1e-3),
        "forest": RandomForestRegressor(numTrees=20, maxDepth=6, seed=42),
    }


def cross_validated(training: DataFrame, tried: Mapping[str, Estimator] | None = None, folds: int = 3) -> DataFrame:
    """(regressor, query_id, value): each query's reciprocal rank when a model of the other folds ranks its pairs.

    A fold is a set of whole queries, picked by a hash of their ids, so no query is ranked by
    a model that saw one of its pairs. Queries without a relevant pair have the value 0.
    """
    training = stage(training.withColumn("fold", F.pmod(F.xxhash64("query_id"), F.lit(folds))), "folds")
    truth, found = training.filter("label > 0").select(*PAIR), None
    for name, regressor in (tried or regressors()).items():
        for fold in range(folds):
            model = fit(training.filter(F.col("fold") != fold), regressor)
            ranked = rerank(model, training.filter(F.col("fold") == fold))
            values = metrics.reciprocal_rank(ranked, truth).select(F.lit(name).alias("regressor"), "query_id", "value")
            found = values if found is None else found.union(values)
    return stage(found, "cross-validated")


def best_regressor(training: DataFrame, tried: Mapping[str, Estimator] | None = None, folds: int = 3) -> tuple[str, Estimator]:
    """The regressor with the highest cross-validated mean reciprocal rank, the first name of equal ones."""
    tried = tried or regressors()
    means = cross_validated(training, tried, folds).groupBy("regressor").agg(F.round(F.avg("value"), 6).alias("mrr"))
    name = means.orderBy(F.desc("mrr"), "regressor").first()["regressor"]  # a row per regressor
    return name, tried[name]


def split_bucket(key: str) -> Column:
    """0 to 99 from the md5 of an id: pseudo-random, the same on any engine."""
    digest = F.md5(F.col(key).cast("string"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(100)).cast("int")


def id_split(ids: DataFrame, key: str = "query_id", train_share: int = TRAIN_SHARE) -> DataFrame:
    """(key, bucket, is_train): a fixed split, made without shuffling or collecting the ids."""
    return ids.select(key, split_bucket(key).alias("bucket")).withColumn(
        "is_train", F.col("bucket") < train_share
    )


def side_ids(split: DataFrame, is_train: bool, most: int | None = None, key: str = "query_id") -> DataFrame:
    """The ids of one side. `most` bounds the labelled queries that a model is fitted on; by hash."""
    side = split.filter(F.col("is_train") == is_train).select(key)
    return side if most is None else side.orderBy(F.md5(F.col(key).cast("string"))).limit(most)
