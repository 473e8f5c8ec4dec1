import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("termloom-tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        # interpreted plans: compiling them takes longer than running them on toy tables
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def term_docs(spark):
    """Turn {doc: {field: 'a b c'}} into the analysed form (doc_id, field arrays)."""

    def make(docs, fields):
        rows = [(d, *[v.get(f, "") for f in fields]) for d, v in docs.items()]
        df = spark.createDataFrame(rows, ["doc_id", *fields])
        split = [F.array_remove(F.split(f, " "), "").alias(f) for f in fields]
        return df.select("doc_id", *split)

    return make


@pytest.fixture(scope="session")
def term_queries(spark):
    """Turn {query: 'a b c'} into (query_id, terms)."""

    def make(queries):
        df = spark.createDataFrame(list(queries.items()), ["query_id", "text"])
        return df.select("query_id", F.array_remove(F.split("text", " "), "").alias("terms"))

    return make


# The toy collections that the golden values belong to.
SINGLE = {
    "d1": {"body": "t3 t3 t3 t6 t6"},
    "d2": {"body": "t1 t2 t3 t3 t6"},
    "d3": {"body": "t3 t3 t4 t5"},
    "d4": {"body": "t4 t5 t6 t6"},
    "d5": {"body": "t1 t2 t3 t5"},
}
FIELDED = {
    "d1": {"title": "t1", "body": "t1 t2 t3 t1 t3", "anchors": "t2 t2"},
    "d2": {"title": "t4 t5", "body": "t1 t3 t4 t4 t4 t5", "anchors": "t5 t3"},
    "d3": {"title": "t1 t3 t5", "body": "t1 t1 t5 t3 t5 t3 t3", "anchors": "t1 t1 t5"},
}
