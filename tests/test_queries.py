"""Queries of the catalog against their SQL on DuckDB, on the smallest driver tables.

`compare.py` does the same for all queries and larger tables.
"""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "unique_elements", "feature_vector", "bm25_top", "mlm", "sdm_total", "fsdm_total", "lm_every_document",
    "entity_dict", "entity_fields", "item_occurrences", "term_frequency", "field_documents", "evaluate", "lm_top", "entity_candidates", "prms_topk", "average_precision", "ltr_training", "tfidf",
]

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    """These queries run with generated code, as in production; the other modules run interpreted."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows_as_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) == []


def test_every_query_has_sql_but_the_fitted_models():
    own = {n for n in queries() if n != "pipeline" and not n.startswith("op")}
    assert own - set(oracle_sql()) == {"spam_eval", "ltr_rerank"}
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["query_id", "rank", "doc_id", "score"]
    assert frame.count() > 0
