"""Work is cut by measured sizes: texts by document, counts where their document lies, entries for sorting by their number."""

import pytest

from termloom.operators import index
from termloom.operators.index import analyzed, build_index, query_units
from termloom.plans import collection as c
from termloom.sources import sinks


@pytest.fixture
def sf_dir(spark, tmp_path):
    rows = [(i if i % 7 else None, f"title {i}\n" + f"one two three w{i % 5} " * 20, "en", "web") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_texts_are_dealt_by_size_and_counts_do_not_move(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(c, "TASK_TEXT", 2000)
    docs = c.documents_by_id(spark, sf_dir)
    assert docs.rdd.getNumPartitions() >= 10
    assert sorted(map(str, docs.collect())) == sorted(map(str, c.documents(spark, sf_dir).collect()))
    built = build_index(analyzed(docs, ["title", "body"]), ["title", "body"], staged=False)
    plan = built.entries._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # of the texts
    plain = build_index(analyzed(c.documents(spark, sf_dir), ["title", "body"]), ["title", "body"], staged=False)
    assert sorted(map(str, built.entries.collect())) == sorted(map(str, plain.entries.collect()))


def test_stored_entries_are_sorted_in_parts_by_their_number(spark, sf_dir, tmp_path, monkeypatch):
    frame, asked = type(spark.range(0)), []
    dealt = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda df, *by: asked.append(by[0]) or dealt(df, *by))
    monkeypatch.setattr(sinks, "BUCKET_ENTRIES", 5)
    built = build_index(analyzed(c.documents_by_id(spark, sf_dir), ["body"]), ["body"], staged=False)
    sinks.save_index(built, f"{tmp_path}/index", buckets=3)
    assert asked[0] == built.entries.count() // 10 > sinks.LEAST_BUCKETS
    stored = sinks.load_index(spark, f"{tmp_path}/index").entries
    assert stored.count() == built.entries.filter("unit <> ''").count()


@pytest.mark.parametrize("kinds", ["TOU", "U", "O"])
def test_pairs_are_told_in_full(spark, monkeypatch, kinds):
    """Hashes only find candidates; terms with blanks, equal terms and the ends of texts count as without hashes."""
    texts = [(1, ["a b", "c", "a", "b c"]), (2, ["a", "b c", "x", "x"]), (3, ["x"]), (4, []), (None, ["c", "a b"])]
    docs = spark.createDataFrame(texts, "doc_id long, body array<string>")
    asked = spark.createDataFrame([(1, ["a", "b c", "a b"]), (2, ["x", "x", "c"])], "query_id long, terms array<string>")
    units = query_units(asked, kinds)
    columns = ["doc_id", "lens", *index.UNIT, "tf"]
    found = build_index(docs, ["body"], kinds, units=units).entries.select(columns)
    monkeypatch.setattr(index, "fits_broadcast", lambda df: False)
    expected = build_index(docs, ["body"], kinds, units=units).entries.select(columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
