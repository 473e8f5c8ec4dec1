"""File readers and writers."""

import random
import json

import pytest

from termloom.operators.index import build_index, query_units, restrict
from termloom.sources import readers, sinks


@pytest.fixture
def write(tmp_path):
    def put(name, text):
        path = tmp_path / name
        path.write_text(text, encoding="utf-8")
        return str(path)

    return put


def test_labelled_texts(spark, write):
    path = write("mail.tsv", 'Id\tLabel\tEmail\na/0\tham\t"one ""two""\nthree"\na/1\tspam\tfour\na/2\todd\tfive\n')
    got = [tuple(r) for r in readers.labelled_texts(spark, path).orderBy("id").collect()]
    assert got == [("a/0", 0, 'one "two"\nthree'), ("a/1", 1, "four"), ("a/2", 1, "five")]


def test_rankings_keep_the_order_of_the_file(spark, write):
    lines = [(f"q{i % 3}", f"d{(i * 7919) % 100_003}") for i in range(6000)]
    path = write("run.tsv", "query_id\tdoc_id\n" + "".join(f"{q}\t{d}\n" for q, d in lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        frame = readers.rankings(spark, path)
        got = frame.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for query in ("q0", "q1", "q2"):
        mine = [d for _, d in sorted((r["rank"], r.doc_id) for r in got if r.query_id == query)]
        assert mine == [d for q, d in lines if q == query]


def test_judgments(spark, write):
    path = write("graded", "q1\td1\t2\t0\nq1\td2\t0\t0\nq1\td3\t1\t0\nq1\td1\t1\t0\n")
    assert sorted(tuple(r) for r in readers.ground_truth(spark, path).collect()) == [("q1", "d1"), ("q1", "d3")]
    path = write("qrels", "MSH1\t87056458\nMSH1 87056800 \n\nOHSU2\t87049102")
    assert [tuple(r) for r in readers.qrels(spark, path).collect()] == [
        ("MSH1", "87056458"), ("MSH1", "87056800"), ("OHSU2", "87049102")
    ]


def test_topics(spark, write):
    block = "<top>\n<num> Number: {}\n<title> {}\n<desc> Description:\nmore text\n</top>\n\n"
    path = write("topics", block.format("OHSU1", "60 year old woman") + block.format("OHSU2", "") + block.format("MSH3", "b c "))
    assert [tuple(r) for r in readers.topics(spark, path).collect()] == [
        ("OHSU1", "60 year old woman"), ("MSH3", "b c")
    ]


def test_json_documents_and_first_documents(spark, write):
    path = write("docs.jsonl", "".join(
        json.dumps({"doc_id": d, "title": t, "body": b}) + "\n" for d, t, b in [("2", "t", "b"), ("1", "u", "c")]
    ))
    docs = readers.json_documents(spark, path)
    assert [tuple(r) for r in readers.first_documents(docs, 1).collect()] == [("1", "u", "c")]


def test_entity_triples(spark):
    key = "http://dbpedia.org/resource/Al_Green"
    good = {key: {"p": [{"type": "literal", "value": ""}, {"type": "uri", "value": "u"}]}, "other": {"p": []}}
    rows = [("Al Green", json.dumps(good)), ("Al Green", "{broken"), ("Nobody", json.dumps(good))]
    payloads = spark.createDataFrame(rows, "entity string, payload string")
    got = sorted(tuple(r) for r in readers.entity_triples(payloads).collect())
    assert got == [(key, "p", "", "literal"), (key, "p", "u", "uri")]


def test_stored_index(spark, tmp_path, term_docs, term_queries):
    docs = term_docs({"a": {"title": "x", "body": "x y x"}, "b": {"title": "", "body": "y"}}, ["title", "body"])
    index = build_index(docs, ["title", "body"])
    sinks.save_postings(index.postings, str(tmp_path / "postings"))
    stored = sinks.load_postings(spark, str(tmp_path / "postings"))
    look = stored.filter("field = 'body' and term = 'y'")
    assert sorted(r.doc_id for r in look.collect()) == ["a", "b"]
    plan = look._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(field" in plan and "EqualTo(term,y)" in plan
    sinks.save_index(index, str(tmp_path / "index"))
    loaded = sinks.load_index(spark, str(tmp_path / "index"))
    assert loaded.fields == ("title", "body") and loaded.stats == index.stats
    units = query_units(term_queries({"q": "y nothing"}))
    cut = restrict(loaded, units)
    assert {(r.doc_id, r.unit) for r in cut.entries.collect()} == {("a", "y"), ("b", "y")}
    assert [r.df.asDict() for r in cut.unit_stats.collect()] == [{"title": 0, "body": 2}]
    plan = cut.entries._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan


def test_save_entities(spark, tmp_path):
    rows = [("a", "names", 1, "x"), ("b", "names", 1, "")]
    sinks.save_entities(
        spark.createDataFrame(rows, "entity_id string, field string, pos long, value string"), str(tmp_path / "e")
    )
    assert [r.entity_id for r in spark.read.parquet(str(tmp_path / "e")).collect()] == ["a"]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [97, 1000, 100_000])
def test_quoted_records_in_splits(spark, tmp_path, end, size):
    """Line breaks, doubled quotes and blank lines in fields; the same rows whatever the splits, and as from one task."""
    rng = random.Random(size)
    texts = ["plain", 'say ""hi""', f"two{end}lines", f'{end}{end}""{end}', "", "tab\there", '""', f"long {'x ' * 90}{end}end"]
    lines = ["Id\tLabel\tEmail"]
    for i in range(200):
        text = rng.choice(texts)
        quoted = '"' + text + '"' if rng.random() < 0.5 or any(c in text for c in '"\n\t') else text
        lines += [f"{i}\t{rng.choice(['ham', 'spam'])}\t{quoted}"] + [""] * (rng.random() < 0.1)
    for name, rows in (("a", lines[:120]), ("b", [lines[0], *lines[120:]])):
        (tmp_path / f"{name}.tsv").write_bytes((end.join(rows) + end).encode())
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        frame = readers.labelled_texts(spark, str(tmp_path))
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        got = sorted(map(tuple, frame.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert got == sorted(map(tuple, readers.labelled_texts(spark, str(tmp_path), strict=False).collect()))
    assert len(got) == 200 and (tasks > 3 or size > 1000)
