"""Readers for the file formats of the collections; every schema is explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.functions.analysis import entity_key
from termloom.operators.joins import running_count
from termloom.operators.metrics import relevant

OBJECTS = "map<string, map<string, array<struct<type: string, value: string>>>>"
RESOURCE_PREFIX = "http://dbpedia.org/resource/"


def quoted_records(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    """Rows of delimited files with a header, whose quoted fields may hold line breaks, read in splits.

    A line is inside a field where an odd number of quotes comes before it in its file. Quotes
    are counted per split, the splits of a file are added up, and then every line knows; only
    the lines of records with line breaks are put together. Quotes have to be doubled inside
    quoted fields and stand nowhere else. Records may span splits; blank lines between records
    are no records. Lines end with a line feed, or with a carriage return before it, which
    becomes a line feed alone inside fields.
    """
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    lines = spark.read.text(path, lineSep="\n").select("value", *at, F.monotonically_increasing_id().alias("line"))
    counted = lines.withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    # a row per split; the last line of a split goes with it as a whole, wherever its bytes end
    splits = counted.groupBy("file", "start").agg(F.sum("quotes").alias("of_split"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = splits.select("file", "start", F.coalesce(F.sum("of_split").over(before), F.lit(0)).alias("earlier"))
    in_split = Window.partitionBy("file", "start").orderBy("line")
    upto = F.sum("quotes").over(in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counted.withColumns({"upto": upto, "n": F.row_number().over(in_split)}).join(known, ["file", "start"])
    total = F.col("earlier") + F.col("upto")
    opening = F.when((total - F.col("quotes")) % 2 == 0, F.when(F.col("quotes") % 2 == 1, total - F.col("quotes")))
    marked = placed.withColumns({
        "inside": (total - F.col("quotes")) % 2 == 1, "ends": total % 2 == 0,
        # the number of quotes before a record's opening line names the record; it grows along the file
        "here": F.max(opening).over(in_split.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    })
    latest = marked.groupBy("file", "start").agg(F.max("here").alias("of_split"))
    carried = latest.select("file", "start", F.max("of_split").over(before).alias("there"))
    rows = marked.filter(~((F.col("start") == 0) & (F.col("n") == 1)))
    whole = rows.filter(~F.col("inside") & F.col("ends")).select("value")
    broken = rows.filter(F.col("inside") | ~F.col("ends")).join(carried, ["file", "start"])
    parts = F.sort_array(F.collect_list(F.struct("start", "line", "value")))
    joined = broken.groupBy("file", F.coalesce("here", "there").alias("record")).agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value")
    )
    bare = F.regexp_replace(F.replace("value", F.lit("\r\n"), F.lit("\n")), "\r$", "")
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"}
    records = whole.union(joined.select("value")).select(bare.alias("value")).filter("value <> ''")
    return records.select(F.from_csv("value", schema, options).alias("r")).select("r.*")


def labelled_texts(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(id, label, text) from a TSV `Id Label Email`; `ham` is 0, anything else 1.

    Files are read in splits (see `quoted_records`); `strict=False` reads a file in one task,
    for files with quotes inside unquoted fields.
    """
    schema = "id STRING, label STRING, email STRING"
    raw = quoted_records(spark, path, schema) if strict else spark.read.csv(
        path, schema=schema, sep="\t", header=True, quote='"', escape='"', multiLine=True,
    )
    return raw.select(
        "id", F.when(F.col("label") == "ham", 0).otherwise(1).alias("label"), F.col("email").alias("text")
    )


def rankings(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, rank, doc_id) from a TSV with a header line, whose line order is the ranking.

    Lines are numbered inside each file split first and then over the splits, so a query
    with a very long list is not sorted in one task.
    """
    raw = spark.read.csv(path, schema="query_id STRING, doc_id STRING", sep="\t", header=True)
    lines = raw.select(
        "query_id", "doc_id",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    numbered = running_count(lines, ["query_id"], [F.col("file"), F.col("start")], [F.col("line")])
    return numbered.select("query_id", F.col("n").cast("int").alias("rank"), "doc_id")


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, doc_id) judged 1 or 2, from `query_id doc_id relevance iteration` TSV."""
    raw = spark.read.csv(
        path, schema="query_id STRING, doc_id STRING, relevance INT, iteration STRING", sep="\t"
    )
    return relevant(raw)


def qrels(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, doc_id) from two columns separated by white space."""
    columns = F.split(F.trim("value"), r"\s+", 2)
    return (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select(columns[0].alias("query_id"), F.trim(columns[1]).alias("doc_id"))
    )


def topics(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, text) from `<top>` blocks: number after `<num>`, text after `<title>`."""
    def line(tag: str):
        return F.trim(F.regexp_extract("value", tag + r"[ \t]*([^\r\n]*)", 1))

    blocks = spark.read.text(path, lineSep="</top>")
    return blocks.select(
        line("<num> Number:").alias("query_id"), line("<title>").alias("text")
    ).filter((F.col("query_id") != "") & (F.col("text") != ""))


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, title, body) from one JSON object per line."""
    return spark.read.schema("doc_id STRING, title STRING, body STRING").json(path)


def entity_triples(payloads: DataFrame) -> DataFrame:
    """Triples of the one subject each payload is about.

    `payloads(entity, payload)`: a name and its JSON text. Malformed JSON and payloads
    without the subject give no triples.
    """
    parsed = payloads.select(
        F.concat(F.lit(RESOURCE_PREFIX), entity_key(F.col("entity"))).alias("subject"),
        F.from_json("payload", OBJECTS, {"mode": "PERMISSIVE"}).alias("data"),
    )
    return (
        parsed.select("subject", F.explode(F.try_element_at("data", F.col("subject"))).alias("predicate", "objects"))
        .select("subject", "predicate", F.explode("objects").alias("o"))
        .select("subject", "predicate", F.col("o.value").alias("object"), F.col("o.type").alias("object_type"))
    )


def first_documents(docs: DataFrame, n: int) -> DataFrame:
    """The first `n` documents by id, for indexing a part of a collection."""
    return docs.orderBy("doc_id").limit(n)
