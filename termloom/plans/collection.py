"""Collections, topics, judgments and triples derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.analysis import Analyzer, english_terms, index_terms
from termloom.operators.entities import COMMENT_PREDICATE, NAME_PREDICATES, TYPE_PREDICATE, TYPE_PREDICATES
from termloom.operators.index import MOST_PARTS, TextIndex, analyzed, build_index, query_units
from termloom.operators.joins import fits_broadcast, lookup_join
from termloom.operators.ltr import TRAIN_SHARE, split_bucket

FIELDS = ["title", "body", "anchors"]
#: Bytes of text that a task counts the units of, about: its table of counts stays in memory.
TASK_TEXT = 4_000_000
SENTENCE_END = r"[.\n!?]+"

RESOURCE = "http://example.org/resource/"
ONTOLOGY = "http://example.org/ontology/"
PROPERTY = "http://example.org/property/"
BRANDS = "Brands"
LABEL, NAME = NAME_PREDICATES[:2]
SUBJECT = TYPE_PREDICATES[1]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of an input with fewer file splits than cores out over the cores.

    A small file is read by a single task, which would then do all text analysis alone. Rows
    are dealt in turn, by no key, so what follows has the same plan as on a large input.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, title, body, anchors): first line, the rest, and source and language tags."""
    return _fielded(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")))


def documents_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` for an index, dealt by `doc_id` in parts of about `TASK_TEXT` bytes of text.

    A file split can hold far more units than a task can count in memory, and counts are more
    than texts: so texts move, once, and the units of a document are counted where it lies.
    """
    raw = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    size = raw.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    return _fielded(raw.repartition(min(max(cores, -(-size // TASK_TEXT)), MOST_PARTS), "doc_id"))


def _fielded(raw: DataFrame) -> DataFrame:
    cut = F.instr("text", "\n")
    return raw.select(
        "doc_id",
        F.when(cut > 0, F.substring_index("text", "\n", 1)).otherwise("").alias("title"),
        F.when(cut > 0, F.substr("text", cut + 1)).otherwise(F.col("text")).alias("body"),
        F.concat_ws(" ", "source", "lang").alias("anchors"),
    )


def queries(spark: SparkSession, sf_dir: str, analyzer: Analyzer = index_terms) -> DataFrame:
    """(query_id, terms): every benchmark text in full is one query."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), analyzer(F.col("text")).alias("terms")
    )


def sentences(df: DataFrame, key: str) -> DataFrame:
    """(key, sentence) with all sentences that are not blank."""
    parts = F.explode(F.split("text", SENTENCE_END)).alias("sentence")
    return (
        df.select(key, parts)
        .select(key, F.trim("sentence").alias("sentence"))
        .filter(F.col("sentence") != "")
    )


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, doc_id, relevance): documents that repeat sentences of a benchmark text.

    2 for three or more shared sentences, else 1; 0 where the document is labelled as low
    quality.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    asked = sentences(items, "query_id").distinct()
    shared = (
        lookup_join(sentences(docs, "doc_id"), asked, ["sentence"], fits_broadcast(asked))
        .distinct()
        .groupBy("query_id", "doc_id")
        .agg(F.count("*").alias("shared"))
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return shared.join(labels, "doc_id", "left").select(
        "query_id", "doc_id",
        F.when(F.col("quality") == 0, 0).when(F.col("shared") >= 3, 2).otherwise(1).alias("relevance"),
    )


def index_for(
    spark: SparkSession,
    sf_dir: str,
    fields: list[str],
    kinds: str = "T",
    analyzer: Analyzer = index_terms,
    count_rule: str = "pairs",
) -> tuple[TextIndex, DataFrame]:
    """Index of the documents cut to the units of all benchmark queries, and those units."""
    units = query_units(queries(spark, sf_dir, analyzer), kinds, count_rule)
    doc_terms = analyzed(documents_by_id(spark, sf_dir), fields, analyzer)
    return build_index(doc_terms, fields, kinds, count_rule=count_rule, units=units), units


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subject, predicate, object, object_type) from parts, suppliers, customers, nations."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    supplied = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    lit, text = F.lit, lambda c: F.col(c).cast("string")

    def fact(predicate: str, value, kind: str):
        return F.struct(
            lit(predicate).alias("predicate"), value.alias("object"), lit(kind).alias("object_type")
        )

    def facts(rows: DataFrame, prefix: str, key: str, *found) -> DataFrame:
        subject = F.concat(lit(RESOURCE + prefix), text(key)).alias("subject")
        return rows.select(subject, F.inline(F.array(*found)))

    comment = F.concat_ws(" ", "p_name", lit("made by"), "p_brand", lit("of size"), text("p_size"))
    nation_uri = F.concat(lit(RESOURCE), "n_name")
    parts = facts(
        part, "Part_", "p_partkey",
        fact(LABEL, F.col("p_name"), "literal"),
        fact(COMMENT_PREDICATE, comment, "literal"),
        fact(TYPE_PREDICATE, lit(ONTOLOGY + "Part"), "uri"),
        fact(TYPE_PREDICATE, F.concat(lit(ONTOLOGY), "p_type"), "uri"),
        fact(SUBJECT, F.concat(lit(RESOURCE + "Category:"), "p_brand", lit("_parts")), "uri"),
        fact(PROPERTY + "brand", F.col("p_brand"), "literal"),
        fact(PROPERTY + "size", text("p_size"), "literal"),
    )
    links = facts(
        supplied, "Part_", "l_partkey",
        fact(PROPERTY + "supplier", F.concat(lit(RESOURCE + "Supplier_"), text("l_suppkey")), "uri"),
    )
    suppliers = facts(
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")), "Supplier_", "s_suppkey",
        fact(NAME, F.col("s_name"), "literal"),
        fact(TYPE_PREDICATE, lit(ONTOLOGY + "Supplier"), "uri"),
        fact(PROPERTY + "nation", nation_uri, "uri"),
    )
    customers = facts(
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")), "Customer_", "c_custkey",
        fact(NAME, F.col("c_name"), "literal"),
        fact(TYPE_PREDICATE, lit(ONTOLOGY + "Customer"), "uri"),
        fact(SUBJECT, F.concat(lit(RESOURCE + "Category:"), "c_mktsegment"), "uri"),
        fact(PROPERTY + "nation", nation_uri, "uri"),
    )
    return parts.union(links).union(suppliers).union(customers)


def entity_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, terms): every part name, with one of its types."""
    names = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_type").alias("p_type"))
    return names.select(
        F.col("p_name").alias("query_id"),
        english_terms(F.concat_ws(" ", "p_name", "p_type")).alias("terms"),
    )


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, link): a list page per brand with its parts, and a page that links the lists of brands with a part of the largest size."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    name = F.concat(F.lit("List of "), "p_brand")
    largest = part.agg(F.max("p_size")).first()[0]
    lists = part.select(name.alias("page"), F.concat(F.lit("Part "), F.col("p_partkey").cast("string")).alias("link"))
    linked = part.filter(F.col("p_size") == largest).select(F.lit(BRANDS).alias("page"), name.alias("link")).distinct()
    return lists.union(linked)


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, link): pages named by the first word of their title, with their link targets."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select(
        F.concat(F.lit("/"), F.regexp_extract("html", "<title>([^ <]*)", 1)).alias("page"),
        F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link"),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, label, is_train): labelled documents; low quality is the positive class."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("label"))
    return split_documents(spark, sf_dir).join(labels, "doc_id")


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, is_train)."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.withColumn("is_train", split_bucket("doc_id") < TRAIN_SHARE)
