"""The numbered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    line_dedup,
    mixing,
    ngram_join,
    resample,
    substring_dedup,
    token_alignment,
    topk_search,
    toxicity,
    url_filter,
    warc,
)
from termloom.llm.common import table
from termloom.operators.staging import new_path

Query = Callable[[SparkSession, str], DataFrame]


WEIGHTS, MIX_FACTOR, MIX_MOST = (5, 2, 1), 1.5, 2
TOXIC = 0.7


def held_out(doc_id: str = "doc_id"):
    """Rows that no model may learn from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_counts(table(spark, sf_dir, "documents"), WEIGHTS, MIX_FACTOR, MIX_MOST)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    warc.write_bundles(table(spark, sf_dir, "pages"), folder)
    return warc.page_digests(spark, folder).drop("url")


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = toxicity.sample(table(spark, sf_dir, "labels"), ~held_out(), "doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted")
    )


RULES = [
    url_filter.Rule("org/", True), url_filter.Rule("example.org/es/", False), url_filter.Rule("example.org/en/1", False),
    url_filter.Rule("com/fr/", True), url_filter.Rule("com/de/", False),
]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boilerplate lines of the documents of each source, which stands for the site."""
    docs = table(spark, sf_dir, "documents")
    cleaned = line_dedup.drop_boilerplate(docs.select("doc_id", "source", "text"), F.col("source"), "text")
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents come in two batches, larger ids first, so the largest id stays."""
    docs = table(spark, sf_dir, "documents")
    middle = docs.agg(F.avg("doc_id")).first()[0] or 0.0
    newer = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    return exact_dedup.deduplicate(docs, [newer, ~newer])


VOCABULARY = "byte_bpe_50k.tiktoken"


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame) -> DataFrame:
    """Token counts and digests of `docs`, encoded and decoded with the public vocabulary."""
    ranks = bpe.read_ranks(public_tokenizers.path(VOCABULARY))
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


DRAWN_SHARE = (5, 100)


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), DRAWN_SHARE)


TOKENIZERS = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"), *map(public_tokenizers.path, TOKENIZERS))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def queries() -> dict[str, Query]:
    return {
        "op1_mixing": op1_mixing,
        "op2_warc": op2_warc,
        "op3_topk_search": op3_topk_search,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_toxicity": op5_toxicity,
        "op6_url_filter": op6_url_filter,
        "op7_line_dedup": op7_line_dedup,
        "op8_ngram_join": op8_ngram_join,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_resample": op11_resample,
        "op12_token_alignment": op12_token_alignment,
        "op13_decontaminate": op13_decontaminate,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_topk_search": OP3,
        "op4_substring_dedup": OP4,
        "op7_line_dedup": OP7,
        "op8_ngram_join": OP8,
        "op9_exact_dedup": OP9,
        "op13_decontaminate": OP13,
    }


OP3 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.w) = len(c.w) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP4 = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 11)) AS s, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS x
  FROM words WHERE len(w) >= 13
), firsts AS (SELECT x, min(doc_id) AS first_id FROM windows GROUP BY x),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS pos FROM windows JOIN firsts USING (x) WHERE first_id < doc_id
), spread AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(g.pos) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (g.pos IS NULL), '') AS text
  FROM spread LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

OP7 = """
WITH split AS (
  SELECT doc_id, coalesce(source, '') AS host, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
), lines AS (SELECT doc_id, host, line, pos, trim(line, ' ') AS bare FROM split),
counted AS (
  SELECT host, bare, count(DISTINCT doc_id) AS pages_with FROM lines WHERE bare <> '' GROUP BY ALL
), totals AS (SELECT coalesce(source, '') AS host, count(*) AS pages_of_host FROM documents GROUP BY ALL),
bad AS (
  SELECT host, bare FROM counted JOIN totals USING (host)
  WHERE pages_with >= 5 AND pages_of_host >= 5 AND pages_with > 0.01 * pages_of_host
), cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(bad.bare) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (bad.bare IS NULL), '') AS text
  FROM lines LEFT JOIN bad USING (host, bare) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(c.n_lines, 0)::INTEGER AS n_lines, coalesce(c.n_dropped, 0)::INTEGER AS n_dropped,
       sha256(coalesce(c.text, '')) AS kept_sha256
FROM documents d LEFT JOIN cleaned c USING (doc_id)
"""

OP8 = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), spread AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS shingle
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM spread GROUP BY doc_id),
in_common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM spread a JOIN spread b USING (shingle)
  WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM in_common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.other FROM reach r JOIN (SELECT a AS at, b AS other FROM links UNION ALL SELECT b, a FROM links) l ON l.at = r.other
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, d.component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) d LEFT JOIN sizes s USING (doc_id)
"""

OP9 = """
WITH hashed AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), groups AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY ALL)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM hashed JOIN groups USING (text_sha256)
"""

OP13 = """
WITH dw AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), iw AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM iw WHERE len(w) > 0)
), shown AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dw, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)
), found AS (
  SELECT doc_id, s, n, item_id FROM shown JOIN wins USING (n, x)
), hit AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS pos FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
