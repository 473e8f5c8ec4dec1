"""Ranked retrieval over the index table.

Every scorer takes an index cut to the query units and `units(query_id, kind, unit, qf)`,
and returns (query_id, doc_id, score). Without `pairs` it scores the documents that hold at
least one query unit; with `pairs(query_id, doc_id)` it scores exactly those, matching or
not (`all_documents` lists every document for one query). Unit statistics are put on the
query side, so the postings meet one join and one aggregation. The rows of one document lie
together, so most of that aggregation happens before its shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.operators.index import UNIT, TextIndex, count_matches, dealt
from termloom.operators.joins import fits_broadcast, lookup_join, top_k
from termloom.operators.ranges import Model

PAIR = ["query_id", "doc_id"]


def unit_statistics(index: TextIndex, units: DataFrame) -> DataFrame:
    """`units` with `df` and `ttf` (structs over fields); only units the collection has."""
    return lookup_join(units, index.unit_stats, UNIT, index.small_queries, spread_by="query_id")


def matches(index: TextIndex, stats: DataFrame, fields: Sequence[str], pairs: DataFrame | None = None) -> DataFrame:
    """Entries of every query unit that occurs in one of `fields`, with the unit's columns.

    With `pairs`, only entries of their documents meet the units, and only those pairs are
    returned. Otherwise a document's entries are brought together first where the units fit a
    broadcast, so sums per query and document move no pairs.
    """
    here = total([F.col("tf")[f] for f in fields]) > 0
    entries = index.entries.filter(here)
    if pairs is None:
        entries = dealt(entries, count_matches(index, stats)) if index.small_queries else entries
        return lookup_join(entries, stats, UNIT, index.small_queries)
    listed = pairs.select("doc_id").distinct()
    entries = entries.join(F.broadcast(listed) if fits_broadcast(listed) else listed, "doc_id", "left_semi")
    return lookup_join(entries, stats, UNIT, index.small_queries).join(pairs.select(*PAIR), PAIR, "left_semi")


def all_documents(index: TextIndex, query_id) -> DataFrame:
    """(query_id, doc_id) of every document for one query.

    The id hangs on the document: as a plain constant it would drop out of the join keys
    and leave a nested-loop join.
    """
    attached = F.when(F.col("doc_id").isNotNull(), F.lit(query_id))
    return index.documents.select(attached.alias("query_id"), "doc_id")


def total(columns: Sequence[Column]) -> Column:
    return sum(columns[1:], columns[0])


def background(index: TextIndex, field: str) -> Column:
    """P(t|C) of a unit in a field, from its statistics; 0 in an empty collection."""
    length = index.stats.total_len[field]
    return F.col("ttf")[field] / F.lit(float(length)) if length else F.lit(0.0)


def per_document(index: TextIndex, rows: DataFrame, weight: Column, pairs: DataFrame | None) -> DataFrame:
    """Sum the weights; listed pairs without a match get 0."""
    sums = rows.groupBy(*PAIR).agg(F.sum(weight).alias("score"))
    return sums if pairs is None else complete(pairs, sums)


def complete(pairs: DataFrame, sums: DataFrame) -> DataFrame:
    return pairs.select(*PAIR).join(sums, PAIR, "left").fillna(0.0, ["score"])


def add_base(index: TextIndex, scored: DataFrame, base: DataFrame) -> DataFrame:
    """Add the part of the score that all documents of a query share."""
    return lookup_join(scored, base, ["query_id"], index.small_queries, "left").select(
        *PAIR, (F.col("score") + F.coalesce("base", F.lit(0.0))).alias("score")
    )


# ---- term counting and BM25 ------------------------------------------------------------

def simple(index: TextIndex, units: DataFrame, field: str = "body", pairs: DataFrame | None = None) -> DataFrame:
    """Sum of tf * qf."""
    rows = matches(index, units, [field], pairs)
    return per_document(index, rows, (F.col("tf")[field] * F.col("qf")).cast("double"), pairs)


def simple_model(units: DataFrame, field: str = "body") -> Model:
    """`simple` for the exact top k."""
    return Model([field], units.select("query_id", *UNIT, F.col("qf").cast("double").alias("weight")), F.col("tf")[field].cast("double"))


def saturated(field: str, k1: float, b: float, average_dl: float) -> Column:
    tf, norm = F.col("tf")[field], 1 - b + b * F.col("lens")[field] / F.lit(average_dl)
    return tf * (1 + k1) / (tf + k1 * norm)


def bm25(
    index: TextIndex,
    units: DataFrame,
    field: str = "body",
    b: float = 0.75,
    k1: float = 1.2,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """BM25 with idf ln(N/n); repeated query terms count once."""
    rows = matches(index, unit_statistics(index, units), [field], pairs)
    return per_document(index, rows, bm25_weight(index, field, b, k1), pairs)


def bm25_weight(index: TextIndex, field: str, b: float, k1: float) -> Column:
    idf = F.log(F.lit(float(index.stats.n_docs)) / F.col("df")[field])
    return saturated(field, k1, b, index.stats.avg_len(field)) * idf


def bm25_model(index: TextIndex, units: DataFrame, field: str = "body", b: float = 0.75, k1: float = 1.2) -> Model:
    """`bm25` for the exact top k."""
    known = unit_statistics(index, units).select("query_id", *UNIT, "df", F.lit(1.0).alias("weight"))
    return Model([field], known, bm25_weight(index, field, b, k1))


def search(
    index: TextIndex,
    units: DataFrame,
    fields: Sequence[str],
    k: int = 100,
    b: float = 0.75,
    k1: float = 1.2,
) -> DataFrame:
    """First-pass OR search: the best field's BM25 with idf ln(1+(N-n+.5)/(n+.5)), top `k`.

    N and the average length count the documents that have the field; repeated query terms
    count as often as they occur.
    """
    def field_score(f: str) -> Column:
        n, df = index.stats.doc_count[f], F.col("df")[f]
        if not n:
            return F.lit(0.0)
        idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
        weight = F.col("qf") * idf * saturated(f, k1, b, index.stats.total_len[f] / n)
        return F.sum(F.when(F.col("tf")[f] > 0, weight).otherwise(0.0))

    rows = matches(index, unit_statistics(index, units), fields)
    scores = [field_score(f) for f in fields]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return top_k(rows.groupBy(*PAIR).agg(best.alias("score")), k)


def bm25f(
    index: TextIndex,
    units: DataFrame,
    weights: Mapping[str, float] | None = None,
    b: Mapping[str, float] | None = None,
    k1: float = 1.2,
    idf_field: str = "body",
    pairs: DataFrame | None = None,
) -> DataFrame:
    """BM25F; idf comes from `idf_field`, and a term unseen there adds 0."""
    weights = weights or {"title": 0.2, "body": 0.8}
    rows = matches(index, unit_statistics(index, units), list(weights), pairs)
    return per_document(index, rows, bm25f_weight(index, weights, b, k1, idf_field), pairs)


def bm25f_weight(index: TextIndex, weights: Mapping[str, float], b: Mapping[str, float] | None, k1: float, idf_field: str) -> Column:
    b = b or dict.fromkeys(weights, 0.75)

    def field_count(f: str) -> Column:
        average = index.stats.avg_len(f)
        if not average:
            return F.lit(0.0)
        return weights[f] * F.col("tf")[f] / (1 - b[f] + b[f] * F.col("lens")[f] / F.lit(average))

    count, df = total([field_count(f) for f in weights]), F.col("df")[idf_field]
    idf = F.when(df > 0, F.log(F.lit(float(index.stats.n_docs)) / df)).otherwise(0.0)
    return count / (k1 + count) * idf


def bm25f_model(
    index: TextIndex,
    units: DataFrame,
    weights: Mapping[str, float] | None = None,
    b: Mapping[str, float] | None = None,
    k1: float = 1.2,
    idf_field: str = "body",
) -> Model:
    """`bm25f` for the exact top k."""
    weights = weights or {"title": 0.2, "body": 0.8}
    known = unit_statistics(index, units).select("query_id", *UNIT, "df", F.lit(1.0).alias("weight"))
    return Model(list(weights), known, bm25f_weight(index, weights, b, k1, idf_field))


# ---- language models, Jelinek-Mercer ---------------------------------------------------

def lm(
    index: TextIndex,
    units: DataFrame,
    field: str = "body",
    smoothing: float = 0.1,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Query log likelihood of one field; see `mixture_lm`."""
    return mixture_lm(index, units, {field: 1.0}, smoothing, pairs)


def mixture_lm(
    index: TextIndex,
    units: DataFrame,
    weights: Mapping[str, float] | None = None,
    smoothing: float = 0.1,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Mixture of smoothed field models: sum of qf * ln(sum_f w_f((1-s) tf/dl + s p_f)).

    A document that lacks a term gets that term's background, which is the same for all
    documents. So the score is one number per query plus a gain per matching term:
    ln(m + bg) = ln(bg) + ln(1 + m/bg). Terms the collection lacks add 0.
    """
    model = lm_model(index, units, weights, smoothing)
    rows = matches(index, model.units, model.fields, pairs)
    return add_base(index, per_document(index, rows, F.col("weight") * model.gain, pairs), model.queries)


def lm_model(index: TextIndex, units: DataFrame, weights: Mapping[str, float] | None = None, smoothing: float = 0.1) -> Model:
    """`mixture_lm` in parts, also for the exact top k."""
    weights = weights or {"title": 0.2, "body": 0.8}
    bg = total([weights[f] * smoothing * background(index, f) for f in weights])
    stats = unit_statistics(index, units).select("query_id", *UNIT, F.col("qf").alias("weight"), bg.alias("bg")).filter("bg > 0")
    base = stats.groupBy("query_id").agg(F.sum(F.col("weight") * F.log("bg")).alias("base"))
    own = total([
        F.when(
            F.col("lens")[f] > 0, weights[f] * (1 - smoothing) * F.col("tf")[f] / F.col("lens")[f]
        ).otherwise(0.0)
        for f in weights
    ])
    return Model(list(weights), stats, F.log1p(own / F.col("bg")), base, lambda lengths: F.col("base"))
