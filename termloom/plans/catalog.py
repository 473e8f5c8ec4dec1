"""All queries by name. Each takes (spark, sf_dir) and reads the driver's tables in full."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.analysis import (
    english_terms,
    entity_key,
    idf,
    standard_terms,
    stem_table,
    strip_punctuation,
)
from termloom.functions.stopwords import ENGLISH
from termloom.operators import (
    dependence,
    elements,
    entities,
    index,
    ltr,
    metrics,
    positional,
    prms,
    ranges,
    scorers,
    textclf,
)
from termloom.operators.joins import top_k
from termloom.operators.staging import new_path, stage
from termloom.plans import collection as c
from termloom.sources import segments, sinks

TITLE_BODY = ["title", "body"]
PART = c.ONTOLOGY + "Part"
MIN_REPEATS = 60
VOCABULARY = ["and", "the", "of", "The", "la", "de", "und", "der", "que", "pour"]
LOOKUP, LOOKUP_DOC = ("body", "la"), 7
LINK_PREFIX = "/Th"
ITEM = "7"
KIND = {"unigram": "T", "ordered": "O", "unordered": "U"}


def rounded(df: DataFrame, *names: str, decimals: int = 6) -> DataFrame:
    """Fixed decimals: sums of doubles differ in their last bits between plans."""
    return df.withColumns({n: F.round(n, decimals) for n in names})


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.spread(c.table(spark, sf_dir, "documents").select("doc_id", "text"))


# ---- words and counts ------------------------------------------------------------------

def unique_elements(spark, sf_dir):
    events = c.table(spark, sf_dir, "events")
    listed = events.select(F.col("event_id").alias("pos"), F.col("user_id").cast("string").alias("elem"))
    return elements.unique_elements(listed, MIN_REPEATS)


def item_occurrences(spark, sf_dir):
    events = c.table(spark, sf_dir, "events")
    return elements.occurrences(events.select(F.col("user_id").cast("string").alias("elem")), ITEM)


def word_freq(spark, sf_dir):
    return elements.word_frequencies(_texts(spark, sf_dir))


def feature_vector(spark, sf_dir):
    vectors = elements.feature_vectors(_texts(spark, sf_dir), VOCABULARY)
    return vectors.select("doc_id", F.array_join(F.transform("vector", lambda v: v.cast("string")), ",").alias("vector"))


def strip_punct(spark, sf_dir):
    text = F.col("text")
    return _texts(spark, sf_dir).select(
        "doc_id",
        strip_punctuation(text).alias("clean"),
        strip_punctuation(text, ENGLISH).alias("clean_no_stop"),
    )


def tokens(spark, sf_dir):
    return index.tokens(index.analyzed(c.documents(spark, sf_dir), TITLE_BODY), TITLE_BODY)


def query_terms(spark, sf_dir):
    """Standard analysis; terms that no body has are dropped."""
    idx, _ = c.index_for(spark, sf_dir, ["body"], analyzer=standard_terms)
    return index.seen_terms(c.queries(spark, sf_dir, standard_terms), idx.postings, "body")


def english_tokens(spark, sf_dir):
    docs = index.analyzed(c.documents(spark, sf_dir), TITLE_BODY, english_terms)
    return index.tokens(docs, TITLE_BODY)


# ---- index -----------------------------------------------------------------------------

def _full_index(spark, sf_dir, fields=TITLE_BODY, staged=False) -> index.TextIndex:
    return index.build_index(index.analyzed(c.documents_by_id(spark, sf_dir), fields), fields, staged=staged)


def index_postings(spark, sf_dir):
    return _full_index(spark, sf_dir).postings


def index_terms_of_field(spark, sf_dir):
    return index.field_terms(_full_index(spark, sf_dir).postings, "title")


def postings_lookup(spark, sf_dir):
    return index.term_postings(_full_index(spark, sf_dir).postings, *LOOKUP)


def term_frequency(spark, sf_dir):
    return index.term_frequency(_full_index(spark, sf_dir).postings, *LOOKUP, LOOKUP_DOC)


def field_documents(spark, sf_dir):
    """Documents that have a title, with its number of terms."""
    docs = index.analyzed(c.documents(spark, sf_dir), TITLE_BODY)
    return index.field_documents(docs, "title").select("doc_id", F.size("terms").alias("n_terms"))


def doc_vectors(spark, sf_dir):
    return index.doc_vectors(_full_index(spark, sf_dir).postings, "title")


def term_stats(spark, sf_dir):
    idx = _full_index(spark, sf_dir, staged=True)
    counts = index.term_stats(idx.postings)
    return rounded(counts.withColumn("idf", idf(F.lit(idx.stats.n_docs), F.col("df"))), "idf")


def field_lengths(spark, sf_dir):
    docs = index.analyzed(c.documents(spark, sf_dir), c.FIELDS)
    return rounded(index.field_lengths(docs, c.FIELDS), "avg_len")


# ---- ranked retrieval ------------------------------------------------------------------

def _scored(scorer, fields, kinds="T", **params):
    rule = params.pop("count_rule", "pairs")

    def run(spark, sf_dir):
        idx, units = c.index_for(spark, sf_dir, fields, kinds, count_rule=rule)
        return rounded(scorer(idx, units, **params), "score")

    return run


def _every_document(scorer, fields, kinds="T"):
    """All benchmark texts as a single query, which scores every document.

    These scores add up a thousand logarithms and more, to about -10000, so they are given
    to four decimals.
    """

    def run(spark, sf_dir):
        idx, units = c.index_for(spark, sf_dir, fields, kinds)
        merged = units.groupBy(*index.UNIT).agg(F.sum("qf").alias("qf"))
        one = stage(merged.withColumn("query_id", F.lit(0).cast("long")), "query")
        every = scorers.all_documents(idx, 0).withColumn("query_id", F.col("query_id").cast("long"))
        return rounded(scorer(idx, one, pairs=every), "score", decimals=4)

    return run


def bm25_top(spark, sf_dir, k=10):
    idx, units = c.index_for(spark, sf_dir, ["body"])
    return ranges.best_matches(idx, scorers.bm25_model(idx, units), k)


def _best(model, fields, k=10, kinds="T", of=ranges.best_matches):
    """The best documents by a scorer, without scoring the others."""

    def run(spark, sf_dir):
        idx, units = c.index_for(spark, sf_dir, fields, kinds)
        return of(idx, model(idx, units), k)

    return run


def bm25_stored_top(spark, sf_dir, k=10):
    """The same from an index that was stored in full and is read for the query's terms only."""
    path = new_path(spark, "stored-index")
    sinks.save_index(_full_index(spark, sf_dir), path)
    units = index.query_units(c.queries(spark, sf_dir))
    idx = index.restrict(sinks.load_index(spark, path), units)
    return ranges.best_matches(idx, scorers.bm25_model(idx, units), k)


#: What one stored index with positions is asked for: windows and counting rules.
STORED_RULES = [(3, "pairs"), (5, "anchored")]


def _positional(spark, sf_dir, fields=("body",)):
    """An index with positions, stored and read back."""
    path = new_path(spark, "positions")
    docs = index.analyzed(c.documents_by_id(spark, sf_dir), list(fields))
    sinks.save_index(index.build_index(docs, list(fields), staged=False, places=True), path)
    return sinks.load_index(spark, path)


def sdm_stored(spark, sf_dir, k=10):
    """Sequential dependence by two windows and both counting rules, all from one stored index."""
    stored, found = _positional(spark, sf_dir), None
    for window, rule in STORED_RULES:
        units = index.query_units(c.queries(spark, sf_dir), "TOU", rule)
        best = ranges.best_matches(idx := positional.paired(stored, units, window, rule), dependence.sdm_model(idx, units), k)
        best = best.select(F.lit(window).alias("near"), F.lit(rule).alias("rule"), "*")
        found = best if found is None else found.union(best)
    return found


def bm25_grown_top(spark, sf_dir, k=10):
    """BM25 on an index that grew: half of the documents with their titles only, the others, then the first half as they are."""
    path = new_path(spark, "grown")
    docs = index.analyzed(c.documents_by_id(spark, sf_dir), TITLE_BODY)
    middle = docs.agg(F.avg("doc_id")).first()[0]
    half = docs.filter(F.col("doc_id") <= middle)
    for part in (half.withColumn("body", F.col("title")), docs.filter(F.col("doc_id") > middle), half):
        segments.append(index.build_index(part, TITLE_BODY, staged=False), path)
    units = index.query_units(c.queries(spark, sf_dir))
    idx = index.restrict(segments.load(spark, path), units)
    return ranges.best_matches(idx, scorers.bm25_model(idx, units), k)


def _stems(docs, fields):
    """Stems of the collection's distinct terms."""
    return stage(stem_table(docs.select(F.explode(F.concat(*fields)).alias("term"))), "stems")


def stemmed_postings(spark, sf_dir):
    docs = index.analyzed(c.documents(spark, sf_dir), TITLE_BODY)
    return index.build_index(docs, TITLE_BODY, staged=False, stems=_stems(docs, TITLE_BODY)).postings


def stemmed_bm25(spark, sf_dir):
    """BM25 with the stems of documents and queries."""
    docs = index.analyzed(c.documents(spark, sf_dir), ["body"])
    asked = c.queries(spark, sf_dir)
    stems = _stems(docs.select("body").union(asked.select("terms")), ["body"])
    units = index.query_units(asked, stems=stems)
    return rounded(scorers.bm25(index.build_index(docs, ["body"], units=units, stems=stems), units), "score")


def sdm_anchored(spark, sf_dir):
    """Pairs near each other, counted per position of the first term, from positions."""
    units = index.query_units(c.queries(spark, sf_dir), "U", "anchored")
    docs = index.analyzed(c.documents_by_id(spark, sf_dir), ["body"])
    parts = units.select("query_id", F.lit("T").alias("kind"), F.explode(F.split("unit", " ")).alias("unit"), "qf")
    idx = positional.paired(index.build_index(docs, ["body"], units=parts, places=True), units, 3, "anchored")
    return rounded(dependence.sdm(idx, units, kind_weights={"U": 1.0}), "score")


def _lm_of_body(idx, units):
    return scorers.lm_model(idx, units, {"body": 1.0})


# ---- entities --------------------------------------------------------------------------

def _entity_index(spark, sf_dir):
    units = index.query_units(c.entity_queries(spark, sf_dir))
    return entities.entity_index(c.triples(spark, sf_dir), units, PART), units


def entity_dict(spark, sf_dir):
    return entities.entity_values(c.triples(spark, sf_dir))


def entity_fields(spark, sf_dir):
    return entities.entity_documents(c.triples(spark, sf_dir), PART)


def entity_keys(spark, sf_dir):
    return c.table(spark, sf_dir, "part").select("p_partkey", entity_key(F.concat_ws(" & ", "p_name", "p_brand")).alias("key"))


def entity_candidates(spark, sf_dir):
    return entities.candidates(c.page_links(spark, sf_dir), LINK_PREFIX)


def candidate_index(spark, sf_dir):
    """Postings of the query terms over the parts that the listed brand pages link."""
    names = entities.candidates(c.part_pages(spark, sf_dir), "List of", c.BRANDS)
    subjects = names.select(F.concat(F.lit(c.RESOURCE), entity_key(F.col("entity"))).alias("subject"))
    units = index.query_units(c.entity_queries(spark, sf_dir))
    return entities.entity_index(c.triples(spark, sf_dir), units, PART, subjects=subjects).postings


def baseline_topk(spark, sf_dir):
    idx, units = _entity_index(spark, sf_dir)
    return scorers.search(idx, units, ["catch_all"], 100)


def collection_lm(spark, sf_dir):
    idx, units = _entity_index(spark, sf_dir)
    return rounded(prms.collection_lm(idx, units), "p")


def term_mapping(spark, sf_dir):
    idx, units = _entity_index(spark, sf_dir)
    return rounded(prms.term_mapping(prms.collection_lm(idx, units)), "p_field")


def prms_scores(spark, sf_dir):
    idx, units = _entity_index(spark, sf_dir)
    return rounded(prms.prms(idx, units), "score")


def prms_topk(spark, sf_dir):
    idx, units = _entity_index(spark, sf_dir)
    return prms.prms_search(idx, units)


def prms_top(spark, sf_dir, k=10):
    """The best of all entities of the type, without a first pass."""
    idx, units = _entity_index(spark, sf_dir)
    return ranges.best_of_all(idx, prms.prms_model(idx, units), k)


# ---- evaluation ------------------------------------------------------------------------

def _predictions(spark, sf_dir):
    """Quality labels as actual classes, and "not toxic" as prediction."""
    labels = c.table(spark, sf_dir, "labels")
    actual = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("actual"))
    predicted = labels.select(F.col("doc_id").alias("id"), (1 - F.col("toxic")).alias("predicted"))
    return metrics.aligned(actual, predicted)


def confusion(spark, sf_dir):
    return metrics.confusion_matrix(_predictions(spark, sf_dir))


def evaluated(spark, sf_dir):
    found = metrics.evaluate(_predictions(spark, sf_dir))
    return rounded(found, *found.columns)


def binary_metrics(spark, sf_dir):
    measures = metrics.binary_measures(metrics.confusion_matrix(_predictions(spark, sf_dir)))
    return rounded(measures, *measures.columns)


def qrels_relevant(spark, sf_dir):
    return metrics.relevant(c.judgments(spark, sf_dir))


def _ranked(spark, sf_dir):
    run, truth = bm25_top(spark, sf_dir, 100), qrels_relevant(spark, sf_dir)
    return stage(run, "run"), stage(truth, "truth")


def _measured(measure):
    return lambda spark, sf_dir: rounded(measure(*_ranked(spark, sf_dir)), "value")


def mean_measure(spark, sf_dir):
    return rounded(metrics.mean_measure(*_ranked(spark, sf_dir), metrics.reciprocal_rank), "mean")


# ---- learning --------------------------------------------------------------------------

def _ltr_index(spark, sf_dir):
    return c.index_for(spark, sf_dir, TITLE_BODY, analyzer=english_terms)


def first_pass(spark, sf_dir):
    return ltr.first_pass(*_ltr_index(spark, sf_dir))


def ltr_query_feats(spark, sf_dir):
    return rounded(ltr.query_features(*_ltr_index(spark, sf_dir)), *ltr.QUERY_FEATURES[1:])


def ltr_doc_feats(spark, sf_dir):
    docs = index.analyzed(c.documents(spark, sf_dir), TITLE_BODY, english_terms)
    return ltr.doc_features(index.document_lengths(docs, TITLE_BODY))


def ltr_pair_feats(spark, sf_dir):
    idx, units = _ltr_index(spark, sf_dir)
    pairs = qrels_relevant(spark, sf_dir)
    return rounded(ltr.pair_features(idx, units, pairs), "avg_TF_title", "avg_TF_body")


def ltr_matrix(spark, sf_dir):
    idx, units = _ltr_index(spark, sf_dir)
    features = ltr.feature_matrix(idx, units, stage(ltr.first_pass(idx, units), "pairs"))
    return rounded(features, *ltr.QUERY_FEATURES[1:], "avg_TF_title", "avg_TF_body")


def ltr_training(spark, sf_dir):
    idx, units = _ltr_index(spark, sf_dir)
    data = ltr.training_data(idx, units, qrels_relevant(spark, sf_dir))
    return rounded(data, *ltr.QUERY_FEATURES[1:], "avg_TF_title", "avg_TF_body")


def id_split(spark, sf_dir):
    return ltr.id_split(c.queries(spark, sf_dir))


def _sides(spark, sf_dir):
    """Index, units, judgments, and the units of all labelled and of all held-out queries."""
    idx, units = _ltr_index(spark, sf_dir)
    split = ltr.id_split(c.queries(spark, sf_dir))

    def side(is_train):
        return units.join(ltr.side_ids(split, is_train), "query_id", "left_semi")

    return idx, units, qrels_relevant(spark, sf_dir), side(True), side(False)


def first_pass_mrr(spark, sf_dir):
    """Mean reciprocal rank of the first pass on held-out queries."""
    idx, _, truth, _, held_out = _sides(spark, sf_dir)
    return rounded(metrics.mean_measure(stage(ltr.first_pass(idx, held_out), "pairs"), truth, metrics.reciprocal_rank), "mean")


def ltr_rerank(spark, sf_dir):
    """Mean reciprocal rank on held-out queries, before and after re-ranking.

    The regressor is picked by cross-validation over the labelled queries alone.
    """
    idx, units, truth, labelled, held_out = _sides(spark, sf_dir)
    training = stage(ltr.training_data(idx, labelled, truth), "training")
    model = ltr.fit(training, ltr.best_regressor(training)[1])
    retrieved = stage(ltr.first_pass(idx, held_out), "pairs")
    features = ltr.feature_matrix(idx, units, retrieved)
    before = metrics.mean_measure(retrieved, truth, metrics.reciprocal_rank)
    after = metrics.mean_measure(ltr.rerank(model, features), truth, metrics.reciprocal_rank)
    return before.select(F.lit("first_pass").alias("ranking"), F.col("mean").alias("mrr")).union(
        after.select(F.lit("reranked"), "mean")
    )


def ltr_reranked(spark, sf_dir):
    """Documents and last rank of every held-out query after re-ranking: all of the first pass, ranked without gaps."""
    idx, units, truth, labelled, held_out = _sides(spark, sf_dir)
    model = ltr.fit(ltr.training_data(idx, labelled, truth), ltr.regressors()["linear"])
    features = ltr.feature_matrix(idx, units, stage(ltr.first_pass(idx, held_out), "pairs"))
    ranked = ltr.rerank(model, features)
    return ranked.groupBy("query_id").agg(F.count_distinct("doc_id").alias("documents"), F.max("rank").alias("last_rank"))


def tfidf(spark, sf_dir):
    return rounded(textclf.tfidf(c.split_documents(spark, sf_dir)), "weight")


def spam_cells(spark, sf_dir):
    """What the classifier reads: class, side, number of non-zero features and their sum, of every labelled document."""
    docs = c.labelled_documents(spark, sf_dir)
    cells = textclf.tfidf(docs, ENGLISH).groupBy("doc_id").agg(F.count("*").alias("cells"), F.sum("weight").alias("total"))
    every = docs.select("doc_id", "label", "is_train").join(cells, "doc_id", "left").fillna(0, ["cells", "total"])
    return rounded(every, "total")


def spam_eval(spark, sf_dir):
    docs = c.labelled_documents(spark, sf_dir)
    model = textclf.train_exact(docs.filter("is_train"), ENGLISH)
    return metrics.evaluate(textclf.predict_exact(model, docs.filter("not is_train")))


def queries():
    found = {
        "unique_elements": unique_elements,
        "item_occurrences": item_occurrences,
        "word_freq": word_freq,
        "feature_vector": feature_vector,
        "strip_punct": strip_punct,
        "tokens": tokens,
        "query_terms": query_terms,
        "english_tokens": english_tokens,
        "index_postings": index_postings,
        "index_terms": index_terms_of_field,
        "postings_lookup": postings_lookup,
        "term_frequency": term_frequency,
        "field_documents": field_documents,
        "doc_vectors": doc_vectors,
        "term_stats": term_stats,
        "field_lengths": field_lengths,
        "simple": _scored(scorers.simple, ["body"]),
        "bm25": _scored(scorers.bm25, ["body"]),
        "lm_jm": _scored(scorers.lm, ["body"]),
        "bm25f": _scored(scorers.bm25f, TITLE_BODY),
        "mlm": _scored(scorers.mixture_lm, TITLE_BODY),
        "bm25_top": bm25_top,
        "bm25_stored_top": bm25_stored_top,
        "simple_top": _best(lambda idx, units: scorers.simple_model(units), ["body"]),
        "lm_top": _best(_lm_of_body, ["body"]),
        "bm25f_top": _best(scorers.bm25f_model, TITLE_BODY),
        "mlm_top": _best(scorers.lm_model, TITLE_BODY),
        "best_document": _best(_lm_of_body, ["body"], 1),
        "sdm_top": _best(dependence.sdm_model, ["body"], kinds="TOU", of=ranges.best_of_all),
        "fsdm_top": _best(dependence.fsdm_model, c.FIELDS, kinds="TOU", of=ranges.best_of_all),
        "lm_every_document": _every_document(scorers.lm, ["body"]),
        "sdm_every_document": _every_document(dependence.sdm, ["body"], "TOU"),
        "sdm_total": _scored(dependence.sdm, ["body"], "TOU"),
        "sdm_anchored": sdm_anchored,
        "sdm_stored": sdm_stored,
        "bm25_grown_top": bm25_grown_top,
        "stemmed_postings": stemmed_postings,
        "stemmed_bm25": stemmed_bm25,
        "fsdm_total": _scored(dependence.fsdm, c.FIELDS, "TOU"),
        "entity_dict": entity_dict,
        "entity_fields": entity_fields,
        "entity_keys": entity_keys,
        "entity_candidates": entity_candidates,
        "candidate_index": candidate_index,
        "baseline_topk": baseline_topk,
        "collection_lm": collection_lm,
        "term_mapping": term_mapping,
        "prms": prms_scores,
        "prms_topk": prms_topk,
        "prms_top": prms_top,
        "confusion": confusion,
        "evaluate": evaluated,
        "binary_metrics": binary_metrics,
        "qrels_relevant": qrels_relevant,
        "precision_at_k": _measured(metrics.precision_at(10)),
        "average_precision": _measured(metrics.average_precision),
        "reciprocal_rank": _measured(metrics.reciprocal_rank),
        "mean_measure": mean_measure,
        "first_pass": first_pass,
        "ltr_query_feats": ltr_query_feats,
        "ltr_doc_feats": ltr_doc_feats,
        "ltr_pair_feats": ltr_pair_feats,
        "ltr_matrix": ltr_matrix,
        "ltr_training": ltr_training,
        "first_pass_mrr": first_pass_mrr,
        "ltr_rerank": ltr_rerank,
        "ltr_reranked": ltr_reranked,
        "id_split": id_split,
        "tfidf": tfidf,
        "spam_cells": spam_cells,
        "spam_eval": spam_eval,
    }
    for name, kind in KIND.items():
        found[f"sdm_{name}"] = _scored(dependence.sdm, ["body"], kind, kind_weights={kind: 1.0})
        found[f"fsdm_{name}"] = _scored(dependence.fsdm, c.FIELDS, kind, kind_weights={kind: 1.0})
    return found
