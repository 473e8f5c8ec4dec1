"""Probabilistic field mapping: field weights chosen per term from the collection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.operators.dependence import MU, dirichlet_mixture, mixture_model
from termloom.operators.index import UNIT, TextIndex
from termloom.operators.joins import top_k
from termloom.operators.ranges import Model
from termloom.operators.scorers import background, search, total, unit_statistics
from termloom.operators.staging import stage

# The fields of an entity document and the depth of the first pass.
ENTITY_FIELDS = ["names", "description", "attributes", "related_entities", "types", "catch_all"]
DEPTH = 200


def collection_lm(index: TextIndex, units: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """(field, term, p) of every query term and field, 0 where the field lacks the term."""
    fields = list(fields or index.fields)
    terms = units.filter(F.col("kind") == "T").select(*UNIT).distinct()
    zero = F.struct(*[F.lit(0).cast("long").alias(f) for f in index.fields])
    counted = terms.join(index.unit_stats, UNIT, "left").withColumn("ttf", F.coalesce("ttf", zero))
    cells = [F.struct(F.lit(f).alias("field"), background(index, f).alias("p")) for f in fields]
    return counted.select(F.col("unit").alias("term"), F.inline(F.array(*cells))).select("field", "term", "p")


def term_mapping(lm: DataFrame) -> DataFrame:
    """(field, term, p_field): each field's share of the term's probability; 0/0 is NULL."""
    totals = lm.groupBy("term").agg(F.sum("p").alias("total"))
    return lm.join(totals, "term").select(
        "field", "term", F.try_divide("p", "total").alias("p_field")
    )


def prms(
    index: TextIndex,
    units: DataFrame,
    fields: Sequence[str] = ENTITY_FIELDS,
    mu: float = MU,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Query log likelihood with mapped field weights; terms unseen in every field add 0."""
    return dirichlet_mixture(index, _mapped_units(index, units, fields), list(fields), mu, pairs)


def prms_model(index: TextIndex, units: DataFrame, fields: Sequence[str] = ENTITY_FIELDS, mu: float = MU) -> Model:
    """`prms` for the exact top k."""
    return mixture_model(index, _mapped_units(index, units, fields), list(fields), mu)


def _mapped_units(index: TextIndex, units: DataFrame, fields: Sequence[str]) -> DataFrame:
    p = {f: background(index, f) for f in fields}
    every = total(list(p.values()))
    return unit_statistics(index, units).select(
        "query_id", *UNIT,
        F.col("qf").cast("double").alias("w"),
        F.struct(*[F.try_divide(p[f], every).alias(f) for f in fields]).alias("w_f"),
        F.struct(*[p[f].alias(f) for f in fields]).alias("p"),
    )


def prms_search(
    index: TextIndex,
    units: DataFrame,
    fields: Sequence[str] = ENTITY_FIELDS,
    k: int = DEPTH,
    mu: float = MU,
) -> DataFrame:
    """Best `k` documents by first-pass search in `catch_all`, re-ranked by `prms`."""
    candidates = stage(search(index, units, ["catch_all"], k), "candidates")
    return top_k(prms(index, units, fields, mu, candidates), k)
