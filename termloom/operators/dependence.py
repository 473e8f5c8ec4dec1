"""Sequential-dependence models: single terms, ordered pairs and pairs in a window.

All three are Dirichlet-smoothed counts of units, so one index with the kinds T, O and U
serves them in one pass. `kind_weights` picks the parts: {"T": 1.0} is the unigram score
alone, `SDM_WEIGHTS` the whole model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.index import UNIT, TextIndex, count_matches, dealt
from termloom.operators.joins import lookup_join
from termloom.operators.ranges import Model
from termloom.operators.scorers import PAIR, background, matches, total, unit_statistics
from termloom.operators.staging import stage

# Weights of the three parts, smoothing, window and field weights.
SDM_WEIGHTS = {"T": 0.85, "O": 0.1, "U": 0.05}
MU = 100.0
FSDM_FIELD_WEIGHTS = {"title": 0.2, "body": 0.7, "anchors": 0.1}
#: Documents of the same lengths go to as many parts; backgrounds by lengths pay from so many matches per background on.
LENGTH_PARTS, LENGTH_GAIN = 8, 8


def check_weights(weights: Mapping[str, float]) -> None:
    if abs(sum(weights.values()) - 1) > 1e-9:
        raise ValueError("feature weights should sum to 1")


def _by_kind(weights: Mapping[str, float]) -> Column:
    chosen = F.lit(0.0)
    for kind, weight in weights.items():
        chosen = F.when(F.col("kind") == kind, F.lit(float(weight))).otherwise(chosen)
    return chosen


def sdm(
    index: TextIndex,
    units: DataFrame,
    field: str = "body",
    kind_weights: Mapping[str, float] | None = None,
    mu: float = MU,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Single-field model.

    ln((c + mu p)/(dl + mu)) = ln(mu p) - ln(dl + mu) + ln(1 + c/(mu p)): the first part is
    one number per query, the second needs the document's length only, and just the third
    touches matching units. Units the collection lacks are left out of all three.
    """
    model = sdm_model(index, units, field, kind_weights, mu)
    scored = _gains(index, matches(index, model.units, [field], pairs), F.col("weight") * model.gain, pairs)
    with_base = lookup_join(scored, model.queries, ["query_id"], index.small_queries, "left").fillna(0.0, ["base", "mass"])
    return with_base.select(*PAIR, (model.rest(lambda f: F.col("lens")[f]) + F.col("gain")).alias("score"))


def sdm_model(
    index: TextIndex, units: DataFrame, field: str = "body", kind_weights: Mapping[str, float] | None = None, mu: float = MU
) -> Model:
    """`sdm` in parts, also for the exact top k."""
    kind_weights = kind_weights or SDM_WEIGHTS
    check_weights(kind_weights)
    stats = (
        unit_statistics(index, units.filter(F.col("kind").isin(list(kind_weights))))
        .select(
            "query_id", *UNIT,
            (_by_kind(kind_weights) * F.col("qf")).alias("weight"),
            (mu * background(index, field)).alias("bg"),
        )
        .filter("bg > 0")
    )
    base = stats.groupBy("query_id").agg(
        F.sum(F.col("weight") * F.log("bg")).alias("base"), F.sum("weight").alias("mass"), F.array(F.lit(field)).alias("active")
    )

    def rest(lengths) -> Column:
        return F.col("base") - F.col("mass") * F.log(lengths(field) + F.lit(mu))

    return Model([field], stats, F.log1p(F.col("tf")[field] / F.col("bg")), base, rest)


def _gains(index: TextIndex, rows: DataFrame, gain: Column, pairs: DataFrame | None) -> DataFrame:
    """(query_id, doc_id, lens, gain) of the matching documents, or of the listed pairs."""
    gains = rows.groupBy(*PAIR, "lens").agg(F.sum(gain).alias("gain"))
    if pairs is None:
        return gains
    listed = pairs.select(*PAIR).join(index.documents, "doc_id")
    return listed.join(gains.drop("lens"), PAIR, "left").fillna(0.0, ["gain"])


def fsdm(
    index: TextIndex,
    units: DataFrame,
    field_weights: Mapping[str, float] | None = None,
    kind_weights: Mapping[str, float] | None = None,
    mu: float = MU,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Fielded model: each unit's probability is a weighted sum over the fields."""
    fields = list(field_weights or FSDM_FIELD_WEIGHTS)
    return dirichlet_mixture(index, _fsdm_units(index, units, field_weights, kind_weights), fields, mu, pairs)


def fsdm_model(
    index: TextIndex,
    units: DataFrame,
    field_weights: Mapping[str, float] | None = None,
    kind_weights: Mapping[str, float] | None = None,
    mu: float = MU,
) -> Model:
    """`fsdm` for the exact top k."""
    stats, fields = _fsdm_units(index, units, field_weights, kind_weights), list(field_weights or FSDM_FIELD_WEIGHTS)
    return mixture_model(index, stats, fields, mu)


def _fsdm_units(
    index: TextIndex, units: DataFrame, field_weights: Mapping[str, float] | None, kind_weights: Mapping[str, float] | None
) -> DataFrame:
    field_weights, kind_weights = field_weights or FSDM_FIELD_WEIGHTS, kind_weights or SDM_WEIGHTS
    check_weights(kind_weights)
    fields = list(field_weights)
    return unit_statistics(index, units.filter(F.col("kind").isin(list(kind_weights)))).select(
        "query_id", *UNIT,
        (_by_kind(kind_weights) * F.col("qf")).alias("w"),
        F.struct(*[F.lit(float(field_weights[f])).alias(f) for f in fields]).alias("w_f"),
        F.struct(*[background(index, f).alias(f) for f in fields]).alias("p"),
    )


def with_prior(stats: DataFrame, fields: Sequence[str], mu: float) -> DataFrame:
    """Units that some field has, with mu * w_f * p_f by field as `prior`."""
    prior = F.struct(*[(mu * F.col("w_f")[f] * F.col("p")[f]).alias(f) for f in fields])
    return stats.filter(total([F.col("w_f")[f] * F.col("p")[f] for f in fields]) > 0).withColumn("prior", prior)


def mixture_model(index: TextIndex, stats: DataFrame, fields: Sequence[str], mu: float) -> Model:
    """`dirichlet_mixture` for the exact top k: a query carries its units' weights and priors in one row.

    Where all matches are scored, a row per unit in generated code is twice as fast as summing that row's array.
    """
    seen = with_prior(stats, fields, mu)

    def unmatched(prior: Column, length) -> Column:
        return total([prior[f] / (length(f) + mu) for f in fields])

    def rest(lengths) -> Column:
        return F.aggregate("terms", F.lit(0.0), lambda s, t: s + t["w"] * F.log(unmatched(t["prior"], lengths)))

    queries = seen.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("w", "prior"))).alias("terms"),
        F.array_compact(F.array(*[F.when(F.max(F.col("prior")[f]) > 0, F.lit(f)) for f in fields])).alias("active"),
    )
    own = total([F.col("w_f")[f] * F.col("tf")[f] / (F.col("lens")[f] + mu) for f in fields])
    gain = F.log1p(own / unmatched(F.col("prior"), lambda f: F.col("lens")[f]))
    units = seen.select("query_id", *UNIT, F.col("w").alias("weight"), "w_f", "prior")
    return Model(list(fields), units, gain, queries, rest, lambda: dirichlet_mixture(index, stats, fields, mu))


def dirichlet_mixture(
    index: TextIndex,
    stats: DataFrame,
    fields: Sequence[str],
    mu: float,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Sum over units of w * ln(sum_f w_f (tf_f + mu p_f)/(dl_f + mu)).

    `stats(query_id, kind, unit, w, w_f, p)`. The background of a unit depends on the
    lengths of all fields, so it is computed for each scored document and each unit of its
    query; the counts only enter through the gain of matching units. Units unseen in every
    field are left out.
    """
    seen = with_prior(stats, fields, mu)

    def unmatched(prior: Column) -> Column:
        return total([prior[f] / (F.col("lens")[f] + mu) for f in fields])

    own = total([F.col("w_f")[f] * F.col("tf")[f] / (F.col("lens")[f] + mu) for f in fields])
    gain = F.col("w") * F.log1p(own / unmatched(F.col("prior")))
    if pairs is None and index.small_queries:
        lengths = stage(index.documents.select("lens").distinct(), "lengths")
        met = count_matches(index, seen)
        if lengths.count() * seen.select("query_id").distinct().count() * LENGTH_GAIN <= met:
            return _scored_by_lengths(index, seen, fields, lengths, met, gain, F.col("w") * F.log(unmatched(F.col("prior"))))
    rows = matches(index, seen.drop("p"), fields, pairs)
    scored = _gains(index, rows, gain, pairs)
    # One row per scored document and unit of its query, summed again at once: the rows are
    # still grouped by (query, document), so this needs no further shuffle.
    units = seen.select("query_id", "w", "prior")
    spelled = lookup_join(scored, units, ["query_id"], index.small_queries, "left")
    base = F.sum(F.col("w") * F.log(unmatched(F.col("prior"))))
    return (
        spelled.groupBy(*PAIR, "lens")
        .agg(F.coalesce(base, F.lit(0.0)).alias("base"), F.first("gain").alias("gain"))
        .select(*PAIR, (F.col("base") + F.col("gain")).alias("score"))
    )


def _scored_by_lengths(
    index: TextIndex, seen: DataFrame, fields: Sequence[str], lengths: DataFrame, met: int, gain: Column, unmatched: Column
) -> DataFrame:
    """`dirichlet_mixture` of all matches where many documents share their lengths: backgrounds once per query and lengths.

    Entries are dealt by their documents' lengths, and so are the backgrounds, an array over the
    queries per lengths; they meet in the task that sums a document's gains. A query without an id
    has the gains alone, as where backgrounds are joined by id.
    """
    # queries fit a broadcast, so a task can number them
    units = stage(seen.drop("p").withColumn("number", F.dense_rank().over(Window.orderBy("query_id")) - 1), "units")
    by_query = (
        lengths.repartition("lens").crossJoin(F.broadcast(units.select("number", "w", "prior")))
        .groupBy("lens", "number").agg(F.sum(unmatched).alias("base"))
    )
    listed = F.transform(F.sort_array(F.collect_list(F.struct("number", "base"))), lambda b: b["base"])
    bases = stage(by_query.groupBy("lens").agg(listed.alias("bases")), "bases")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(LENGTH_PARTS)).cast("int")
    by = ("lens", "part")
    here = total([F.col("tf")[f] for f in fields]) > 0
    entries = dealt(index.entries.filter(here).withColumn("part", part), met, by)
    scored = lookup_join(entries, units, UNIT, True).groupBy("query_id", "number", "doc_id", *by).agg(F.sum(gain).alias("gain"))
    every = bases.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(LENGTH_PARTS - 1))))
    found = scored.join(dealt(every, met, by).hint("shuffle_hash"), list(by))
    base = F.when(F.col("query_id").isNotNull(), F.get("bases", F.col("number"))).otherwise(0.0)
    return found.select(*PAIR, (base + F.col("gain")).alias("score"))
