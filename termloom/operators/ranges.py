"""Exact best documents without scoring every match.

A score here is a part that depends on the query and the document's lengths only, plus a gain
per matching unit that is never negative:

    score(q, d) = rest(q, lengths of d) + sum over units u of weight(q, u) * gain(u, d)

Documents are dealt to ranges of similar length. The largest gain of each unit in each range,
and the shortest lengths there, bound the score of every document of a range. The ranges with
the highest bounds are scored first; the k-th score found is a threshold, and a range whose bound
is below it never meets the query again. All entries of a document lie in one range, so scores
add up where the range's entries lie: what is moved is entries, not matching pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.operators.index import UNIT, TextIndex, count_matches, dealt
from termloom.operators.joins import fits_broadcast, lookup_join, top_k
from termloom.operators.staging import stage

#: Documents of a range, about.
RANGE_DOCS = 64
#: Ranges that are scored first, per query.
FIRST_RANGES = 4
#: Scores are told apart from here on: they are rounded to six decimals before ties are broken.
SLACK = 2e-6
#: With fewer entries to look at than this, every match is scored.
DIRECT_PAIRS = 20_000_000
#: The same where all queries fit a broadcast, so that entries are moved once and no pairs: bounds, a row per
#: unit, range and query, are themselves more than the entries.
DIRECT_BROADCAST = 100_000_000_000
#: Lengths up to here have a cell of their own; the next cells follow without a gap.
EXACT, WIDE = 8, 3
#: Blocks in which queries meet the shortest documents.
PARTS = 8

Lengths = Callable[[str], Column]


@dataclass(frozen=True)
class Model:
    """What a scorer needs of units, queries and documents.

    `units(query_id, kind, unit, weight, ...)` has the unit's own columns besides; `gain` is
    made of those and the entry's `tf` and `lens`. `queries(query_id, active, ...)` has what
    `rest` reads, a function from lengths by field to a column that falls as the lengths of
    the fields in the array `active` grow, and depends on no others; without it the rest is 0.
    `scores` gives all matches' scores where there is a faster way than `gain` and `rest`.
    """

    fields: Sequence[str]
    units: DataFrame
    gain: Column
    queries: DataFrame | None = None
    rest: Callable[[Lengths], Column] | None = None
    scores: Callable[[], DataFrame] | None = None

    def unit_columns(self) -> list[str]:
        return [c for c in self.units.columns if c not in ("query_id", "weight")]


def range_of(fields: Sequence[str], n_docs: int) -> Column:
    """A document's range: the power of two of its length, and a hash that deals equal ones out."""
    parts = max(1, -(-n_docs // (4 * RANGE_DOCS)))
    length = sum([F.col("lens")[f] for f in fields[1:]], F.col("lens")[fields[0]])
    size = F.floor(F.log2(length + 1.0)).cast("long")
    return F.pmod(F.xxhash64("doc_id"), F.lit(parts)) * 64 + size


def gained(index: TextIndex, model: Model) -> DataFrame:
    """(range, doc_id, lens, kind, unit, gain) of the entries of any query's units; gains don't depend on the query."""
    here = sum([F.col("tf")[f] for f in model.fields[1:]], F.col("tf")[model.fields[0]]) > 0
    known = model.units.select(*model.unit_columns()).distinct()
    entries = lookup_join(index.entries.filter(here), known, UNIT, index.small_queries)
    return entries.select(range_of(model.fields, index.stats.n_docs).alias("range"), "doc_id", "lens", *UNIT, model.gain.alias("gain"))


def bounds(index: TextIndex, model: Model) -> DataFrame:
    """(query_id, range, kind, unit, weight, most, shortest): the units of each query in each range, with their largest gain."""
    shortest = F.struct(*[F.min(F.col("lens")[f]).alias(f) for f in model.fields])
    per_unit = gained(index, model).groupBy("range", *UNIT).agg(F.max("gain").alias("most"), shortest.alias("shortest"))
    asked = model.units.select("query_id", *UNIT, "weight")
    return lookup_join(per_unit, asked, UNIT, index.small_queries, spread_by="range")


def with_rest(model: Model, rows: DataFrame, lengths: str, spread_by: str) -> DataFrame:
    """`rows(query_id, gains, ...)` with the column `score`: the rest at the lengths in `lengths`, and the gains."""
    if model.rest is None:
        return rows.withColumn("score", F.col("gains"))
    joined = lookup_join(rows, model.queries, ["query_id"], fits_broadcast(model.queries), spread_by=spread_by)
    return joined.withColumn("score", model.rest(lambda f: F.col(lengths)[f]) + F.col("gains"))


def score_ranges(index: TextIndex, model: Model, asked: DataFrame) -> DataFrame:
    """(query_id, doc_id, score) of the matching documents in the ranges of `asked(query_id, range, kind, unit, weight)`.

    While `asked` fits a broadcast, entries are dealt by range and sums need no further
    exchange; otherwise both meet by range and unit.
    """
    entries = gained(index, model)
    if fits_broadcast(asked):
        needed = asked.select("range").distinct()
        dealt = entries.join(F.broadcast(needed), "range", "left_semi").repartition("range")
        met = dealt.join(F.broadcast(asked), ["range", *UNIT])
    else:
        met = entries.join(asked, ["range", *UNIT])
    sums = met.groupBy("range", "query_id", "doc_id", "lens").agg(F.sum(F.col("weight") * F.col("gain")).alias("gains"))
    return with_rest(model, sums, "lens", "doc_id").select("query_id", "doc_id", "score")


@dataclass(frozen=True)
class Plan:
    """The ranges of each query: scored first, needed besides, and all of them, with the first scores."""

    first: DataFrame
    needed: DataFrame
    every: DataFrame
    scores: DataFrame


def plan_ranges(index: TextIndex, model: Model, k: int) -> Plan:
    """Score the most promising ranges, and pick those that may hold one of the best `k` besides."""
    units_in = stage(bounds(index, model), "bounds")
    shortest = F.struct(*[F.min(F.col("shortest")[f]).alias(f) for f in model.fields])
    summed = units_in.groupBy("query_id", "range").agg(
        F.sum(F.col("weight") * F.col("most")).alias("gains"), shortest.alias("shortest")
    )
    bound = with_rest(model, summed, "shortest", "range").select("query_id", "range", F.col("score").alias("bound"))
    promising = Window.partitionBy("query_id").orderBy(F.desc("bound"), "range")
    every = stage(bound.withColumn("place", F.row_number().over(promising)), "ranges")
    first = every.filter(F.col("place") <= FIRST_RANGES)

    def units_of(ranges: DataFrame) -> DataFrame:
        chosen = ranges.select("query_id", "range")
        small = fits_broadcast(chosen)
        return units_in.join(F.broadcast(chosen) if small else chosen, ["query_id", "range"]).select("query_id", "range", *UNIT, "weight")

    scores = stage(score_ranges(index, model, units_of(first)), "first-scores")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = scores.withColumn("n", F.row_number().over(best)).filter(F.col("n") == k).select("query_id", F.col("score").alias("least"))
    small = fits_broadcast(kth)
    rest = every.filter(F.col("place") > FIRST_RANGES).join(F.broadcast(kth) if small else kth, "query_id", "left")
    needed = rest.filter(F.col("least").isNull() | (F.col("bound") >= F.col("least") - SLACK))
    return Plan(first, stage(units_of(needed), "needed"), every, scores)


def all_scores(index: TextIndex, model: Model) -> DataFrame:
    """(query_id, doc_id, score) of every matching document.

    Entries of a document are brought together before they meet the queries, so what is moved
    is entries, not pairs; queries too large for a broadcast meet them by unit.
    """
    here = sum([F.col("tf")[f] for f in model.fields[1:]], F.col("tf")[model.fields[0]]) > 0
    entries = index.entries.filter(here)
    entries = dealt(entries, pairs_to_score(index, model)) if index.small_queries else entries
    met = lookup_join(entries, model.units, UNIT, index.small_queries)
    sums = met.groupBy("query_id", "doc_id", "lens").agg(F.sum(F.col("weight") * model.gain).alias("gains"))
    return with_rest(model, sums, "lens", "doc_id").select("query_id", "doc_id", "score")


def pairs_to_score(index: TextIndex, model: Model) -> int:
    """Entries of all queries' units, counted per query."""
    return count_matches(index, model.units)


def best_matches(index: TextIndex, model: Model, k: int, direct: int | None = None) -> DataFrame:
    """The best `k` matching documents per query, as `top_k` of all their scores would give them.

    Up to `direct` entries to look at, bounds cost more than they save and all are scored.
    """
    if direct is None:
        direct = DIRECT_BROADCAST if index.small_queries else DIRECT_PAIRS
    if pairs_to_score(index, model) <= direct:
        return top_k(model.scores() if model.scores else all_scores(index, model), k)
    plan = plan_ranges(index, model, k)
    return top_k(plan.scores.union(score_ranges(index, model, plan.needed)), k)


# ---- documents without a match ---------------------------------------------------------

def shortest_documents(documents: DataFrame, fields: Sequence[str], k: int) -> DataFrame:
    """(doc_id, lens) of the documents that can be among the best `k` of a query without matching it.

    The scores meant fall as the length of any of `fields` grows, and depend on nothing else.
    So a document goes when `k` others are as short in every field: shorter in one, or as long
    with a larger id. Lengths are cut into cells, of one length up to `EXACT` and then four to
    a power of two; a cell goes as a whole when the cells below it have `k` documents.
    """
    lens = {f: F.col("lens")[f] for f in fields}
    wide = {f: F.floor(4 * F.log2(n.cast("double"))) for f, n in lens.items()}
    cells = F.struct(*[F.when(lens[f] <= EXACT, lens[f]).otherwise(wide[f] - WIDE).cast("int").alias(f) for f in fields])
    placed = documents.select("doc_id", "lens", F.struct(*[lens[f].alias(f) for f in fields]).alias("own"), cells.alias("cell"))
    # cells are a grid over the logarithms of lengths: their number does not grow with the documents
    counts = {tuple(r.cell): r["count"] for r in placed.groupBy("cell").count().collect()}
    low_first = sorted(counts, key=sum)
    kept = [(c,) for c in counts if _below(low_first, counts, c, k) < k]
    wanted = documents.sparkSession.createDataFrame(kept, placed.select("cell").schema)
    largest = Window.partitionBy("own").orderBy(F.desc("doc_id"))
    near = placed.join(F.broadcast(wanted), "cell", "left_semi")
    return near.withColumn("n", F.row_number().over(largest)).filter(F.col("n") <= k).select("doc_id", "lens")


def _below(low_first: Sequence[tuple], counts: dict[tuple, int], cell: tuple, k: int) -> int:
    """Documents in other cells that are as short as any of `cell` in every field; counting ends at `k`."""
    found = 0
    for other in low_first:
        if other != cell and all(a < b or (a == b and b <= EXACT) for a, b in zip(other, cell)):
            found += counts[other]
            if found >= k:
                break
    return found


def best_of_all(index: TextIndex, model: Model, k: int, direct: int | None = None) -> DataFrame:
    """The best `k` per query of ALL documents, whether they match or not; for queries with a unit the collection has.

    A document without a match scores the rest alone, which `active` lengths decide: the
    fields that hold any of the query's units. Candidates are the shortest documents in these
    fields. One that does match counts with its whole score among the best matches, or `k`
    others beat it.
    """
    matched = best_matches(index, model, k, direct).select("query_id", "doc_id", "score")
    queries = stage(model.queries.withColumn("fields", F.array_join("active", " ")), "rests")
    found = matched
    # as many sets as the fields have subsets, at most
    for (fields,) in queries.select("fields").distinct().collect():
        short = stage(shortest_documents(index.documents, fields.split(" "), k), "shortest")
        part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int")
        asked = queries.filter(F.col("fields") == fields).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        pairs = short.withColumn("part", part).join(asked, "part")
        alone = pairs.select("query_id", "doc_id", model.rest(lambda f: F.col("lens")[f]).alias("score"))
        found = found.union(top_k(alone, k).select("query_id", "doc_id", "score"))
    return top_k(found.groupBy("query_id", "doc_id").agg(F.max("score").alias("score")), k)
