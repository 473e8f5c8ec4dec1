"""The inverted index as a table.

One row per (document, unit): `entries(doc_id, lens, kind, unit, tf)`. `tf` is a struct with
the count of the unit in every field and `lens` one with the lengths of the fields, so a
scorer that mixes fields finds all it needs in one row. `kind` is T for single terms, O for
adjacent pairs and U for pairs within a window; the latter two exist only when a scorer
asks for them. Each document also has one row with an empty unit and counts of 0, which
stands for the document itself: document counts and lengths come out of the same pass as
the postings, and the corpus is read and tokenised once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.analysis import Analyzer, index_terms
from termloom.operators.joins import fits_broadcast, lookup_join
from termloom.operators.staging import stage

UNIT = ["kind", "unit"]
#: Entries of a partition of a stored index, about; a unit's hash picks its one.
BUCKET_ENTRIES, LEAST_BUCKETS = 250_000, 16
#: Matches of entries with query units that a task sums, about, and the most parts that documents are dealt to.
TASK_MATCHES, MOST_PARTS = 2_000_000, 20_000


# ---- units -----------------------------------------------------------------------------

def adjacent_pairs(terms: Column) -> Column:
    """'a b' for every two neighbouring terms, in order."""
    return F.zip_with(
        F.slice(terms, F.lit(1), F.greatest(F.size(terms) - 1, F.lit(0))),
        F.slice(terms, F.lit(2), F.greatest(F.size(terms) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )


def unordered(pair: Column) -> Column:
    """'a b' with the smaller term first."""
    words = F.split(pair, " ")
    return F.concat_ws(" ", F.array_min(words), F.array_max(words))


def _units_at(kinds: str, window: int, count_rule: str) -> Column:
    """Units that start at position `pos` of `terms`, as an array of (kind, unit).

    Position 0 holds the empty term of the document's own row, which pairs with nothing.
    With the rule `pairs`, U has one unit for each two positions less than `window` apart.
    With `anchored`, it has 'a b' once per position of a that has b less than `window` away
    on either side; the position itself counts as near.
    """
    term, pos, terms = F.col("term"), F.col("pos"), F.col("terms")

    def unit(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("unit"))

    def after(gap: int) -> Column:
        return F.when(pos > 0, F.get(terms, pos + gap))

    def pair(a: Column, b: Column) -> Column:
        return F.concat(a, F.lit(" "), b)

    found = []
    if "T" in kinds:
        found.append(unit("T", term))
    if "O" in kinds:
        found.append(unit("O", pair(term, after(1))))
    if "U" in kinds and count_rule == "pairs":
        for gap in range(1, window):
            other = after(gap)
            ordered = pair(F.least(term, other), F.greatest(term, other))
            found.append(unit("U", F.when(other.isNotNull(), ordered)))
    units = F.array(*found)
    if "U" in kinds and count_rule == "anchored":
        first = F.greatest(pos - (window - 2), F.lit(2))
        near = F.array_distinct(F.slice(terms, first, F.greatest(pos + window - first + 1, F.lit(0))))
        listed = F.transform(near, lambda other: unit("U", F.concat(term, F.lit(" "), other)))
        units = F.concat(units, F.when(pos > 0, listed).otherwise(F.slice(listed, 1, 0)))
    return units


def _ways(kinds: str, window: int) -> list[tuple[str, Column, Column]]:
    """(kind, first, second) of the pairs that start at position `pos` of `terms`, by the rule `pairs`; null where there is none."""
    term, pos = F.col("term"), F.col("pos")

    def after(gap: int) -> Column:
        return F.when(pos > 0, F.get(F.col("terms"), pos + gap))

    def sorted_pair(other: Column) -> tuple[Column, Column]:
        # least and greatest pass over nulls
        return F.when(other.isNotNull(), F.least(term, other)), F.when(other.isNotNull(), F.greatest(term, other))

    ordered = [("O", term, after(1))] if "O" in kinds else []
    gaps = range(1, window) if "U" in kinds else []
    return ordered + [("U", *sorted_pair(after(gap))) for gap in gaps]


def _key(kind: Column, *words: Column) -> Column:
    return F.xxhash64(kind, *words)


def _wanted_at(occurrences: DataFrame, units: DataFrame, kinds: str, window: int) -> DataFrame:
    """The occurrences of `units(kind, unit)`, which fit a broadcast, by the rule `pairs`, as (doc_id, lens, field, pos, kind, unit).

    Most pairs of a text are in no query. So pairs are looked up by a hash of their words, not written
    out, and only what is found is compared with the unit in full.
    """
    own = F.when(F.col("pos") == 0, "").otherwise("T")
    ways = _ways(kinds, window)
    keys = [_key(own, F.col("term"))] + [F.when(b.isNotNull(), _key(F.lit(kind), a, b)) for kind, a, b in ways]
    at = F.posexplode(F.array(*keys)).alias("way", "key")
    words = F.split("unit", " ")
    singles = units.filter("kind IN ('', 'T')").select(*UNIT, _key(F.col("kind"), F.col("unit")).alias("key"))
    # terms may hold blanks: a unit is listed for every blank that can part its two terms
    blanks = units.filter("kind NOT IN ('', 'T')").filter(F.size(words) > 1).select(
        *UNIT, words.alias("words"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("cut")
    )
    first = F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ")
    second = F.array_join(F.slice("words", F.col("cut") + 1, F.size("words")), " ")
    listed = singles.union(blanks.select(*UNIT, _key(F.col("kind"), first, second).alias("key"))).distinct()
    met = occurrences.select("*", at).join(F.broadcast(listed.filter(F.col("kind").isin(["", *kinds]))), "key")
    spelled = (F.col("way") == 0) & (F.col("kind") == own) & (F.col("unit") == F.col("term"))
    for way, (kind, a, b) in enumerate(ways, 1):
        spelled = spelled | ((F.col("way") == way) & (F.col("kind") == kind) & (F.col("unit") == F.concat(a, F.lit(" "), b)))
    return met.filter(spelled).select("doc_id", "lens", "field", "pos", *UNIT)


def query_units(queries: DataFrame, kinds: str = "T", count_rule: str = "pairs", stems: DataFrame | None = None) -> DataFrame:
    """`queries(query_id, terms)` as (query_id, kind, unit, qf); pairs come from neighbours.

    With `stems(term, stem)` terms are replaced by their stems first.
    """
    if count_rule not in ("pairs", "anchored"):
        raise ValueError("count_rule is 'pairs' or 'anchored'")
    if stems is not None:
        spelled = queries.select("query_id", F.posexplode("terms").alias("pos", "term"))
        found = lookup_join(spelled, stems, ["term"], fits_broadcast(stems), "left", spread_by="query_id")
        in_order = F.sort_array(F.collect_list(F.struct("pos", F.coalesce("stem", "term").alias("term"))))
        queries = found.groupBy("query_id").agg(F.transform(in_order, lambda t: t["term"]).alias("terms"))
    of_kind = {
        "T": lambda t: t,
        "O": adjacent_pairs,
        "U": lambda t: F.transform(adjacent_pairs(t), unordered) if count_rule == "pairs" else adjacent_pairs(t),
    }
    units = F.array(
        *[F.struct(F.lit(k).alias("kind"), of_kind[k](F.col("terms")).alias("units")) for k in kinds]
    )
    return (
        queries.select("query_id", F.explode(units).alias("u"))
        .select("query_id", "u.kind", F.explode("u.units").alias("unit"))
        .groupBy("query_id", "kind", "unit")
        .agg(F.count("*").alias("qf"))
    )


# ---- building --------------------------------------------------------------------------

def analyzed(docs: DataFrame, fields: Sequence[str], analyzer: Analyzer = index_terms) -> DataFrame:
    """Text columns to term arrays, one row per document."""
    return docs.select("doc_id", *[analyzer(F.col(f)).alias(f) for f in fields])


def tokens(doc_terms: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(doc_id, field, pos, term), positions counted after stop words are gone."""
    per_field = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("terms")) for f in fields])
    return doc_terms.select("doc_id", F.explode(per_field).alias("f")).select(
        "doc_id", "f.field", F.posexplode("f.terms").alias("pos", "term")
    )


@dataclass(frozen=True)
class CollectionStats:
    """Totals of a collection: a few numbers per field, whatever its size."""

    n_docs: int
    doc_count: Mapping[str, int]
    total_len: Mapping[str, int]

    def avg_len(self, field: str) -> float:
        return self.total_len[field] / self.n_docs if self.n_docs else 0.0


@dataclass(frozen=True)
class TextIndex:
    entries: DataFrame
    fields: tuple[str, ...]
    small_queries: bool = False

    @property
    def documents(self) -> DataFrame:
        """(doc_id, lens) of every document."""
        return self.entries.filter(F.col("unit") == "").select("doc_id", "lens")

    @property
    def postings(self) -> DataFrame:
        """(field, term, doc_id, tf, dl) of single terms."""
        terms = self.entries.filter(F.col("kind") == "T")
        return self._per_field(terms, F.col("unit").alias("term"), tf="tf", dl="lens").filter("tf > 0").select(
            "field", "term", "doc_id", "tf", "dl"
        )

    @property
    def doc_len(self) -> DataFrame:
        """(doc_id, field, dl), with rows for empty fields."""
        return self._per_field(self.documents, dl="lens")

    def _per_field(self, rows: DataFrame, *extra: Column, **structs: str) -> DataFrame:
        """One row per field from columns that are structs over the fields."""
        cells = [
            F.struct(F.lit(f).alias("field"), *[F.col(c)[f].alias(n) for n, c in structs.items()])
            for f in self.fields
        ]
        return rows.select("doc_id", *extra, F.inline(F.array(*cells)))

    @cached_property
    def unit_stats(self) -> DataFrame:
        """(kind, unit, df, ttf): documents and occurrences per field, as structs.

        Staged, because most scorers need it both for the query's share of the score and
        for the matches.
        """
        counted = self.entries.filter(F.col("unit") != "").groupBy(*UNIT).agg(
            F.struct(*[F.count_if(F.col("tf")[f] > 0).alias(f) for f in self.fields]).alias("df"),
            F.struct(*[F.sum(F.col("tf")[f]).alias(f) for f in self.fields]).alias("ttf"),
        )
        return stage(counted, "unit-stats")

    @property
    def field_stats(self) -> DataFrame:
        """(field, n_docs, doc_count, total_len)."""
        return self.doc_len.groupBy("field").agg(
            F.count("*").alias("n_docs"),
            F.count_if(F.col("dl") > 0).alias("doc_count"),
            F.sum("dl").alias("total_len"),
        )

    @cached_property
    def stats(self) -> CollectionStats:
        """The rows of `field_stats` as numbers for the scoring formulas."""
        rows = {r.field: r for r in self.field_stats.collect()}  # one row per field
        return CollectionStats(
            n_docs=max((r.n_docs for r in rows.values()), default=0),
            doc_count={f: rows[f].doc_count if f in rows else 0 for f in self.fields},
            total_len={f: rows[f].total_len if f in rows else 0 for f in self.fields},
        )


@dataclass(frozen=True)
class StoredIndex(TextIndex):
    """An index read back from its folder, with the statistics that are stored beside it.

    Entries and unit statistics lie in partitions by `bucket`, a hash of the unit.
    """

    stored_documents: DataFrame | None = None
    stored_units: DataFrame | None = None
    stored_fields: DataFrame | None = None
    buckets: int = 1

    @property
    def documents(self) -> DataFrame:
        return self.stored_documents

    @property
    def unit_stats(self) -> DataFrame:
        return self.stored_units

    @property
    def field_stats(self) -> DataFrame:
        return self.stored_fields


def unit_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*UNIT), F.lit(buckets)).cast("int")


def build_index(
    doc_terms: DataFrame,
    fields: Sequence[str],
    kinds: str = "T",
    window: int = 3,
    count_rule: str = "pairs",
    units: DataFrame | None = None,
    staged: bool = True,
    places: bool = False,
    stems: DataFrame | None = None,
) -> TextIndex:
    """Count units per document and field.

    With `places`, entries of single terms also have the terms' positions in every field, as
    a struct of sorted arrays; `positional.paired` counts pairs from those, by any rule.
    With `stems(term, stem)`, entries of terms with one stem are merged under it; `units` are
    then those of stemmed queries.

    The result is staged for the several reads a scorer makes; `staged=False` leaves it
    lazy for plans that read it once.

    Where `doc_terms` lies by `doc_id` (`documents_by_id` of the plans), units are counted where
    their document is, without a further shuffle.

    With `units(query_id, kind, unit, qf)` only the units of those queries are kept. When
    that table fits a broadcast, other occurrences are dropped before the shuffle;
    otherwise units are counted first, which merges repeats map-side, and then joined in
    salted parts.
    """
    if stems is not None and kinds != "T":
        raise ValueError("stems are for single terms; pairs of stems come from positions")
    asked, units = units, units if units is None or stems is None else spellings(units, stems)
    small = units is not None and fits_broadcast(units)
    listed = F.array(
        *[
            F.struct(F.lit(f).alias("field"), F.concat(F.array(F.lit("")), F.col(f)).alias("terms"))
            for f in fields
        ]
    )
    occurrences = (
        doc_terms.select(
            "doc_id",
            F.struct(*[F.size(f).alias(f) for f in fields]).alias("lens"),
            F.inline(listed),
        )
        .select("doc_id", "lens", "field", "terms", F.posexplode("terms").alias("pos", "term"))
    )
    own_kind = F.when(F.col("pos") == 0, "")
    if kinds == "T":
        occurrences = occurrences.select(
            "doc_id", "lens", "field", "pos", F.coalesce(own_kind, F.lit("T")).alias("kind"), F.col("term").alias("unit")
        )
    elif small and count_rule == "pairs":
        occurrences = _wanted_at(occurrences, _wanted(units), kinds, window)
    else:
        # the document's own row is kept by its single-term unit, whatever kinds are asked for
        at = _units_at("T" + kinds.replace("T", ""), window, count_rule)
        occurrences = occurrences.select("doc_id", "lens", "field", "pos", F.inline(at)).select(
            "doc_id", "lens", "field", "pos", F.coalesce(own_kind, F.col("kind")).alias("kind"), "unit"
        ).filter(F.col("unit").isNotNull() & F.col("kind").isin(["", *kinds]))
    if small and (kinds == "T" or count_rule != "pairs"):
        occurrences = lookup_join(occurrences, _wanted(units), UNIT, True, "left_semi")
    in_field = {f: (F.col("field") == f) & (F.col("pos") > 0) for f in fields}
    counted = [F.struct(*[F.count_if(here).alias(f) for f, here in in_field.items()]).alias("tf")]
    if places:
        if kinds != "T":
            raise ValueError("positions are kept for single terms")
        where = [F.sort_array(F.collect_list(F.when(here, F.col("pos")))).alias(f) for f, here in in_field.items()]
        counted.append(F.struct(*where).alias("places"))
    entries = occurrences.groupBy("doc_id", "lens", *UNIT).agg(*counted)
    if units is not None and not small:
        entries = lookup_join(entries, _wanted(units), UNIT, False, "left_semi")
    if stems is not None:
        entries = merged_terms(entries, stems, fields)
        small = asked is not None and fits_broadcast(asked)
    return TextIndex(stage(entries, "index") if staged else entries, tuple(fields), small)


def spellings(units: DataFrame, stems: DataFrame) -> DataFrame:
    """The terms that stand for `units` in texts: themselves, and all terms with such a stem."""
    own = units.select(*UNIT).distinct()
    return own.unionByName(stems.join(own.withColumnRenamed("unit", "stem"), "stem").select("kind", F.col("term").alias("unit"))).distinct()


def merged_terms(entries: DataFrame, stems: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Entries under their terms' stems: counts added, positions put in order.

    A document has an entry per distinct term, so the table meets the vocabulary of each
    document, not its text.
    """
    found = lookup_join(entries, stems.withColumnRenamed("term", "unit"), ["unit"], fits_broadcast(stems), "left")
    counts = [F.struct(*[F.sum(F.col("tf")[f]).alias(f) for f in fields]).alias("tf")]
    if "places" in entries.columns:
        together = [F.sort_array(F.flatten(F.collect_list(F.col("places")[f]))).alias(f) for f in fields]
        counts.append(F.struct(*together).alias("places"))
    return found.withColumn("unit", F.coalesce("stem", "unit")).groupBy("doc_id", "lens", *UNIT).agg(*counts)


def restrict(index: TextIndex, units: DataFrame) -> TextIndex:
    """Cut a full index down to the units of some queries.

    A stored index is read in the partitions of these units only and not written again; an
    index made by a plan is staged, since scorers read it more than once.
    """
    small, wanted = fits_broadcast(units), _wanted(units)
    if not isinstance(index, StoredIndex):
        return TextIndex(stage(lookup_join(index.entries, wanted, UNIT, small, "left_semi"), "index"), index.fields, small)
    # as many numbers as the index has buckets, at most
    asked = [r[0] for r in wanted.select(unit_bucket(index.buckets)).distinct().collect()]

    def cut(rows: DataFrame, spread_by: str) -> DataFrame:
        rows = rows.filter(F.col("bucket").isin(asked)).drop("bucket")
        return lookup_join(rows, wanted, UNIT, small, "left_semi", spread_by=spread_by)

    return replace(index, entries=cut(index.entries, "doc_id"), stored_units=cut(index.stored_units, "unit"), small_queries=small)


def _wanted(units: DataFrame) -> DataFrame:
    """Distinct units, and the empty one of the documents' own rows."""
    own = units.sparkSession.range(1).select(F.lit("").alias("kind"), F.lit("").alias("unit"))
    return units.select(*UNIT).distinct().union(own)


def count_matches(index: TextIndex, units: DataFrame) -> int:
    """Entries of all units of `units(query_id, kind, unit, ...)`, counted per query."""
    df = index.unit_stats.select(*UNIT, F.greatest(*[F.col("df")[f] for f in index.fields], F.lit(0)).alias("met"))
    met = lookup_join(units.select("query_id", *UNIT), df, UNIT, index.small_queries, spread_by="query_id")
    return met.agg(F.sum("met")).first()[0] or 0


def dealt(entries: DataFrame, matches: int, by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Entries by document, in as many parts as keep a task's share of `matches` with the queries in memory.

    The number is given, so that adaptive execution doesn't put parts together by the size of the
    entries: an entry meets many queries.
    """
    cores = entries.sparkSession.sparkContext.defaultParallelism
    return entries.repartition(min(max(cores, -(-matches // TASK_MATCHES)), MOST_PARTS), *by)


def document_lengths(doc_terms: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(doc_id, lens) straight from the analysed documents."""
    return doc_terms.select("doc_id", F.struct(*[F.size(f).alias(f) for f in fields]).alias("lens"))


def field_lengths(doc_terms: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, n_docs, doc_count, total_len, avg_len); the average is over all documents.

    Lengths need no term counts, so this is one pass without an index.
    """
    cells = [F.struct(F.lit(f).alias("field"), F.size(f).alias("dl")) for f in fields]
    return doc_terms.select(F.inline(F.array(*cells))).groupBy("field").agg(
        F.count("*").alias("n_docs"),
        F.count_if(F.col("dl") > 0).alias("doc_count"),
        F.sum("dl").alias("total_len"),
        F.avg("dl").alias("avg_len"),
    )


# ---- look-ups --------------------------------------------------------------------------

def field_documents(doc_terms: DataFrame, field: str) -> DataFrame:
    """(doc_id, terms) of the documents that have the field."""
    return doc_terms.filter(F.size(field) > 0).select("doc_id", F.col(field).alias("terms"))


def field_terms(postings: DataFrame, field: str) -> DataFrame:
    return postings.filter(F.col("field") == field).select("term").distinct()


def term_postings(postings: DataFrame, field: str, term: str) -> DataFrame:
    return postings.filter((F.col("field") == field) & (F.col("term") == term)).select("doc_id", "tf")


def term_frequency(postings: DataFrame, field: str, term: str, doc_id) -> DataFrame:
    """One row; 0 when the document lacks the term."""
    return term_postings(postings, field, term).filter(F.col("doc_id") == doc_id).agg(
        F.coalesce(F.sum("tf"), F.lit(0)).alias("tf")
    )


def doc_vectors(postings: DataFrame, field: str) -> DataFrame:
    """(doc_id, term, tf) of one field; documents with an empty field have no rows."""
    return postings.filter(F.col("field") == field).select("doc_id", "term", "tf")


def term_stats(postings: DataFrame) -> DataFrame:
    """(field, term, df, ttf)."""
    return postings.groupBy("field", "term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("ttf")
    )


def seen_terms(queries: DataFrame, postings: DataFrame, field: str) -> DataFrame:
    """(query_id, qpos, term) of the query terms some document has in `field`; repeats stay."""
    terms = queries.select("query_id", F.posexplode("terms").alias("qpos", "term"))
    return terms.join(field_terms(postings, field), "term", "left_semi").select("query_id", "qpos", "term")
