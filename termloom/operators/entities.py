"""Entities from triples: grouped values, fielded documents, candidates.

Triples are (subject, predicate, object, object_type) with object_type "literal" or "uri".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.analysis import Analyzer, english_terms, resolve_uri
from termloom.operators.index import UNIT, TextIndex, _wanted, merged_terms, spellings
from termloom.operators.joins import fits_broadcast, lookup_join, positions
from termloom.operators.prms import ENTITY_FIELDS
from termloom.operators.staging import stage

# The predicates that are folded into a field of their own.
TYPE_PREDICATE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
NAME_PREDICATES = [
    "http://www.w3.org/2000/01/rdf-schema#label",
    "http://xmlns.com/foaf/0.1/name",
    "http://xmlns.com/foaf/0.1/givenName",
    "http://xmlns.com/foaf/0.1/surname",
]
TYPE_PREDICATES = [TYPE_PREDICATE, "http://purl.org/dc/terms/subject"]
COMMENT_PREDICATE = "http://www.w3.org/2000/01/rdf-schema#comment"

# Fixed value: the type of the entities that are indexed by default.
MUSICAL_ARTIST = "http://dbpedia.org/ontology/MusicalArtist"


def entity_values(triples: DataFrame) -> DataFrame:
    """(subject, predicate, pos, object, is_single): the objects of a predicate, numbered in order.

    `is_single` marks a predicate with one value. A row is a value, so no predicate has more
    values than a row can hold.
    """
    keys = ["subject", "predicate"]
    numbered = positions(triples.select(*keys, "object"), keys, ["object"])
    several = numbered.filter(F.col("pos") == 2).select(*keys, F.lit(False).alias("single"))
    return numbered.join(several, keys, "left").select(
        *keys, "pos", "object", F.coalesce("single", F.lit(True)).alias("is_single")
    )


def has_type(triples: DataFrame, target: str) -> DataFrame:
    """Distinct subjects with `target` among their types."""
    return _typed(triples, target).distinct()


def _typed(triples: DataFrame, target: str) -> DataFrame:
    return triples.filter(
        (F.col("predicate") == TYPE_PREDICATE) & (F.col("object") == target)
    ).select("subject")


def of_type(triples: DataFrame, target: str) -> DataFrame:
    """Triples of the subjects that have the type.

    Both sides enter the join straight from their shuffle, so adaptive execution can split
    a subject that owns a large share of the triples. The subjects are never broadcast: packed
    files of a few MB hold more of them than the driver does.
    """
    return triples.join(_typed(triples, target).hint("merge"), "subject", "left_semi")


def folded(triples: DataFrame) -> DataFrame:
    """(entity_id, field, predicate, object): one field per triple, URIs as readable labels.

    The first rule that fits decides: name, comment, type, literal, other entity.
    """
    literal = F.col("object_type") == "literal"
    field: Column = (
        F.when(F.col("predicate").isin(NAME_PREDICATES), "names")
        .when(F.col("predicate") == COMMENT_PREDICATE, "description")
        .when(F.col("predicate").isin(TYPE_PREDICATES), "types")
        .when(literal, "attributes")
        .otherwise("related_entities")
    )
    return triples.select(
        F.col("subject").alias("entity_id"),
        field.alias("field"),
        "predicate",
        F.when(literal, F.col("object")).otherwise(resolve_uri(F.col("object"))).alias("object"),
    )


def entity_documents(triples: DataFrame, target: str = MUSICAL_ARTIST) -> DataFrame:
    """(entity_id, field, pos, value): the values of every field, in (predicate, object) order.

    Each value is in its own field and in `catch_all`. A field's text is its values joined
    by blanks in the order of `pos`; it is not put together here, as an entity may have more
    values than a row can hold.
    """
    values = folded(of_type(triples, target)).select(
        "entity_id", F.explode(F.array("field", F.lit("catch_all"))).alias("field"), "predicate", F.col("object").alias("value")
    )
    return positions(values, ["entity_id", "field"], ["predicate", "value"]).select("entity_id", "field", "pos", "value")


def about(triples: DataFrame, subjects: DataFrame) -> DataFrame:
    """The triples about one of `subjects(subject)`.

    A bitmap of the subjects' hashes, ten bits each, cuts the triples where they are read;
    what passes it, one in ten of the others at most, meets the subjects themselves.
    """
    wanted = stage(subjects.select("subject").distinct(), "subjects")
    bits = max(1, 10 * wanted.count())

    def place(subject: Column) -> Column:
        return F.pmod(F.xxhash64(subject), F.lit(bits))

    bitmap = (
        wanted.select(place(F.col("subject")).alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    small = fits_broadcast(bitmap)
    marked = triples.withColumn("place", place(F.col("subject"))).withColumn("bucket", F.bitmap_bucket_number("place"))
    met = lookup_join(marked, bitmap, ["bucket"], small, spread_by="subject")
    bit = F.bitmap_bit_position("place")
    octet = F.conv(F.hex(F.substr("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    passed = met.filter(F.getbit(octet, (bit % 8).cast("int")) == 1).select(*triples.columns)
    return lookup_join(passed, wanted, ["subject"], fits_broadcast(wanted), "left_semi", spread_by="object")


def entity_index(
    triples: DataFrame,
    units: DataFrame,
    target: str = MUSICAL_ARTIST,
    analyzer: Analyzer = english_terms,
    stems: DataFrame | None = None,
    subjects: DataFrame | None = None,
) -> TextIndex:
    """Index of the fielded entities, straight from the triples; with `subjects(subject)` of those entities only.

    With `stems(term, stem)`, terms with one stem count as one; `units` are then those of stemmed queries.

    Terms are counted per triple and summed per entity, so no entity's text is ever put
    together; each value counts for its own field and for `catch_all`. Every value also
    adds its length under the empty unit, so counts and lengths come out of one pass.
    """
    triples = triples if subjects is None else about(triples, subjects)
    values = folded(of_type(triples, target)).select(
        F.col("entity_id").alias("doc_id"), "field", analyzer(F.col("object")).alias("terms")
    )
    length = F.struct(F.lit("").alias("kind"), F.lit("").alias("unit"), F.size("terms").alias("n"))
    words = F.transform(
        "terms", lambda t: F.struct(F.lit("T").alias("kind"), t.alias("unit"), F.lit(1).alias("n"))
    )
    counted = values.select("doc_id", "field", F.inline(F.concat(F.array(length), words)))
    asked = units if stems is None else spellings(units, stems)
    small = fits_broadcast(asked)
    if small:
        counted = lookup_join(counted, _wanted(asked), UNIT, True, "left_semi")
    counts = [
        F.coalesce(F.sum(F.when(F.col("field") == f, F.col("n"))), F.lit(0)).alias(f)
        for f in ENTITY_FIELDS if f != "catch_all"
    ]
    sums = counted.groupBy("doc_id", *UNIT).agg(F.struct(*counts, F.sum("n").alias("catch_all")).alias("tf"))
    if not small:
        sums = lookup_join(sums, _wanted(asked), UNIT, False, "left_semi")
    if stems is not None:
        nameless = sums.withColumn("lens", F.lit(0))
        sums = merged_terms(nameless, stems, ENTITY_FIELDS).drop("lens")
        small = fits_broadcast(units)
    sums = stage(sums, "entity-counts")
    own = F.col("unit") == ""
    lens = sums.filter(own).select("doc_id", F.col("tf").alias("lens"))
    nothing = F.struct(*[F.lit(0).cast("long").alias(f) for f in ENTITY_FIELDS])
    entries = sums.join(lens.hint("merge"), "doc_id").select(
        "doc_id", "lens", *UNIT, F.when(own, nothing).otherwise(F.col("tf")).alias("tf")
    )
    return TextIndex(stage(entries, "entities"), tuple(ENTITY_FIELDS), small)


def candidates(page_links: DataFrame, prefix: str = "List of", seed: str | None = None, cap: int | None = None) -> DataFrame:
    """(entity): distinct links of the pages that are linked as lists.

    `seed` names the one page whose list links count, else those of all pages do. `cap`, where
    it is asked for, keeps the first names in order.
    """
    lists = page_links.filter(F.col("link").startswith(prefix))
    lists = lists if seed is None else lists.filter(F.col("page") == seed)
    lists = lists.select(F.col("link").alias("page")).distinct()
    found = lookup_join(page_links, lists, ["page"], fits_broadcast(lists), "left_semi", spread_by="link")
    names = found.select(F.col("link").alias("entity")).distinct()
    return names if cap is None else names.orderBy("entity").limit(cap)
