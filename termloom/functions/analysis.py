"""Text analysis as column expressions; each returns a Column and runs in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.stopwords import ENGLISH, ENGLISH_SHORT

Analyzer = Callable[[Column], Column]

# The delimiters of plain word counting and the punctuation that is deleted.
WORD_DELIMITERS = r"[\s.,:;?!]+"
PUNCTUATION = r"[.,:;?!]+"
# Java's \w is ASCII only, so letters and digits are named by their Unicode classes.
NON_WORD = r"[^\p{L}\p{N}]+"
POSSESSIVE = r"['’][sS]([^\p{L}\p{N}]|$)"
TWO_WORD_CHARS = r"[\p{L}\p{N}_]{2,}"


def _without(words: Column, stop: Sequence[str]) -> Column:
    return F.filter(words, lambda w: ~w.isin(list(stop))) if stop else words


def _present(words: Column) -> Column:
    """No text means no words, not an unknown list of words."""
    return F.coalesce(F.array_remove(words, ""), F.array().cast("array<string>"))


def plain_words(text: Column) -> Column:
    """Words between white space and basic punctuation, case kept."""
    return _present(F.split(text, WORD_DELIMITERS))


def strip_punctuation(text: Column, stop: Sequence[str] = ()) -> Column:
    """Delete punctuation without a replacement; optionally drop stop words as well."""
    stripped = F.regexp_replace(text, PUNCTUATION, "")
    if not stop:
        return stripped
    return F.array_join(
        F.filter(
            F.array_remove(F.split(stripped, r"\s+"), ""),
            lambda w: ~F.lower(w).isin(list(stop)),
        ),
        " ",
    )


def index_terms(text: Column, stop: Sequence[str] = ENGLISH) -> Column:
    """Lower-cased letter/digit runs in text order, stop words dropped."""
    words = F.split(F.lower(F.regexp_replace(text, NON_WORD, " ")), " ")
    return _without(_present(words), stop)


def standard_terms(text: Column) -> Column:
    """Lower-cased letter/digit runs; nothing dropped."""
    return index_terms(text, stop=())


def english_terms(text: Column) -> Column:
    """`standard_terms` after dropping possessive endings, then the short stop list."""
    return index_terms(F.regexp_replace(text, POSSESSIVE, "$1"), stop=ENGLISH_SHORT)


def long_words(text: Column) -> Column:
    """Lower-cased words of two or more word characters (underscore counts as one)."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TWO_WORD_CHARS), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def stemmed(tokens: DataFrame, stem_map: DataFrame) -> DataFrame:
    """Replace each `term` by its `stem` where the table (term, stem) has one.

    Neither side carries a broadcast hint: Spark broadcasts the map while it is below its
    own size threshold and otherwise shuffles both.
    """
    return tokens.join(stem_map, "term", "left").withColumn(
        "term", F.coalesce("stem", "term")
    ).drop("stem")


def plural_stem(term: Column) -> Column:
    """English plural endings off: -ies to -y, -es to -e, -s to nothing, with the usual exceptions.

    It is meant for distinct terms (`stem_table`); any other table (term, stem) does as well.
    """
    # Endings and the letters before them that keep a word as it is.
    ies, es, s = "([^ae])ies$", "([^aeo])es$", "([^us])s$"
    return (
        F.when(term.rlike(ies), F.regexp_replace(term, ies, "$1y"))
        .when(term.rlike(es), F.regexp_replace(term, es, "$1e"))
        .when(term.rlike(s) & ~term.rlike("(ies|es)$"), F.regexp_replace(term, s, "$1"))
        .otherwise(term)
    )


def stem_table(terms: DataFrame, stem: Callable[[Column], Column] = plural_stem) -> DataFrame:
    """(term, stem) of the distinct `terms(term)` that a stemmer changes."""
    stemmed_to = stem(F.col("term"))
    return terms.select("term").distinct().select("term", stemmed_to.alias("stem")).filter("stem <> term")


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(n_docs / df)


def resolve_uri(uri: Column) -> Column:
    """Readable label of a URI: last path segment, underscores as spaces, no category prefix."""
    label = F.replace(F.element_at(F.split(uri, "/"), -1), F.lit("_"), F.lit(" "))
    return F.regexp_replace(label, "^Category:", "")


def entity_key(name: Column) -> Column:
    """Key under which an entity name is stored."""
    return F.replace(F.replace(name, F.lit(" "), F.lit("_")), F.lit("&"), F.lit("and"))
