"""Boilerplate lines by their frequency within a site. DataFrame functions only.

Pages are grouped by host. A line's frequency on a host is the number of its pages that
contain the line divided by the number of its pages; lines above `max_ratio` go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import LOWER, UPPER
from termloom.operators.joins import fits_broadcast
from termloom.operators.staging import stage

MAX_RATIO = 0.01
MIN_PAGES = 5


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substr(url, at + 3), "^([^/?#]*)", 1)
    return F.when(at > 0, F.translate(host, UPPER, LOWER)).otherwise("")


def _key(line: Column) -> Column:
    """A line without the blanks around it stands for itself by its MD5; blank lines by null."""
    bare = F.trim(line)
    return F.when(bare != "", F.unhex(F.md5(bare)))


def boilerplate(pages: DataFrame, host: str, text: str, max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line_key, pages_with, pages_of_host) of the lines above the ratio.

    A page counts a line once, so the pages that contain it are a plain count; it is summed
    per task before the shuffle, and a line or host with a third of all rows sends one row
    per task.
    """
    lines = pages.select(
        F.col(host).alias("host"),
        F.array_distinct(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), _key)).alias("keys"),
    )
    counted = lines.select("host", F.explode("keys").alias("line_key")).filter("line_key IS NOT NULL").groupBy(
        "host", "line_key"
    ).agg(F.count("*").alias("pages_with")).filter(F.col("pages_with") >= min_pages)
    totals = lines.groupBy("host").agg(F.count("*").alias("pages_of_host")).filter(F.col("pages_of_host") >= min_pages)
    return counted.join(totals, "host").filter(F.col("pages_with") > max_ratio * F.col("pages_of_host"))


def drop_boilerplate(pages: DataFrame, host: Column, text: str, max_ratio: float = MAX_RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """All columns of `pages` with `text` cleaned, and `n_lines`, `n_dropped`.

    The boilerplate lines of a host come as one array per host: as each page adds its own
    lines only, a host has at most (lines per page) / `max_ratio` of them, whatever its
    size. That table is joined by host, by broadcast where it was measured to be small, else
    by a sort-merge join that splits a large host.

    Defined cases: a null host is a site of its own; null texts stay null, with no lines;
    blank lines stay; lines are compared without the blanks around them, and copies of a
    line within a page count once and go together; a line on fewer than `min_pages` pages is
    never boilerplate, so small sites keep theirs. Rows are never dropped: a page of nothing
    but boilerplate becomes an empty text. Further columns pass through, whatever their
    names.
    """
    own = "line dedup: "
    keyed = pages.withColumn(own + "host", F.coalesce(host, F.lit("")))
    found = boilerplate(keyed, own + "host", text, max_ratio, min_pages)
    # one row per host; its array is bounded as said above
    by_host = stage(
        found.groupBy("host").agg(F.collect_list("line_key").alias(own + "keys")), "boilerplate"
    ).withColumnRenamed("host", own + "host")
    small = fits_broadcast(by_host.select(F.col(own + "host").alias("h"), F.transform(own + "keys", F.hex).alias("k")))
    joined = keyed.join(F.broadcast(by_host) if small else by_host.hint("merge"), own + "host", "left")
    lines = F.split(F.col(text), "\n")
    kept = F.when(F.col(own + "keys").isNull(), lines).otherwise(
        F.filter(lines, lambda line: ~F.coalesce(F.array_contains(F.col(own + "keys"), _key(line)), F.lit(False)))
    )
    size = F.greatest(F.size(lines), F.lit(0))
    cleaned = joined.withColumn(own + "kept", kept).withColumns({
        "n_lines": size,
        "n_dropped": size - F.greatest(F.size(own + "kept"), F.lit(0)),
        text: F.array_join(own + "kept", "\n"),
    })
    names = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    return cleaned.select(*[F.col(f"`{c}`") for c in names], "n_lines", "n_dropped")
