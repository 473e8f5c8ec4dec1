"""URLs judged by host and path rules, and by character language models where no rule fits.

URLs that a rule allows or blocks are the training set. Two variable-order Markov models,
one of allowed and one of blocked URLs, give every character's probability after the up to
three before it: each order is blended with the next shorter one, with more weight the more
often its context was seen (Witten-Bell). A URL is judged by the mean, over its characters,
of the logarithm of the ratio of the two probabilities; the bar is put where it separates
rule-judged URLs that the models have not seen best.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import LOWER, UPPER

ORDER = 3
#: The symbols of the models: letters fold to lower case, digits to 0, what is left to one.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0/.-_?=&:#%+~"
OTHER, START = len(SYMBOLS), len(SYMBOLS) + 1
SIZE = len(SYMBOLS) + 2
#: One in so many rule-judged URLs, by hash, is kept from the models and sets the bar.
HELD_OUT = 5
STEPS = 2000


@dataclass(frozen=True)
class Rule:
    """`text` is a host, a slash and the beginning of a path."""

    text: str
    allow: bool

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where it is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule whose host is the URL's or a parent domain of it and whose path begins the URL's; else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        at_host = (host == rule.host) | host.endswith("." + rule.host)
        found = F.when(at_host & path.startswith(rule.path), rule.text).otherwise(found)
    return found


def symbols(urls: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all URLs one after another, each URL led by `ORDER` start symbols, and their lengths."""
    table = np.full(256, OTHER, dtype=np.int64)
    for i, c in enumerate(SYMBOLS):
        table[ord(c)] = table[ord(c.upper())] = i
    table[ord("0") : ord("9") + 1] = SYMBOLS.index("0")
    raw = [u.encode() for u in urls]
    lens = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    flat = table[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    out = np.full(len(flat) + ORDER * len(raw), START, dtype=np.int64)
    out[np.arange(len(flat)) + ORDER * (np.repeat(np.arange(len(raw)), lens) + 1)] = flat
    return out, lens


def _windows(urls: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Number of each character with the three before it, and the URL it is in."""
    flat, lens = symbols(urls)
    number = np.zeros(max(0, len(flat) - ORDER), dtype=np.int64)
    for k in range(ORDER + 1):
        number = number * SIZE + flat[k : len(flat) - ORDER + k]
    owner = np.repeat(np.arange(len(lens)), lens + ORDER)[ORDER:]
    own = flat[ORDER:] != START
    return number[own], owner[own]


def count_windows(urls: DataFrame) -> DataFrame:
    """(allow, number, times) over `urls(allow, url)`; summed per task first."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for allow, group in batch.groupby("allow"):
                numbers, times = np.unique(_windows(group["url"])[0], return_counts=True)
                yield pd.DataFrame({"allow": bool(allow), "number": numbers, "times": times})

    return urls.mapInPandas(counted, "allow boolean, number long, times long").groupBy("allow", "number").agg(F.sum("times").alias("times"))


def _probabilities(counts: np.ndarray) -> np.ndarray:
    """Blended probability of every window of `ORDER` + 1 symbols: a table of SIZE to the power of its length."""
    blended = np.full(SIZE, 1 / SIZE)
    for order in range(ORDER + 1):
        own = counts.reshape(-1, *[SIZE] * (order + 1)).sum(axis=0)
        seen, kinds = own.sum(axis=-1, keepdims=True), (own > 0).sum(axis=-1, keepdims=True)
        # a context never seen leaves all weight to the shorter one
        blended = np.where(seen > 0, (own + kinds * blended) / np.maximum(seen + kinds, 1), blended)
    return blended


@dataclass
class Model:
    """Log-ratio of the two models for every window, and the bar; some ten megabytes whatever the corpus."""

    ratio: np.ndarray
    bar: float

    def scores(self, urls: pd.Series) -> np.ndarray:
        if not len(urls):
            return np.zeros(0)
        numbers, owner = _windows(urls)
        sums = np.bincount(owner, weights=self.ratio[numbers], minlength=len(urls))
        return sums / np.maximum(np.bincount(owner, minlength=len(urls)), 1)


def fit(urls: DataFrame) -> Model:
    """Fit on all of `urls(allow, url)`.

    What comes to the driver is bounded by the alphabet: the counts of the windows of four
    of `SIZE` symbols, and histograms of `STEPS` steps.
    """
    urls = urls.filter("url IS NOT NULL AND allow IS NOT NULL")
    aside = F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0
    counts = np.zeros((2, SIZE ** (ORDER + 1)))
    found = count_windows(urls.filter(~aside)).toPandas()
    counts[found["allow"].astype(int), found["number"]] = found["times"]
    ratio = (np.log(_probabilities(counts[1])) - np.log(_probabilities(counts[0]))).ravel().astype(np.float32)
    model = Model(ratio, 0.0)
    judged = score(urls.filter(aside), model, "url", "ratio")
    low, high = judged.agg(F.min("ratio"), F.max("ratio")).first()
    if low is None or low == high or not counts.sum(axis=1).all():
        return model
    step = (F.col("ratio") - low) / (high - low) * STEPS
    bins = judged.groupBy("allow", F.least(F.floor(step), F.lit(STEPS - 1)).cast("int").alias("bin")).count().toPandas()
    per_class = np.zeros((2, STEPS))
    per_class[bins["allow"].astype(int), bins["bin"]] = bins["count"]
    share = per_class / np.maximum(per_class.sum(axis=1, keepdims=True), 1)
    # blocked below the bar plus allowed from it on; in the middle of the best places
    right = np.concatenate([[0], np.cumsum(share[0])]) + np.concatenate([[1], 1 - np.cumsum(share[1])])
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return Model(ratio, float(low + (high - low) * best.mean() / STEPS))


def score(urls: DataFrame, model: Model, url_col: str, out: str) -> DataFrame:
    """Adds the length-normalised log-ratio; null and empty URLs get 0."""
    shared = urls.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def ratios(batch: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(batch))

    return urls.withColumn(out, ratios(F.coalesce(F.col(url_col), F.lit(""))))


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, ratio) for every row; `verdict` is allow or block.

    Defined cases: a URL that is null or has no `://` has an empty host and path, so no rule
    fits; null and empty URLs score 0. Without rule-judged URLs of both kinds the models are
    level and every URL without a rule is allowed, unless the bar says otherwise. Equal URLs
    get equal verdicts; an empty table gives no row; further columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select(
        "page_id", "url", host.alias("host"), path.alias("path")
    ).withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    allowed = F.col("rule").isin([r.text for r in rules if r.allow])
    model = fit(parsed.filter("rule IS NOT NULL").select(allowed.alias("allow"), "url"))
    scored = score(parsed, model, "url", "ratio")
    allow = F.when(F.col("rule").isNull(), F.col("ratio") >= model.bar).otherwise(allowed)
    return scored.select("page_id", "host", "path", "rule", F.when(allow, "allow").otherwise("block").alias("verdict"), "ratio")
