"""Toxicity by a gap-weighted subsequence kernel, Nyström landmarks and a linear SVM.

Words are compared with short landmarks by the kernel that sums, over all subsequences of
`ORDER` letters the two share, `DECAY` to the length each of them spans. A word that has all
letters of a landmark in order is also compared by subsequences of the landmark's length,
where a letter between costs a factor of `WHOLE_DECAY` and no more: `idxiot` stays close to
`idiot`. A word also counts without what is no letter, and single letters in a row count as
a word, so `i--d--i--o--t` and `i d i o t` are `idiot`. Landmarks are the letter runs that
tell labelled toxic texts from clean ones best, each also without its start. A document's
value with a landmark is its best word's, the Nyström map whitens these values by the
kernel matrix of the landmarks, a linear SVM weighs them, and a logistic curve fitted to
its margins turns them into a score from 0 to 1.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import give_back

ORDER, DECAY, WHOLE_DECAY = 3, 0.5, 0.95
#: Values of order `ORDER` are raised to this power, again a kernel, so that many half-similar words do not add up to an insult.
POWER = 2
#: Stands before every word and counts as a letter of it.
START = "^"
LANDMARKS = 96
#: Labelled rows that the model is fitted on at most; they are taken by the hash of their ids.
LABELLED = 20_000
GRAMS = (4, 5, 6, 8)
#: A landmark candidate has this many toxic texts and this score at least; the best `CANDIDATES` are looked at.
MIN_TOXIC, MIN_GAIN, CANDIDATES = 3, 10, 2000
#: Least logarithm of the ratio of a candidate's rates in toxic and clean texts.
MIN_RATIO = 1.5
COVER, SAME = 3, 0.6
#: Least share of a landmark's letters that a word must have in their order, whatever lies
#: between them, for a kernel value other than 0.
SHARED = 0.7
#: Words of up to `PIECE` letters, with their start, are compared whole, longer ones in pieces of twice as many, which overlap
#: by half: an insult that spans up to `PIECE` letters is whole in a piece, a longer one may be cut.
PIECE = 16
#: Words are compared with others of up to the same of these lengths, so that short ones are not filled up.
WIDTHS = (6, 8, 10, 12, PIECE)
#: Words whose kernel values a task remembers.
REMEMBERED = 300_000
#: Texts whose words are compared together, and words near a landmark that are.
TOGETHER = 500
#: A landmark with this score and this logarithm of the ratio of its rates makes a text toxic alone.
SURE_GAIN, SURE_RATIO = 80, 3
PENALTY = 10.0
SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
NO_LETTERS = re.compile(r"[\W\d_]+")


def words_of(text: str) -> set[str]:
    """Lower-cased words, every run of three or more single letters as one more word, and all of these without what is no letter."""
    lowered = text.lower()
    words = set(lowered.split())
    if SPACED.search(lowered):
        words.update("".join(run.split()) for run in SPACED.findall(lowered))
    words.update([NO_LETTERS.sub("", w) for w in words if not w.isalpha()])
    words.discard("")
    return words


def _codes(strings: list[str], width: int) -> np.ndarray:
    """Letters as numbers above 0, a row per string."""
    out = np.zeros((len(strings), width), dtype=np.int32)
    if strings:
        flat = np.array([s[:width] for s in strings], dtype=f"U{width}")
        out[:] = flat.view(np.uint32).reshape(len(strings), width)
    return out


def kernel(left: np.ndarray, right: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Subsequence kernel of the rows of two code tables, row by row; `left` may have one row for all.

    What ends in a pair of equal letters is the sum of what ends before it in both strings,
    decayed by the distance. Divided by the decay up to its place, that is a running sum over
    both strings, so a further letter costs a product and two running sums.
    """
    right = np.ascontiguousarray(right.T)[:, None]
    hits = ((right == left.T[None]) & (right > 0)).astype(np.float64)
    decayed = decay ** (np.arange(hits.shape[0])[:, None, None] + np.arange(hits.shape[1])[None, :, None])
    sums = hits / decayed
    for _ in range(1, order):
        for j in range(1, hits.shape[0]):
            sums[j] += sums[j - 1]
        for i in range(1, hits.shape[1]):
            sums[:, i] += sums[:, i - 1]
        longer = np.zeros_like(hits)
        np.multiply(hits[1:, 1:], sums[:-1, :-1], out=longer[1:, 1:])
        sums = longer
    return decay**2 * (sums * decayed).sum(axis=(0, 1))


def whole_kernel(name: np.ndarray, words: np.ndarray, decay: float = WHOLE_DECAY) -> np.ndarray:
    """The kernel by subsequences of all letters of `name`, in terms of its own value, for each row of a code table.

    Such a subsequence takes the letters one after the other, so one running sum a letter does.
    """
    words = np.ascontiguousarray(words.T)
    decayed = decay ** np.arange(len(words))[:, None]
    sums = (words == name[0]) / decayed
    for letter in name[1:]:
        before = np.cumsum(sums[:-1], axis=0)
        sums = np.zeros_like(sums)
        np.multiply(words[1:] == letter, before, out=sums[1:])
    return decay ** (1 - len(name)) * (sums * decayed).sum(axis=0)


@dataclass
class Landmarks:
    """Landmark strings with what comparing words with them needs."""

    names: list[str]

    def __post_init__(self) -> None:
        self.width = max([len(n) for n in self.names], default=1)
        self.codes = _codes(self.names, self.width)
        self.own = np.maximum(kernel(self.codes, self.codes), 1e-9)
        # letters of the landmarks are numbered from 1 on; all others are 0
        letters = sorted(set("".join(self.names)))
        self.number = np.zeros(0x110000, dtype=np.uint8 if len(letters) < 256 else np.uint32)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        # a 64-bit number holds several landmarks one after the other, a bit per letter and a free one behind each
        self.groups: list[list[int]] = []
        self.places: list[np.ndarray] = []
        at = 64
        for j, name in enumerate(self.names):
            if at + len(name) >= 64:
                at = 0
                self.groups.append([])
                self.places.append(np.zeros(len(letters) + 1, dtype=np.uint64))
            for i, c in enumerate(name):
                self.places[-1][self.number[ord(c)]] |= np.uint64(1 << at + i)
            self.groups[-1].append(j)
            at += len(name) + 1

    def values(self, words: list[str]) -> np.ndarray:
        """Kernel values, in terms of the landmark's own one and at most 1, the better of the two orders: a row per word."""
        out = np.zeros((len(words), len(self.names)), dtype=np.float32)
        marked = [START + w for w in words]
        lengths = np.array([len(w) for w in marked], dtype=np.int64)
        for low, high in zip((0, *WIDTHS), WIDTHS):
            some = np.flatnonzero((lengths > low) & (lengths <= high))
            self._compare(out, [marked[k] for k in some], some, high)
        pieces, owner = [], []
        for k, word in enumerate(marked):
            if len(word) > PIECE:
                for at in range(0, max(1, len(word) - PIECE), PIECE):
                    pieces.append(word[at : at + 2 * PIECE])
                    owner.append(k)
        self._compare(out, pieces, np.array(owner, dtype=np.int64), 2 * PIECE)
        return out

    def _compare(self, out: np.ndarray, pieces: list[str], owner: np.ndarray, width: int) -> None:
        if not pieces:
            return
        codes = _codes(pieces, width)
        numbers = self.number[codes.T].astype(np.intp)
        for group, places in zip(self.groups, self.places):
            for j, shared in zip(group, _in_order(numbers, places, *[len(self.names[j]) for j in group])):
                length = len(self.names[j])
                code = self.codes[j : j + 1, :length]
                near = np.flatnonzero(shared >= SHARED * length)
                for first in range(0, len(near), TOGETHER):
                    some = near[first : first + TOGETHER]
                    found = kernel(code, codes[some])
                    np.maximum.at(out[:, j], owner[some], np.minimum(found / self.own[j], 1) ** POWER)
                some = near[shared[near] == length]
                if len(some):
                    np.maximum.at(out[:, j], owner[some], np.minimum(whole_kernel(code[0], codes[some]), 1))


def _in_order(numbers: np.ndarray, places: np.ndarray, *lengths: int) -> np.ndarray:
    """Lengths of the longest common subsequences of each column of letter numbers and the landmarks of a group: a row per landmark.

    All landmarks go through the letters at once. A carry out of one's bits goes to the free bit behind them, which is cleared.
    """
    starts = np.cumsum([0, *[n + 1 for n in lengths]]).tolist()
    masks = [np.uint64((1 << n) - 1 << at) for n, at in zip(lengths, starts)]
    used = np.bitwise_or.reduce(masks)
    missing = np.full(numbers.shape[1], used)
    for row in numbers:
        hit = places.take(row)
        hit &= missing
        moved = missing + hit
        missing -= hit
        missing |= moved
        missing &= used
    return np.array([n - np.bitwise_count(missing & mask) for n, mask in zip(lengths, masks)])


class Features:
    """Best kernel value of each landmark over a text's words; remembers words between texts."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks, self.near, self.far = landmarks, {}, set()

    def of(self, texts: Iterable[str | None]) -> np.ndarray:
        """A row per text; few texts are held as word sets at a time."""
        texts = list(texts)
        parts = [self._of(texts[at : at + TOGETHER]) for at in range(0, len(texts), TOGETHER)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.landmarks.names)), dtype=np.float32)

    def _of(self, texts: list[str | None]) -> np.ndarray:
        split = [words_of(t) if t else set() for t in texts]
        fresh = list(set().union(*split) - self.near.keys() - self.far) if split else []
        if len(self.near) + len(self.far) + len(fresh) > REMEMBERED:
            self.near, self.far = {}, set()
            fresh = list(set().union(*split))
        for at in range(0, len(fresh), 50_000):
            some = fresh[at : at + 50_000]
            values = self.landmarks.values(some)
            close = values.any(axis=1)
            self.near.update((some[i], values[i].copy()) for i in np.flatnonzero(close))
            self.far.update(some[i] for i in np.flatnonzero(~close))
        out = np.zeros((len(split), len(self.landmarks.names)), dtype=np.float32)
        for row, words in enumerate(split):
            if found := words & self.near.keys():
                out[row] = np.max([self.near[w] for w in found], axis=0)
        return out


@dataclass
class Model:
    """What scoring needs, a few kilobytes: landmarks, SVM weights on raw kernel values, curve."""

    landmarks: list[str]
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, values: np.ndarray) -> np.ndarray:
        margins = values.astype(np.float64) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -50, 50)))


def sample(labels: DataFrame, usable: Column, id_col: str, label_col: str, limit: int = LABELLED) -> DataFrame:
    """(id, label) of at most `limit` usable labelled rows, those with the smallest hashes of their ids.

    An id that is labelled more than once counts once, as toxic if any of its rows says so;
    rows without an id or with a label other than 0 and 1 are left out.
    """
    return (
        labels.filter(usable & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .groupBy(id_col).agg(F.max(label_col).alias(label_col))
        .orderBy(F.xxhash64(id_col), id_col).limit(limit)
    )


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"]):
            words = {START + w for w in words_of(text or "")}
            found = {w for w in words if 5 <= len(w) <= 11}
            for n in GRAMS:
                found.update(w[i : i + n] for w in words for i in range(len(w) - n + 1))
            (toxic if label else clean).update(found)
    names = list(toxic.keys() | clean.keys())
    for at in range(0, len(names), 100_000):
        some = names[at : at + 100_000]
        yield pd.DataFrame({"gram": some, "toxic": [toxic[g] for g in some], "clean": [clean[g] for g in some]})


def choose_landmarks(rows: DataFrame, limit: int = LANDMARKS) -> list[str]:
    """Letter runs that tell the classes of `rows(text, label)` apart and cover the toxic texts.

    A run scores its toxic texts times the logarithm of the ratio of its two rates. Of the
    `CANDIDATES` best, the one that scores most on texts that fewer than `COVER` chosen ones
    cover is taken, again and again, until `limit` are or a further one would cover fewer
    than `MIN_TOXIC` texts. Runs of nearly the same texts as a chosen one are passed over,
    but a run that starts a word is also taken without its start, so that it is found inside
    words: those come on top of `limit`.
    """
    sizes = dict(rows.groupBy("label").count().collect())
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return []
    counts = rows.mapInPandas(_gram_counts, "gram string, toxic long, clean long").groupBy("gram").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    ratio = F.log((F.col("toxic") + 0.5) / (pos + 1) / ((F.col("clean") + 0.5) / (neg + 1)))
    best = counts.filter(F.col("toxic") >= MIN_TOXIC).select("gram", ratio.alias("ratio"), (F.col("toxic") * ratio).alias("gain"))
    best = best.filter((F.col("gain") >= MIN_GAIN) & (F.col("ratio") >= MIN_RATIO)).orderBy(F.desc("gain"), F.desc(F.length("gram")), "gram").limit(CANDIDATES)
    grams = [(row["gram"], row["ratio"]) for row in best.collect()]
    place = {gram: i for i, (gram, _) in enumerate(grams)}
    lengths = sorted({len(g) for g in place})

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for text in batch["text"]:
                words = {START + w for w in words_of(text or "")}
                runs = {w[i : i + n] for w in words for n in lengths for i in range(len(w) - n + 1)}
                kept.append([place[g] for g in runs & place.keys()])
            yield pd.DataFrame({"has": kept})

    texts = rows.filter("label = 1").mapInPandas(found, "has array<int>").toPandas()["has"]
    has = np.zeros((len(texts), len(grams)), dtype=bool)
    for i, columns in enumerate(texts):
        has[i, list(columns)] = True
    weight, sizes_of = np.array([r for _, r in grams]), has.sum(axis=0)
    need, usable, chosen = np.full(len(texts), COVER), np.ones(len(grams), dtype=bool), []
    while len(chosen) < limit and usable.any():
        new = has[need > 0].sum(axis=0)
        top = int(np.argmax(np.where(usable & (new >= MIN_TOXIC), new * weight, 0)))
        if not usable[top] or new[top] < MIN_TOXIC:
            break
        chosen.append(grams[top][0])
        need -= has[:, top]
        both = has[has[:, top]].sum(axis=0)
        usable &= both <= SAME * (sizes_of + sizes_of[top] - both)
    inside = [g.removeprefix(START) for g in chosen if g.startswith(START) and len(g) > min(GRAMS)]
    return list(dict.fromkeys(chosen + inside))


def _svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps; classes weigh the same. y: -1 or 1."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    cost = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum()))) * PENALTY
    ridge = np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x1.shape[1])
    for _ in range(50):
        active = y * (x1 @ w) < 1
        xa = x1[active] * cost[active, None]
        new = np.linalg.solve(ridge + xa.T @ x1[active], xa.T @ y[active])
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return w[:-1], float(w[-1])


def _curve(margins: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through margins and labels, with smoothed targets."""
    pos, neg = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -50, 50)))
        grad = np.array([((p - target) * margins).sum(), (p - target).sum()])
        h = p * (1 - p) + 1e-9
        hess = np.array([[(h * margins**2).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", landmarks: int = LANDMARKS) -> Model:
    """Train on the texts of `labelled(id, label)`, which `sample` bounds to `LABELLED` rows.

    That bound also makes its broadcast and the table of kernel values (a row of
    `landmarks` numbers per labelled text) that comes to the driver safe. Null texts
    are learned as texts without words, an id of several rows of `docs` by each of them.
    Without texts of both classes the model gives every text the share of toxic ones.
    """
    labelled = labelled.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(labelled), "id")
    names = choose_landmarks(rows, landmarks)
    if not names:
        share = rows.agg(F.avg("label")).first()[0] or 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model([], np.zeros(0), 0.0, 1.0, float(np.log(share / (1 - share))))
    table = Landmarks(names)

    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features(table)
        for batch in batches:
            yield pd.DataFrame({"x": list(features.of(batch["text"])), "label": batch["label"]})
        del features
        give_back()

    found = rows.mapInPandas(values, "x array<float>, label int").toPandas()
    return _train(table, np.array(found["x"].tolist(), dtype=np.float64), found["label"].to_numpy())


def _train(table: Landmarks, x: np.ndarray, label: np.ndarray) -> Model:
    """Nyström map, SVM and curve from the landmark values of labelled texts.

    Most toxic texts hold several landmarks, and some none, so a plain fit asks for several.
    Each sure landmark of a toxic text is therefore also learned alone, in an average clean text.
    """
    names = table.names
    alone = table.values([n.removeprefix(START) for n in names]).astype(np.float64)
    gram = (alone + alone.T) / 2
    power, base = np.linalg.eigh(gram)
    whiten = base / np.sqrt(np.maximum(power, 1e-2)) @ base.T
    has, toxic = x > 0.999, label > 0
    pos, neg = has[toxic].sum(axis=0), has[~toxic].sum(axis=0)
    ratio = np.log((pos + 0.5) / (toxic.sum() + 1) / ((neg + 0.5) / ((~toxic).sum() + 1)))
    sure = (ratio >= SURE_RATIO) & (pos * ratio >= SURE_GAIN)
    if sure.any() and not toxic.all():
        added = np.repeat(np.maximum(alone[sure], x[~toxic].mean(axis=0)), pos[sure], axis=0)
        x, label = np.vstack([x, added]), np.concatenate([label, np.ones(len(added), dtype=label.dtype)])
    w, bias = _svm(x @ whiten, np.where(label > 0, 1.0, -1.0))
    slope, shift = _curve(x @ whiten @ w + bias, label.astype(np.float64))
    return Model(names, whiten @ w, bias, slope, shift)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of `docs` and the score of its whole text.

    Defined cases: null and empty texts get the score of a text without any word; a text's
    length does not matter but by its words; a word of more than twice `PIECE` letters counts
    by its pieces; rows with the same text get the same score; a column of `docs` named `out`
    is replaced.
    """
    landmarks = Landmarks(model.landmarks)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features(landmarks)
        for batch in batches:
            yield pd.Series(model.scores(features.of(batch)))
            del batch
            give_back()
        del features
        give_back()

    return docs.withColumn(out, scores(F.col(text_col)))
