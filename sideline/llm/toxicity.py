"""Toxicity by a counterfactual-regularised classifier.

A logistic model over hashed features (the distinct words of a text and their leading letters) is fitted on labelled
rows. For each training text that names an identity group, a counterfactual is made by swapping identity terms
for others of the same kind; the loss adds the squared difference of the two logits, so that naming a group
does not move a score by itself.

The fit uses a bounded sample of labelled rows (``max_toxic`` and ``max_clean``, drawn by a hash of doc_id);
scoring covers every text, in place, with a weight vector of fixed size. No label, doc_id, source or language is
an input of a score.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import small_batches, text_of

#: Bounds of the training sample.
MAX_TOXIC = 3000
MAX_CLEAN = 5000
#: Features are hashed into this many places.
PLACES = 1 << 20
#: The settings below are those of the least five-fold cross-validated error within the training rows (README).
PREFIXES = (4,)
MIN_DOCS = 3
MIN_Z = 3.0
#: Part of the corpus's log odds that is added to the intercept (the fit gives both classes the same weight).
PRIOR_SHARE = 0.25
MEMO_WORDS = 300_000

#: Identity terms by kind; a term is swapped for the next one of its kind.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girl", "boy"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"), ("homosexual", "heterosexual"),
    ("black", "white", "asian", "latino"), ("african", "european", "american", "mexican", "chinese", "indian", "arab"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrant", "native", "refugee"), ("immigrants", "natives", "refugees"), ("blind", "deaf", "disabled"),
    ("old", "young"), ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
SWAP = {term: kind[(i + 1) % len(kind)] for kind in IDENTITY for i, term in enumerate(kind)}

_WORDS = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> set[str]:
    return set(_WORDS(text.lower()))


class Features(dict):
    """Word -> places of its features; remembers a bounded number of words."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        names = [word, *(f"{word[:n]}~" for n in PREFIXES if len(word) > n)]
        at = tuple(zlib.crc32(x.encode()) % PLACES for x in names)
        if len(self) >= MEMO_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = at
        return at

    def of(self, words: set[str]) -> list[int]:
        return list(set().union(*map(self.__getitem__, words)))


_features = Features()


@dataclass
class Model:
    weights: np.ndarray  # float32, PLACES long
    intercept: float

    def score(self, text: str) -> float:
        z = self.intercept + float(self.weights[_features.of(words_of(text))].sum(dtype="float64"))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def sample(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN):
    """Features of the sampled labelled rows as an Arrow table (toxic, at, swapped), and the number of labelled
    rows of each class. Repeated labels of a doc_id count once, the worst one."""
    known = (labels.where("doc_id is not null and toxic is not null and toxic in (0, 1)").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("doc_id")
    drawn = known.where("toxic = 1").orderBy(order, "doc_id").limit(max_toxic).unionByName(
        known.where("toxic = 0").orderBy(order, "doc_id").limit(max_clean))
    small_batches(docs)
    # at most max_toxic + max_clean ids: a fixed bound, so the sample may be broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")

    @arrow_udf("struct<at array<int>, swapped array<int>>")
    def features(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            words = words_of(t.as_py() or "")
            other = {SWAP.get(w, w) for w in words} if not words.isdisjoint(SWAP) else None
            rows.append({"at": _features.of(words), "swapped": None if other is None else _features.of(other)})
        kind = pa.list_(pa.int32())
        return pa.array(rows, pa.struct([("at", kind), ("swapped", kind)]))

    return rows.select("toxic", features(text_of()).alias("f")).select("toxic", "f.at", "f.swapped").toArrow(), counts


def _blocks(lists: pa.ChunkedArray, rows: int = 500):
    """(first row, offsets, places) of a few rows at a time; the driver never holds all places as 64-bit numbers."""
    for i in range(0, len(lists), rows):
        some = lists.slice(i, rows).combine_chunks()
        yield i, np.r_[0, np.cumsum(pa.compute.list_value_length(some).to_numpy(zero_copy_only=False))], some.flatten().to_numpy()


class _Rows:
    """A sparse 0/1 matrix of the chosen columns."""

    def __init__(self, lists: pa.ChunkedArray, columns: np.ndarray, width: int):
        row, at = [np.zeros(0, "int32")], [np.zeros(0, "int32")]
        for first, ends, places in _blocks(lists):
            chosen = columns[places]
            row.append((first + np.repeat(np.arange(len(ends) - 1, dtype="int32"), np.diff(ends)))[chosen >= 0].astype("int32"))
            at.append(chosen[chosen >= 0])
        self.row, self.at, self.n, self.width = np.concatenate(row), np.concatenate(at), len(lists), width

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.at], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=g[self.row], minlength=self.width)


def fit(sampled: pa.Table, counts: dict[int, int], steps: int = 150, l2: float = 1e-4, swap_weight: float = 1.0) -> Model:
    """The model of a sample. Without labelled rows all scores are 0; with one class alone they are its share."""
    weights = np.zeros(PLACES, "float32")
    y = sampled["toxic"].to_numpy().astype("float64")
    if len(np.unique(y)) < 2:
        share = counts.get(1, 0) / max(1, sum(counts.values()))
        return Model(weights, float(np.clip(np.log(max(share, 1e-13) / max(1 - share, 1e-13)), -30, 30)))
    in_toxic, in_all = np.zeros(PLACES), np.zeros(PLACES)
    for first, ends, places in _blocks(sampled["at"]):
        in_all += np.bincount(places, minlength=PLACES)
        in_toxic += np.bincount(places, weights=np.repeat(y[first:first + len(ends) - 1], np.diff(ends)), minlength=PLACES)
    n1, n0 = y.sum(), len(y) - y.sum()
    # features that stand out from the classes' difference by chance
    p1, p0 = (in_toxic + 0.5) / (n1 + 1), (in_all - in_toxic + 0.5) / (n0 + 1)
    p = (in_all + 1) / (n1 + n0 + 2)
    z = (p1 - p0) / np.sqrt(p * (1 - p).clip(1e-9) * (1 / n1 + 1 / n0))
    identity = {i for term in SWAP for i in _features[term]}
    chosen = np.flatnonzero((in_all >= MIN_DOCS) & (np.abs(z) >= MIN_Z))
    chosen = np.union1d(chosen, [i for i in identity if in_all[i]]).astype("int64")
    columns = np.full(PLACES, -1, "int32")
    columns[chosen] = np.arange(len(chosen))
    x = _Rows(sampled["at"], columns, len(chosen))
    named = sampled.filter(pa.compute.is_valid(sampled["swapped"]))
    pairs = [tuple(_Rows(named[c], columns, len(chosen)) for c in ("at", "swapped"))] if named.num_rows else []
    balance = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    w, b = np.zeros(len(chosen)), 0.0
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for t in range(1, steps + 1):  # Adam on the whole sample
        s = x.times(w) + b
        g = balance * (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y)
        grad = np.r_[x.back(g) + l2 * w, g.sum()]
        for own, swapped in pairs:
            gap = swap_weight * (own.times(w) - swapped.times(w)) / own.n
            grad[:-1] += own.back(gap) - swapped.back(gap)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        step = 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    weights[chosen] = w
    prior = np.log(max(counts.get(1, 0), 1) / max(counts.get(0, 0), 1))
    return Model(weights, float(b + PRIOR_SHARE * prior))


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """The model of the labelled rows of ``docs``. Labels other than 0 and 1, without a doc_id or of no document are left
    out, repeated ones count once, the worst; rows of one doc_id are each a row; NULL texts are empty. Without
    labels, or without documents, the model scores 0; with one class alone, the share of that class."""
    return fit(*sample(docs, labels, max_toxic, max_clean))


def scorer(df: DataFrame, model: Model):
    """A function of a text column that gives its score; NULL texts are empty."""
    small_batches(df)
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.intercept))  # of fixed size

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        m = Model(*shared.value)
        return pa.array([m.score(t.as_py() or "") for t in texts], pa.float64())

    return score


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted: one row per row. NULL and empty texts score by the intercept alone; repeated rows
    repeat; an empty table gives no rows; other columns are not read."""
    s = docs.select("doc_id", scorer(docs, model)(text_of()).alias("score"))
    return s.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not reject (score below 0.5); same columns. NULL and empty texts score by
    the intercept; repeated rows stay or go together; an empty table stays empty."""
    return docs.where(scorer(docs, model)(text_of()) < 0.5)
