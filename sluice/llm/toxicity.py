"""Toxicity by class-conditional Kneser-Ney models.

A bigram model of toxic and one of ordinary text backs off to its class's unigrams, and
these to unigrams shared by both classes, so an expression that is rare or new looks alike
to both. The score is the difference of the two log-likelihoods, mapped to 0..1 by a
logistic curve over two length-normalised forms of it: per token, and what tokens give
above ``STRONG`` by the root of the length. The first alone also follows how the classes
differ in subject or language; the second sees a few plain words in a long text.

Words are lowered (A-Z) and stripped of punctuation at their ends; words with few different
words before them in the counted sample, and new ones, are one unknown word, so copies of
a text don't make its words known. Counts come from three quarters of a sample of at most
``SAMPLE`` documents of each class, the curve from the others: a documented bound, chosen
by a hash of the id; all of a chosen text is used. Models are fitted in one task over that
bounded sample, and scoring reads each whole text once, without a shuffle.

Defined results: a null or empty text is a text without words, scored as such; a missing
or null label is no label; repeated labels of an id count as toxic if one is; of rows that
share an id, the least text is the one learnt from; without examples of both classes every
score is 0; repeated rows are scored alike; an empty table gives no rows; other columns of
the inputs are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fold

SAMPLE = 4000
DISCOUNT = 0.75
MIN_CONTEXTS = 5
CONTEXT_SHARE = 0.02  # a known word has so many contexts for each toxic document at least
STRONG = float(np.log(16))
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
CALIBRATION_EVERY = 4

_EDGES = b""".,;:!?"'()[]{}<>*#$%&|-_"""
_UNKNOWN, _EDGE = 0, 1


def tokens(text: str | bytes | None) -> list[bytes]:
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    return [w.strip(_EDGES) or w for w in raw.lower().split()]


def _discounted(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.maximum(counts - DISCOUNT, 0) / total


class ClassModel:
    """One class's probabilities: bigrams, unigrams by how many words they follow, shared."""

    def __init__(self, pairs: np.ndarray, size: int, shared: np.ndarray):
        keys, counts = np.unique(pairs, return_counts=True)
        before, after = keys // size, keys % size
        follows = np.bincount(after, minlength=size).astype(np.float64)
        total = max(1.0, follows.sum())
        rest = DISCOUNT * np.count_nonzero(follows) / total
        self.unigrams = _discounted(follows, total) + rest * shared
        seen = np.bincount(before, counts, minlength=size)
        kinds = np.bincount(before, minlength=size)
        # What a word leaves to the unigrams; all if it was never seen.
        self.backoff = np.where(seen > 0, DISCOUNT * kinds / np.maximum(seen, 1), 1.0)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.extra = np.append(_discounted(counts, seen[before]), 0.0)
        self.size = size

    def log_probabilities(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        keys = before * self.size + after
        at = np.searchsorted(self.keys, keys)
        extra = np.where(self.keys[at] == keys, self.extra[at], 0.0)
        return np.log(extra + self.backoff[before] * self.unigrams[after])


@dataclass
class Model:
    vocabulary: dict[bytes, int]
    toxic: ClassModel
    ordinary: ClassModel
    weights: tuple[float, float, float] = (1.0, 1.0, 0.0)

    def ids(self, text) -> np.ndarray:
        find = self.vocabulary.get
        words = [find(w, _UNKNOWN) for w in tokens(text)]
        return np.array([_EDGE, *words, _EDGE], np.int64)

    def features(self, text) -> tuple[float, float]:
        """Toxic over ordinary log-likelihood, per token with the end as one; strong tokens."""
        ids = self.ids(text)
        a, b = ids[:-1], ids[1:]
        gain = self.toxic.log_probabilities(a, b) - self.ordinary.log_probabilities(a, b)
        strong = np.maximum(gain - STRONG, 0).sum() / np.sqrt(len(gain))
        return float(gain.mean()), float(strong)

    def score(self, text) -> float:
        mean, strong = self.features(text)
        z = self.weights[0] * mean + self.weights[1] * strong + self.weights[2]
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def fit_counts(texts: list, toxic: list[bool]) -> Model:
    words = [[b"", *tokens(t)] for t in texts]
    flat = np.array([w for ws in words for w in ws], object)
    names, code = np.unique(flat, return_inverse=True)
    # The empty word stands before each text; pairs that span two texts end in it.
    kinds = np.unique(code[:-1] * len(names) + code[1:])
    contexts = np.bincount(kinds % len(names), minlength=len(names))
    least = max(MIN_CONTEXTS, CONTEXT_SHARE * sum(toxic))
    kept = [w for w, n in zip(names.tolist(), contexts) if n >= least and w]
    model = Model({w: i + 2 for i, w in enumerate(kept)}, None, None)
    size = len(kept) + 2
    pairs = {True: [], False: []}
    for text, label in zip(texts, toxic):
        ids = model.ids(text)
        pairs[label].append(ids[:-1] * size + ids[1:])
    gathered = {k: np.concatenate(v) for k, v in pairs.items()}
    union = np.unique(np.concatenate(list(gathered.values())))
    follows = np.bincount(union % size, minlength=size).astype(np.float64)
    rest = DISCOUNT * np.count_nonzero(follows) / follows.sum()
    shared = _discounted(follows, follows.sum()) + rest / size
    model.toxic, model.ordinary = (ClassModel(gathered[k], size, shared) for k in (True, False))
    return model


def calibrate(model: Model, texts: list, toxic: list[bool], rounds: int = 60) -> Model:
    """Weights of the logistic curve by Newton's steps, classes weighing the same."""
    x = np.array([model.features(t) for t in texts])
    y = np.array(toxic, np.float64)
    if not 0 < y.sum() < len(y):
        return model
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    design = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    at = np.zeros(3)
    penalty = 1e-3 * np.array([1.0, 1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        slope = design.T @ (weight * (y - p)) - penalty * at
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(penalty + 1e-9)
        at = at + np.clip(np.linalg.solve(curve, slope), -2, 2)
    scaled = np.maximum(at[:2], 0) / spread
    model.weights = (*scaled.tolist(), float(at[2] - scaled @ middle))
    return model


def _sample(rows: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` rows of each class, those with the smallest hash of the id."""
    totals = rows.groupBy("toxic").agg(F.count("toxic").alias("total"))
    place = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    near = rows.join(totals, "toxic").withColumn("place", place)
    near = near.filter(F.col("place") * F.col("total") <= 2 * sample + 20)
    order = Window.partitionBy("toxic").orderBy("place", "doc_id")
    return near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fits on labelled documents that are not held out; None without both classes."""
    marked = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
        .filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    # Ids are chosen first, so that only chosen texts are moved.
    chosen = _sample(marked, sample).select("doc_id", "toxic", "n")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # An id that many rows share is one example; reduced in each task before it is moved.
    rows = rows.groupBy("doc_id", "toxic", "n").agg(F.min("text").alias("text"))

    def train(batches):
        group = pd.concat(list(batches) or [pd.DataFrame(columns=["doc_id", "toxic", "n", "text"])])
        # The order has to follow from the rows alone, not from how they arrived.
        group = group.sort_values(["n", "doc_id", "text"], na_position="first")
        text = group["text"].tolist()
        label = group["toxic"].astype(bool).tolist()
        for_curve = (group["n"] % CALIBRATION_EVERY == 0).tolist()
        counted = [(t, y) for t, y, c in zip(text, label, for_curve) if not c]
        held = [(t, y) for t, y, c in zip(text, label, for_curve) if c]
        if len({y for _, y in counted}) == 2:
            model = fit_counts(*map(list, zip(*counted)))
            if held:
                model = calibrate(model, *map(list, zip(*held)))
            yield pd.DataFrame({"model": [pickle.dumps(model)]})

    fitted = rows.repartition(1).mapInPandas(train, "model binary").collect()
    return pickle.loads(fitted[0].model) if fitted else None


def scorer(docs: DataFrame, model: Model | None):
    """A function from a text column to its score."""
    if model is None:
        return lambda text: F.lit(0.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.binary())
        return pa.array([shared.value.score(t.as_py()) for t in raw], pa.float64())

    udf = F.arrow_udf(score, "double")
    return lambda text: udf(text.cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    score = scorer(docs, fit(docs, labels))
    rows = docs.select("doc_id", score(F.col("text")).alias("score"))
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
