"""Language identification by the nearest of several centroids per language.

Texts are lowered, all but letters become spaces, and the byte n-grams of one to three
bytes are counted in ``BUCKETS`` hashed buckets. Vectors are sublinear counts times the
inverse document frequency, of length one. Each language's training vectors are clustered
by spherical k-means into ``CENTROIDS`` centroids; a text takes the language of the
centroid with the largest cosine. A text farther from it than its language's radius is
rejected: ``MARGIN`` of the way from the distance that all but ``WRONG`` of the language's
training documents keep to, to no likeness at all. So few wrong labels neither widen a radius nor
become a centroid: groups that hold no more of the documents are set aside first.

The classifier is fitted on at most ``SAMPLE`` documents per language, a documented bound,
chosen by a hash of the id; each language is fitted in its own task. Prediction reads
each whole text once, without a shuffle.

Defined results: ``und`` with score 0 for a null text and one without a letter; without
any training document every text is ``und``; the language first by name wins a tie;
repeated rows are judged alike; an empty table gives no rows; other columns are passed
through by ``keep_identified`` and otherwise ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed, fold

SAMPLE = 1000
CENTROIDS = 4
ROUNDS = 12
WRONG = 0.02  # share of a language's labels that may be wrong
MARGIN = 0.6
BUCKETS = 4096
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def counts(text: str | None) -> np.ndarray | None:
    """N-gram counts of a text by bucket; None if it has no letter."""
    if not text or not any(map(str.isalpha, text)):
        return None
    letters = f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} "
    b = np.frombuffer(letters.encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    grams = [b + 1]
    if len(b) > 1:
        grams.append((b[:-1] << 8 | b[1:]) + (1 << 16))
    if len(b) > 2:
        grams.append((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) + (1 << 25))
    mixed = np.concatenate(grams) * np.uint32(2654435761)
    return np.bincount(mixed >> np.uint32(20), minlength=BUCKETS)


def vectors(rows: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    x = np.log1p(np.asarray(rows, np.float32).reshape(-1, BUCKETS)) * idf
    return _unit(x)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def cluster(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; starts are spread out one by one, so a result repeats."""
    picked = [0]
    for _ in range(min(k, len(x)) - 1):
        picked.append(int(np.argmin((x @ x[picked].T).max(axis=1))))
    centroids = x[picked]
    for _ in range(rounds):
        own = (x @ centroids.T).argmax(axis=1)
        sums = np.stack([x[own == j].sum(axis=0) for j in range(len(centroids))])
        filled = np.linalg.norm(sums, axis=1) > 0
        centroids = np.where(filled[:, None], _unit(sums), centroids)
    return centroids


def centre(x: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """Centroids of one language's vectors and the radius within which a text is kept."""
    kept = np.arange(len(x))
    while True:
        c = cluster(x[kept], k)
        own = (x[kept] @ c.T).argmax(axis=1)
        n = np.bincount(own, minlength=len(c))
        c, filled = c[n > 0], np.flatnonzero(n)
        least = filled[n[filled].argmin()]
        if len(kept) - n[least] < (1 - WRONG) * len(x):
            break
        kept = kept[own != least]
    far = float(np.sort(1 - (x @ c.T).max(axis=1))[-1 - int(WRONG * len(x))])
    return c, far + MARGIN * (1 - far)


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid, sorted
    centroids: np.ndarray
    idf: np.ndarray
    radius: np.ndarray  # of each centroid's language

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, cosine and whether the text is too far off, for each text."""
        found = [(UNKNOWN, 0.0, True)] * len(texts)
        known = [(i, c) for i, t in enumerate(texts) if (c := counts(t)) is not None]
        if not known or not self.languages:
            return found
        cosines = vectors([c for _, c in known], self.idf) @ self.centroids.T
        best = cosines.argmax(axis=1)
        for (i, _), j, row in zip(known, best, cosines):
            cosine = min(1.0, max(0.0, float(row[j])))
            found[i] = (self.languages[j], cosine, 1 - cosine > self.radius[j])
        return found


def _sample(docs: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` rows of each language, those with the smallest hash of id and text.

    Rows that share an id are told apart by their texts, so no id holds a language's
    sample, and rows of equal id and text count once, however many there are.
    """
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    docs = docs.withColumn("key", key)
    totals = docs.groupBy("lang").agg(F.approx_count_distinct("key").alias("total"))
    place = F.pmod(F.col("key"), F.lit(1 << 30)) / float(1 << 30)
    # One row per language, counted first: the texts are not shuffled for the shares.
    totals = broadcast_if_small(checkpointed(totals))
    near = docs.join(totals, "lang").withColumn("place", place)
    # Twice as many as needed on average; the window then only ranks these.
    near = near.filter(F.col("place") * F.col("total") <= 2 * sample + 20)
    near = near.groupBy("lang", "place", "key").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("place", "key")
    return near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample)


def fit(docs: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> Model:
    """Fits centroids on labelled ``docs`` with ``doc_id``, ``text`` and ``lang``.

    What reaches the driver is a few vectors per language.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())

    def packed(texts: pa.Array) -> pa.Array:
        rows = [counts(t.as_py()) for t in texts]
        return pa.array([None if r is None else r.astype(np.uint32).tobytes() for r in rows])

    grams = F.arrow_udf(packed, "binary")
    rows = _sample(labelled, sample).select("lang", "n", grams("text").alias("counts"))
    rows = checkpointed(rows.filter("counts IS NOT NULL"))

    def unpacked(group: pd.DataFrame) -> np.ndarray:
        ordered = group.sort_values("n")["counts"]
        return np.stack([np.frombuffer(c, np.uint32) for c in ordered])

    def frequencies(group: pd.DataFrame) -> pd.DataFrame:
        x = unpacked(group)
        seen = (x > 0).sum(axis=0).astype(np.int64)
        return pd.DataFrame({"n": [len(x)], "seen": [seen.tobytes()]})

    seen = rows.groupBy("lang").applyInPandas(frequencies, "n long, seen binary").collect()
    if not seen:
        empty = np.zeros((0, BUCKETS), np.float32)
        return Model([], empty, np.ones(BUCKETS, np.float32), np.ones(0))
    total = sum(r.n for r in seen)
    df = sum(np.frombuffer(r.seen, np.int64) for r in seen)
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        x = vectors(list(unpacked(group)), idf)
        c, radius = centre(x, k)
        return pd.DataFrame(
            {
                "lang": [group["lang"].iloc[0]],
                "k": [len(c)],
                "centroids": [c.astype(np.float32).tobytes()],
                "radius": [radius],
            }
        )

    schema = "lang string, k int, centroids binary, radius double"
    fitted = sorted(rows.groupBy("lang").applyInPandas(centroids, schema).collect())
    return Model(
        [r.lang for r in fitted for _ in range(r.k)],
        np.concatenate([np.frombuffer(r.centroids, np.float32) for r in fitted]).reshape(-1, BUCKETS),
        idf,
        np.array([r.radius for r in fitted for _ in range(r.k)]),
    )


def predictor(docs: DataFrame, model: Model):
    """A function from a text column to a struct of lang, score and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def predict(texts: pa.Array) -> pa.Array:
        found = []
        for at in range(0, len(texts), 512):
            found += shared.value.predict(texts[at : at + 512].to_pylist())
        names = ("lang", "score", "rejected")
        return pa.array([dict(zip(names, row)) for row in found], kind)

    udf = F.arrow_udf(predict, "lang string, score double, rejected boolean")
    return lambda text: udf(text.cast("string"))


def learn(docs: DataFrame) -> Model:
    """Fits on the documents that are not held out."""
    return fit(docs.select("doc_id", "text", "lang").filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT))


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``rejected``."""
    predict = predictor(docs, learn(docs))
    rows = docs.select("doc_id", predict(F.col("text")).alias("p"))
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        F.col("p.lang").alias("lang_pred"),
        F.col("p.score").alias("score"),
        F.col("p.rejected").alias("rejected"),
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is not rejected, same columns."""
    predict = predictor(docs, learn(docs))
    return docs.filter(~predict(F.col("text"))["rejected"])
