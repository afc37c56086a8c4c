"""Language-model scoring by a log-bilinear model trained with noise-contrastive estimation.

Tokens are words (A-Z lowered) and one end per text. The corpus counts of all training
texts give a token's count c, the number of tokens N and of distinct tokens V. Each token
belongs to a unit: the end and the ``TOP`` most frequent words are units of their own, all
other words, known or new, share ``BUCKETS`` units by their last bytes. The score of a
token is log P(unit | two units before) + log P(token | unit); the second comes from the
counts, with one slot for new words, so probabilities of all tokens add up to one.

The first is the log-bilinear model: each earlier unit's vector is mapped by the matrix of
its distance, and the sum is compared with all units. Every task trains on its own
documents in numpy with noise shared by a batch, and parameters are averaged over tasks,
weighted by tokens, first by groups of tasks. A round trains on one of ``PARTS`` parts of the
texts. Rounds go over all parts at least once, and go on while the log probability of
texts held back from training (one in ``HELD_BACK``) gains ``GAIN`` a token by a round, so
that a small table is gone over several times. As two units before are the whole context,
batched matrix products give the normalised probabilities of all contexts once per worker,
and scoring looks them up.

Counts of the most frequent words, at most ``FREQUENT``, are sent to all tasks;
the rest of the tokens are joined with the counts by shuffling, so no hot word is ever
shuffled, whatever its share.

Defined results: a null or empty text is one end; repeated rows and ids are each scored;
a null id is a training text; without training texts N is 0 and units are equally likely;
an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, lower_ascii, most_frequent, words, written

FOLDS, HELD_OUT = 5, 1
END = ""  # the end's place among the words, none of which is empty
TOP = 159
BUCKETS = 96
UNITS = 1 + TOP + BUCKETS
SUFFIX = 3  # bytes
FREQUENT = 200_000

SIZE = 16  # of the vectors
NOISE = 32  # samples for a batch
BATCH = 256
RATE = 0.1
PARTS = 2  # of the training texts, one for each round
MAX_ROUNDS = 24
GAIN = 0.01  # log10 a token
HELD_BACK = 32  # one in so many training texts tells when to stop
GROUPS = 64  # of tasks whose parameters are averaged first
_TOKENS = "doc_id long, row long, n_tokens long, n_known long, base double, score double, rare array<string>"


def bucket(word: bytes) -> int:
    return crc32(word[-SUFFIX:]) % BUCKETS


def _bucket(word: Column) -> Column:
    raw = word.cast("binary")
    return (F.crc32(F.substring(raw, -SUFFIX, SUFFIX)) % BUCKETS).cast("int")


def corpus_counts(docs: DataFrame) -> DataFrame:
    """``word`` and its count ``c`` over all training texts; the end is the empty word."""
    tokens = F.concat(words(lower_ascii(F.col("text"))), F.array(F.lit(END)))
    return docs.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count("word").alias("c"))


@dataclass(frozen=True)
class Counts:
    """What the tasks need of the counts: totals, and the frequent words one by one."""

    n: int
    v: int
    words: dict[bytes, int]  # place of each frequent word in the next three
    unit: np.ndarray
    base: np.ndarray  # log10 of P(word)
    inner: np.ndarray  # log10 of P(word | unit)
    known: np.ndarray
    unit_n: np.ndarray  # tokens by unit
    bucket_rest: np.ndarray  # what log10 of P(word | unit) divides by, by bucket

    @property
    def base_rest(self) -> float:
        return self.n + 0.5 * (self.v + 1)


def gather_counts(counts: DataFrame) -> Counts:
    """A bounded part of the written ``counts``: totals by bucket and the frequent words."""
    total = counts.agg(F.sum("c").alias("n"), F.count("c").alias("v")).first()
    n, v = int(total.n or 0), int(total.v)
    real = counts.filter(F.col("word") != END)
    first = most_frequent(real, "c", FREQUENT).toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    names = [w.encode() for w in first["word"].to_pylist()]
    c = np.concatenate([first["c"].to_numpy(), [0.0]]).astype(np.float64)
    ends = counts.filter(F.col("word") == END).first()
    c[-1] = ends.c if ends else 0  # the end is the last one
    top = names[:TOP]
    unit = np.array([1 + i if i < TOP else 1 + TOP + bucket(w) for i, w in enumerate(names)] + [0])
    by_bucket = real.groupBy(_bucket(F.col("word")).alias("k")).agg(
        F.sum("c").alias("n"), F.count("c").alias("v")
    )
    bucket_n, bucket_v = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in by_bucket.collect():
        bucket_n[row.k], bucket_v[row.k] = row.n, row.v
    np.subtract.at(bucket_n, [bucket(w) for w in top], c[: len(top)])
    np.subtract.at(bucket_v, [bucket(w) for w in top], 1)
    rest = bucket_n + 0.5 * (bucket_v + 1)
    unit_n = np.concatenate([[c[-1]], np.zeros(TOP), bucket_n])
    unit_n[1 : 1 + len(top)] = c[: len(top)]
    shared = unit > TOP
    inner = np.zeros(len(c))
    inner[shared] = np.log10((c[shared] + 0.5) / rest[unit[shared] - 1 - TOP])
    base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    places = {w: i for i, w in enumerate(names)}
    return Counts(n, v, places, unit, base, inner, c > 0, unit_n, rest)


def units_of(text: bytes, counts: Counts) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Units of the text's tokens, places of its frequent tokens, and its other words."""
    tokens = text.lower().split()
    places = np.fromiter(map(counts.words.get, tokens, repeat(-1)), np.int64, len(tokens))
    places = np.append(places, len(counts.unit) - 1)
    units = counts.unit[places]
    rare = np.flatnonzero(places < 0)
    others = [tokens[i] for i in rare]
    units[rare] = [1 + TOP + bucket(w) for w in others]
    return units, places[places >= 0], others


def after_ends(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The units of texts in one row, two ends before each, and the places of the units."""
    sizes = np.array([len(t) for t in texts], np.int64)
    places = np.arange(sizes.sum()) + np.repeat(2 * np.arange(1, len(texts) + 1), sizes)
    ids = np.zeros(sizes.sum() + 2 * len(texts), np.int64)
    ids[places] = np.concatenate([*texts, np.zeros(0, np.int64)])
    return ids, places


class LogBilinear:
    """Parameters as one vector of floats, and what is computed with them."""

    shapes = ((UNITS, SIZE), (UNITS, SIZE), (SIZE, SIZE), (SIZE, SIZE), (UNITS,))

    def __init__(self, flat: np.ndarray):
        self.flat = flat.astype(np.float32)
        ends = np.cumsum([0, *(int(np.prod(s)) for s in self.shapes)])
        parts = [self.flat[a:b].reshape(s) for a, b, s in zip(ends, ends[1:], self.shapes)]
        self.context, self.target, self.near, self.far, self.bias = parts

    @classmethod
    def start(cls, noise: np.ndarray) -> LogBilinear:
        size = sum(int(np.prod(s)) for s in cls.shapes)
        model = cls(np.random.default_rng(7).normal(0, 0.1, size))
        model.near[:] = model.far[:] = np.eye(SIZE)
        model.bias[:] = np.log(noise)
        return model

    def log10_table(self) -> np.ndarray:
        """Log10 probability of each unit after each pair of units, far one first."""
        near, far = self.context @ self.near, self.context @ self.far
        table = np.empty((UNITS, UNITS, UNITS), np.float32)
        for i in range(UNITS):
            scores = (far[i] + near) @ self.target.T + self.bias
            top = scores.max(axis=1, keepdims=True)
            total = np.log(np.exp(scores - top).sum(axis=1, keepdims=True)) + top
            table[i] = (scores - total) / np.log(10)
        return table

    def train(self, texts: list[np.ndarray], noise: np.ndarray, seed: int) -> None:
        """One pass of noise-contrastive steps over the units of texts, each after two ends."""
        random = np.random.default_rng(seed)
        log_noise = np.log(NOISE * noise).astype(np.float32)
        heat = [np.full(s, 1e-2, np.float32) for s in self.shapes]
        ids, places = after_ends(texts)
        cumulated = np.cumsum(noise)
        for start in range(0, len(places), BATCH):
            at = places[start : start + BATCH]
            far, near, word = ids[at - 2], ids[at - 1], ids[at]
            n = len(word)
            r_near, r_far = self.context[near], self.context[far]
            q = r_near @ self.near + r_far @ self.far
            drawn = np.searchsorted(cumulated, random.random(NOISE) * cumulated[-1])
            drawn = np.minimum(drawn, UNITS - 1)
            t = self.target[word]
            odds = self.bias - log_noise
            real = (q * t).sum(axis=1) + odds[word]
            false = q @ self.target[drawn].T + odds[drawn]
            # Gradients of the log-likelihood of telling real from noise, averaged.
            with np.errstate(over="ignore"):
                g_real = 1 / (n + n * np.exp(real))
                g_false = -1 / (n + n * np.exp(-false))
            g_q = g_real[:, None] * t + g_false @ self.target[drawn]
            g_target = _sums(word, g_real[:, None] * q)
            np.add.at(g_target, drawn, g_false.T @ q)
            g_bias = np.bincount(word, g_real, UNITS)
            np.add.at(g_bias, drawn, g_false.sum(axis=0))
            g_both = np.concatenate([g_q @ self.near.T, g_q @ self.far.T])
            g_context = _sums(np.concatenate([near, far]), g_both)
            grads = (g_context, g_target, r_near.T @ g_q, r_far.T @ g_q, g_bias)
            own = (self.context, self.target, self.near, self.far, self.bias)
            for value, seen, g in zip(own, heat, grads):
                seen += g * g
                value += RATE * g / np.sqrt(seen)


_CELLS = np.arange(UNITS * SIZE).reshape(UNITS, SIZE)


def _sums(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows of vectors added up by id."""
    return np.bincount(_CELLS[ids].ravel(), rows.ravel(), UNITS * SIZE).reshape(UNITS, SIZE).astype(np.float32)


def train(units: DataFrame, counts: Counts) -> LogBilinear:
    """Rounds of training over the written ``units`` (``part`` and ``units`` of each text)."""
    noise = (counts.unit_n + 1) / (counts.unit_n + 1).sum()
    model, before = LogBilinear.start(noise), -np.inf
    for turn in range(MAX_ROUNDS):
        model = _round(units.filter(F.col("part") == turn % PARTS), model, noise, turn)
        if turn + 1 >= PARTS - 1:
            now = mean_log10(units.filter(F.col("part") == PARTS), model)
            # Without texts to tell, each part is trained on once.
            if turn + 1 >= PARTS and (now is None or now - before < GAIN):
                break
            before = now
    return model


def _round(units: DataFrame, model: LogBilinear, noise: np.ndarray, turn: int) -> LogBilinear:
    """The model trained on ``units`` once in each task, averaged; as it is without any."""
    flat = units.sparkSession.sparkContext.broadcast(model.flat)

    def learn(batches):
        from pyspark import TaskContext

        own, tokens, task = LogBilinear(flat.value.copy()), 0, TaskContext.get().partitionId()
        for batch in batches:
            texts = [np.frombuffer(u.as_py(), np.uint8) for u in batch["units"]]
            own.train(texts, noise, 1000 * turn + task % 997 + tokens % 991)
            tokens += sum(map(len, texts))
        if tokens:
            raw = (own.flat.astype(np.float64) * tokens).tobytes()
            kinds = [("slot", pa.int32()), ("tokens", pa.int64()), ("flat", pa.binary())]
            values = {"slot": task % GROUPS, "tokens": tokens, "flat": raw}
            yield pa.RecordBatch.from_pylist([values], schema=pa.schema(kinds))

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(f, np.float64) for f in group["flat"])
        tokens = int(group["tokens"].sum())
        return pd.DataFrame({"tokens": [tokens], "flat": [total.tobytes()]})

    learnt = units.select("units").mapInArrow(learn, "slot int, tokens long, flat binary")
    sums = learnt.groupBy("slot").applyInPandas(add, "tokens long, flat binary").collect()
    flat.unpersist()
    tokens = sum(s.tokens for s in sums)
    return LogBilinear(sum(np.frombuffer(s.flat, np.float64) for s in sums) / tokens) if sums else model


def mean_log10(units: DataFrame, model: LogBilinear) -> float | None:
    """The model's mean log10 probability of a unit of the written ``units``."""
    flat = units.sparkSession.sparkContext.broadcast(model.flat)

    def measure(batches):
        tokens, total, table = 0, 0.0, _table(flat.value)
        for batch in batches:
            ids, at = after_ends([np.frombuffer(u.as_py(), np.uint8) for u in batch["units"]])
            total += float(table[ids[at - 2], ids[at - 1], ids[at]].sum(dtype=np.float64))
            tokens += len(at)
        yield pa.RecordBatch.from_pydict({"tokens": pa.array([tokens], pa.int64()), "total": pa.array([total], pa.float64())})

    found = units.select("units").mapInArrow(measure, "tokens long, total double")
    sums = found.agg(F.sum("tokens").alias("tokens"), F.sum("total").alias("total")).first()
    flat.unpersist()
    return sums.total / sums.tokens if sums.tokens else None


def _unit_rows(docs: DataFrame, counts) -> DataFrame:
    def encode(texts: pa.Array) -> pa.Array:
        raw = texts.cast(pa.binary())
        rows = [units_of(t.as_py() or b"", counts.value)[0] for t in raw]
        return pa.array([u.astype(np.uint8).tobytes() for u in rows], pa.binary())

    lot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(PARTS * HELD_BACK))
    part = F.when(lot < PARTS, PARTS).otherwise(lot % PARTS).alias("part")
    return docs.select(part, F.arrow_udf(encode, "binary")(F.col("text").cast("string")).alias("units"))


_TABLES: dict[int, np.ndarray] = {}  # of this worker, by checksum of the parameters


def _table(flat: np.ndarray) -> np.ndarray:
    key = crc32(flat.tobytes())
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = LogBilinear(flat).log10_table()
    return _TABLES[key]


def _scored(docs: DataFrame, counts, model) -> DataFrame:
    """A row per document: what frequent tokens give, and its other words."""

    def score(batches):
        table, known = _table(model.value), counts.value
        for batch in batches:
            out = []
            for text in batch["text"].cast(pa.binary()):
                units, places, others = units_of(text.as_py() or b"", known)
                ids = np.concatenate([[0, 0], units])
                gain = table[ids[:-2], ids[1:-1], units].sum(dtype=np.float64)
                out.append(
                    (
                        len(units),
                        int(known.known[places].sum()),
                        float(known.base[places].sum()),
                        float(gain + known.inner[places].sum()),
                        others,
                    )
                )
            columns = [list(c) for c in zip(*out)] or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            arrays[4] = arrays[4].cast(pa.list_(pa.string()))
            names = ["doc_id", "row", "n_tokens", "n_known", "base", "score", "rare"]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], *arrays], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(score, _TOKENS.replace("doc_id long", f"doc_id {kind}"))


def score_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document with its counts, base score and score (log10 probabilities)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    sc = docs.sparkSession.sparkContext
    training = docs.filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    counts = written(corpus_counts(training))
    gathered = gather_counts(counts)
    shared = sc.broadcast(gathered)
    model = train(written(_unit_rows(training, shared)), gathered)
    rows = written(_scored(docs, shared, sc.broadcast(model.flat)))

    # The other words, one row each, with their counts; by row again.
    rest = F.get(F.array(*[F.lit(float(r)) for r in gathered.bucket_rest]), _bucket(F.col("word")))
    c = F.coalesce(F.col("c"), F.lit(0))
    rare = rows.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
    sums = rare.groupBy("row").agg(
        F.sum((c > 0).cast("long")).alias("more_known"),
        F.sum(F.log10((c + 0.5) / gathered.base_rest)).alias("more_base"),
        F.sum(F.log10((c + 0.5) / rest)).alias("more_score"),
    )
    zero = F.lit(0)
    return rows.drop("rare").join(sums, "row", "left").select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(gathered.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero)).alias("score"),
    )
