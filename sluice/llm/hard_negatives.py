"""Hard negatives: for each anchor and positive, the best rows within a window of scores.

A score is the inner product of scaled whole-number vectors. An anchor's positives are its
best rows of the same label; a negative fits a positive if its score lies between two
percentages of the positive's score.

Slot-decomposed selection. The windows of an anchor overlap, but their upper limits cut the
line of scores into disjoint slots, and a window takes the best rows at or below its limit:
its own slot and all lower ones. So it is enough to keep the best ``k`` rows of every slot.
Each task does so for the rows it holds, Spark keeps the best ``k`` of what the tasks found,
and a window's answer is the merge of the slots from its own downwards, cut at ``k`` and at
its lower limit. As slots are disjoint and in descending order, merging is appending.

Every row meets every anchor once per pass (first for positives, then for negatives), in
blocks: rows are dealt evenly, by position, into pieces that a task can hold, and anchors
are sent to each piece and stream past it. What a task holds is bounded by a piece, and
what is shuffled is the rows, the anchors per piece, and ``k`` rows per anchor, slot and
piece. Labels play no part in the dealing, so a label with many rows is no burden.

Defined results: rows without an id or label, and those whose vector is null or holds a
null or non-finite component, take no part; an empty vector scores zero; missing components
of a shorter vector count as zero. Ties go to the smaller id. Repeated rows are rows of
their own, as positives and as negatives; rows of the anchor's id are never its positives;
equal rows are one anchor. A positive with a negative score has no window. An anchor without
positives, or whose windows hold no row, has no result; an empty table gives no rows; other
columns of the input are ignored. Scores beyond 64 bits count as the largest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written
from .vectors import EXACT_DOUBLE, EXACT_FLOAT, matrix, to_longs, usable, whole

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90

# Components of a piece (32 MB as doubles), and rows below which pieces aren't split further
# to occupy idle cores.
PIECE, LEAST_ROWS = 1 << 22, 1 << 12
# Scores computed at a time.
SCORES = 1 << 20

_FOUND = "anchor long, slot int, id long, score long"


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of whole-number rows of ``a`` and ``b``, exactly."""
    bound = a.shape[1] * np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0)
    if bound < EXACT_FLOAT:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if bound < EXACT_DOUBLE:
        return a @ b.T
    return to_longs(whole(a) @ whole(b).T)


def best(scores: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest scores per row among those that fit.

    Among equal scores the leftmost are taken.
    """
    lowest = -np.inf if scores.dtype.kind == "f" else np.iinfo(scores.dtype).min
    scores = np.where(fits, scores, scores.dtype.type(lowest))
    n = scores.shape[1]
    if n <= k:
        return np.nonzero(fits)
    kth = np.partition(scores, n - k, axis=1)[:, n - k, None]
    above, equal = scores > kth, scores == kth
    room = k - above.sum(axis=1, keepdims=True)
    return np.nonzero((above | equal & (np.cumsum(equal, axis=1) <= room)) & fits)


def search(width: int, k: int, positives: bool):
    """The function of one task: its piece of the rows first, then the anchors."""

    def chunk(ids, labels, rows, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        anchors = matrix(batch["vector"], SCALE, width)
        scores = inner_products(anchors, rows)
        same = batch["label"].to_numpy()[:, None] == labels
        if positives:
            own = batch["id"].to_numpy()[:, None] == ids
            slots = [same & ~own]
        else:
            limits = batch["limits"].to_pylist()
            # Anchors with fewer slots than others get empty ones.
            most = max(map(len, limits))
            limits = np.array([x + x[-1:] * (most - len(x)) for x in limits], np.int64)
            slots = [
                ~same & (scores <= limits[:, j, None]) & (scores > limits[:, j + 1, None])
                for j in range(most - 1)
            ]
        numbers = batch["anchor"].to_numpy()
        for j, fits in enumerate(slots):
            at, found = best(scores, fits, k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers[at]),
                    pa.array(np.full(len(at), j, np.int32)),
                    pa.array(ids[found]),
                    pa.array(to_longs(scores[at, found])),
                ],
                ["anchor", "slot", "id", "score"],
            )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, piece = [], None
        for batch in batches:
            n_rows = batch["anchor"].null_count  # rows come before anchors
            if n_rows:
                held = batch.slice(0, n_rows)
                parts.append((held["id"].to_numpy(), held["label"].to_numpy(), matrix(held["vector"], SCALE, width)))
            anchors = batch.slice(n_rows)
            if not anchors.num_rows or not parts:
                continue
            if piece is None:
                piece = [np.concatenate(column) for column in zip(*parts)]
            step = max(1, SCORES // len(piece[0]))
            for start in range(0, anchors.num_rows, step):
                yield from chunk(*piece, anchors.slice(start, step))

    return task


def _meet(rows: DataFrame, anchors: DataFrame, pieces: int, width: int, k: int, positives: bool) -> DataFrame:
    """The best ``k`` rows per anchor and slot: columns anchor, slot, id, score."""
    sent = anchors.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    # Rows that were written lie in files, so their positions are the same on a retry.
    dealt = rows.select(
        "id", "label", "vector", (F.monotonically_increasing_id() % pieces).cast("int").alias("piece")
    )
    found = (
        dealt.unionByName(sent, allowMissingColumns=True)
        .repartitionById(pieces, F.col("piece"))
        .sortWithinPartitions(F.col("anchor").isNotNull(), "id")
        .mapInArrow(search(width, k, positives), _FOUND)
    )
    place = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id"))
    # Tasks keep their best k before the shuffle.
    return found.withColumn("place", place).filter(F.col("place") <= k).drop("place")


def _share(score: Column, percent: int) -> Column:
    return score.cast("decimal(20,0)") * percent / 100


def mine(
    embeddings: DataFrame,
    anchors: Column,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` selects, which may be any share of them.

    Returns anchor_id, positive_id, rank, negative_id, positive_score and negative_score.
    """
    rows = written(
        embeddings.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & usable(F.col(vector))).select(
            F.col(vec_id).cast("long").alias("id"),
            F.col(label).cast("long").alias("label"),
            F.col(vector).alias("vector"),
            F.coalesce(anchors, F.lit(False)).alias("asks"),
        )
    )
    asking = rows.filter("asks").select("id", "label", "vector").distinct()
    asking = written(asking.withColumn("anchor", F.monotonically_increasing_id()))
    n, width = rows.agg(F.count("id"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    pieces = max(1, -(-n * max(width, 1) // PIECE), min(cores, -(-n // LEAST_ROWS)))

    # At most n_positives rows per anchor from here on.
    windows = (
        _meet(rows, asking, pieces, width, n_positives, True)
        .select(
            "anchor",
            F.struct(
                F.col("id").alias("positive_id"),
                F.col("score").alias("positive_score"),
                F.ceil(_share(F.col("score"), low)).cast("long").alias("low"),
                F.floor(_share(F.col("score"), high)).cast("long").alias("high"),
            ).alias("w"),
        )
        .filter("w.low <= w.high")
        .groupBy("anchor")
        .agg(F.collect_list("w").alias("windows"))
    )
    # Upper limits from the top, then what lies below every window.
    limits = F.concat(
        F.sort_array(F.array_distinct(F.col("windows.high")), asc=False),
        F.array(F.array_min(F.col("windows.low")) - 1),
    )
    asking = written(asking.join(windows, "anchor").withColumn("limits", limits))
    found = _meet(
        rows, asking.select("anchor", "id", "label", "vector", "limits"), pieces, width, n_negatives, False
    )
    # At most n_negatives rows for each of an anchor's slots, in descending order.
    slots = found.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), "id"))).alias("slots")
    )
    merged = asking.join(slots, "anchor").select(
        F.col("id").alias("anchor_id"), "limits", "slots", F.explode("windows").alias("w")
    )
    own = F.array_position("limits", F.col("w.high")) - 1
    suffix = F.slice(F.filter("slots", lambda r: r["slot"] >= own), 1, n_negatives)
    inside = F.filter(suffix, lambda r: -r["down"] >= F.col("w.low"))
    return merged.select("anchor_id", "w", F.posexplode(inside).alias("at", "negative")).select(
        "anchor_id",
        F.col("w.positive_id").alias("positive_id"),
        (F.col("at") + 1).alias("rank"),
        F.col("negative.id").alias("negative_id"),
        F.col("w.positive_score").alias("positive_score"),
        (-F.col("negative.down")).alias("negative_score"),
    )
