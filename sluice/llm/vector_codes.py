"""Vector codes: vectors cut into parts, each coded as its nearest entry of a small codebook.

Codebooks are refined over all rows: a round finds every part's nearest entry, adds up the
parts per entry (in tasks first, then in Spark), and replaces each entry by their mean. Only
the codebooks themselves pass through the driver: a fixed number of entries, each as wide as
a part.

Orchard search finds the nearest entry. Every entry has a list of all others, nearest first.
A search stands at its best entry and goes down that entry's list: a closer entry is jumped
to, and its list taken instead; entries seen before are marked and left out. An entry
further from the best one than twice the distance from there to the part can't be closer to
the part than the best one is, nor can any entry after it, so there the search stops. Parts
are searched side by side, a few list places at a time. Entries at exactly twice the distance
are still looked at, so ties go to the lower index. All arithmetic is on whole numbers.

Defined results: rows whose vector is null or holds a null or non-finite component are left
out. Vectors shorter than the longest, or than the next multiple of the parts, count as
ending in zeros. A table of fewer rows than entries gives smaller codebooks. The first
entries go by id, null ids last, rows of one id by their vector; repeated rows are rows of
their own. Null labels are one label. An empty table gives no rows. Other columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, written
from .vectors import EXACT_DOUBLE, matrix, to_longs, usable, whole

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4

# Places of a neighbour list that are looked at in one go, and parts searched side by side.
STEP, TOGETHER = 32, 1024

_SUMS = "cell int, parts long, sums array<decimal(38,0)>"
_CODES = "vec_id long, label string, code string, error long"


class Codebook:
    """The entries for one part position, with their neighbour lists."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.largest = np.abs(entries).max(initial=0.0)
        exact = exactly(entries, 2 * self.largest)
        between = np.array([((exact - entry) ** 2).sum(axis=1) for entry in exact])
        self.order = np.argsort(between, axis=1, kind="stable")
        self.between = np.take_along_axis(between, self.order, axis=1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each part's nearest entry."""
        found = [self._search(parts[i : i + TOGETHER]) for i in range(0, len(parts), TOGETHER)]
        return tuple(np.concatenate(column) for column in zip(*found))

    def _search(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, size = len(parts), len(self.entries)
        largest = np.abs(parts).max(initial=0.0) + self.largest
        parts, entries = exactly(parts, largest), exactly(self.entries, largest)
        own, other = (parts**2).sum(axis=1), (entries**2).sum(axis=1)
        best = np.zeros(n, np.int64)
        distance = ((parts - entries[0]) ** 2).sum(axis=1)
        place = np.zeros(n, np.int64)  # how far down the best entry's list
        seen = np.zeros((n, size), bool)
        seen[:, 0] = True
        searching = np.arange(n)
        while len(searching):
            at = place[searching, None] + np.arange(STEP)
            beyond = at >= size
            lists = best[searching, None] * size + np.minimum(at, size - 1)
            entry = self.order.ravel()[lists]
            # Squared, twice the distance is four times.
            now, held = distance[searching], best[searching]
            beyond |= (self.between.ravel()[lists] > 4 * now[:, None]).astype(bool)
            marks = searching[:, None] * size + entry
            left_out = beyond | seen.ravel()[marks]
            seen.ravel()[marks[~left_out]] = True
            products = np.einsum("nw,nsw->ns", parts[searching], entries[entry])
            found = own[searching, None] - 2 * products + other[entry]
            found[left_out] = np.inf
            least = found.min(axis=1)
            candidate = np.where(found == least[:, None], entry, size).min(axis=1)
            closer = ((least < now) | (least == now) & (candidate < held)).astype(bool)
            moved = searching[closer]
            best[moved], distance[moved] = candidate[closer], least[closer]
            place[searching] += STEP
            place[moved] = 0
            searching = searching[closer | ~beyond[:, -1]]
        return best, distance


def exactly(rows: np.ndarray, largest: float) -> np.ndarray:
    """Whole-number rows in a type that holds squared distances of up to twice the length
    of a row whose numbers are as large as ``largest``."""
    return rows if 4 * rows.shape[-1] * largest**2 < EXACT_DOUBLE else whole(rows)


def cut(vectors: pa.Array, parts: int, width: int) -> list[np.ndarray]:
    """The whole-number vectors cut into ``parts`` matrices of ``width`` columns."""
    return np.split(matrix(vectors, SCALE, parts * width), parts, axis=1)


def add_up(codebooks: Sequence[Codebook], width: int):
    """The function of one task of a round: sums of the parts nearest to each entry."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(codebooks[0].entries)
        sums = np.zeros((len(codebooks) * size, width), object)
        counts = np.zeros(len(sums), np.int64)
        for batch in batches:
            for p, (book, part) in enumerate(zip(codebooks, cut(batch["vector"], len(codebooks), width))):
                nearest, _ = book.nearest(part)
                np.add.at(counts, p * size + nearest, 1)
                # Exact: fewer than 2^13 components below 2^40 are added at a time.
                for start in range(0, len(part), TOGETHER):
                    some = slice(start, start + TOGETHER)
                    added = np.zeros((size, width))
                    np.add.at(added, nearest[some], part[some])
                    sums[p * size : (p + 1) * size] += whole(added)
        used = np.flatnonzero(counts)
        columns = [
            pa.array(used.astype(np.int32)),
            pa.array(counts[used]),
            pa.array([list(map(str, sums[c])) for c in used], pa.list_(pa.string())).cast(
                pa.list_(pa.decimal128(38, 0))
            ),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["cell", "parts", "sums"])

    return task


def code(codebooks: Sequence[Codebook], width: int):
    """The function of one task that codes its rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(codebooks, cut(batch["vector"], len(codebooks), width))
            found = [book.nearest(part) for book, part in pairs]
            indexes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            error = to_longs(sum(whole(square) for _, square in found))
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], pa.array([row.tobytes().hex() for row in indexes], pa.string()), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    return task


def refined(kept: DataFrame, codebooks: list[Codebook], width: int) -> list[Codebook]:
    """The codebooks after one round over all rows."""
    size = len(codebooks[0].entries)
    added = (
        kept.mapInArrow(add_up(codebooks, width), _SUMS)
        .select("cell", "parts", F.posexplode_outer("sums").alias("at", "sum"))
        .groupBy("cell", "at")
        .agg(F.sum("parts").alias("parts"), F.sum("sum").alias("sum"))
    )
    entries = [book.entries.copy() for book in codebooks]
    for row in added.collect():  # as many numbers as the codebooks hold
        if row["at"] is not None:
            part, entry = divmod(row["cell"], size)
            entries[part][entry, row["at"]] = int(row["sum"]) // row["parts"]
    return [Codebook(e) for e in entries]


def digest(codebooks: Sequence[Codebook]) -> str:
    numbers = (str(int(x)) for book in codebooks for x in book.entries.ravel())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def train(kept: DataFrame, parts: int, entries: int, rounds: int) -> tuple[list[Codebook], int]:
    """Codebooks learnt from all rows of ``kept`` (vec_id, vector), and the width of a part.

    There are none if there are no rows.
    """
    width = kept.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return [], 0
    width = -(-width // parts)
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vector").limit(entries).collect()
    start = pa.array([r.vector for r in first], pa.list_(pa.float64()))
    codebooks = [Codebook(part) for part in cut(start, parts, width)]
    for _ in range(rounds):
        codebooks = refined(kept, codebooks, width)
    return codebooks, width


def compress(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per usable vector: vec_id, code (two hex digits a part), error (squared, over
    all parts), label_error (errors of the label's rows) and codebooks_sha256."""
    if not 1 <= entries <= 256:
        raise ValueError("a code's part is one byte: 1 to 256 entries")
    kept = embeddings.filter(usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(vector).alias("vector"),
    )
    codebooks, width = train(kept, parts, entries, rounds)
    coded = kept.mapInArrow(code(codebooks, width), _CODES) if codebooks else kept.selectExpr(
        "vec_id", "label", "'' AS code", "0L AS error"
    )
    coded = written(coded)
    # Errors are added up per label before anything is shuffled.
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(broadcast_if_small(written(totals)), F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
