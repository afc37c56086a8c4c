"""SimHash near-duplicates by an inverted index over positional bytes.

A fingerprint is eight bytes, each with its position. Two fingerprints that differ in at
most four bits differ in at most four bytes, so they are guaranteed to share four
positional bytes: the minimum count a pair has to reach. Tallying single bytes would meet
a thirty-second of all pairs, so the index holds each set of four positional bytes
(70 to a fingerprint): a pair is in a common posting exactly if it shares four bytes or
more. Pairs that are met are verified by their differing bits.

Equal fingerprints are one entry. Only the links that connect a posting's members are
kept, never all its pairs: from each member, links go to the members that nothing has
reached yet. A posting over ``BLOCK`` members is dealt into blocks, and pairs of blocks
are searched by different tasks, so a task holds two blocks of eight bytes a member.

Defined results: A-Z are lowered, words are runs of other characters than the six spaces;
a null or empty text and one of spaces has the fingerprint zero, which links like any
other; repeated rows and ids are kept, each with its component; ``component_id`` is the
smallest id that is not null, null if there is none; an empty table gives no rows; other
columns of the input are ignored, or passed through by ``one_per_group``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType
from xxhash import xxh64_intdigest

from .common import broadcast_if_small, checkpointed, written
from .components import components

SHINGLE = 4
SEED = 42
MAX_BITS = 4
BYTES = 8
SHARED = BYTES - MAX_BITS  # positional bytes that linked fingerprints share at least
BLOCK = 100_000
_CHUNK = 1 << 16  # hashes whose bits are counted at once


def fingerprint_of(text: bytes) -> int:
    """The signed 64-bit fingerprint of one text."""
    words = text.lower().split()  # of bytes: A-Z, and the six spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    n = max(1, len(words) - SHINGLE + 1)
    last = ends[min(SHINGLE, len(words)) - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        spans = zip(starts[at : min(at + _CHUNK, n)], last[at : at + _CHUNK])
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits((2 * votes > n).astype(np.uint8))
    return int(packed.view(">i8")[0])


def _fingerprints(texts: pa.Array) -> pa.Array:
    rows = texts.cast(pa.binary()).to_pylist()
    return pa.array([fingerprint_of(t or b"") for t in rows], pa.int64())


def fingerprint(text: Column) -> Column:
    return F.arrow_udf(_fingerprints, LongType())(text.cast("string"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


# One mask for each choice of four positions.
MASKS = [
    _signed(sum(0xFF << 8 * p for p in chosen)) for chosen in combinations(range(BYTES), SHARED)
]


def _index(prints: DataFrame) -> DataFrame:
    """A row for each fingerprint and choice of positions: the choice and the shared bytes."""
    entries = F.array(
        *[
            F.struct(F.lit(k).cast("byte").alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes"))
            for k, m in enumerate(MASKS)
        ]
    )
    return prints.select("fp", F.explode(entries).alias("e")).select("e.choice", "e.bytes", "fp")


def stars(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what a chain of close pairs connects: from each member that is
    reached to the one it was reached from first."""
    left, found, sources = prints, [], []
    while len(left) > 1:
        queue, left = [left[:1]], left[1:]
        while queue and len(left):
            for one in queue.pop():
                near = np.bitwise_count(left ^ one) <= MAX_BITS
                if near.any():
                    found.append(left[near])
                    sources.append(np.full(len(found[-1]), one))
                    queue.append(found[-1])
                    left = left[~near]
                    if not len(left):
                        break
    if not found:
        return prints[:0], prints[:0]
    return np.concatenate(found), np.concatenate(sources)


_LINK = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _star_links(postings: pa.Array) -> pa.Array:
    values, ends = postings.values.to_numpy(zero_copy_only=False), postings.offsets.to_numpy()
    found = [stars(values[i:j].view(np.uint64)) for i, j in zip(ends[:-1], ends[1:])]
    offsets = np.concatenate([[0], np.cumsum([len(a) for a, _ in found])]).astype(np.int32)
    columns = [np.concatenate([np.empty(0, np.uint64), *c]).view(np.int64) for c in zip(*found)]
    columns = [pa.array(c, pa.int64()) for c in columns or [np.empty(0, np.int64)] * 2]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, ["a", "b"]))


def links(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` that connect the same
    fingerprints as all pairs within ``MAX_BITS`` do."""
    key = ["choice", "bytes"]
    index = _index(prints)
    sizes = checkpointed(
        index.groupBy(*key)
        .agg(F.count("fp").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("n > 1")
    )
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = sizes.filter("n = 2").select("a", "b").filter(distance <= MAX_BITS)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    large = (
        index.join(broadcast_if_small(sizes.filter("n > 2").select(*key, "n")), key)
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .groupBy(*key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .agg(F.collect_list("fp").alias("members"))
    )
    connect = F.arrow_udf(_star_links, ArrayType(_LINK))
    starred = large.select(F.explode(connect("members")).alias("l")).select("l.a", "l.b")
    return pairs.unionByName(starred).distinct()


def _labels(prints: DataFrame) -> DataFrame:
    """``fp`` and ``least``, the smallest ``least`` of the component it is in."""
    prints = checkpointed(prints)
    nodes = components(links(prints.select("fp")))
    rooted = prints.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    return rooted.join(rooted.groupBy("root").agg(F.min("least").alias("best")), "root").select(
        "fp", F.col("best").alias("least")
    )


def link_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` in hexadecimal, ``component_id``."""
    rows = written(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fp")))
    labels = _labels(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    return rows.join(labels, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def one_per_group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents without near-duplicates, same columns: of each component the row with
    the smallest id (null last) stays, one of them if several rows have it."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = written(
        docs.select(
            whole.alias("doc"),
            fingerprint(F.col(text)).alias("fp"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    order = F.struct(
        F.col(f"doc.{doc_id}").isNull().alias("no_id"),
        F.col(f"doc.{doc_id}").alias("id"),
        F.col("row").alias("row"),
    )
    labels = _labels(rows.groupBy("fp").agg(F.min(order).alias("least")))
    keep = labels.select(F.col("least.row").alias("row")).distinct()
    return rows.join(keep, "row", "left_semi").select("doc.*")
