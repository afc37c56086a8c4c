"""Token counts per section, from one encoding of each whole document.

A document is encoded once, so counts are those of the real token stream, which encoding
each section alone would not give. A byte-level vocabulary splits the text's bytes without
a rest, so running sums of token lengths are exact byte offsets, and counting the bytes
that start a character maps them to characters. Token spans are then joined with section
spans by interval, both being sorted.

Sections are the lines of the text: each reaches up to and includes its newline. A token
that crosses boundaries belongs to the section that holds most of its characters, the
earliest of them if several do. A character split into several tokens belongs to the token
in which it starts; a token in which none starts goes where its first byte lies. So every
token belongs to exactly one section, and the counts of sections add up to the document's.

Defined results: a null or empty text has no sections and no tokens; repeated rows are
counted alike; no part of a long text is left out; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

VOCABULARY = "byte_bpe_50k.tiktoken"

_SECTION = StructType([StructField(n, LongType()) for n in ("start", "end", "tokens")])
COUNTS = StructType(
    [
        StructField("n_tokens", LongType()),
        StructField("n_crossing", LongType()),
        StructField("sections", ArrayType(_SECTION)),
    ]
)


def vocabulary_path() -> str:
    """Where the public vocabulary lies on this machine, as on every executor."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@lru_cache(maxsize=2)
def encoder(path: str):
    """The encoder of a vocabulary file and the byte length of each of its tokens."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    lengths[list(ranks.values())] = [len(token) for token in ranks]
    return encoding, lengths


def token_spans(text: str, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end in characters of each token, and the character of its first byte."""
    encoding, lengths = encoder(path)
    ids = np.asarray(encoding.encode_ordinary(text), np.int64)
    ends = np.cumsum(lengths[ids])
    raw = np.frombuffer(text.encode(), np.uint8)
    # Characters that start before each byte offset.
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    starts = ends - lengths[ids]
    return before[starts], before[ends], np.maximum(before[np.minimum(starts + 1, len(raw))] - 1, 0)


def line_bounds(text: str) -> np.ndarray:
    """Where lines start, and the end of the last one, in characters."""
    characters = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    breaks = np.flatnonzero(characters == 10) + 1
    last = [] if len(breaks) and breaks[-1] == len(characters) else [len(characters)]
    return np.concatenate([[0], breaks, last]).astype(np.int64)


def attribute(starts, ends, first, bounds) -> tuple[np.ndarray, int]:
    """Tokens per section and how many tokens cross a boundary.

    ``bounds`` are the sorted edges of adjoining sections; each token span overlaps a run
    of them, found by two binary searches. Only crossing tokens are looked at one by one.
    """
    n = len(bounds) - 1
    at = np.searchsorted(bounds, first, "right") - 1
    low = np.searchsorted(bounds, starts, "right") - 1
    high = np.searchsorted(bounds, np.maximum(ends - 1, starts), "right") - 1
    crossing = np.flatnonzero((ends > starts) & (high > low))
    owner = np.where(ends > starts, low, at)
    for k in crossing:
        edges = bounds[low[k] : high[k] + 2].clip(starts[k], ends[k])
        owner[k] = low[k] + int(np.argmax(np.diff(edges)))
    return np.bincount(owner, minlength=n), len(crossing)


def count_text(text: str | None, path: str) -> dict:
    if not text:
        return {"n_tokens": 0, "n_crossing": 0, "sections": []}
    starts, ends, first = token_spans(text, path)
    bounds = line_bounds(text)
    tokens, crossing = attribute(starts, ends, first, bounds)
    sections = zip(bounds[:-1].tolist(), bounds[1:].tolist(), tokens.tolist())
    return {
        "n_tokens": len(starts),
        "n_crossing": crossing,
        "sections": [dict(zip(("start", "end", "tokens"), s)) for s in sections],
    }


def token_counts(text: Column, path: str | None = None) -> Column:
    """A struct of ``n_tokens``, ``n_crossing`` and the sections with their tokens."""
    path = path or vocabulary_path()
    section = pa.struct([(n, pa.int64()) for n in ("start", "end", "tokens")])
    kind = pa.struct(
        [("n_tokens", pa.int64()), ("n_crossing", pa.int64()), ("sections", pa.list_(section))]
    )

    def count(texts: pa.Array) -> pa.Array:
        return pa.array([count_text(t.as_py(), path) for t in texts], kind)

    return F.arrow_udf(count, COUNTS)(text.cast("string"))


def count_tokens(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: id, tokens, tokens that cross sections, sections in order."""
    counted = docs.select(F.col(doc_id).alias("doc_id"), token_counts(F.col(text)).alias("c"))
    return counted.select("doc_id", "c.*")
