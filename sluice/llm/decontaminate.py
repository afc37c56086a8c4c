"""Benchmark decontamination by edit distance over windows as long as the items.

Texts become words: letters lowered, ASCII punctuation removed. An item is found in a text if
some passage of the text is within ``max_edits`` word edits of it, a fifth of its words.
For each item length, windows of that length at every word of a text are looked at:

1. A window without enough of an item's rare words can't be that near: k edits take away
   at most k of them. This drops nothing that could match, only nearly all windows; an
   item with k rare words or fewer lets all windows through, which is slower.
2. The CGK embedding walks over a window's words; at each step a random function of step
   and word decides whether the walk moves on, so texts a few edits apart soon walk in
   step again and edit distance becomes Hamming distance.
3. Bit-sampling LSH reads a few sampled steps of the walk as a key, ``TABLES`` samples a
   walk. A walk covers ``REACH`` words, as walks over texts a fifth of which is edited stay
   in step no longer; in longer windows walks start at places spread over the window. How
   many walks an item length needs for the ``recall`` asked for is found by simulation:
   items of that length with as many edits as may be, substitutions alone and all kinds.
   Windows shift by single words, so a passage is also met in neighbouring windows.
4. Windows that share a key with an item are verified exactly, by the edit distance
   between the item and the best passage around the window. Of items that may have an edit
   and for whose length no number of walks up to ``MOST_WALKS`` is enough, as of those under
   ``SHORT`` words, all windows of step 1 are verified.

The benchmark is gone through in blocks of at most ``BLOCK_BYTES``, measured first. One
block's index at a time is built and broadcast, and every document is read once per block.
With a single block nothing is shuffled. With more, each block's matches are written and
its index is given up before the next is built; matches follow from the text alone, so at
the end they are joined with the documents by the text's digest.

Defined results: null and empty texts match nothing; items that are null or
without words are not used, all others are, and those under five words have to be met word
for word; equal items match alike; repeated rows are judged alike;
whole texts are searched; with an empty table or benchmark nothing matches. Other columns
are passed through by ``remove_contaminated`` and otherwise ignored.
"""

from __future__ import annotations

import string
from collections import Counter, defaultdict
from functools import lru_cache, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import broadcast_if_small, written

SHORT = 8  # words
MAX_EDIT_SHARE = 0.2
RECALL = 0.95  # of passages with as many edits as may be
REACH = 24  # words a walk covers
LEAST_WALKS, MOST_WALKS = 4, 24
SIMULATED = 120  # passages for each item length and kind of edits
TABLES = 5  # for each walk
SAMPLED = 3  # steps read by a table
STRETCH = 3  # steps of a walk for each word
COMMON_SHARE = 0.02  # a word of more items than this, and of more than two, is not rare
BLOCK_BYTES = 8 << 20

_PUNCTUATION = string.punctuation.encode()
_MIX = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier that mixes bits

MATCH = StructType([StructField(n, LongType()) for n in ("item_id", "start", "edits")])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(None, _PUNCTUATION).split()


def max_edits(length: int) -> int:
    return int(MAX_EDIT_SHARE * length)


def passage_edits(item: np.ndarray, words: np.ndarray) -> int:
    """Edits between the item and the passage of ``words`` that is nearest to it."""
    steps = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, np.int64)
    for i, word in enumerate(item, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (words != word))])
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


class Walks:
    """The random walks over windows, and the keys read off them.

    The random functions are a bit for each walk, step and word; they are the same in every
    process. The largest word id stands for the place after the end of a walk's words.
    """

    def __init__(self, n_words: int, end: int) -> None:
        self.end = end
        shape = (MOST_WALKS, STRETCH * REACH // 64 + 1, n_words)
        random = np.random.default_rng(11)
        self.moves = random.integers(0, 1 << 64, shape, np.uint64, endpoint=False)

    def embed(self, rows: np.ndarray, n_walks: int) -> np.ndarray:
        """CGK embeddings of rows of word ids of one length: by walk, row and step."""
        n, length = rows.shape
        reach = min(length, REACH)
        # The first walk starts at the window's first word, the last one ends at its last.
        first = np.round(np.linspace(0, length - reach, n_walks)).astype(np.int64)[:, None]
        limit = first + reach
        padded = np.concatenate([rows, np.full((n, 1), self.end)], axis=1)
        # Walks mostly end at two thirds of three steps a word; what follows is padding.
        out = np.empty((n_walks, n, 2 * reach), np.int64)
        at, row = np.broadcast_to(first, (n_walks, n)), np.arange(n)
        walk = np.arange(n_walks)[:, None]
        for step in range(2 * reach):
            out[:, :, step] = word = np.where(at == limit, self.end, padded[row, at])
            moves = self.moves[walk, step >> 6, word] >> np.uint64(step & 63)
            at = np.minimum(at + (moves & np.uint64(1)).astype(np.int64), limit)
        return out

    def keys(self, rows: np.ndarray, n_walks: int) -> np.ndarray:
        """LSH keys of each row, a column for each table of each walk."""
        n, length = rows.shape
        steps = 2 * min(length, REACH)
        random = np.random.default_rng(length)
        sampled = min(SAMPLED, steps)
        chosen = [
            [random.choice(steps, sampled, replace=False) for _ in range(TABLES)]
            for _ in range(n_walks)
        ]
        read = self.embed(rows, n_walks)[np.arange(n_walks)[:, None, None], :, np.array(chosen)]
        read = read.transpose(3, 0, 1, 2).reshape(n, n_walks * TABLES, sampled)
        key = np.broadcast_to(np.arange(n_walks * TABLES, dtype=np.uint64), (n, n_walks * TABLES))
        for k in range(sampled):
            key = (key + read[:, :, k].astype(np.uint64)) * _MIX
            key = key ^ key >> np.uint64(29)
        return key


def edited(random: np.random.Generator, item: np.ndarray, edits: int, all_kinds: bool) -> np.ndarray:
    """The item with so many words replaced by foreign ones, taken out or put in."""
    out = list(item)
    for place in sorted(random.choice(len(item), edits, replace=False), reverse=True):
        kind = random.integers(3) if all_kinds else 0
        out[place : place + (kind != 2)] = [] if kind == 1 else [0]
    return np.array(out)


@lru_cache(maxsize=1024)
def walks_needed(length: int, recall: float) -> int | None:
    """Walks that find at least ``recall`` of passages of this length with as many edits as
    may be; None if ``MOST_WALKS`` are too few, or the length is too short for walks."""
    edits = max_edits(length)
    if edits == 0:
        return LEAST_WALKS
    if length < SHORT:
        return None
    # Each item has words of its own, and with them random functions of its own.
    random = np.random.default_rng(length)
    items = np.arange(1, SIMULATED * length + 1).reshape(SIMULATED, length)
    walks = Walks(items.size + 2, items.size + 1)
    own, pad = walks.keys(items, MOST_WALKS), np.zeros(length, np.int64)
    found = []
    for all_kinds in (False, True):
        windows, of = [], []
        for i, item in enumerate(items):
            text = np.concatenate([pad, edited(random, item, edits, all_kinds), pad])
            around = np.lib.stride_tricks.sliding_window_view(text, length)
            windows.append(around[(around > 0).sum(axis=1) >= length - edits])
            of += [i] * len(windows[-1])
        met = walks.keys(np.concatenate(windows), MOST_WALKS) == own[of]
        hit = np.zeros((SIMULATED, MOST_WALKS), bool)
        np.logical_or.at(hit, of, met.reshape(len(of), MOST_WALKS, TABLES).any(axis=2))
        # By how many walks each passage is found: these lie closer to each other than fewer
        # walks would, so fewer find no less.
        found.append(np.maximum.accumulate(hit, axis=1).mean(axis=0))
    enough = np.minimum(*found)[LEAST_WALKS - 1 :] >= recall
    return LEAST_WALKS + int(np.argmax(enough)) if enough.any() else None


class Index:
    """The items of one block, with their rare words and their LSH keys by length.

    Words have ids from 1; 0 stands for all words of no item, and the largest id for the
    place after the end of a text.
    """

    def __init__(self, items: list[tuple[int, str]], recall: float = RECALL):
        texts = [(i, w) for i, w in ((i, words_of(t)) for i, t in items) if w]
        among = Counter(w for _, ws in texts for w in set(ws))
        self.vocabulary = {w: k for k, w in enumerate(sorted(among), 1)}
        self.items = [(i, np.array([self.vocabulary[w] for w in ws])) for i, ws in texts]
        self.end = len(among) + 1
        # For each rare word the items that have it, one after the other.
        rare = np.zeros(self.end + 1, bool)
        for w, k in self.vocabulary.items():
            rare[k] = among[w] <= max(2, COMMON_SHARE * len(texts))
        owners = sorted((int(w), p) for p, (_, ids) in enumerate(self.items) for w in set(ids[rare[ids]]))
        self.owners = np.array([p for _, p in owners], np.int64)
        self.first = np.searchsorted([w for w, _ in owners], np.arange(self.end + 2))
        self.needed = np.array([rare[ids].sum() - max_edits(len(ids)) for _, ids in self.items], np.int64)

        self.walks = Walks(self.end + 1, self.end)
        by_length = defaultdict(list)
        for place, (_, ids) in enumerate(self.items):
            by_length[len(ids)].append(place)
        # Walks, keys in order and the items of each key, for lengths that walks suit.
        self.tables = {}
        for length, places in by_length.items():
            n = walks_needed(length, recall)
            if n is None:
                continue
            by_key = defaultdict(list)
            rows = np.stack([self.items[p][1] for p in places])
            for place, row in zip(places, self.walks.keys(rows, n)):
                for key in row.tolist():
                    by_key[key].append(place)
            self.tables[length] = (n, np.array(sorted(by_key), np.uint64), dict(by_key))

    def _starts(self, ids: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Items and the starts of windows of their length that hold enough of their rare
        words; windows at the text's end may be cut as far as edits reach."""
        n = self.first[ids + 1] - self.first[ids]
        where = np.repeat(np.arange(len(ids)), n)
        within = np.arange(len(where)) - np.repeat(np.cumsum(n) - n, n)
        owner = self.owners[self.first[ids[where]] + within]
        counts = np.bincount(owner, minlength=len(self.items))
        found = []
        for place in np.flatnonzero(counts >= self.needed):
            length, cut = len(self.items[place][1]), max_edits(len(self.items[place][1]))
            if len(ids) < length - cut:
                continue
            starts = np.arange(max(0, len(ids) - length + cut) + 1)
            at = where[owner == place]
            inside = np.searchsorted(at, starts + length) - np.searchsorted(at, starts)
            found.append((place, starts[inside >= self.needed[place]]))
        return found

    def matches(self, text) -> list[dict]:
        """Items found in the text: id, word at which a window starts, edits."""
        words = words_of(text)
        if not words or not self.items:
            return []
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
        candidates = defaultdict(list)
        by_length = defaultdict(list)
        for place, starts in self._starts(ids):
            length = len(self.items[place][1])
            if length not in self.tables:
                candidates[place] = starts.tolist()
            else:
                by_length[length].append(starts)
        for length, parts in by_length.items():
            starts = np.unique(np.concatenate(parts))
            padded = np.concatenate([ids, np.full(length, self.end)])
            n_walks, known, by_key = self.tables[length]
            for at in range(0, len(starts), 1024):
                some = starts[at : at + 1024]
                found = self.walks.keys(padded[some[:, None] + np.arange(length)], n_walks)
                for row, table in zip(*np.nonzero(np.isin(found, known))):
                    for place in by_key[int(found[row, table])]:
                        candidates[place].append(int(some[row]))
        found = []
        for place, at in candidates.items():
            item_id, item = self.items[place]
            edits, start = min(self._verified(item, ids, sorted(set(at))), default=(len(item), 0))
            if edits <= max_edits(len(item)):
                found.append({"item_id": item_id, "start": start, "edits": edits})
        return sorted(found, key=lambda m: (m["item_id"] is None, m["item_id"] or 0, m["start"]))

    @staticmethod
    def _verified(item: np.ndarray, ids: np.ndarray, starts: list[int]):
        """Edits at each candidate; windows that overlap are looked at as one passage."""
        margin, at = max_edits(len(item)), 0
        while at < len(starts):
            to = at
            while to + 1 < len(starts) and starts[to + 1] <= starts[to] + margin:
                to += 1
            a, b = max(0, starts[at] - margin), starts[to] + len(item) + margin
            yield passage_edits(item, ids[a:b]), starts[at]
            at = to + 1


def _blocks(items: DataFrame) -> list[DataFrame]:
    """The benchmark in parts of bounded size, dealt by a hash of the item."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    total = items.agg(F.sum(size)).first()[0] or 0
    n = -(-int(total) // (BLOCK_BYTES // 2)) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [items.filter(part == k) for k in range(n)] if n > 1 else [items]


def matches(text: Column, index) -> Column:
    """The matches of a broadcast index in a text column."""
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "edits")]))

    def find(texts: pa.Array) -> pa.Array:
        return pa.array([index.value.matches(t.as_py()) for t in texts], kind)

    return F.arrow_udf(find, ArrayType(MATCH))(text.cast("string"))


def _with_matches(docs: DataFrame, text: str, benchmark: DataFrame, recall: float) -> DataFrame:
    """``docs`` as the struct ``doc``, and ``matches`` with all blocks of the benchmark."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    sc = benchmark.sparkSession.sparkContext
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    whole = F.col(f"doc.`{text}`").cast("string")
    blocks = _blocks(items)

    def index(block: DataFrame):
        return sc.broadcast(Index([tuple(r) for r in block.collect()], recall))

    if len(blocks) == 1:
        return rows.withColumn("matches", matches(whole, index(blocks[0])))
    found = []
    for block in blocks:
        shared = index(block)
        hits = rows.select(F.sha2(whole, 256).alias("digest"), matches(whole, shared).alias("m"))
        # A row for each text that matches.
        found.append(written(hits.filter(F.size("m") > 0).dropDuplicates(["digest"])))
        shared.destroy()
    # As many rows for a text as there are blocks, at most.
    all_found = reduce(DataFrame.unionByName, found).groupBy("digest").agg(
        F.sort_array(F.flatten(F.collect_list("m"))).alias("matches")
    )
    none = F.array().cast(ArrayType(MATCH))
    joined = rows.withColumn("digest", F.sha2(whole, 256)).join(
        broadcast_if_small(written(all_found)), "digest", "left"
    )
    return joined.select("doc", F.coalesce("matches", none).alias("matches"))


def find_items(docs: DataFrame, benchmark: DataFrame, recall: float = RECALL) -> DataFrame:
    """One row per document: ``doc_id``, ``contaminated`` and the matches."""
    rows = _with_matches(docs.select("doc_id", "text"), "text", benchmark, recall)
    return rows.select("doc.doc_id", (F.size("matches") > 0).alias("contaminated"), "matches")


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", recall: float = RECALL
) -> DataFrame:
    """The documents in which no item is found, same columns."""
    rows = _with_matches(docs, text, benchmark, recall).filter(F.size("matches") == 0)
    return rows.select(*[F.col(f"doc.`{c}`") for c in docs.columns])
