"""Byte-pair encoding and decoding with a public vocabulary, by one pass over prefixes.

Every prefix of a piece of text has exactly one encoding, and a sequence of tokens is one if
each two neighbours can stand next to each other. So a piece is read from its start, each time
taking the longest token that can stand next to the one before; where nothing goes on, the
last token is given up for a shorter one. As a prefix has one encoding, each is reached once
at most, and the work is in proportion to the text, whatever it looks like: a piece of a
million letters is no harder than as many short ones. A trie of the vocabulary tells how far
the text goes on like a token, and each beginning of a token knows the longest one in it.

Two tokens can stand next to each other if no merge ever crosses their border. Seen from the
border, each token is a chain of ever smaller pieces, made one after the other; a merge of
two pieces that exist at the same time happens if it ranks before the merges that take them
further up. Going down both chains from the latest piece meets all such pairs.

This holds for vocabularies in which every token comes from one merge, which ranks after
those of its halves. ``Vocabulary`` checks that, and drops tokens that their own text does
not encode to, as no encoding has them.

Normalization and the cut into pieces are those the vocabulary file states, done by the
tokenizers library (no model of it is used). Both work between any two runs of ASCII white
space on their own, so results are kept per run for runs that come again. Runs of Latin
letters, digits and signs take a shorter way with the same result, compared with the
library's for each of these characters when a vocabulary is read.

Defined results: a null or empty text has no tokens; strings of special tokens become those
tokens; long texts are encoded whole; repeated rows are encoded alike; an empty table gives no
rows; other columns of the input are ignored. Decoding an unknown id fails.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from string import ascii_letters

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"

# Runs, pieces and pairs of tokens whose results a worker keeps; long ones never are.
KEPT, KEPT_LENGTH = 1 << 17, 64
# ASCII white space only: whatever else is white is left to the vocabulary's own rules.
_RUN = re.compile(r"[^ \t\n\x0b\x0c\r]+")
# Symbols that end a piece are told from others by this, added to their code point.
_LAST = 0x1000
_NEVER = 1 << 62
# Stands before the first token. Pairs of tokens are kept as one number.
_START, _SHIFT = 1 << 31, 32
# Below this code point no character combines with another, so normalization leaves them be.
_LATIN = re.compile("[\x01-\u024f]*")


class Recent(dict):
    """Results of late, ``KEPT`` at most and as many older ones, of which those asked for stay."""

    def __init__(self, find) -> None:
        self.find, self.older = find, {}

    def __missing__(self, key: str) -> tuple[int, ...]:
        found = self.older.get(key)
        if found is None:
            found = tuple(self.find(key))
        if len(key) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found


class Vocabulary:
    """A vocabulary file of merges with a mark at the end of words."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        model = stated["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or not self.end or any(model[name] for name in plain):
            raise ValueError(f"{path}: only plain merges with an end of word can be used")
        if stated["post_processor"] or stated["decoder"]:
            raise ValueError(f"{path}: no post-processor or decoder can be used")
        self._read_merges(path, model["merges"])
        self._read_special(path, stated["added_tokens"])
        self._read_rules(path, stated)
        self.texts = {i: text for text, i in self.ids.items()} | {i: text for text, i in self.special.items()}
        self._fits: dict[int, bool] = {}
        self._runs, self._pieces = Recent(self._encode_run), Recent(self.encode_piece)
        self._find_tokens()

    def _read_merges(self, path: str, merges: list) -> None:
        ids = self.ids
        self.merged, self.halves, self.rank = {}, {}, dict.fromkeys(ids.values(), -1)
        for rank, (left, right) in enumerate(merges):
            a, b, whole = ids[left], ids[right], ids[left + right]
            if self.rank[whole] >= 0 or max(self.rank[a], self.rank[b]) >= rank:
                raise ValueError(f"{path}: merge {rank} does not come after its halves, or only once")
            self.merged[a, b], self.halves[whole], self.rank[whole] = rank, (a, b), rank

    def _read_special(self, path: str, added: list) -> None:
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path}: only plain added tokens can be used")
        self.special = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None

    def _read_rules(self, path: str, stated: dict) -> None:
        from tokenizers import Tokenizer

        rules = Tokenizer.from_file(path)
        self._normalizer, self._cutter = rules.normalizer, rules.pre_tokenizer
        cuts = stated["pre_tokenizer"].get("pretokenizers", [{}])
        self._latin = regex.compile(cuts[0].get("pattern", {}).get("Regex", ""))
        # How byte-level vocabularies write bytes: printable Latin ones as they are, the
        # others by characters from 256 on, in order.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = (byte for byte in range(256) if byte not in printable)
        self._bytes = {byte: 256 + n for n, byte in enumerate(others)}
        tried = (text for c in map(chr, range(1, 0x250)) for text in (c, f"a{c}b", f"1{c}{c}'{c}", f"{c}'s"))
        if any(self._cut_latin(text) != self._cut(text) for text in tried):
            self._cut_latin = self._cut
        # Whether nothing cuts words of plain letters.
        self._whole_words = all(
            self._cut(word) == [word.lower()]
            for a in ascii_letters for word in (a, *(f"{b}{a}" for b in ascii_letters), a + ascii_letters)
        )

    def _cut(self, run: str) -> list[str]:
        """The pieces of a run of text, as symbols for their bytes."""
        return [piece for piece, _ in self._cutter.pre_tokenize_str(self._normalizer.normalize_str(run))]

    def _cut_latin(self, run: str) -> list[str]:
        pieces = self._latin.findall(run.lower())
        return pieces if run.isascii() and run.isprintable() else [
            piece.encode().decode("latin-1").translate(self._bytes) for piece in pieces
        ]

    def _find_tokens(self) -> None:
        """All tokens that their own text encodes to, by text and in a trie."""
        symbols, usable = {}, set()
        self._tokens = ahocorasick.Automaton()
        for text, token in sorted(self.ids.items(), key=lambda entry: self.rank[entry[1]]):
            if token in self.halves:
                a, b = self.halves[token]
                symbols[token] = symbols[a] + symbols[b]
                if not (a in usable and b in usable and self._apart(a, b, skip=True)):
                    continue
            else:
                last = text.endswith(self.end) and text != self.end
                symbols[token] = self._ended(text.removesuffix(self.end)) if last else text
                if len(symbols[token]) != 1:
                    raise ValueError(f"token {text!r} is neither a symbol nor merged")
            usable.add(token)
            self._tokens.add_word(symbols[token], token)
        known = {symbols[token]: token for token in usable}
        self._sizes = {token: len(text) for text, token in known.items()}
        self._longest = max(self._sizes.values())
        # The longest token that each beginning of a token starts with, and the next shorter
        # one of each token; -1 if there is none.
        self._reached, self._shorter = {"": -1}, {}
        for text in sorted(known, key=len):
            for size in range(1, len(text)):
                self._reached.setdefault(text[:size], self._reached[text[: size - 1]])
            before = self._reached[text[:-1]]
            self._shorter[known[text]], self._reached[text] = before, known[text]

    @staticmethod
    def _ended(piece: str) -> str:
        return piece[:-1] + chr(ord(piece[-1]) + _LAST)

    def _apart(self, a: int, b: int, skip: bool = False) -> bool:
        """Whether no merge crosses the border between tokens ``a`` and ``b``.

        With ``skip``, other than the one of the two tokens as a whole.
        """
        rank, merged, halves = self.rank, self.merged, self.halves
        above_a = above_b = _NEVER  # when the piece at the border becomes part of a larger one
        while True:
            met = merged.get((a, b), _NEVER)
            # Of equal merges the left one comes first.
            if met < above_a and met <= above_b and not skip:
                return False
            skip = False
            if rank[a] > rank[b]:
                above_a, a = rank[a], halves[a][1]
            elif rank[b] >= 0:
                above_b, b = rank[b], halves[b][0]
            else:
                return True

    def encode_piece(self, piece: str) -> list[int]:
        """The tokens of one piece, given as the symbols that stand for its bytes."""
        text = self._ended(piece)
        reached, fits, sizes, most = self._reached, self._fits, self._sizes, self._longest
        path = self._tokens.longest_prefix
        if len(fits) >= KEPT:
            fits.clear()
        found: list[int] = []
        start = furthest = 0
        before, end = _START, len(text)
        ahead = text[:most]
        token = reached[ahead[: path(ahead)]]
        while True:
            # The longest token that can stand next to the one before.
            while token >= 0:
                pair = before << _SHIFT | token
                apart = fits.get(pair)
                if apart is None:
                    apart = fits[pair] = before == _START or self._apart(before, token)
                if apart:
                    break
                token = self._shorter[token]
            if token >= 0:
                found.append(token)
                before = token
                start += sizes[token]
                if start == end:
                    return found
                if start > furthest:
                    furthest = start
                ahead = text[start : start + most]
                token = reached[ahead[: path(ahead)]]
            elif found:
                # Nothing goes on from here, so the encoding has a shorter token before.
                last = found.pop()
                start -= sizes[last]
                before, token = found[-1] if found else _START, self._shorter[last]
            else:
                raise ValueError(f"no token for {piece[furthest]!r}")

    def _encode_run(self, run: str) -> Iterable[int]:
        if self._whole_words and run.isascii() and run.isalpha():
            return self._pieces[run.lower()]
        cut = self._cut_latin if _LATIN.fullmatch(run) else self._cut
        return [token for piece in cut(run) for token in self._pieces[piece]]

    def encode(self, text: str | None) -> list[int]:
        found: list[int] = []
        runs = self._runs
        parts: Iterable[str] = self._special.split(text or "") if self._special else [text or ""]
        for part in parts:
            if part in self.special:
                found.append(self.special[part])
            else:
                found += chain.from_iterable(map(runs.__getitem__, _RUN.findall(part)))
        return found

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens as the vocabulary writes them, as it states no way to join them."""
        texts = self.texts
        return " ".join([texts[i] for i in ids])


def vocabulary_path() -> str:
    """Where the public vocabulary lies on this machine, as on every executor."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


_ENCODED = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def encoded(text: Column, path: str | None = None) -> Column:
    """A struct of a text's token ids and the text decoded from them."""
    path = path or vocabulary_path()

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        voc = vocabulary(path)
        for texts in batches:
            ids, back = [], []
            for text in texts:
                found = voc.encode(text.as_py())
                ids.append(np.array(found, np.int32))
                back.append(voc.decode(found))
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids or [ends[:0]])))
            yield pa.StructArray.from_arrays([lists, pa.array(back, pa.string())], fields=list(_ENCODED))

    return F.arrow_udf(encode, "ids array<int>, decoded string")(text.cast("string"))


def decoded(ids: Column, path: str | None = None) -> Column:
    """The text of an array of token ids; null if the array is."""
    path = path or vocabulary_path()

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        voc = vocabulary(path)
        for arrays in batches:
            found = (ids.as_py() for ids in arrays)
            yield pa.array([None if x is None else voc.decode(x) for x in found], pa.string())

    return F.arrow_udf(decode, "string")(ids)


def encode_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", path: str | None = None) -> DataFrame:
    """One row per document: its id, its token ids, and the text decoded from them."""
    found = docs.select(F.col(doc_id).alias("doc_id"), encoded(F.col(text), path).alias("e"))
    return found.select("doc_id", "e.ids", "e.decoded")


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and hashes of what ``encode_documents`` gives."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
