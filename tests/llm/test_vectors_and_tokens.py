"""Hard negatives, vector codes and byte-pair encoding against brute force and hard rows."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import bpe, hard_negatives, queries, vector_codes

SCHEMA = (
    "vec_id long, label int, embedding array<float>, "
    # Names that the operators use themselves.
    "id long, anchor long, piece int, slot int, cell int, of string, error long, vector string"
)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, "o", 6, "v") for r in rows], SCHEMA)


def some_rows(n, width=8, seed=1, labels=3):
    draw = np.random.default_rng(seed)
    return [
        (i, int(draw.integers(labels)), [float(np.float32(x)) for x in draw.normal(0, 0.3, width)])
        for i in range(n)
    ]


NAN, INF = float("nan"), float("inf")
HARD = [
    (500, None, [0.1] * 8), (600, 1, None), (None, 1, [0.1] * 8), (700, 1, [0.1] * 7 + [None]),
    (800, 1, [NAN] * 8), (900, 1, [INF] * 8), (1000, 1, [-INF] * 8), (1100, 1, []), (1200, 1, [0.2]),
]


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def brute_negatives(rows):
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
            if i is not None and label is not None and usable(v)]
    found = []
    for anchor, label, v in {(i, label, tuple(v)) for i, label, v in kept if i % 100 == 0}:
        scored = [(-sum(a * b for a, b in zip(v, w)), i, other) for i, other, w in kept]
        positives = sorted((s, i) for s, i, other in scored if other == label and i != anchor)[:5]
        for p, positive in positives:
            fits = sorted((s, i) for s, i, other in scored if other != label and 30 * -p <= 100 * -s <= 90 * -p)
            found += [(anchor, positive, at, i, -p, -s) for at, (s, i) in enumerate(fits[:10], 1)]
    return sorted(found)


MINED = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(spark, rows):
    found = hard_negatives.mine(vectors(spark, rows), anchors=F.col("vec_id") % 100 == 0)
    assert found.columns == MINED
    return sorted(map(tuple, found.collect()))


def test_hard_negatives_equal_brute_force_with_hard_rows(spark):
    rows = some_rows(450) + HARD
    # Repeated rows, of which one is an anchor, ties of other ids, and an id with two vectors.
    rows += rows[100:140] + [(i + 2000, label, v) for i, label, v in rows[50:90]] + [(200, 2, [0.5] * 8)]
    expected = brute_negatives(rows)
    assert mined(spark, rows) == expected and len(expected) > 100


def test_hard_negatives_of_many_pieces_and_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "PIECE", 400)  # 50 rows of 8 components
    monkeypatch.setattr(hard_negatives, "SCORES", 300)
    same = [(i + 300, i % 2, [0.5, 0.25] * 4) for i in range(200)]  # a third of all rows are alike
    rows = some_rows(300) + same + [(i + 1001, 2, [0.3, 0.1] * 4) for i in range(50)]
    expected = brute_negatives(rows)
    assert mined(spark, rows) == expected and len(expected) > 100


def test_hard_negatives_without_anchors_rows_or_positives(spark):
    assert mined(spark, []) == [] == mined(spark, HARD[:7]) == mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])])
    assert mined(spark, [(0, 1, [1.0]), (1, 2, [1.0])]) == []
    # A positive below zero has no window; one of zero takes negatives of zero.
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-0.5])]) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [0.0]), (2, 2, [0.0])]) == [(0, 1, 1, 2, 0, 0)]


def test_scores_stay_exact_however_large():
    draw = np.random.default_rng(3)
    for size in (1 << 9, 1 << 20, 1 << 29):
        a, b = (np.floor(draw.normal(0, size, (5, 9))) for _ in range(2))
        expected = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert hard_negatives.to_longs(hard_negatives.inner_products(a, b)).tolist() == expected


def test_best_takes_the_leftmost_of_equals():
    scores = np.array([[1, 5, 5, 5, 2], [0, 0, 0, 0, 0]], np.float32)
    fits = np.array([[1, 1, 1, 1, 1], [0, 1, 0, 1, 0]], bool)
    rows, columns = hard_negatives.best(scores, fits, 2)
    assert list(zip(rows, columns)) == [(0, 1), (0, 2), (1, 1), (1, 3)]


def nearest(book, part):
    return min((sum((a - b) ** 2 for a, b in zip(part, entry)), at) for at, entry in enumerate(book))


def brute_codes(rows, entries=256, parts=4):
    kept = [r for r in rows if usable(r[2])]
    width = max((len(v) for _, _, v in kept), default=0)
    width = -(-width // parts)
    cut = [
        [[math.floor(1024 * x) for x in (v + [0.0] * (parts * width - len(v)))][p * width : (p + 1) * width] for p in range(parts)]
        for _, _, v in kept
    ]
    by_id = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][2]))[:entries]
    books = [[cut[i][p] for i in by_id] for p in range(parts)]
    for _ in range(4):
        for p, book in enumerate(books):
            members = {}
            for vector in cut:
                members.setdefault(nearest(book, vector[p])[1], []).append(vector[p])
            books[p] = [
                [sum(x) // len(members[at]) for x in zip(*members[at])] if at in members else entry
                for at, entry in enumerate(book)
            ]
    numbers = ",".join(str(x) for book in books for entry in book for x in entry)
    coded = [[nearest(book, vector[p]) for p, book in enumerate(books)] for vector in cut]
    errors = [sum(e for e, _ in found) for found in coded]
    totals = {}
    for (_, label, _), error in zip(kept, errors):
        totals[label] = totals.get(label, 0) + error
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    return [
        (i, "".join(f"{at:02x}" for _, at in found), error, totals[label], digest)
        for (i, label, _), found, error in zip(kept, coded, errors)
    ]


CODED = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def coded(spark, rows):
    found = vector_codes.compress(vectors(spark, rows))
    assert found.columns == CODED
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("width", [8, 7])
def test_vector_codes_equal_brute_force_with_hard_rows(spark, width):
    rows = some_rows(420, width) + [(i, label, v and v[:width]) for i, label, v in HARD]
    rows += rows[:60] + [(7, 2, [0.5] * width)] + [(i + 5000, 1, [0.25] * width) for i in range(150)]
    assert coded(spark, rows) == sorted(brute_codes(rows), key=repr)


def test_vector_codes_of_few_or_no_rows(spark):
    assert coded(spark, []) == [] == coded(spark, HARD[1:2] + HARD[3:7])
    few = some_rows(5, 4)
    assert coded(spark, few) == sorted(brute_codes(few), key=repr)
    assert coded(spark, [(1, None, [])]) == [(1, "00000000", 0, 0, hashlib.sha256(b"").hexdigest())]


def test_orchard_search_equals_a_scan_also_for_large_numbers():
    draw = np.random.default_rng(5)
    for size, spread in ((20, 200), (3, 256), (1 << 30, 60)):
        entries = draw.integers(-size, size, (spread, 4)).astype(float)
        parts = draw.integers(-size, size, (300, 4)).astype(float)
        index, square = vector_codes.Codebook(entries).nearest(parts)
        expected = [nearest([list(map(int, e)) for e in entries], list(map(int, p))) for p in parts]
        assert [(int(s), int(i)) for s, i in zip(square, index)] == expected


def test_orchard_search_leaves_entries_out(monkeypatch):
    # Far groups of entries: a search in the first one never goes through the lists' far ends.
    draw = np.random.default_rng(6)
    entries = np.concatenate([draw.integers(0, 50, (32, 4)) + 10_000 * g for g in range(8)]).astype(float)
    looked_at = []
    einsum = np.einsum
    monkeypatch.setattr(np, "einsum", lambda *given: looked_at.append(given[2].shape) or einsum(*given))
    vector_codes.Codebook(entries).nearest(entries[:32] + 1)
    assert sum(n * s for n, s, _ in looked_at) <= 32 * len(entries) / 2


LONG = "".join(random.Random(3).choice("abehilnorst") for _ in range(60_000))
TEXTS = [
    None, "", " \n\t", "It's 25 o'clock, isn't it?  I'LL go.", "It's 25 o'clock, isn't it?  I'LL go.",
    "<|startoftext|>a<|endoftext|>b<|ENDOFTEXT|><|endoftext|>", "İstanbul ΣΑΣ é é ́x ß ẞ ﬁ Å",
    "a b　c\u0085d\x1ce\x1ff​g﻿", "\0 a\0b", "日本語テキスト 🙂👍🏽 １２３ ½ Ⅷ", "aaaaaaa " * 3 + "a" * 999,
    "</w> <w></w>", LONG, " ".join(LONG[i : i + 9] for i in range(0, 50_000, 9)),
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.vocabulary_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def expected_tokens(library, texts):
    found = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    return [(ids, library.decode(ids, skip_special_tokens=False)) for ids in found]


def test_tokens_of_hard_texts_equal_the_library(spark, library):
    given = spark.createDataFrame([(i, t, [1], "d") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids array<int>, decoded string")
    found = {r.doc_id: (r.ids, r.decoded) for r in bpe.encode_documents(given).collect()}
    assert [found[i] for i in range(len(TEXTS))] == expected_tokens(library, TEXTS)
    assert bpe.encode_documents(given.filter("false")).count() == 0
    again = bpe.encode_documents(given).select("decoded", bpe.decoded(F.col("ids")).alias("again"))
    assert again.filter("decoded <> again").count() == 0
    assert spark.sql("SELECT CAST(NULL AS array<int>) AS ids").select(bpe.decoded(F.col("ids"))).first()[0] is None
    assert bpe.digests(bpe.encode_documents(given.limit(1))).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_tokens_of_random_texts_equal_the_library(library):
    draw = random.Random(7)
    bits = ["a", "in", "the", "er", "'s", "'", "é", "é", "<|endoftext|>", " ", "\n", "ß", "日", "🙂", "!!", "\x1f", "ing", "</w>", "9"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(draw.choice("abehilnorst") for _ in range(draw.randint(1, 60))) for _ in range(3000)]
    texts += ["".join(chr(draw.randrange(1, 0x3000)) for _ in range(20)) for _ in range(1000)]
    voc = bpe.vocabulary(bpe.vocabulary_path())
    assert [(voc.encode(t), voc.decode(voc.encode(t))) for t in texts] == expected_tokens(library, texts)


def test_tokens_stay_right_when_kept_results_are_dropped(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    voc = bpe.Vocabulary(bpe.vocabulary_path())
    text = "one two three one four five two six seven eight nine ten eleven one"
    assert voc.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, (voc._runs, voc._runs.older, voc._pieces, voc._pieces.older))) <= 3


def test_digests_of_all_documents_equal_the_library(spark, sf_dir, library):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = [
        (r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(text))
        for r, (ids, text) in zip(texts, expected_tokens(library, [r.text for r in texts]))
    ]
    found = queries.queries()["op13_bpe"](spark, sf_dir)
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_other_vocabularies_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="only plain merges"):
        bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_plain_words_are_not_cut_and_tokens_are_given_up_where_nothing_goes_on(monkeypatch):
    from tokenizers import Tokenizer

    voc = bpe.Vocabulary(bpe.vocabulary_path())
    library = Tokenizer.from_file(bpe.vocabulary_path())
    monkeypatch.setattr(voc, "_cut_latin", None)  # calling it fails
    for word in ("ofanreinat", "Thonshti", "whwhst", "ab" * 500, "ana" * 300, "inonlyertion"):
        assert voc.encode(word) == library.encode(word, add_special_tokens=False).ids
    assert max(voc._sizes.values()) == voc._longest and len(voc._shorter) == len(voc._sizes)
