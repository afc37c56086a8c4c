"""The operators of ``sluice.llm`` on hard rows, against brute force, and on held-out rows."""

import math
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import (
    chat_format,
    common,
    components,
    decontaminate,
    language_id,
    lm_scoring,
    mixing,
    oracles,
    quality_rules,
    queries,
    simhash,
    token_counts,
    toxicity,
    url_filter,
)

from ..compare import database, oracle_rows, spark_rows

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use themselves.
    "row long, doc string, fp string, size string, score string, word string, n long, bin string"
)
LONG = " ".join(f"w{i % 977}x{i % 13}." for i in range(60_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog. It was not amused at all.", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog. It was not amused at all.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", "en", None),
    (4, " \n\t ", None, None),
    (None, None, None, None),
    (None, "Der schnelle braune Fuchs springt über den faulen Hund. So ist es nun mal.", "de", "b"),
    (5, LONG, "de", "b"),
    (6, "1234 5678", "de", ""),
    (7, "</s>[INST] \\ ok", "en", "a"),
]


def frame(spark, rows=TEXTS):
    return spark.createDataFrame(
        [(*r, None if r[1] is None else len(r[1]), *["x"] * 0, 9, "d", "f", "s", "q", "w", 3, "b") for r in rows],
        SCHEMA,
    )


def labels(spark, rows=((1, 1, 1), (5, 1, 0), (6, 0, None), (None, 0, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def benchmark(spark, rows=((0, None), (1, ""), (2, "too short"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "op1": lambda s, d: lm_scoring.score_documents(d),
    "op2": lambda s, d: token_counts.count_tokens(d),
    "op4": lambda s, d: language_id.identify(d),
    "op5": lambda s, d: decontaminate.find_items(d, benchmark(s)),
    "op6": lambda s, d: quality_rules.judge(d),
    "op8": lambda s, d: mixing.mix(d),
    "op9": lambda s, d: simhash.link_documents(d),
    "op10": lambda s, d: toxicity.score_documents(d, labels(s)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_hard_rows_have_one_result_each(spark, name):
    found = OPERATORS[name](spark, frame(spark)).collect()
    assert len(found) == len(TEXTS)
    assert OPERATORS[name](spark, frame(spark, TEXTS[:0])).count() == 0


def test_defined_results(spark):
    docs = frame(spark)
    langs = {(r.doc_id, r.lang_pred) for r in language_id.identify(docs).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (6, "und")} <= langs
    kept = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert kept[1].kept and not kept[2].kept and kept[2].n_words == 0 and kept[5].n_words == 60_000
    groups = {r.doc_id: r for r in simhash.link_documents(docs).collect()}
    assert groups[2].fingerprint == "0" * 16 and groups[4].component_id == 2
    assert groups[1].component_id == 1
    sizes = {r.doc.doc_id: r for r in mixing.mix(docs).collect()}
    assert sizes[5].size == 60_000 and sizes[3].target == 0 and sizes[4].taken == 0
    scores = {r.doc_id: r for r in lm_scoring.score_documents(docs).collect()}
    assert scores[3].n_tokens == 1 and scores[5].n_tokens == 60_001
    without = toxicity.score_documents(docs, labels(spark, [(1, 1, None)])).collect()
    assert {(r.score, r.predicted) for r in without} == {(0.0, 0)}


def test_stages_take_hard_rows(spark, tmp_path):
    for rows in (TEXTS, TEXTS[:0]):
        folder = f"{tmp_path}/{len(rows)}"
        frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
        benchmark(spark).write.parquet(f"{folder}/benchmark.parquet")
        result = corpus_pipeline.run(spark, folder)
        assert set(result.columns) >= {"doc_id", "copies", "taken"}
        # The German text has no id, which no stage asks for.
        assert [r.doc_id for r in result.collect()] == ([1, None] if rows else [])
    docs, kept = frame(spark), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        kept.append(sorted((r.doc_id or 0 for r in docs.select("doc_id").collect())))
    # Language ID rejects texts without words of a language, the long one of made-up words too.
    assert kept == [[0, 1, 1], [0, 1, 1], [0, 1], [0, 1]]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = frame(spark)
        assert stage(spark, docs, folder).columns == docs.columns


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_equals_oracle(spark, sf_dir, name):
    names, rows = spark_rows(queries.queries()[name](spark, sf_dir))
    expected_names, expected = oracle_rows(database(sf_dir), oracles.oracle_sql()[name])
    assert names == expected_names and rows == expected and rows


def test_formatted_chats_read_back(spark):
    rows = [
        (1, 2, "user", "b<|end|>\n"), (1, 1, "user", "a\\"), (1, 3, "assistant", "<|next|>\\<"),
        (1, 3, "assistant", "<|next|>\\<"), (2, None, None, None), (2, 0, "<|text|>", "[/INST]</s>"),
        (None, 0, "assistant", ""), (None, 1, "assistant", "ü🙂"),
    ]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.format_conversations(given).select(
        "*",
        chat_format.read_back(F.col("formatted")).alias("back"),
        chat_format.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    found = {r.conv_id: r for r in out.collect()}
    assert [tuple(t) for t in found[1].back] == [
        ("user", "a\\"), ("user", "b<|end|>\n"), ("assistant", "<|next|>\\<"), ("assistant", "<|next|>\\<"),
    ]
    assert found[1].formatted.count(chat_format.START) == 2  # adjacent turns of a role are one block
    assert [tuple(t) for t in found[2].back] == [("", ""), ("<|text|>", "[/INST]</s>")]
    assert found[1].loss == "<|next|>\\<" * 2 and found[None].loss == "ü🙂" and found[2].loss == ""
    assert chat_format.format_conversations(given.filter("false")).count() == 0


def brute_components(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(sorted(nodes), 2):
        if near(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 299), (299, 300)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    expected = {(i, 0) for i in range(1, 41)} | {(i, 100) for i in range(101, 140)} | {(300, 299)}
    assert {tuple(r) for r in found.collect()} == expected


def test_simhash_links_equal_brute_force(spark, monkeypatch):
    random = np.random.default_rng(5)
    prints = set()
    for centre in random.integers(0, 1 << 63, 12):
        for _ in range(30):
            flips = random.choice(64, random.integers(0, 7), replace=False)
            value = int(centre) ^ sum(1 << int(b) for b in flips)
            prints.add(value - (1 << 64) if value >> 63 else value)
    monkeypatch.setattr(simhash, "BLOCK", 8)  # so that postings are dealt into blocks
    given = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {r.node: r.root for r in components.components(simhash.links(given)).collect()}
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= simhash.MAX_BITS
    expected = brute_components(prints, near)
    assert {p: found.get(p, p) for p in prints} == expected


def test_counted_tokens_are_those_of_the_text(spark):
    text = "One line here\n\n\n  two é🙂 lines\r\n" + "x" * 5000 + "\nend"
    r = token_counts.count_text(text, token_counts.vocabulary_path())
    encoding, _ = token_counts.encoder(token_counts.vocabulary_path())
    pieces = encoding.encode_ordinary(text)
    assert r["n_tokens"] == len(pieces) == sum(s["tokens"] for s in r["sections"])
    assert [text[s["start"] : s["end"]] for s in r["sections"]] == text.splitlines(True) if "\r" not in text else True
    # The rule, by looking at each token's characters.
    at, expected = 0, [0] * len(r["sections"])
    for raw in (encoding.decode_single_token_bytes(p) for p in pieces):
        whole = text.encode()
        a, b = len(whole[:at].decode("utf-8", "ignore")), len(whole[: at + len(raw)].decode("utf-8", "ignore"))
        held = [max(0, min(b, s["end"]) - max(a, s["start"])) for s in r["sections"]]
        expected[int(np.argmax(held)) if max(held) else next(i for i, s in enumerate(r["sections"]) if a < s["end"])] += 1
        at += len(raw)
    got = [s["tokens"] for s in r["sections"]]
    assert sum(abs(a - b) for a, b in zip(got, expected)) <= 2 * text.count("🙂") + 2


def made_up(random, n):
    return ["".join(random.choice(list("abcdefgh"), 6)) for _ in range(n)]


def brute_matches(items, text):
    """Items with a passage of the text within their edits, by going through the whole text."""
    found = set()
    for i, item in enumerate(items):
        ids = {w: k for k, w in enumerate(item, 1)}
        words = np.array([ids.get(w, 0) for w in decontaminate.words_of(text)] or [0])
        edits = decontaminate.passage_edits(np.array([ids[w] for w in item]), words)
        found |= {i} if edits <= decontaminate.max_edits(len(item)) else set()
    return found


@pytest.mark.parametrize("length", [6, 20, 37, 55, 80, 150, 400])
@pytest.mark.parametrize("all_kinds", [False, True])
def test_passages_with_as_many_edits_as_may_be_are_found(length, all_kinds):
    random = np.random.default_rng(3)
    items = [[w.encode() for w in made_up(random, length)] for _ in range(30)]
    index = decontaminate.Index([(i, b" ".join(w).decode()) for i, w in enumerate(items)])
    found = false = 0
    for i in range(len(items)):
        places = decontaminate.edited(
            random, np.arange(1, length + 1), decontaminate.max_edits(length), all_kinds
        )
        passage = [items[i][p - 1].decode() if p else made_up(random, 1)[0] for p in places]
        text = " ".join(made_up(random, 40) + passage + made_up(random, 30))
        matched = {m["item_id"] for m in index.matches(text.upper() + ".")}
        if length <= 55:
            assert matched <= brute_matches(items, text)
        found, false = found + (i in matched), false + len(matched - {i})
        mixed = " ".join(random.permutation([w.decode() for w in items[i]] + made_up(random, length)))
        false += len(index.matches(mixed))
    assert found >= 0.9 * len(items) and false == 0


def test_walks_follow_from_the_recall_asked_for(monkeypatch):
    asked = [decontaminate.walks_needed(30, recall) for recall in (0.3, 0.9, 0.99)]
    assert asked[0] == decontaminate.LEAST_WALKS and asked == sorted(asked, key=lambda n: n or 99)
    # Lengths for which no number of walks is enough are found all the same.
    random = np.random.default_rng(4)
    item, passage = made_up(random, 30), made_up(random, 6)
    index = decontaminate.Index([(0, " ".join(item))], recall=1.1)
    assert index.tables == {} and [m["edits"] for m in index.matches(" ".join(passage + item[6:]))] == [6]


def test_distance_of_passages():
    assert decontaminate.passage_edits(np.array([1, 2, 3, 4]), np.array([9, 1, 2, 7, 4, 9])) == 1


def test_one_block_of_the_benchmark_is_held_at_a_time(spark, monkeypatch):
    random = np.random.default_rng(5)
    items = [" ".join(made_up(random, 12)) for _ in range(40)]
    given = benchmark(spark, [*enumerate(items), (99, None)])
    rows = [(i, f"before {items[i % 40]} after {items[(i * 7) % 40]}", "en", "a") for i in range(60)]
    docs = frame(spark, rows + [(-1, None, "en", "a"), (-2, "nothing of it at all", "en", "a")] + rows[:3])
    whole = sorted((r.doc_id, r.contaminated, sorted(m.item_id for m in r.matches)) for r in decontaminate.find_items(docs, given).collect())
    held, most = set(), []
    real = spark.sparkContext.broadcast

    def broadcast(value):
        shared = real(value)
        held.add(shared)
        most.append(len(held))
        destroy = shared.destroy
        monkeypatch.setattr(shared, "destroy", lambda *a: (held.discard(shared), destroy(*a)))
        return shared

    monkeypatch.setattr(spark.sparkContext, "broadcast", broadcast)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 800)
    found = decontaminate.find_items(docs, given)
    assert len(most) >= 8 and max(most) == 1 and not held
    assert sorted((r.doc_id, r.contaminated, sorted(m.item_id for m in r.matches)) for r in found.collect()) == whole
    assert sum(len(m) for _, _, m in whole) > 100
    left = decontaminate.remove_contaminated(docs, given)
    assert sorted(r.doc_id for r in left.collect()) == [-2, -1] and left.columns == docs.columns


def test_short_items_are_found():
    texts = ["zebra", "blue whale", "name the red planet", "what is the capital of France?", "how many legs has one common house spider"]
    index = decontaminate.Index([*enumerate(texts), (8, "..."), (9, None)])
    found = lambda text: [(m["item_id"], m["edits"]) for m in index.matches(text)]
    for i, text in enumerate(texts):
        for around in ("{}", "before {}", "{} after", "some words before {} and after"):
            assert found(around.format(text)) == [(i, 0)]
    # One edit in five words or more, none in fewer.
    assert found("so what is the main capital of France then") == [(3, 1)] == found("what is capital of France")
    assert found("how many legs has one tiny house spider") == [(4, 1)]
    assert found("what was the main capital of France") == [] == found("name the big red planet") == found("whale blue")


def test_language_model_probabilities_add_up(spark):
    docs = frame(spark)
    counts = lm_scoring.gather_counts(lm_scoring.corpus_counts(docs))
    start = lm_scoring.LogBilinear.start((counts.unit_n + 1) / (counts.unit_n + 1).sum())
    total = (10.0 ** start.log10_table()[3, 5].astype(float)).sum()
    assert abs(total - 1) < 1e-4
    for word in ("a", "ab", "the,", "größe"):
        row = spark.range(1).select(lm_scoring._bucket(F.lit(word))).first()[0]
        assert row == lm_scoring.bucket(word.encode())


def test_language_model_beats_counted_pairs_of_units(spark, sf_dir):
    """The trained units against bigrams of the same units, smoothed, on held-out texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = lm_scoring.fold(F.col("doc_id"), lm_scoring.FOLDS) == lm_scoring.HELD_OUT
    counts = lm_scoring.gather_counts(lm_scoring.corpus_counts(docs.filter(~held)))
    rows = lm_scoring._unit_rows(docs.withColumn("text", F.coalesce("text", F.lit(""))), spark.sparkContext.broadcast(counts))
    training, held_out = (lm_scoring.written(rows.filter(f)) for f in (~held, held))
    model = lm_scoring.train(training, counts)
    table = 10.0 ** model.log10_table().astype(float)
    assert abs(table.sum(axis=2) - 1).max() < 1e-3
    unigram = (counts.unit_n + 1) / (counts.unit_n + 1).sum()
    pairs = np.zeros((lm_scoring.UNITS, lm_scoring.UNITS))

    def read(frame):
        return lm_scoring.after_ends([np.frombuffer(r.units, np.uint8) for r in frame.collect()])

    ids, at = read(training)
    np.add.at(pairs, (ids[at - 1], ids[at]), 1)
    pairs = (pairs + 20 * unigram) / (pairs.sum(axis=1, keepdims=True) + 20)
    ids, at = read(held_out)
    counted = np.log10(pairs[ids[at - 1], ids[at]]).mean()
    plain = np.log10(table[ids[at - 2], ids[at - 1], ids[at]]).mean()
    print("counted", counted, "model", plain)
    assert plain > counted
    # The distributed measure and a text by text look-up say the same.
    assert abs(lm_scoring.mean_log10(held_out, model) - plain) < 1e-4


def test_language_model_beats_the_base_on_held_out_texts(spark, sf_dir):
    held = queries.queries()["op1_lm_scoring"](spark, sf_dir).filter("held_out")
    sums = held.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert sums.score > sums.base


def test_held_out_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = queries.queries()["op4_language_id"](spark, sf_dir).join(docs, "doc_id").filter("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


WORDS = {"aa": "la rana salta sobre el agua clara", "bb": "the quick brown fox jumps high", "cc": "ein kleiner hund lief davon"}


@pytest.mark.parametrize("ids", ["one for a language", "none", "copies"])
def test_languages_are_learnt_whatever_ids_rows_have(spark, ids):
    numbers = spark.range(6000)
    frames = []
    for lang, words in WORDS.items():
        rows = numbers.select(
            F.when(F.lit(ids == "none"), F.lit(None)).when(F.lit(ids != "copies" and lang == "aa"), 77)
            .otherwise(F.col("id")).cast("long").alias("doc_id"),
            F.concat_ws(" ", F.lit(words), F.col("id").cast("string"), F.lit(words)).alias("text"),
            F.lit(lang).alias("lang"),
        )
        if ids == "copies" and lang == "aa":  # most rows are one
            first = F.lit(f"{words} and {words}")
            rows = rows.withColumns({"text": F.when(F.col("doc_id") > 300, first).otherwise(F.col("text")),
                                     "doc_id": F.when(F.col("doc_id") > 300, 5).otherwise(F.col("doc_id"))})
        frames.append(rows)
    docs = frames[0].unionByName(frames[1]).unionByName(frames[2])
    taken = {r.lang: r["count"] for r in language_id._sample(docs, 200).groupBy("lang").count().collect()}
    assert taken == dict.fromkeys(WORDS, 200)
    model = language_id.fit(docs, sample=200)
    assert [lang for lang, _, _ in model.predict([w + " again" for w in WORDS.values()])] == list(WORDS)


UNSEEN = [
    "Tämä on suomenkielinen lause, jossa kerrotaan päivän säästä ja kaupungin elämästä.",
    "Это предложение на русском языке о погоде и городе.",
    "这是一个关于天气和城市的中文句子。",
    "هذه جملة باللغة العربية عن الطقس والمدينة",
    "".join(np.random.default_rng(1).choice(list("abcdefghijklmnopqrstuvwxyz    "), 200)),
]


@pytest.mark.parametrize("wrong", [0, 100])
def test_texts_in_unseen_languages_are_rejected(spark, sf_dir, wrong):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    # One in so many texts is not in the language of its label.
    other = F.get(F.array(*map(F.lit, UNSEEN)), (F.col("doc_id") % 5).cast("int"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(max(wrong, 1)))
    mixed = docs.withColumn("text", F.when((place == 0) & F.lit(wrong > 0), other).otherwise(F.col("text")))
    model = language_id.fit(mixed)
    assert all(rejected for _, _, rejected in model.predict(UNSEEN))
    kept = [not r for lang, _, r in model.predict([r.text for r in docs.collect()]) if lang != "und"]
    assert np.mean(kept) > 0.995


def test_held_out_toxicity(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic IS NOT NULL")
    found = queries.queries()["op10_toxicity"](spark, sf_dir).join(given, "doc_id").filter("held_out")
    clean = found.filter("toxic = 0").agg(F.avg("predicted")).first()[0]
    assert clean < 0.05 < found.filter("toxic = 1").agg(F.avg("predicted")).first()[0]


def test_rows_that_share_an_id_are_one_toxic_example(spark):
    rows = [(i, f"{'vile words' if i % 2 else 'kind words'} number{i} and more", "en", "a") for i in range(60)]
    marked = labels(spark, [(i, 1, i % 2) for i in range(60)])
    once = toxicity.fit(frame(spark, rows), marked)
    often = toxicity.fit(frame(spark, rows + rows[:1] * 200), marked)
    assert once.weights == often.weights and once.vocabulary == often.vocabulary


def test_names_are_split_into_words():
    costs = {"data": 3.0, "base": 3.5, "database": 8.0, "a": 4.0}
    assert url_filter.segment("database", costs, (10.0, 3.0)) == ["data", "base"]
    assert url_filter.segment("", costs, (10.0, 3.0)) == []
    assert "".join(url_filter.segment("xdatay", costs, (10.0, 3.0))) == "xdatay"


def test_url_rules_and_hard_urls(spark):
    rows = [
        (1, "http://WWW.Example.com/en/1?x", "<p>blog news</p>"), (2, "x://example.com/en/", None),
        (3, "http://shop.example.com/en/2", ""), (4, None, None), (5, "no scheme", "x"), (6, "a://net", ""),
        (7, "http://a.b.net/es/://c", None), (8, "http://notnet/es/", "p"), (8, "http://notnet/es/", "p"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("names", F.lit(1))
    found = {r.page_id: r for r in url_filter.classify(pages, queries.URL_RULES).collect()}
    assert (found[1].rule, found[1].verdict) == ("www.example.com/en/", "allow")
    assert found[2].rule == found[3].rule == "example.com/en/" and found[3].verdict == "block"
    assert (found[4].host, found[5].path, found[6].rule, found[8].rule) == ("", "", None, None)
    assert (found[7].host, found[7].path, found[7].verdict) == ("a.b.net", "/es/://c", "block")
    assert url_filter.classify(pages, queries.URL_RULES).count() == len(rows)
    assert url_filter.classify(pages.filter("false"), queries.URL_RULES).count() == 0


def test_names_split_into_words_however_rare(spark, monkeypatch):
    letters = "bcdfghjklm"
    filler = " ".join("zq" + "".join(letters[i // 10**k % 10] for k in range(5)) for i in range(60_000))
    rows = [(1, "http://casino.net/es/", filler), (2, "http://kind.com/", "blue casino"), (3, "http://kind.com/", "kind"),
            (4, "http://bluecasino.org/", None), (5, "http://bluekind.org/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in url_filter.classify(pages, queries.URL_RULES).collect()}
    assert (found[4].verdict, found[5].verdict) == ("block", "allow")
    # The same if the counts of most pieces are joined instead of sent.
    monkeypatch.setattr(url_filter, "SENT", 20)
    assert {r.page_id: r for r in url_filter.classify(pages, queries.URL_RULES).collect()} == found


def test_kept_documents_hold_what_their_verdict_leaves(spark):
    lines = "A first line that ends here.\nHome | News | About | Help | More\n\nA second one, which has some words.\n"
    rows = [*TEXTS, (8, lines, "en", "a"), (9, lines * 2 + "no end", "en", "a"), (10, "Home | News\n" * 20, "en", "a")]
    docs = frame(spark, rows).withColumn("verdict", F.lit("v"))
    text = F.col("text")
    plain = docs.filter(quality_rules.verdict(text)["kept"]).withColumns(
        {"text": quality_rules.clean_text(text), "n_chars": F.length(quality_rules.clean_text(text)).cast("long")}
    )
    found = quality_rules.filter_documents(docs)
    assert found.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))
    # Document 9 repeats itself, 10 is nothing but menus.
    assert sorted(r.doc_id for r in found.filter("verdict = 'v' AND doc_id > 7").collect()) == [8]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("licen") == 1  # the lines are judged once


def test_splits_cost_no_more_than_any_other():
    random = np.random.default_rng(3)
    unknown = (4.0, 1.5)
    for _ in range(60):
        name = "".join(random.choice(list("ab"), random.integers(1, 11)))
        pieces = sorted({name[a:b] for a, b in combinations(range(len(name) + 1), 2)})
        costs = {p: float(random.random() * 9) for p in pieces if random.random() < 0.4}
        sent = {p: None for p in pieces[::3]} | {p: c for p, c in list(costs.items())[::2]}

        def cost(words):
            return sum(costs.get(w, unknown[0] + unknown[1] * len(w)) for w in words)

        cuts = [c for n in range(len(name)) for c in combinations(range(1, len(name)), n)]
        splits = [[name[a:b] for a, b in zip((0, *c), (*c, len(name)))] for c in cuts]
        found = url_filter.segment(name, sent, unknown, costs)
        assert "".join(found) == name and math.isclose(cost(found), min(map(cost, splits)))


def plain_verdicts(pages, rules):
    """Rules, Viterbi and naive Bayes page by page: host, path, rule, verdict and odds by id."""
    counts, read = Counter(), {}
    for p in pages:
        visible = regex.sub(r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<[^>]*>", " ", p.html or "")
        counts.update(regex.findall(r"\p{L}+", visible.lower()))
        rest = (p.url or "").partition("://")[2]
        own = regex.match(r"(?s)([^/?#]*)([^?#]*)", rest)
        host, path = own[1].lower(), own[2]
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        read[p.page_id] = (host, path, max(fits, key=lambda r: len(r[0] + r[1]), default=None))
    total = sum(counts.values()) or 1
    costs = {w: -math.log(n / total) for w, n in counts.items()}

    def features(host, path):
        for place, text in (("h", host), ("p", path)):
            for name in regex.findall(r"\p{L}+|[0-9]+", text.lower()):
                name = "#" if name[0] in "0123456789" else name
                for word in url_filter.segment(name, costs, (math.log(total), math.log(26))):
                    yield f"{place}:{word}"

    seen, of = Counter(), {"allow": Counter(), "block": Counter()}
    everything = set()
    for host, path, rule in read.values():
        everything.update(features(host, path))
        if rule:
            seen[rule[2]] += 1
            of[rule[2]].update(features(host, path))
    size = {k: of[k].total() + len(everything) + 1 for k in of}
    prior = math.log((seen["allow"] + 1) / (seen["block"] + 1))
    result = {}
    for page, (host, path, rule) in read.items():
        odds = prior + sum(
            math.log((of["allow"][f] + 1) / size["allow"]) - math.log((of["block"][f] + 1) / size["block"])
            for f in features(host, path)
        )
        named = rule and rule[0] + rule[1]
        result[page] = (host, path, named, rule[2] if rule else "allow" if odds >= 0 else "block", odds)
    return result


@pytest.mark.parametrize("budget", [url_filter.SENT, 20])
def test_pages_are_judged_as_by_plain_naive_bayes(spark, sf_dir, monkeypatch, budget):
    monkeypatch.setattr(url_filter, "SENT", budget)
    if budget == 20:
        monkeypatch.setattr(common.broadcast_if_small, "__defaults__", (0,))
    pages = common.table(spark, sf_dir, "pages")
    found = url_filter.classify(pages, queries.URL_RULES).collect()
    expected = plain_verdicts(pages.select("page_id", "url", "html").collect(), queries.URL_RULES)
    assert len(found) == len(expected)
    for r in found:
        *same, odds = expected[r.page_id]
        assert math.isclose(r.odds, odds, rel_tol=1e-9, abs_tol=1e-9)
        assert [r.host, r.path, r.rule] == same[:3] and (r.verdict == same[3] or abs(odds) < 1e-9)


def test_long_names_and_long_lists_of_names(spark):
    long = "bluecasino" * 40_000
    path = "/".join(f"blue{'abcdefgh'[i % 8]}kind" for i in range(20_000))
    rows = [(1, "http://casino.net/es/", "blue casino kind"), (2, "http://kind.com/", "blue kind <SCRIPT>var x</SCRIPT>"),
            (3, f"http://a.org/{long}", None), (4, f"http://a.org/{path}", "<Style>y</sTYLE> kind")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in url_filter.classify(pages, queries.URL_RULES).collect()}
    expected = plain_verdicts(pages.collect(), queries.URL_RULES)
    for page, (_, _, rule, verdict, odds) in expected.items():
        assert (found[page].rule, found[page].verdict) == (rule, verdict)
        assert math.isclose(found[page].odds, odds, rel_tol=1e-9)
    assert {r.word for r in url_filter.word_counts(pages).collect()} == {"blue", "casino", "kind"}


def test_nested_columns_count_as_large_as_they_are(spark):
    wide = spark.range(100).select(F.array_repeat(F.struct(F.lit("name").alias("n")), 1000).alias("names"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(common.broadcast_if_small(wide, 2 << 20)) and not hinted(common.broadcast_if_small(wide, 1 << 20))


def test_mixed_sources_come_near_their_targets(spark, sf_dir):
    mixed = queries.queries()["op8_mix_sources"](spark, sf_dir)
    assert mixed.filter(F.col("taken") > 3 * F.col("size")).count() == 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    for r in mixed.join(docs, "doc_id").groupBy("source", "target").agg(
        F.sum("taken").alias("taken"), F.max("size").alias("largest")
    ).collect():
        assert abs(r.taken - r.target) <= r.largest / 2 + 1


def test_documents_are_taken_as_often_as_they_expect(spark):
    """Two sources of 20,000 documents of four sizes each, and a small one that gains words."""
    sizes = F.get(F.array(*map(F.lit, (3, 20, 100, 500))), (F.col("id") % 4).cast("int"))
    source = F.when(F.col("id") < 20_000, "a").when(F.col("id") < 40_000, "b").otherwise("c")
    docs = spark.range(42_000).select(
        F.col("id").alias("doc_id"), source.alias("source"), F.repeat(F.lit("w "), sizes).alias("text")
    )
    found = mixing.mix(docs).select("doc.source", "size", "source_size", "target", "copies", "taken")
    rows = found.groupBy("source", "size", "source_size", "target").agg(
        F.avg("copies").alias("copies"), F.min("copies").alias("least"), F.max("copies").alias("most"),
        F.sum("taken").alias("taken"), F.count("size").alias("n"),
    ).collect()
    assert len(rows) == 12
    for source in "abc":
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 250

        def expected(level, r):
            return min(3, level * r.size.bit_length())

        low, high = 0.0, 3.0
        for _ in range(60):  # the level by bisection
            level = (low + high) / 2
            words = sum(r.n * r.size * expected(level, r) for r in own)
            low, high = (level, high) if words < own[0].target else (low, level)
        for r in own:
            share = expected(level, r)
            part = share - math.floor(share + 1e-9)
            assert abs(r.copies - share) < 0.01 + 4 * math.sqrt(part * (1 - part) / r.n)
            assert r.least >= math.floor(share - 1e-9) and r.most <= min(3, math.floor(share + 1e-9) + 1)
    copies = {(r.source, r.size): r.copies for r in rows}
    assert copies["b", 3] < copies["b", 20] < copies["b", 100] < copies["b", 500]
