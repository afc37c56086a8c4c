"""URL filters: rules on hosts and paths, and naive Bayes over segmented names.

A rule has a host and a path; it fits the host and its subdomains if the url's path starts
with the rule's. The longest fitting rule decides. Where none fits, multinomial naive
Bayes does: pages with a rule are its labelled examples, and its features are the words of
host and path. Names are concatenations, so a unigram Viterbi splits each into words,
with word frequencies counted over the visible text of all pages; a piece that is no word
costs more with each letter.

Equal feature lists are one row: features are counted and scored once per distinct list
(hosts and path patterns), summed before shuffling, and only verdicts are joined back to
the pages, so a host with a third of all pages is one entry. Lists go by a number while
they are taken apart, so a long one is not repeated for each of its names. Names are split
once each; a name is read in windows of ``LONGEST`` letters, so one of millions of letters
takes time and memory in proportion to its length.

All words count, however rare. The pieces that most names have, at most ``SENT`` of them,
are sent to all tasks with their counts; the other pieces are joined with the counts by
shuffling, and each name gets the counts of its own. A hot piece is thus never shuffled.

Defined results: a null url and one without ``://`` have an empty host and path and no
features, and the priors decide; a url may be anything after that. Equal evidence, and no
labelled page at all, mean allow. Repeated rows are judged alike; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed, lower_ascii, most_frequent

SENT = 50_000  # pieces
ROWS = 1 << 16  # of a batch of pieces
LONGEST = 24  # letters of a word
SMOOTHING = 1.0
ALLOW, BLOCK = "allow", "block"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_TAGS = r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<[^>]*>"


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest of ``rules`` (host, path, verdict) that fits, as a struct of rule and
    verdict; null if none does. Rules are a short list; each is two comparisons."""
    fitting = [
        (
            ((host == rule_host) | F.endswith(host, F.lit("." + rule_host)))
            & F.startswith(path, F.lit(rule_path)),
            F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    ]
    first, *rest = fitting
    return reduce(lambda chosen, f: chosen.when(*f), rest, F.when(*first))


def word_counts(texts: DataFrame, html: str = "html") -> DataFrame:
    """``word`` and its count ``n`` for every word of the visible text of all pages."""
    visible = F.lower(F.regexp_replace(F.coalesce(F.col(html), F.lit("")), _TAGS, " "))
    found = texts.select(F.explode(F.regexp_extract_all(visible, F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return checkpointed(found.groupBy("word").agg(F.count("word").alias("n")))


def segment(name: str, costs: dict, unknown: tuple[float, float], own: dict | None = None) -> list[str]:
    """The cheapest split of a name into words: the costs are negative log probabilities.

    A piece that is no word (in neither dictionary, or there without a cost) costs a fixed
    sum and one for each letter. Of equally cheap splits the one with the longer last word
    is taken.
    """
    own, best, cut = own or {}, array("d", [0.0]), array("q", [0])
    for end in range(1, len(name) + 1):
        least, place = math.inf, 0
        for start in range(max(0, end - LONGEST), end):
            piece = name[start:end]
            cost = costs.get(piece)
            if cost is None:
                cost = own.get(piece)
                if cost is None:
                    cost = unknown[0] + unknown[1] * (end - start)
            if best[start] + cost < least:
                least, place = best[start] + cost, start
        best.append(least)
        cut.append(place)
    words, end = [], len(name)
    while end:
        words.append(name[cut[end] : end])
        end = cut[end]
    return words[::-1]


def pieces_of(name: str) -> Iterator[set[str]]:
    """What a split of the name can consist of, but for pieces too long to be a word.

    Sets of about ``ROWS`` pieces at most; those of a long name may share some.
    """
    found = set()
    for end in range(1, len(name) + 1):
        found.update(name[start:end] for start in range(max(0, end - LONGEST), end))
        if len(found) >= ROWS:
            yield found
            found = set()
    yield found


def _pieces(names: DataFrame) -> DataFrame:
    """``id`` and ``word`` for every piece of the names, which have ``id`` and ``name``."""

    def rows(ids: list[int], found: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], ["id", "word"])

    def cut(batches):
        for batch in batches:
            ids, found = [], []
            for own, name in zip(batch["id"].to_pylist(), batch["name"].to_pylist()):
                for pieces in pieces_of(name):
                    ids += [own] * len(pieces)
                    found += pieces
                    if len(ids) >= ROWS:
                        yield rows(ids, found)
                        ids, found = [], []
            yield rows(ids, found)

    return names.select("id", "name").mapInArrow(cut, "id long, word string")


def split_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name`` and its ``words`` for each of the distinct names, with the counts as unigrams."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    names = checkpointed(names.select("name", F.monotonically_increasing_id().alias("id")))
    pieces = _pieces(names)
    uses = checkpointed(
        pieces.groupBy("word").agg(F.count("word").alias("uses")).join(counts, "word", "left")
    )
    sent = most_frequent(uses, "uses", SENT)
    costs = {r.word: r.n and -math.log(r.n / total) for r in sent.collect()}
    shared = names.sparkSession.sparkContext.broadcast(costs)
    unknown = (math.log(total), math.log(26))
    least = sent.agg(F.min("uses")).first()[0]
    # Only words are left here: a piece that is none needs no count.
    words = uses.filter("n IS NOT NULL").select("word", "n", "uses")
    words = checkpointed(words if least is None else words.filter(F.col("uses") < least)).drop("uses")
    others = pieces.join(broadcast_if_small(words), "word")
    own = others.groupBy("id").agg(F.collect_set(F.struct("word", "n")).alias("own"))

    def split(names: pa.Array, own: pa.Array) -> pa.Array:
        sent, found = shared.value, []
        for name, rows in zip(names.to_pylist(), own.to_pylist()):
            mine = {r["word"]: -math.log(r["n"] / total) for r in rows or ()}
            found.append(segment(name, sent, unknown, mine))
        return pa.array(found, pa.list_(pa.string()))

    udf = F.arrow_udf(split, "array<string>")
    return names.join(own, "id", "left").select("name", udf("name", "own").alias("words"))


def _names(page: DataFrame) -> DataFrame:
    """``names`` of a page: (place, name) of its host's and path's parts; numbers are one."""

    def parts(text: Column, place: str) -> Column:
        found = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|[0-9]+"), F.lit(0))
        return F.transform(
            found,
            lambda p: F.struct(
                F.lit(place).alias("place"),
                F.when(p.rlike("^[0-9]"), F.lit("#")).otherwise(p).alias("name"),
            ),
        )

    return page.withColumn("names", F.concat(parts(F.col("host"), "h"), parts(F.col("path"), "p")))


def classify(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """One row per page: id, host, path, rule, verdict and the odds of naive Bayes."""
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = _names(urls.withColumn("r", rule_for(F.col("host"), F.col("path"), rules)))
    # Distinct lists of names, with how many pages of each class have them.
    lists = checkpointed(
        ruled.groupBy("names")
        .agg(
            F.count_if(F.col("r.verdict") == ALLOW).alias(ALLOW),
            F.count_if(F.col("r.verdict") == BLOCK).alias(BLOCK),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )
    entries = lists.select("id", ALLOW, BLOCK, F.explode_outer("names").alias("e"))
    names = entries.filter("e IS NOT NULL").select("e.name").distinct()
    distinct = checkpointed(split_names(names, word_counts(pages)))
    features = checkpointed(
        entries.join(broadcast_if_small(distinct), F.col("e.name") == F.col("name"), "left")
        .select("id", ALLOW, BLOCK, F.col("e.place").alias("place"), F.explode_outer("words").alias("word"))
        .withColumn("feature", F.concat_ws(":", "place", "word"))
    )
    known = features.filter("word IS NOT NULL")
    sums = checkpointed(known.groupBy("feature").agg(F.sum(ALLOW).alias("a"), F.sum(BLOCK).alias("b")))
    totals = sums.agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count("a").alias("v")).first()
    seen = lists.agg(F.sum(ALLOW).alias("a"), F.sum(BLOCK).alias("b")).first()
    n_allow, n_block = (float(x or 0) for x in (totals.a, totals.b))
    of_feature = F.log((F.col("a") + SMOOTHING) / (n_allow + SMOOTHING * (totals.v + 1))) - F.log(
        (F.col("b") + SMOOTHING) / (n_block + SMOOTHING * (totals.v + 1))
    )
    prior = math.log(((seen.a or 0) + 1) / ((seen.b or 0) + 1))
    weights = sums.select("feature", of_feature.alias("weight"))
    odds = (
        features.join(broadcast_if_small(checkpointed(weights)), "feature", "left")
        .groupBy("id")
        .agg((F.coalesce(F.sum("weight"), F.lit(0.0)) + prior).alias("odds"))
    )
    of_list = checkpointed(lists.select("id", "names").join(odds, "id").drop("id"))
    judged = ruled.join(broadcast_if_small(of_list), "names", "left")
    own = F.when(F.coalesce("odds", F.lit(0.0)) >= 0, ALLOW).otherwise(BLOCK)
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", own).alias("verdict"),
        "odds",
    )
