"""Quality rules: clean line by line, then reject documents that lose too much text.

Every rule is an expression over one row, so nothing is shuffled and no row leaves the
JVM. Work is linear in the text, but for one sort of the word windows of documents
that do repeat windows.

Defined results: a null text has no words and is rejected as too short, like an empty
one; repeated rows are judged alike; a document of any length is judged whole; other
columns of the input are neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, without, words

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20

# Line rules. A line fails if it ...
SENTENCE_END = r"[.!?:;…。！？][\"'”’»)\]]*(?:[\x20\x09-\x0D]|$)"  # ... ends no sentence,
MAX_SHOUTS = 2  # ... holds more runs of "!!" than this,
MAX_SYMBOL_PERCENT = 5  # ... holds more symbols than this, in percent of its characters,
MAX_SEPARATORS = 2  # ... holds more menu separators than this,
SEPARATORS = "|»›•·"
# ... or reads like one of these.
BOILERPLATE = (
    r"(?i)(licen[sc]ed under|all rights reserved|copyright (\(c\)|©|[0-9]{4})|terms of (use|service)"
    r"|privacy policy|cookie (policy|settings)|accept (all )?cookies|click here|sign up for|log ?in to"
    r"|subscribe to|share this|follow us|powered by|back to top|skip to content|javascript is disabled)"
)
# A document is rejected if its surviving lines hold less than this share of its word characters.
MIN_KEPT_PERCENT = 50


def repeat_words(w: Column) -> Column:
    """How many words of ``w`` lie in windows of five words that occur more than once."""

    def windows(body) -> Column:
        """``body`` of the five words of each window."""
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: body(*[F.get(w, i + k) for k in range(WINDOW)]),
        )

    def covered(positions: Column) -> Column:
        """Words under windows that start at these places, in order: each adds what is new."""
        steps = F.transform(
            positions,
            lambda p, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(positions, k + 1) - p, F.lit(WINDOW))
            ),
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def in_sorted(s: Column) -> Column:
        def repeated(x, k):
            same = [F.coalesce(F.get(s, n)["w"] == x["w"], F.lit(False)) for n in (k - 1, k + 1)]
            return same[0] | same[1]

        return let(F.sort_array(F.transform(F.filter(s, repeated), lambda x: x["i"])), covered)

    def all_differ(hashes: Column) -> Column:
        return F.size(F.array_distinct(hashes)) == F.size(hashes)

    # Windows whose hashes all differ are different; only otherwise are they spelt out.
    ordered = F.sort_array(
        F.transform(
            windows(lambda *five: F.concat_ws(" ", *five)),
            lambda x, i: F.struct(x.alias("w"), i.alias("i")),
        )
    )
    return (
        F.when((F.size(w) < WINDOW) | let(windows(F.xxhash64), all_differ), F.lit(0))
        .otherwise(let(ordered, in_sorted))
        .cast("long")
    )


def _occurrences(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def line_passes(line: Column) -> Column:
    """Whether one line survives the punctuation, navigation and boilerplate rules."""
    symbols = F.length(line) - F.length(without(line, SYMBOLS))
    separators = F.length(line) - F.length(without(line, SEPARATORS))
    return (
        line.rlike(SENTENCE_END)
        & (_occurrences(line, "!!") <= MAX_SHOUTS)
        & (symbols * 100 <= F.length(line) * MAX_SYMBOL_PERCENT)
        & (separators <= MAX_SEPARATORS)
        & ~line.rlike(BOILERPLATE)
    )


def clean_lines(text: Column) -> Column:
    """The lines that pass, each once, blank lines left out."""
    return F.array_distinct(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), line_passes))


def clean_text(text: Column) -> Column:
    return F.array_join(clean_lines(text), "\n")


def _word_chars(text: Column) -> Column:
    return F.length(without(text, SPACES)).cast("long")


def verdict(text: Column, cleaned: bool = False) -> Column:
    """A struct of the base counts, ``base_failed``, ``kept_chars`` and ``kept``; with
    ``cleaned`` also of the surviving text, as ``clean``."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(without(line, SPACES)) > 0)
    clean = clean_text(text)
    left = let(clean, lambda c: F.struct(_word_chars(c).alias("chars"), c.alias("text"))) if cleaned else None
    base = F.struct(
        let(
            words(text),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")
            ),
        ).alias("w"),
        _word_chars(text).alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a)))
        .cast("long")
        .alias("n_dup_lines"),
        left.alias("left") if cleaned else _word_chars(clean).alias("kept_chars"),
    )

    def judged(b: Column) -> Column:
        n, repeats = b["w"]["n_words"], b["w"]["n_repeat_words"]
        failed = (n < MIN_WORDS) | (repeats * 100 > n * MAX_REPEAT_PERCENT)
        kept_chars = b["left"]["chars"] if cleaned else b["kept_chars"]
        enough = kept_chars * 100 >= b["word_chars"] * MIN_KEPT_PERCENT
        return F.struct(
            n.alias("n_words"),
            *[b[c].alias(c) for c in ("word_chars", "n_symbols", "n_dup_lines")],
            repeats.alias("n_repeat_words"),
            failed.alias("base_failed"),
            kept_chars.alias("kept_chars"),
            (~failed & enough).alias("kept"),
            *([b["left"]["text"].alias("clean")] if cleaned else []),
        )

    return let(base, judged)


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: its id, the counts and the verdict."""
    return docs.select(F.col(doc_id).alias("doc_id"), verdict(F.col(text)).alias("v")).select(
        "doc_id", "v.*"
    )


def filter_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Kept documents with the failing lines taken out of their text, same columns."""
    name = "verdict"
    while name in [c.lower() for c in docs.columns]:
        name += "_"
    # A generator's column is computed once: a filter on a plain one would go below it.
    judged = docs.select("*", F.explode(F.array(verdict(F.col(text), cleaned=True))).alias(name))
    clean = F.col(name)["clean"]
    changes = {text: clean}
    if n_chars in docs.columns:
        changes[n_chars] = F.length(clean).cast(docs.schema[n_chars].dataType)
    return judged.filter(F.col(name)["kept"]).withColumns(changes).drop(name)
