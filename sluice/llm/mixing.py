"""Mixing sources to target weights by Pareto order sampling.

Each source has a target number of words, and each document expects a number of copies
of its own: documents with more words expect more, in proportion to the digits of their
size in base two, up to ``MAX_COPIES``, so that a source's expected words are its target.
The whole part of what a document expects is taken for certain; the rest is its inclusion
probability in a sample without replacement: documents of a source are ranked by their
random odds divided by the odds of that probability and taken in that order until the
words that are left to take are reached, to the nearest document. So a source misses its
target by up to half of the document at which its words run out, which is several percent
of a source of few, long documents.

Documents of a source with as many digits expect the same, so expectations come from sums
over at most 64 classes of size per source. No source is ever sorted or gathered as a
whole. Ranks fall into bins, words are summed
by (source, bin) before the shuffle, a window over at most ``BINS`` rows a source finds
the bin in which a source's words run out, and only the documents of that one bin are
ranked one by one. The result is a cut per source, and the choice of a document is a
comparison with the cut of its source. Draws come from a hash of the document id, so
reruns agree, whatever the partitions.

Defined results: a null text has size 0; a null source is a source of its own, after all
others; a null id has one draw of its own; rows with the same id share a draw and are
taken or left together; a source without words has the target 0; an empty table gives no
rows. Other columns of the input are passed through by ``mix`` and can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, broadcast_if_small, checkpointed, without

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BINS = 65_536
SEED = "mix-1"
DIGITS = 13  # hexadecimal, of the digest a draw is made of


def n_words(text: Column) -> Column:
    """Words of a text: its runs of other characters than the six spaces."""
    blank = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    starts = F.concat(F.lit(" "), blank)
    # A word starts at each space that another character follows.
    squeezed = F.regexp_replace(starts, " +", " ")
    spaces = F.length(squeezed) - F.length(without(squeezed, " "))
    return (spaces - F.endswith(squeezed, F.lit(" ")).cast("int")).cast("long")


def draw(doc_id: Column) -> Column:
    """A number over 0 and below 1 that follows from the id alone."""
    key = F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    digits = F.conv(F.substring(F.md5(key.cast("binary")), 1, DIGITS), 16, 10).cast("long")
    return (digits + 0.5) / float(16**DIGITS)


def rank_of(u: Column, probability: Column) -> Column:
    """Pareto rank: random odds over inclusion odds; null if the probability is 0."""
    odds = F.nullif(probability / (1 - probability), F.lit(0.0))
    return (u / (1 - u)) / odds


def _bin(rank: Column) -> Column:
    """Bins of equal width on rank / (1 + rank), which puts the usual cut of 1 halfway."""
    return F.least(F.floor(rank / (1 + rank) * BINS), F.lit(BINS - 1)).cast("int")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Adds ``target`` to one row per ``source`` with its ``source_size``.

    Weights repeat over the sources by code point, null last. All words are shared by
    weight; what would go over ``MAX_COPIES`` times a source's size goes to the others.
    Sharing again until none is over has one end: a level c with the targets
    min(cap, c * weight). Sources ordered by cap / weight reach their caps in that order,
    so running sums give the level at once. One row per source passes one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weighed = sizes.withColumn("weight", F.get(F.array(*map(F.lit, WEIGHTS)), place).cast("long"))
    weighed = weighed.withColumn("cap", F.col("source_size") * MAX_COPIES)
    everything = Window.partitionBy()
    # Those before a source in this order are at their caps if it is.
    filled = Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    summed = weighed.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("cap").over(filled), F.lit(0)).alias("cap_before"),
        (
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filled), F.lit(0))
        ).alias("weight_left"),
    )
    left = F.col("total") - F.col("cap_before")
    # At its cap: the level, if it alone were the next, would be at or over cap / weight.
    capped = left * F.col("weight") >= F.col("cap") * F.col("weight_left")
    marked = summed.withColumn("capped", capped)
    sums = marked.select(
        "*",
        F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything).alias("full"),
        F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything).alias("open"),
    )
    level = (F.col("total") - F.col("full")) / F.col("open")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        level * F.col("weight")
    )
    return sums.select("source", "source_size", target.alias("target"))


def digits_of(size: Column) -> Column:
    """Digits of a size in base two; 0 has none."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0).cast("int")


def expectations(classes: DataFrame) -> DataFrame:
    """Copies that a document expects, ``expected``, per ``source`` and ``digits``.

    ``classes`` has the ``words`` of each, and its source's ``source_size`` and ``target``.
    Expectations are level * digits, but ``MAX_COPIES`` at most, and the expected words of a
    source are its target. The classes with the most digits are at the limit first, so
    running sums give the level at once, over at most 64 rows a source.
    """
    larger = Window.partitionBy("source").orderBy(F.desc("digits")).rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("source")
    weight = F.col("digits") * F.col("words")
    summed = classes.select(
        "*",
        F.coalesce(F.sum("words").over(larger), F.lit(0)).alias("words_before"),
        (F.sum(weight).over(own) - F.coalesce(F.sum(weight).over(larger), F.lit(0))).alias("weight_left"),
    )
    left = F.col("target") - F.col("words_before") * MAX_COPIES
    # At the limit: the level, were this the largest class below it, would lift it there.
    full = left * F.col("digits") >= F.col("weight_left") * MAX_COPIES
    marked = summed.withColumn("full", full & (F.col("digits") > 0))
    sums = marked.select(
        "*",
        F.sum(F.when(F.col("full"), F.col("words")).otherwise(0)).over(own).alias("full_words"),
        F.sum(F.when(F.col("full"), 0).otherwise(weight)).over(own).alias("open"),
    )
    level = (F.col("target") - F.col("full_words") * MAX_COPIES) / F.col("open")
    expected = (
        F.when(F.col("full"), F.lit(float(MAX_COPIES)))
        .when(F.col("digits") == 0, F.lit(0.0))
        .otherwise(F.greatest(F.least(level * F.col("digits"), F.lit(float(MAX_COPIES))), F.lit(0.0)))
    )
    return sums.select("source", "digits", "words", "source_size", "target", expected.alias("expected"))


def _plans(expected: DataFrame) -> DataFrame:
    """Per source and digits: whole copies, the probability of one more, and the words that
    the sample of the whole source takes."""
    copies = F.floor("expected").cast("long")
    certain = F.sum(copies * F.col("words")).over(Window.partitionBy("source"))
    return expected.select(
        "source",
        "digits",
        "source_size",
        "target",
        copies.alias("copies"),
        (F.col("expected") - copies).alias("probability"),
        (F.col("target") - certain).alias("to_take"),
    )


def _same_source(left: str, right: str) -> Column:
    return F.col(f"{left}.source").eqNullSafe(F.col(f"{right}.source"))


def _same_class(left: str, right: str) -> Column:
    return _same_source(left, right) & (F.col(f"{left}.digits") == F.col(f"{right}.digits"))


def cuts(units: DataFrame) -> DataFrame:
    """One row per source and class of size (``digits``): sizes, target, whole copies, the
    probability of one more and the source's last rank that is taken.

    ``units`` has source, doc_id, size and digits. Ranks are compared as (rank, doc_id).
    """
    units = checkpointed(units.withColumn("u", draw(F.col("doc_id"))))
    classes = checkpointed(units.groupBy("source", "digits").agg(F.sum("size").alias("words")))
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")))
    classes = classes.alias("c").join(targets.alias("t"), _same_source("c", "t"))
    classes = classes.select("c.*", "t.source_size", "t.target")
    plans = checkpointed(_plans(expectations(classes)))
    ranked = (
        units.alias("d")
        .join(broadcast_if_small(plans).alias("p"), _same_class("d", "p"))
        .filter("probability > 0")
        .select(
            "d.source",
            "d.doc_id",
            "size",
            "to_take",
            rank_of(F.col("u"), F.col("probability")).alias("rank"),
        )
        .withColumn("bin", _bin(F.col("rank")))
    )
    by_bin = ranked.groupBy("source", "to_take", "bin").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bin")
    crossing = (
        by_bin.withColumn("before", F.sum("words").over(running) - F.col("words"))
        .filter((F.col("before") <= F.col("to_take")) & (F.col("before") + F.col("words") > F.col("to_take")))
        .select("source", "bin", "before")
    )
    crossing = broadcast_if_small(checkpointed(crossing))
    # The documents of the one bin in which the words run out, a row for each id.
    inside = (
        ranked.alias("r")
        .join(crossing.alias("c"), _same_source("r", "c") & (F.col("r.bin") == F.col("c.bin")))
        .groupBy("r.source", "rank", "doc_id", "to_take", "before")
        .agg(F.sum("size").alias("size"))
    )
    in_order = Window.partitionBy("source").orderBy("rank", "doc_id")
    # A document is taken if more than half of it is still wanted.
    wanted = F.col("to_take") - (F.col("before") + F.sum("size").over(in_order) - F.col("size"))
    last = (
        inside.withColumn("taken", wanted * 2 > F.col("size"))
        .filter("taken")
        .groupBy("source")
        .agg(F.max(F.struct("rank", "doc_id")).alias("last"))
    )
    plans, crossing, last = plans.alias("p"), crossing.alias("c"), last.alias("l")
    return plans.join(crossing, _same_source("p", "c"), "left").join(
        last, _same_source("p", "l"), "left"
    ).select("p.*", "c.bin", "l.last")


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per document: ``doc`` (the whole input row), ``size``, ``source_size``,
    ``target``, ``copies`` and ``taken`` words."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(source).cast("string").alias("source"),
        F.col(doc_id).alias("doc_id"),
        n_words(F.col(text)).alias("size"),
    ).withColumn("digits", digits_of(F.col("size")))
    cut = broadcast_if_small(checkpointed(cuts(rows.drop("doc"))))
    chosen = rows.alias("d").join(cut.alias("p"), _same_class("d", "p"), "left")
    rank = rank_of(draw(F.col("d.doc_id")), F.col("probability"))
    at = F.struct(rank.alias("rank"), F.col("d.doc_id").alias("doc_id"))
    # Bins before the crossing are taken, bins after it are not; a source that never
    # runs out, which can only be by rounding, is taken as a whole.
    extra = (
        F.when((F.col("probability") <= 0) | rank.isNull(), False)
        .when(F.col("bin").isNull(), True)
        .when(_bin(rank) != F.col("bin"), _bin(rank) < F.col("bin"))
        .otherwise(F.coalesce(at <= F.col("last"), F.lit(False)))
    )
    copies = F.col("copies") + extra.cast("long")
    return chosen.select(
        "doc",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
