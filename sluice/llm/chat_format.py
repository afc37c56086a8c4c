r"""Chat formatting: conversations as training texts with a loss mask, in Spark expressions.

A conversation's turns are collected with one shuffle on its id and sorted as structs;
adjacent turns of one role become one block by array aggregation; blocks are
concatenated under a template. Roles and texts are escaped, so control strings inside
them never act as marks, and ``read_back`` gives the exact turns again.

Template (fixed marks): each block is ``<|start|>role<|text|>text<|next|>text<|end|>\n``,
where ``<|next|>`` stands between merged turns. Escaping doubles a backslash and puts one
after the first character of a control string, so no text holds a mark and removing one
backslash before each character undoes it.

Defined results: turns are ordered by (turn, role, text), null turn numbers first;
repeated rows are all kept; a null text or role counts as empty; rows with a null id are
one conversation; an empty table gives no rows; other columns of the input are ignored.
A conversation is one row of the result, so it has to fit a task; different
conversations share nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

# The template's marks.
START, TEXT, NEXT, END = "<|start|>", "<|text|>", "<|next|>", "<|end|>"
# Control strings of the template and of common chat formats, as a pattern.
CONTROL = r"(<|\[)(\||/?s>|/?INST\]|</?SYS>>)"
TRAINED_ROLE = "assistant"

_BLOCKS = "array<struct<role:string,texts:array<string>>>"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _turns(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its id and its turns in order."""
    empty = F.lit("")
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    return conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def merge_turns(turns: Column) -> Column:
    """Blocks of adjacent turns with one role: the role and the texts in order."""

    def add(blocks: Column, turn: Column) -> Column:
        last = F.get(blocks, F.size(blocks) - 1)
        longer = F.struct(
            turn["role"].alias("role"),
            F.concat(last["texts"], F.array(turn["text"])).alias("texts"),
        )
        new = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        return F.when(
            F.coalesce(last["role"] == turn["role"], F.lit(False)),
            F.concat(F.slice(blocks, F.lit(1), F.size(blocks) - 1), F.array(longer)),
        ).otherwise(F.concat(blocks, F.array(new)))

    return F.aggregate(turns, F.array().cast(_BLOCKS), add)


def _piece(text: Column, trained: Column) -> Column:
    return F.struct(text.alias("text"), trained.alias("trained"))


def _pieces(blocks: Column) -> Column:
    """The output in pieces, in order, each wholly under the loss mask or wholly outside."""

    def block_pieces(block: Column) -> Column:
        trained = block["role"] == TRAINED_ROLE
        head = F.concat(F.lit(START), escape(block["role"]), F.lit(TEXT))

        def text_pieces(text: Column, k: Column) -> Column:
            mark = F.when(k == 0, head).otherwise(F.lit(NEXT))
            return F.array(_piece(mark, F.lit(False)), _piece(escape(text), trained))

        texts = F.flatten(F.transform(block["texts"], text_pieces))
        return F.concat(texts, F.array(_piece(F.lit(END + "\n"), F.lit(False))))

    return F.flatten(F.transform(blocks, block_pieces))


def _spans(pieces: Column) -> Column:
    """(start, length) in code points of each piece under the mask, starts counted from 0."""
    spans = "array<struct<start:bigint,length:bigint>>"
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(spans).alias("spans"))

    def add(s: Column, piece: Column) -> Column:
        length = F.length(piece["text"]).cast("long")
        span = F.array(F.struct(s["at"].alias("start"), length.alias("length")))
        return F.struct(
            (s["at"] + length).alias("at"),
            F.when(piece["trained"], F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"),
        )

    return F.aggregate(pieces, state, add, lambda s: s["spans"])


def format_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted`` text and ``loss_spans`` of (start, length) in code points."""
    return _turns(conversations).select(
        "conv_id",
        let(
            _pieces(merge_turns(F.col("turns"))),
            lambda pieces: F.struct(
                F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("formatted"),
                _spans(pieces).alias("loss_spans"),
            ),
        ).alias("out"),
    ).select("conv_id", "out.*")


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text: (role, text) in order, merged turns apart again."""
    blocks = F.split(formatted, F.lit(r"\Q" + END + r"\E\n"))

    def turns(block: Column) -> Column:
        def parsed(parts: Column) -> Column:
            role = unescape(F.substring(F.get(parts, F.lit(0)), len(START) + 1, 1 << 30))
            texts = F.split(F.get(parts, F.lit(1)), F.lit(r"\Q" + NEXT + r"\E"))
            return F.transform(
                texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
            )

        return let(F.split(block, F.lit(r"\Q" + TEXT + r"\E")), parsed)

    return F.flatten(F.transform(F.filter(blocks, lambda b: b != ""), turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between its parts."""
    part = F.transform(
        spans,
        lambda s: unescape(
            F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))
        ),
    )
    return F.array_join(part, "")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be checked of formatted conversations, read back from the output alone."""

    def of_turns(turns: Column) -> Column:
        text = F.array_join(
            F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
            "",
        )
        return F.struct(
            F.size(turns).cast("long").alias("n_turns"),
            F.sha2(text, 256).alias("turns_sha256"),
        )

    def of_loss(text: Column) -> Column:
        return F.struct(
            F.length(text).cast("long").alias("loss_chars"),
            F.sha2(text, 256).alias("loss_sha256"),
        )

    return formatted.select(
        "conv_id",
        let(read_back(F.col("formatted")), of_turns).alias("t"),
        let(loss_text(F.col("formatted"), F.col("loss_spans")), of_loss).alias("l"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select("conv_id", "t.*", "l.*", "formatted_chars")
