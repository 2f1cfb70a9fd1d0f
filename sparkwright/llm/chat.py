"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs (partially, on the map side),
sorted, cut into blocks of adjacent same-role turns, and concatenated under a
template:

    <turn>ROLE\\n TEXT [\\n<next>\\n TEXT ...] \\n</turn>\\n

``<next>`` separates the texts that were merged into one block.  A control
string inside a text (``<turn>``, ``</turn>``, ``<next>``) gets one more
backslash in front, so the template's own marks are the only ones without a
backslash and every text can be read back.  A role is one line: its
backslashes are doubled and its line feeds written as ``\\n``.

Defined results: a null role or text counts as empty; a null ``turn`` sorts
first; equal turns are ordered by role, then text, and repeated rows are all
kept; a null ``conv_id`` is one conversation of its own; an empty table gives
an empty result; other columns are ignored.  A formatted conversation is one
row, so one conversation must fit a task; the work is linear in its turns, but for
the running sums of the spans, which take a step per binary digit of their number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, NEXT, CLOSE = "<turn>", "\n<next>\n", "\n</turn>\n"
CONTROL = "<(?:/?turn|next)>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*{CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*{CONTROL})", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value worked out once: within a lambda a plain column would be
    worked out again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(turns: Column) -> Column:
    """Adjacent turns of one role as ``array<struct<role, texts>>``."""

    def cut(turns: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(turns) - 1)
        starts = F.filter(
            places, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, F.greatest(i - 1, F.lit(0)))["role"])
        )
        return _let(
            starts,
            lambda starts: F.transform(
                starts,
                lambda start, k: F.struct(
                    F.get(turns, start)["role"].alias("role"),
                    F.transform(
                        F.sequence(start, F.coalesce(F.get(starts, k + 1), F.size(turns)) - 1),
                        lambda i: F.get(turns, i)["text"],
                    ).alias("texts"),
                ),
            ),
        )

    return _let(turns, cut)


def _piece(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("s"), loss.alias("loss"))


def _pieces(blocks: Column, loss_role: str) -> Column:
    """The output in order, each piece with its loss flag."""
    no = F.lit(False)

    def block(b: Column) -> Column:
        texts = F.transform(
            b["texts"],
            lambda t, k: F.when(k == 0, F.array(_piece(escape(t), b["role"] == loss_role))).otherwise(
                F.array(_piece(F.lit(NEXT), no), _piece(escape(t), b["role"] == loss_role))
            ),
        )
        head = _piece(F.concat(F.lit(OPEN), _escape_role(b["role"]), F.lit("\n")), no)
        return F.concat(F.array(head), F.flatten(texts), F.array(_piece(F.lit(CLOSE), no)))

    return F.flatten(F.transform(blocks, block))


def _running(lengths: Column) -> Column:
    """Running sums of an array.  Each step adds the sums that end twice as far
    before, so there are as many steps as the array's size has binary digits."""
    start = F.struct(F.lit(1).alias("by"), lengths.alias("sums"))

    def step(acc: Column, _: Column) -> Column:
        by, sums = acc["by"], acc["sums"]
        added = F.transform(sums, lambda n, i: F.when(i < by, n).otherwise(n + F.get(sums, F.greatest(i - by, F.lit(0)))))
        return F.struct((by * 2).alias("by"), added.alias("sums"))

    digits = F.length(F.bin(F.size(lengths)))
    return F.aggregate(F.sequence(F.lit(1), digits), start, step, lambda acc: acc["sums"])


def _spans(pieces: Column) -> Column:
    """Start and length of every piece under the loss, in code points and bytes."""
    chars = F.transform(pieces, lambda p: F.char_length(p["s"]))
    octets = F.transform(pieces, lambda p: F.octet_length(p["s"]))

    def spans(ends: Column) -> Column:
        def span(p: Column, i: Column) -> Column:
            n, size = F.char_length(p["s"]), F.octet_length(p["s"])
            return F.when(
                p["loss"],
                F.struct(
                    (F.get(ends["chars"], i) - n).alias("start"),
                    n.alias("length"),
                    (F.get(ends["bytes"], i) - size).alias("first_byte"),
                    size.alias("bytes"),
                ),
            )

        return F.filter(F.transform(pieces, span), lambda x: x.isNotNull())

    return _let(F.struct(_running(chars).alias("chars"), _running(octets).alias("bytes")), spans)


def format_conversations(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_spans``: one row per conversation.

    ``loss_spans`` are the ranges of ``formatted`` that hold texts of
    ``loss_role``, in code points (``start, length``) and in bytes of UTF-8
    (``first_byte, bytes``); marks and separators are outside of them."""
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    blocks = turns.select("conv_id", _blocks(F.col("turns")).alias("blocks"))
    pieces = blocks.select("conv_id", _pieces(F.col("blocks"), loss_role).alias("pieces"))
    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["s"]), "").alias("formatted"),
        _spans(F.col("pieces")).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, ``array<struct<role, text>>``."""
    blocks = F.split(formatted, CLOSE)

    def turns(block: Column) -> Column:
        cut = F.locate("\n", block)
        role = _unescape_role(F.substr(block, F.lit(len(OPEN) + 1), cut - len(OPEN) - 1))
        texts = F.split(F.substr(block, cut + 1), NEXT)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), turns))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between.  Spans
    are cut by their bytes, which takes no count of code points from the start."""

    def cut(data: Column) -> Column:
        return F.transform(spans, lambda s: unescape(F.decode(F.substr(data, s["first_byte"] + 1, s["bytes"]), "UTF-8")))

    return F.array_join(_let(formatted.cast("binary"), cut), "")


def count_blocks(formatted: Column) -> Column:
    return (F.size(F.split(formatted, CLOSE)) - 1).cast("long")
