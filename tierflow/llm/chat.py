r"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes one example: all turns before it as context, and only its own text trainable. A conversation
with turns after its last reply (or without any reply) gets one more example without a trainable part, so that no turn
is lost. A turn is written ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and texts ``<|`` cannot occur: a
backslash goes between ``<`` (and any backslashes after it) and ``|``, and ``unescape`` takes exactly one away again. In
roles ``%`` and line breaks are percent-coded, so that the first line break ends the role.

Defined cases: a null role or text counts as an empty one; turns are ordered by turn number (null first), then role, then
text, so repeated rows stay as repeated turns; a null conversation id is an id like any other; an empty table gives an
empty one; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINABLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def encode_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def decode_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, example, n_turns, text, loss_start, loss_chars)`` per example.

    ``example`` counts from 1, ``n_turns`` is the number of turns in ``text``, and the trainable part is ``loss_chars``
    code points of ``text`` from ``loss_start`` (0-based; null without one).
    """
    rows = turns.select(
        F.col(conv), F.col(turn), F.coalesce(F.col(role), F.lit("")).alias("__role"), F.coalesce(F.col(text), F.lit("")).alias("__text")
    )
    rows = rows.withColumn("__body", escape(F.col("__text")))
    rows = rows.withColumn("__head", F.concat(F.lit(START), encode_role(F.col("__role")), F.lit("\n")))
    rows = rows.withColumn("__piece", F.concat("__head", "__body", F.lit(END + "\n")))
    order = Window.partitionBy(conv).orderBy(F.col(turn).asc_nulls_first(), "__role", "__text")
    sofar = order.rowsBetween(Window.unboundedPreceding, 0)
    reply = F.col("__role") == TRAINABLE
    rows = rows.withColumns({
        "n_turns": F.row_number().over(order).cast("long"),
        "example": F.sum(reply.cast("long")).over(sofar),
        "__last": F.lead(F.lit(1)).over(order).isNull(),
        "text": F.array_join(F.collect_list("__piece").over(sofar), ""),
    })
    rows = rows.where(reply | F.col("__last"))
    after = F.length("__body") + F.lit(len(END) + 1)
    return rows.select(
        conv,
        F.when(reply, F.col("example")).otherwise(F.col("example") + 1).alias("example"),
        "n_turns",
        "text",
        F.when(reply, F.length("text") - after).alias("loss_start"),
        F.when(reply, F.length("__body")).otherwise(F.lit(0)).alias("loss_chars"),
    )


def trained_text(formatted: DataFrame) -> Column:
    """The reply under the loss mask of an example, as it was before escaping; null without one."""
    body = F.substring(formatted["text"], formatted["loss_start"] + 1, formatted["loss_chars"])
    return F.when(formatted["loss_start"].isNotNull(), unescape(body))


def parse(text: Column) -> Column:
    """The turns of a formatted text as ``array<struct<role, text>>``."""
    pieces = F.filter(F.split(text, START.replace("|", r"\|")), lambda p: p != "")

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        size = F.length(piece) - F.length(head) - F.lit(len(END) + 2)
        return F.struct(decode_role(head).alias("role"), unescape(F.substring(piece, F.length(head) + 2, size)).alias("text"))

    return F.transform(pieces, turn)


def digest(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the examples of each conversation hold, read back from them. The examples already lie together by conversation."""
    rows = formatted.withColumn("__trained", trained_text(formatted))
    grouped = rows.groupBy(conv).agg(
        F.max(F.struct("n_turns", "text")).alias("__whole"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"),
        F.array_sort(F.collect_list(F.when(F.col("loss_start").isNotNull(), F.struct("example", F.col("__trained").alias("text"))))).alias("__replies"),
    )
    turns = F.transform(parse(F.col("__whole.text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    replies = F.array_join(F.transform("__replies", lambda r: r["text"]), "")
    grouped = grouped.withColumns({"__turns": turns, "__loss": replies})
    return grouped.select(
        conv,
        F.size("__turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("__turns", "").cast("binary"), 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("__loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
