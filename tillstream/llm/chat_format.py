"""Chat formatting with Spark expressions.

A conversation's turns are collected as structs, sorted, and neighbours of one role are
merged into a block; the blocks' texts are joined with control strings. Control strings
inside texts are escaped, so that the formatted text can be read back exactly. All array
work is linear in the number of turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the control strings of the template
START, END, NEXT = "<|im_start|>", "<|im_end|>\n", "<|im_next|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """``text`` without any ``<|``: backslashes doubled, then one put inside each ``<|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def format_chats(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """``conv_id``, ``segments`` and ``formatted`` for each conversation.

    Turns are ordered by number, then role, then text, nulls first; rows that repeat are
    turns of their own. A null role or text is empty; turns with a null id are one
    conversation. Neighbouring turns of one role share a block. ``segments`` are texts
    with ``train``, true for the texts of ``loss_role``; put together they are
    ``formatted``. Texts are taken whole. An empty table gives an empty one; other columns
    are not looked at.
    """
    row = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    count = F.size("turns")
    starts = F.filter(
        F.sequence(F.lit(0), count - 1),
        lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"]),
    )
    with_starts = sorted_turns.withColumn("starts", starts)
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(count))
    blocks = F.zip_with(
        "starts",
        ends,
        lambda a, b: F.struct(
            F.col("turns")[a]["role"].alias("role"),
            F.transform(F.slice("turns", a + 1, b - a), lambda t: t["text"]).alias("texts"),
        ),
    )

    def plain(text: Column) -> Column:
        return F.struct(text.alias("text"), F.lit(False).alias("train"))

    def of_block(b: Column) -> Column:
        texts = F.transform(
            b["texts"],
            lambda t, i: F.array(
                plain(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT))),
                F.struct(escape(t).alias("text"), (b["role"] == loss_role).alias("train")),
            ),
        )
        head = F.concat(F.lit(START), _escape_role(b["role"]), F.lit("\n"))
        return F.concat(F.array(plain(head)), F.flatten(texts), F.array(plain(F.lit(END))))

    segments = F.filter(F.flatten(F.transform(blocks, of_block)), lambda s: (s["text"] != "") | s["train"])
    return with_starts.select("conv_id", segments.alias("segments")).select(
        "conv_id",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of ``role`` and ``text``."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def of_block(b: Column) -> Column:
        body = F.substring(b, F.lit(len(START) + 1), F.length(b))
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substring(body, F.length(role) + 2, F.length(body)), r"<\|im_next\|>")
        return F.transform(
            texts,
            lambda t: F.struct(_unescape_role(role).alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, of_block))


def loss_text(segments: Column) -> Column:
    """All text that is trained on, as it was before escaping."""
    trained = F.filter(segments, lambda s: s["train"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["text"])), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from ``formatted`` and ``segments``, as counts and digests."""
    turns = F.transform(
        read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    read = formatted.select(
        "conv_id", "formatted", turns.alias("turns"), loss_text(F.col("segments")).alias("loss")
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
