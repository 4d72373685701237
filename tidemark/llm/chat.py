"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns up to it are the
context, and only that reply is trainable. The template is

    ### <role>: <text></turn>\n

with role and text escaped, so no text can look like a mark: a backslash becomes
``\\b``, ``#`` becomes ``\\h``, ``<`` becomes ``\\l`` and, in roles, ``:`` becomes ``\\c``.
An escaped text holds neither ``#`` nor ``<``, hence no mark, and each backslash
in it starts exactly one code, so unescaping restores every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MID, CLOSE = "### ", ": ", "</turn>\n"
TARGET = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    out = F.replace(out, F.lit("#"), F.lit("\\h"))
    return F.replace(out, F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\l"), F.lit("<"))
    out = F.replace(out, F.lit("\\h"), F.lit("#"))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\c"), F.lit(":")))


def format_examples(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, example, formatted, loss_start, loss_length, trainable.

    One row per assistant turn of each conversation, numbered from 0 in turn order,
    with the formatted prefix that ends with that turn. The loss mask is the range of
    ``loss_length`` code points from ``loss_start`` (0-based) in ``formatted``: the
    escaped reply. Turns after the last assistant turn, or a conversation without one, give a last
    row with ``trainable`` false and an empty mask, so that no turn is lost.

    Null texts and roles count as empty; turns with equal numbers (nulls first)
    go by role and then text, repeated rows all stay. Rows with a null
    conversation form one conversation. An empty table gives no rows.

    A conversation is rendered once into one string, as its longest example needs anyway;
    examples are prefixes of it.
    """
    role = F.coalesce(F.col(f"`{role_col}`"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rendered = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.concat(F.lit(OPEN), _escape_role(role), F.lit(MID)).alias("head"),
        escape(text).alias("body"),
    )
    before = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = rendered.select(
        "conv_id",
        (F.col("role") == TARGET).alias("target"),
        F.char_length("head").cast("bigint").alias("head_chars"),
        F.char_length("body").cast("bigint").alias("body_chars"),
        F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
        F.sum(F.char_length("head") + F.char_length("body") + F.lit(len(CLOSE)))
        .over(before.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("stop"),
    )
    # Same partitioning as the window: the grouping adds no shuffle.
    convs = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("stop", "target", "head_chars", "body_chars", "piece"))).alias("ts")
    )
    last = F.size("ts") - 1
    convs = convs.select(
        "conv_id",
        F.array_join(F.transform("ts", lambda t: t["piece"]), "").alias("whole"),
        F.transform(
            F.filter("ts", lambda t, i: t["target"] | (i == last)),
            lambda t: F.struct(t["stop"], t["target"], t["body_chars"]),
        ).alias("wanted"),
    )
    return convs.select("conv_id", "whole", F.posexplode("wanted").alias("example", "t")).select(
        "conv_id",
        "example",
        F.substring(F.col("whole"), F.lit(1), F.col("t.stop").cast("int")).alias("formatted"),
        (F.col("t.stop") - F.lit(len(CLOSE)) - F.col("t.body_chars")).alias("loss_start"),
        F.when(F.col("t.target"), F.col("t.body_chars")).otherwise(F.lit(0).cast("bigint")).alias("loss_length"),
        F.col("t.target").alias("trainable"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted string, unescaped."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")
    return F.transform(
        blocks,
        lambda b: F.struct(
            _unescape_role(F.substring(F.substring_index(b, MID, 1), F.lit(len(OPEN) + 1), F.char_length(b))).alias("role"),
            unescape(
                F.substring(b, F.char_length(F.substring_index(b, MID, 1)) + F.lit(len(MID) + 1), F.char_length(b))
            ).alias("text"),
        ),
    )


def masked_text(formatted: Column, start: Column, length: Column) -> Column:
    """The text under an example's loss mask, unescaped."""
    return unescape(F.substring(formatted, (start + 1).cast("int"), length.cast("int")))


def conversation_digest(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted examples: n_turns, turns_sha256,
    loss_chars, loss_sha256 and formatted_chars (all examples together)."""
    part = examples.select(
        "conv_id",
        "example",
        F.char_length("formatted").cast("bigint").alias("chars"),
        masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_length")).alias("reply"),
        "formatted",
    )
    # The last example holds every turn; max over (example, formatted) keeps one string per conversation.
    rows = part.groupBy("conv_id").agg(
        F.max(F.struct("example", "formatted"))["formatted"].alias("whole"),
        F.sum("chars").alias("formatted_chars"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "reply"))), lambda x: x["reply"]), "").alias("loss"),
    )
    rows = rows.withColumn("ts", read_turns(F.col("whole")))
    flat = F.array_join(F.transform("ts", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "conv_id",
        F.size("ts").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(flat, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
