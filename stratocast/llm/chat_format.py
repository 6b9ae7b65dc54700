"""Chat formatting with Spark expressions only.

A conversation becomes one text. Adjacent turns of one role share a block:

    <turn>ROLE
    TEXT<sep>TEXT</turn>

followed by a line feed. The three control strings <turn>, <sep> and </turn>
never occur in escaped texts: ``<``, any number of backslashes and the rest of
a control string get one more backslash after the ``<``; reading takes it away.
In roles a backslash is written \\b and a line feed \\n.

The turn structs of a conversation are collected and sorted, equal neighbours
are found by place, and each block's texts are joined as arrays. The loss mask
is an array of [begin, end) code points of the assistant's texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPEN, _SEP, _CLOSE = "<turn>", "<sep>", "</turn>\n"
_CONTROL = r"(turn>|sep>|/turn>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)" + _CONTROL, r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)" + _CONTROL, r"<$1$2")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def format_conversations(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """``turns`` (conv_id, turn, role, text; others are ignored) -> (conv_id,
    formatted string, loss_mask array<struct<begin, end>>), one row per conv_id.

    Turns are ordered by turn, then role, then escaped text, nulls first; repeated turns
    stay. A null text or role is empty. Rows of a null conv_id form one
    conversation. An empty table gives no rows. A mask is empty without texts of
    the role ``trained``; an empty text has an empty span.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), escape(F.coalesce("text", F.lit(""))).alias("text")
    )
    sorted_ = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    size = F.size("t")
    role = lambda i: F.element_at("t", i)["role"]  # noqa: E731  places count from 1
    # the first places of blocks, and behind the last block
    firsts = F.filter(F.sequence(F.lit(1), size), lambda i: (i == 1) | (role(i) != role(F.greatest(i - 1, F.lit(1)))))
    rows = sorted_.withColumn("f", F.concat(firsts, F.array(size + 1)))
    block = lambda k: F.struct(
        role(F.element_at("f", k)).alias("role"),
        F.transform(
            F.slice("t", F.element_at("f", k), F.element_at("f", k + 1) - F.element_at("f", k)), lambda x: x["text"]
        ).alias("texts"),
    )
    rows = rows.select("conv_id", F.transform(F.sequence(F.lit(1), F.size("f") - 1), block).alias("b"))
    head = lambda b: F.concat(F.lit(_OPEN), escape_role(b["role"]), F.lit("\n"))
    rows = rows.select(
        "conv_id",
        F.array_join(F.transform("b", lambda b: F.concat(head(b), F.array_join(b["texts"], _SEP), F.lit(_CLOSE))), "").alias("formatted"),
        # a text with what stands before it since the text before, as lengths
        F.flatten(
            F.transform(
                "b",
                lambda b: F.transform(
                    b["texts"],
                    lambda x, j: F.struct(
                        F.when(j == 0, F.length(head(b)) + len(_CLOSE)).otherwise(len(_SEP)).alias("gap"),
                        F.length(x).alias("size"),
                        (b["role"] == trained).alias("trained"),
                    ),
                ),
            )
        ).alias("parts"),
    )
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(-len(_CLOSE)).alias("at"), F.expr("cast(array() as array<struct<begin:int,end:int>>)").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + p["size"]).alias("at"),
            F.when(
                p["trained"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + p["gap"]).alias("begin"),
                            (acc["at"] + p["gap"] + p["size"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return rows.select("conv_id", "formatted", spans.alias("loss_mask"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: array<struct<role, text>>."""
    blocks = F.filter(F.split(formatted, _CLOSE), lambda b: b != "")
    body = lambda b: F.substring(b, F.lit(len(_OPEN) + 1), F.length(b))
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.regexp_extract(body(b), r"(?s)^[^\n]*\n(.*)$", 1), _SEP),
                lambda x: F.struct(
                    unescape_role(F.regexp_extract(body(b), r"^([^\n]*)\n", 1)).alias("role"), unescape(x).alias("text")
                ),
            ),
        )
    )


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, in order and with nothing between."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substring(formatted, s["begin"] + 1, s["end"] - s["begin"]))), "")
