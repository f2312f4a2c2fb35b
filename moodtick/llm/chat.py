"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context,
its reply alone trainable. The template writes a turn as

    <|turn|>role<|says|>text<|end|>

and a control string inside a role or text is broken by a backslash after its first
character (a backslash is doubled), so the marks of the template stand only where
the template put them and every text can be read back. Everything is DataFrame
functions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template, and the strings broken in texts ("<|" also
# covers the marks).
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED = "assistant"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(f"{s[0]}\\{s[1:]}"))
    return c


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def examples(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per assistant turn: conv_id, example (1, 2, ...), n_turns (context and
    reply), text (formatted), loss_start and loss_length (code points of ``text`` to
    train on: the escaped reply without the marks).

    A conversation whose last turn is no assistant's has one example more, of all its
    turns, with loss_length 0; so every turn stands in the output. Turns go by
    (turn, role, text), a null turn first; repeated rows are turns of their own; null
    roles and texts are empty. Rows with a null conv_id are one conversation. Extra
    columns are not read; an empty table has no examples. The output is by its nature
    quadratic in the length of a conversation; a conversation fits in a row."""
    own = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    turns = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(SAYS))
    shaped = turns.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                head(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == TRAINED).alias("trained")
            ),
        ).alias("turns"),
    )
    n = F.size("turns")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: F.col("turns")[i - 1]["trained"] | (i == n))
    each = shaped.select("conv_id", "turns", F.posexplode(ends).alias("k", "n_turns"))
    whole = lambda t: F.concat(t["head"], t["body"], F.lit(END))
    last = F.col("turns")[F.col("n_turns") - 1]
    context = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("n_turns") - 1), whole), "")
    parts = each.select(
        "conv_id", (F.col("k") + 1).alias("example"), "n_turns", context.alias("context"), last.alias("last")
    )
    return parts.select(
        "conv_id",
        "example",
        "n_turns",
        F.concat("context", "last.head", "last.body", F.lit(END)).alias("text"),
        (F.length("context") + F.length("last.head")).alias("loss_start"),
        F.when(F.col("last.trained"), F.length("last.body")).otherwise(0).alias("loss_length"),
    )


def loss_text(example_text: str = "text") -> Column:
    """The trained text of an example, unescaped."""
    return unescape(F.substring(example_text, F.col("loss_start") + 1, F.col("loss_length")))


def turns(formatted: Column) -> Column:
    """Formatted text read back: an array of (role, text)."""
    pieces = F.filter(F.split(formatted, re.escape(END)), lambda x: x != "")
    pair = lambda x: F.split(F.substr(x, F.lit(len(TURN) + 1)), re.escape(SAYS), 2)
    return F.transform(
        pieces, lambda x: F.struct(unescape(pair(x)[0]).alias("role"), unescape(pair(x)[1]).alias("text"))
    )


def read_back(found: DataFrame) -> DataFrame:
    """The rows of ``examples`` -> one row per conversation: conv_id, turns (role, text) of
    its longest example, loss (the trained texts of its examples, in order),
    formatted_chars of the longest example, n_examples and example_chars of all."""
    return (
        found.groupBy("conv_id")
        .agg(
            F.max_by("text", "n_turns").alias("whole"),
            F.sort_array(F.collect_list(F.struct("example", loss_text().alias("text")))).alias("losses"),
            F.count("*").alias("n_examples"),
            F.sum(F.length("text").cast("long")).alias("example_chars"),
        )
        .select(
            "conv_id",
            turns(F.col("whole")).alias("turns"),
            F.array_join(F.transform("losses", lambda x: x["text"]), "").alias("loss"),
            F.length("whole").cast("long").alias("formatted_chars"),
            "n_examples",
            "example_chars",
        )
    )
