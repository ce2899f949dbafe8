"""Chat formatting in Spark expressions: turns are collected per conversation,
sorted, adjacent turns of one role merged, and the template concatenated.

    <|im_start|>role\\n text <|im_turn|> text <|im_end|>\\n

A message holds the turns of one role that follow each other, with
``<|im_turn|>`` between them. Inside roles and texts every ``<`` that stands
before backslashes and a ``|`` gets one more backslash, so no text can hold a
mark of the template, and taking that backslash away gives the text back. A line
break in a role is written as ``<|line|>``.

Defined results: a null text or role is empty; turns are sorted by turn (nulls
first), then role, then text, so ties and repeated rows are kept and lie in a
fixed order; rows with a null conv_id form one conversation with a null id; an
empty table gives an empty result; columns of other names play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

START, TURN, END, LINE = "<|im_start|>", "<|im_turn|>", "<|im_end|>", "<|line|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def role_line(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def format_chats(rows: DataFrame, loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """Conversations from rows of (conv_id, turn, role, text): conv_id, n_turns,
    ``formatted``, and ``loss_spans``, the (start, length) in code points of each
    text of ``loss_roles`` inside ``formatted``, as it stands there."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    turns = F.sort_array(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text"))))
    chats = rows.groupBy("conv_id").agg(turns.alias("turns"))
    # A message begins where the role changes and reaches to the next such turn.
    n = F.size("turns")
    changes = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    chats = chats.withColumn("begins", F.concat(changes, F.array(n)))

    def message_of(begin: Column, i: Column) -> Column:
        own = F.slice("turns", begin + 1, F.get("begins", i + 1) - begin)
        return F.struct(
            F.get(own, F.lit(0))["role"].alias("role"), F.transform(own, lambda t: t["text"]).alias("texts")
        )

    chats = chats.withColumn(
        "messages", F.transform(F.slice("begins", F.lit(1), F.size("begins") - 1), message_of)
    )

    def body(message: Column) -> Column:
        return F.array_join(F.transform(message["texts"], escape), TURN)

    def lay_out(message: Column) -> Column:
        return F.concat(F.lit(START), role_line(message["role"]), F.lit("\n"), body(message), F.lit(f"{END}\n"))

    chats = chats.withColumn("parts", F.transform("messages", lay_out))
    spans_so_far = F.struct(
        F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans")
    )

    def spans_of(state: Column, message: Column) -> Column:
        head = F.length(role_line(message["role"])) + len(START) + 1
        lengths = F.transform(message["texts"], lambda t: F.length(escape(t)).cast("long"))
        own = F.transform(
            lengths,
            lambda n, i: F.struct(
                (
                    state["at"]
                    + head
                    + F.aggregate(F.slice(lengths, F.lit(1), i), F.lit(0).cast("long"), lambda a, b: a + b)
                    + i * len(TURN)
                ).alias("start"),
                n.alias("length"),
            ),
        )
        learned = message["role"].isin(list(loss_roles))
        spans = F.when(learned, F.concat(state["spans"], own)).otherwise(state["spans"])
        return F.struct((state["at"] + F.length(lay_out(message))).alias("at"), spans.alias("spans"))

    laid = F.aggregate("messages", spans_so_far, spans_of, lambda s: s["spans"])
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join("parts", "").alias("formatted"),
        laid.alias("loss_spans"),
    )


def read_chats(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    messages = F.filter(F.split(formatted, r"\Q<|im_end|>\E\n"), lambda m: F.length(m) > 0)

    def turns_of(message: Column) -> Column:
        line = F.substring_index(F.substr(message, F.lit(len(START) + 1)), "\n", 1)
        role = unescape(F.replace(line, F.lit(LINE), F.lit("\n")))
        body = F.substr(message, F.position(F.lit("\n"), message) + 1)
        return F.transform(
            F.split(body, r"\Q<|im_turn|>\E"),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(messages, turns_of))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
        ),
        "",
    )
