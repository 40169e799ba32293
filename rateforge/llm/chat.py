"""Chat formatting of conversation turns, in DataFrame expressions only.

A conversation's turn structs are collected and sorted; adjacent turns of one
role are merged with an array aggregation into one message, whose parts stay
apart by a mark; messages are concatenated into one string:

    <|im_start|>ROLE<|im_sep|>TEXT[<|im_cont|>TEXT ...]<|im_end|>

Control strings in roles and texts (these marks and those of other common
templates) are escaped: a word joiner is put after their first character, and
a word joiner of the text is doubled. Reading back undoes both, so every text
returns exactly. The loss mask is a list of (start, length) spans in code
points, one for each assistant text.

Defined cases: a null text is empty, a null role is the empty role; turns are
ordered by turn (null first), role, text, so repeated rows are turns of their
own in a fixed order; rows with a null ``conv_id`` form one conversation; extra
columns are ignored; an empty table gives no rows. A conversation is one row of
the output, so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, CONT, END = "<|im_start|>", "<|im_sep|>", "<|im_cont|>", "<|im_end|>"
#: Control strings escaped inside texts: the template's own and other common ones.
CONTROL = [START, SEP, CONT, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
JOINER = "\u2060"
LOSS_ROLE = "assistant"


def _quote(literal: str) -> str:
    return "".join(f"\\{c}" if c in r"\[](){}|.*+?^$" else c for c in literal)


_CONTROL_PATTERN = "([<\\[])(?=" + "|".join(_quote(c[1:]) for c in CONTROL) + ")"


def escape(text: Column) -> Column:
    """``text`` without control strings; ``unescape`` gives it back."""
    doubled = F.replace(text, F.lit(JOINER), F.lit(JOINER * 2))
    return F.regexp_replace(doubled, _CONTROL_PATTERN, "$1" + JOINER)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"{JOINER}({JOINER}?)", "$1")


def merged_turns(turns: Column) -> Column:
    """Messages (role, parts) of sorted turns (role, text): adjacent turns of one role become one."""
    # The places where a run of one role starts; a fold that copies the messages
    # at every turn would be quadratic in a long conversation.
    n = F.size(turns)
    starts = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
    )
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(n))
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(
            F.get(turns, a)["role"].alias("role"),
            F.transform(F.slice(turns, a + 1, b - a), lambda t: t["text"]).alias("parts"),
        ),
    )


def format_conversations(conversations: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, formatted, loss_spans) of each conversation (conv_id, turn, role, text)."""
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Sorted as they are, then escaped: equal turns stand in the order of their own texts.
    ordered = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    escaped = F.transform("turns", lambda t: F.struct(t["turn"], escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    grouped = ordered.select("conv_id", escaped.alias("turns"))
    messages = grouped.select("conv_id", merged_turns(F.col("turns")).alias("messages"))
    pieces = messages.select("conv_id", _formatted("messages"), _pieces("messages", loss_role))
    return pieces.select("conv_id", "formatted", _blocks("pieces")).select("conv_id", "formatted", _loss_spans("blocks"))


def _formatted(messages: str) -> Column:
    shown = F.transform(
        messages, lambda m: F.concat(F.lit(START), m["role"], F.lit(SEP), F.array_join(m["parts"], CONT), F.lit(END))
    )
    return F.array_join(shown, "").alias("formatted")


def _pieces(messages: str, loss_role: str) -> Column:
    """All parts in order: the lengths of what stands before, of the part, and of what stands after it; whether it is a loss text."""
    return F.flatten(
        F.transform(
            messages,
            lambda m: F.transform(
                m["parts"],
                # what stands before a part: the header, or the mark between parts
                lambda part, i: F.struct(
                    F.when(i == 0, F.length(m["role"]) + len(START) + len(SEP)).otherwise(F.lit(len(CONT))).alias("head"),
                    F.length(part).alias("length"),
                    F.when(i == F.size(m["parts"]) - 1, F.lit(len(END))).otherwise(F.lit(0)).alias("foot"),
                    (m["role"] == loss_role).alias("loss"),
                ),
            ),
        )
    ).alias("pieces")


def _blocks(pieces: str) -> Column:
    """The pieces in blocks of about the root of their number."""
    n = F.size(pieces)
    size = F.ceil(F.sqrt(n)).cast("int")
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(n / size).cast("int") - 1, F.lit(0)))
    return F.transform(numbers, lambda j: F.slice(pieces, j * size + 1, size)).alias("blocks")


def _loss_spans(blocks: str) -> Column:
    """Spans of the loss role's texts, by a running position over all parts.

    A fold that appends copies what it holds at every step. Blocks are folded
    apart, from position 0, and then moved to where they begin, so that a long
    conversation costs its length times a block, not the square of its length.
    """
    at = F.lit(0).cast("long").alias("at")
    in_block = F.transform(
        blocks,
        lambda own: F.aggregate(
            own,
            F.struct(at, F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
            lambda s, p: F.struct(
                (s["at"] + p["head"] + p["length"] + p["foot"]).cast("long").alias("at"),
                F.when(
                    p["loss"],
                    F.concat(
                        s["spans"],
                        F.array(
                            F.struct((s["at"] + p["head"]).cast("long").alias("start"), p["length"].cast("long").alias("length"))
                        ),
                    ),
                )
                .otherwise(s["spans"])
                .alias("spans"),
            ),
        ),
    )
    return F.aggregate(
        in_block,
        F.struct(at, F.array().cast("array<array<struct<start:bigint,length:bigint>>>").alias("spans")),
        lambda s, block: F.struct(
            (s["at"] + block["at"]).alias("at"),
            F.concat(
                s["spans"],
                F.array(
                    F.transform(
                        block["spans"],
                        lambda x: F.struct((s["at"] + x["start"]).alias("start"), x["length"].alias("length")),
                    )
                ),
            ).alias("spans"),
        ),
        lambda s: F.flatten(s["spans"]),
    ).alias("loss_spans")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds, unescaped."""
    blocks = F.filter(F.split(formatted, _quote(START), -1), lambda b: b != "")
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(
                    F.substring(
                        b,
                        F.instr(b, SEP) + len(SEP),
                        F.length(b) - F.instr(b, SEP) - len(SEP) - len(END) + 1,
                    ),
                    _quote(CONT),
                    -1,
                ),
                lambda part: F.struct(
                    unescape(F.substring_index(b, SEP, 1)).alias("role"), unescape(part).alias("text")
                ),
            ),
        )
    )


def masked_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    texts = F.transform(
        loss_spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))
    )
    return F.array_join(texts, "")
