"""Chat formatting with Spark expressions only.

The template of a conversation is one block for each run of adjacent turns of one role:

    <|turn|>ROLE<|text|>TEXT<|next|>TEXT<|end|>

Control strings inside roles and texts, this template's and the common ones of others
(</s>, <s>, [INST], [/INST], <<SYS>>, <</SYS>>, <|...|>), are broken by a backslash after
their first character, and backslashes are doubled; dropping one backslash before any
character reverses both.  So a control string in the output is always the template's own.

The turns of a conversation are collected as structs, sorted, folded into blocks by an
array aggregation, and concatenated.  `loss_spans` are the code-point ranges of assistant
texts in the output; marks, roles and other texts carry no loss.

Turns are ordered by turn, then role, then text; a null turn comes first and a repeated row
is a turn of its own.  Null roles and texts count as empty.  Rows with a null conv_id form
one conversation.  An empty table gives no rows.  Other columns are ignored.  One output
row holds one conversation, so a conversation must fit in a task; conversations do not share
one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOSS_ROLE = "assistant"

# The template's marks.
TURN, TEXT, NEXT, END = "<|turn|>", "<|text|>", "<|next|>", "<|end|>"

#: First characters of control strings, and the bar of a closing mark.
_CONTROL = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])|\|(?=>))"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, and loss_spans (array of start and length, code points from 0)."""
    clean = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    chats = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    kind = "array<struct<role:string,texts:array<string>>>"

    def fold(blocks: Column, t: Column) -> Column:
        last = F.element_at(blocks, -1)
        text = F.array(escape(t["text"]))
        more = F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(F.struct(last["role"].alias("role"), F.concat(last["texts"], text).alias("texts"))))
        new = F.concat(blocks, F.array(F.struct(t["role"].alias("role"), text.alias("texts"))))
        return F.when(F.size(blocks) == 0, new).when(last["role"] == t["role"], more).otherwise(new)

    blocks = F.aggregate("turns", F.array().cast(kind), fold)
    # each block as pieces (text, under loss); positions are the running lengths
    loss = lambda b: b["role"] == LOSS_ROLE
    piece = lambda text, flag: F.struct(text.alias("text"), flag.alias("loss"))
    texts = lambda b: F.flatten(F.transform(b["texts"], lambda x, i: F.array(
        piece(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT)), F.lit(False)), piece(x, loss(b)))))
    pieces = F.flatten(F.transform("blocks", lambda b: F.concat(
        F.array(piece(F.concat(F.lit(TURN), escape(b["role"]), F.lit(TEXT)), F.lit(False))), texts(b), F.array(piece(F.lit(END), F.lit(False))))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def mark(state: Column, p: Column) -> Column:
        n = F.length(p["text"])
        span = F.array(F.struct(state["at"].alias("start"), n.alias("length")))
        return F.struct((state["at"] + n).alias("at"), F.when(p["loss"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return (chats.select("conv_id", blocks.alias("blocks")).select("conv_id", pieces.alias("pieces"))
            .select("conv_id", _joined(F.transform("pieces", lambda p: p["text"])).alias("formatted"),
                    F.aggregate("pieces", start, mark)["spans"].alias("loss_spans")))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, one for each turn that went in."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda b: b != "")

    def turns(block: Column) -> Column:
        halves = F.split(F.substring(block, len(TURN) + 1, 2**31 - 1), r"<\|text\|>", 2)
        role = unescape(F.element_at(halves, 1))
        return F.transform(F.split(F.element_at(halves, 2), r"<\|next\|>", -1), lambda x: F.struct(role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return _joined(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))))


def read_back(chats: DataFrame) -> DataFrame:
    """What format_conversations() wrote, as read from its output: counts and digests."""
    turns = read_turns(F.col("formatted"))
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    said = _joined(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return (chats.select("conv_id", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                    F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"))
