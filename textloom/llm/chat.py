"""Chat formatting in Spark expressions only: sorted turns, merged speakers, one string a conversation, and what of it is trained on.

A block is ``<|im_start|>role<|im_sep|>text<|im_end|>``. Adjacent turns of one role are merged into one block whose texts are
parted by ``<|im_next|>``, so every row can be read back. Control strings inside roles and texts, those of this template and of
other common ones, get a backslash after their first character (one more where some stand there already); taking one away
restores the text exactly. The loss mask is an array of (start, end) code points of the formatted string: the text of each
assistant turn, without marks.

Defined results: a null text is empty, a null role is the empty role; turns sort by turn (null first), then role, then text, so
repeated rows stay, side by side; rows without a conversation id cannot be put together, so each is a conversation of its own
under a null id; an empty table gives an empty result; other columns of the input are not read.
A conversation is one string, so its rows meet in one task; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>"
TRAINED = "assistant"
#: First character, backslashes, rest of every control string.
_CONTROL = r"(<|\[)(\\*)(\||s>|/s>|/?INST\]|</?SYS>>)"
_ESCAPED = r"(<|\[)\\(\\*)(\||s>|/s>|/?INST\]|</?SYS>>)"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, _CONTROL, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _ESCAPED, "$1$2$3")


def _blocks(turns: Column) -> Column:
    """array<struct<role, texts>>: adjacent turns of one role in one block. Block starts are found first, so the array is cut once."""
    n = F.size(turns)
    at = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.element_at(turns, i).getField("role") != F.element_at(turns, F.greatest(i - 1, F.lit(1))).getField("role")))
    ends = F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(n + 1))
    pair = F.arrays_zip(at.alias("a"), ends.alias("b"))
    return F.transform(pair, lambda p: F.struct(F.element_at(turns, p.getField("a")).getField("role").alias("role"), F.transform(F.slice(turns, p.getField("a"), p.getField("b") - p.getField("a")), lambda t: t.getField("text")).alias("texts")))


def _spans(blocks: Column) -> Column:
    """Spans of trained texts: lengths run along the blocks, and along the texts of a block."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def block(acc: Column, b: Column) -> Column:
        begin = acc["at"] + len(START) + F.length(b["role"]) + len(SEP)
        first = F.struct(begin.cast("long").alias("at"), acc["spans"].alias("spans"))

        def text(x: Column, t: Column) -> Column:
            end = x["at"] + F.length(t)
            span = F.array(F.struct(x["at"].alias("start"), end.cast("long").alias("end")))
            return F.struct((end + len(NEXT)).cast("long").alias("at"), F.when(b["role"] == TRAINED, F.concat(x["spans"], span)).otherwise(x["spans"]).alias("spans"))

        done = F.aggregate(b["texts"], first, text)
        return F.struct((done["at"] - len(NEXT) + len(END)).cast("long").alias("at"), done["spans"].alias("spans"))

    return F.aggregate(blocks, zero, block)["spans"]


def format_chats(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, formatted, loss_spans) per conversation; spans are in code points, start inclusive, end exclusive."""
    role, text = (escape(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in (role_col, text_col))
    rows = conversations.select(F.col(id_col).alias("id"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    whole = rows.where("id is not null").groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    alone = rows.where("id is null").select("id", F.array("t").alias("turns"))
    blocks = whole.unionByName(alone).select("id", _blocks(F.col("turns")).alias("blocks"))
    body = F.transform("blocks", lambda b: F.concat(F.lit(START), b["role"], F.lit(SEP), F.array_join(b["texts"], NEXT), F.lit(END)))
    return blocks.select(F.col("id").alias(id_col), F.array_join(body, "").alias("formatted"), _spans(F.col("blocks")).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> from a formatted string: every row that went in, unescaped."""
    q = lambda s: "\\Q" + s + "\\E"
    blocks = F.slice(F.split(formatted, q(START)), F.lit(2), F.greatest(F.size(F.split(formatted, q(START))) - 1, F.lit(0)))

    def turns(b: Column) -> Column:
        role = F.substring_index(b, SEP, 1)
        rest = F.substr(b, F.length(role) + 1 + len(SEP), F.length(b) - F.length(role) - len(SEP) - len(END))
        return F.transform(F.split(rest, q(NEXT)), lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped span by span, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def chat_table(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of what the formatted strings say when they are read back."""
    f = format_chats(conversations, id_col)
    turns, loss = read_turns(F.col("formatted")), loss_text(F.col("formatted"), F.col("loss_spans"))
    f = f.select(id_col, "formatted", turns.alias("turns"), loss.alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return f.select(
        id_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
