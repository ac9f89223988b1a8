"""Chat formatting by prefix-target expansion: one example per assistant turn, all turns before it as context.

A turn is written as ``<|role|>``, a new line, its text, ``<|end|>`` and a new line. Control strings of this and of
other common templates are made harmless inside texts by a tilde after their first character, one more than they had;
taking one away again gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
END = "<|end|>\n"
REPLY = "assistant"
_CONTROL = r"(\||/?s>|/?INST\]|</?SYS>>|bos>|eos>|pad>|unk>)"
_PLAIN, _ESCAPED = r"([<\[])(~*)" + _CONTROL, r"([<\[])~(~*)" + _CONTROL


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, "$1~$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _role_escaped(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("~"), F.lit("~t")), F.lit("|"), F.lit("~p"))


def _role_unescaped(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("~p"), F.lit("|")), F.lit("~t"), F.lit("~"))


def examples(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``example``, ``text``, ``loss_start``, ``loss_end``, ``last``, ``loose``.

    ``conversations`` needs conv_id, turn, role and text; other columns are not read. Only the reply between
    ``loss_start`` and ``loss_end`` (code points) is trained on. Turns after the last reply, or a conversation without
    one, give a last example with an empty mask, so that nothing is lost. ``last`` marks a conversation's longest
    example. A null text or role counts as empty; turns with equal numbers (null first) go by role and text, and
    repeated rows stay. A row with a null conv_id is in no conversation with others, but one by itself; ``loose`` tells such
    rows apart and is null for all others. An empty table gives no examples.

    An example has its whole prefix in one row: that is the format, and the one thing gathered per conversation.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text"))
    loose = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    chats = conversations.withColumn("loose", loose).groupBy("conv_id", "loose").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    begun = lambda role: F.concat(F.lit("<|"), _role_escaped(role), F.lit("|>\n"))
    written = F.transform("turns", lambda t: F.concat(begun(t["role"]), t["text"], F.lit(END)))
    chats = chats.withColumn("written", written).withColumn("size", F.size("turns"))
    numbers = F.sequence(F.lit(1), F.col("size"))
    ends = F.filter(numbers, lambda k: (F.element_at("turns", k)["role"] == REPLY) | (k == F.col("size")))
    each = chats.select("conv_id", "loose", "turns", "written", "size", F.posexplode(ends).alias("example", "upto"))
    turn = F.element_at("turns", F.col("upto"))
    text = F.array_join(F.slice("written", F.lit(1), F.col("upto")), "")
    each = each.select(
        "conv_id",
        "loose",
        F.col("example").cast("bigint").alias("example"),
        text.alias("text"),
        F.when(turn["role"] == REPLY, F.length(turn["text"])).otherwise(0).cast("bigint").alias("_reply"),
        (F.col("upto") == F.col("size")).alias("last"),
    )
    end = F.length("text") - len(END)
    return each.select(
        "conv_id", "example", "text", (end - F.col("_reply")).alias("loss_start"), end.cast("bigint").alias("loss_end"), "last", "loose"
    )


def turns_of(text: Column) -> Column:
    """The turns of an example, as structs of role and text."""
    parts = F.split(F.substring(text, F.lit(1), F.length(text) - len(END)), r"<\|end\|>\n", -1)
    role = lambda t: _role_unescaped(F.regexp_extract(t, r"(?s)^<\|(.*?)\|>\n", 1))
    said = lambda t: unescaped(F.regexp_extract(t, r"(?s)^<\|.*?\|>\n(.*)$", 1))
    return F.transform(parts, lambda t: F.struct(role(t).alias("role"), said(t).alias("text")))


def trained_text(text: Column, start: Column, end: Column) -> Column:
    return unescaped(F.substring(text, start.cast("int") + 1, (end - start).cast("int")))
