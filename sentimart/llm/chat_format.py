"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns as
context, and only that reply under the loss mask. A conversation whose last
turn is not the assistant's gets one more example without any trainable text,
so that the output holds every turn.

Template. A turn of the assistant is ``<s>TEXT</s>``; any other is
``[INST]ROLE\\nTEXT[/INST]``. A control string inside a text gets a backslash
after its first character (one more, if it has some), which reading back
removes; in a role, backslashes and line ends are escaped. So every
unescaped control string is the template's own.

A conversation is rendered once; its examples are prefixes of that string and
spans of code points in it.

Defined results: a null text or role is empty; turns are ordered by turn, then
role, then text, null turns first, so repeated rows count as turns; a null
conv_id is a conversation like any other; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentimart.llm.common import text_of

ASSISTANT = "assistant"
#: Control strings after their first character, and where an escape goes.
ESCAPE, ESCAPED = r"([<\[])(\\*)(/?(?:s>|INST\]))", r"$1\\$2$3"
UNESCAPE, UNESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))", "$1$2$3"
TURN = r"(?s)<s>.*?</s>|\[INST\].*?\[/INST\]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, ESCAPED)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, UNESCAPED)


def _role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_back(role: Column) -> Column:
    parts = F.split(unescaped(role), r"\\\\")  # split at escaped backslashes
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def examples(turns: DataFrame) -> DataFrame:
    """``(conv_id, example, text, loss_start, loss_end, whole)`` of ``turns(conv_id, turn, role, text)``.

    The mask is the span ``[loss_start, loss_end)`` of code points, null in an
    example without trainable text; ``whole`` marks the example with every turn.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    body = escaped(F.col("text"))
    reply = F.col("role") == ASSISTANT
    # text_of: a null text is empty, in the order as in the output
    rows = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"))
    rows = rows.withColumn("body", body).select(
        "conv_id", "turn", "role", "text", reply.alias("reply"), F.length("body").alias("size"),
        F.when(reply, F.concat(F.lit("<s>"), "body", F.lit("</s>")))
        .otherwise(F.concat(F.lit("[INST]"), _role(F.col("role")), F.lit("\n"), "body", F.lit("[/INST]"))).alias("shown"))
    rows = rows.select("conv_id", "reply", "size", "shown", F.row_number().over(order).alias("at"),
                       F.sum(F.length("shown")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("end"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "end", "size", "reply", "shown"))).alias("t"))
    last = F.size("t")
    cuts = F.filter("t", lambda x: x["reply"] | (x["at"] == last))
    cuts = F.transform(cuts, lambda x: F.struct(
        x["end"].cast("int").alias("end"), (x["at"] == last).alias("whole"),
        F.when(x["reply"], x["end"] - F.lit(4) - x["size"]).alias("loss_start"), F.when(x["reply"], x["end"] - F.lit(4)).alias("loss_end")))
    out = whole.select("conv_id", F.array_join(F.transform("t", lambda x: x["shown"]), "").alias("all"), F.posexplode(cuts).alias("example", "x"))
    return out.select("conv_id", "example", F.substring(F.col("all"), F.lit(1), F.col("x.end")).alias("text"),
                      F.col("x.loss_start").cast("int").alias("loss_start"), F.col("x.loss_end").cast("int").alias("loss_end"), F.col("x.whole").alias("whole"))


def turns_of(text: Column) -> Column:
    """The turns ``array<struct<role, text>>`` read back from a formatted text."""
    def turn(x: Column) -> Column:
        inner = F.substring(x, F.lit(7), F.length(x) - 13)
        cut = F.instr(inner, "\n")
        return F.when(x.startswith("<s>"), F.struct(
            F.lit(ASSISTANT).alias("role"), unescaped(F.substring(x, F.lit(4), F.length(x) - 7)).alias("text"))).otherwise(F.struct(
                _role_back(F.substring(inner, F.lit(1), cut - 1)).alias("role"),
                unescaped(F.substring(inner, cut + 1, F.length(inner))).alias("text")))

    return F.transform(F.regexp_extract_all(text, F.lit(TURN), F.lit(0)), turn)


def digests(out: DataFrame) -> DataFrame:
    """What reading :func:`examples` back gives, for each conversation."""
    lost = unescaped(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    read = out.select("conv_id", "example", F.when(F.col("loss_start").isNotNull(), lost).alias("lost"),
                      F.length("text").cast("long").alias("chars"), F.when(F.col("whole"), turns_of(F.col("text"))).alias("turns"))
    one = read.groupBy("conv_id").agg(
        F.sum("chars").alias("formatted_chars"), F.max("turns").alias("turns"),
        F.sort_array(F.collect_list(F.when(F.col("lost").isNotNull(), F.struct("example", "lost")))).alias("lost"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    one = one.select("conv_id", "formatted_chars", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                     F.array_join(F.transform("lost", lambda x: x["lost"]), "").alias("lost"))
    return one.select("conv_id", "n_turns", "turns_sha256", F.length("lost").cast("long").alias("loss_chars"),
                      F.sha2(F.col("lost").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
