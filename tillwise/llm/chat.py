"""Chat formatting by prefix-target expansion (operator 1). DataFrame
functions only.

Every assistant turn becomes an example: the formatted text of all turns up to
and including it, of which only that reply (without its end mark) is under the
loss mask. Turns after the last reply belong to no example; with ``keep_rest``
they are given out as one more example without a loss, so nothing is lost.

A turn is written ``<s>[INST] role [/INST] text</s>`` and a line feed. Control
strings inside roles and texts get a backslash after their first character
(those that have some get one more), which keeps every real mark unmistakable
and is undone exactly.

All examples of a conversation are prefixes of one text; offsets come from a
running sum in a window, and the prefixes are cut when the rows are expanded,
one at a time. The turns of one conversation meet in one task, as their common
text does.

Edge cases: NULL roles and texts are empty; an empty role is never a reply;
turns are ordered by turn (NULL first), role, text, and repeated rows are
turns of their own; a NULL conv_id is a conversation; other columns are
ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    begin: str = "<s>[INST] "
    middle: str = " [/INST] "
    end: str = "</s>\n"
    # escaped inside texts; no control string may contain another's first character further on
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    reply_role: str = "assistant"

    @property
    def pattern(self) -> tuple[str, str]:
        """Regular expressions of the first characters and of the rests."""
        return ("[" + "".join(sorted({re.escape(c[0]) for c in self.controls})) + "]",
                "|".join(re.escape(c[1:]) for c in self.controls))


def escape(c: Column, t: Template = Template()) -> Column:
    first, rest = t.pattern
    return F.regexp_replace(c, rf"({first})(\\*)({rest})", r"$1\\$2$3")


def unescape(c: Column, t: Template = Template()) -> Column:
    first, rest = t.pattern
    return F.regexp_replace(c, rf"({first})\\(\\*)({rest})", "$1$2$3")


def examples(turns: DataFrame, template: Template = Template(), keep_rest: bool = True) -> DataFrame:
    """conv_id, example (from 0), n_turns and text, loss_start (from 0) and
    loss_chars of the reply in it (NULL: no loss), last (the longest one)."""
    t = template
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = (rows.withColumn("body", escape(F.col("text"), t))
                .withColumn("head", F.concat(F.lit(t.begin), escape(F.col("role"), t), F.lit(t.middle))))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("head") + F.length("body") + len(t.end)
    rows = rows.withColumn("no", F.row_number().over(order)).withColumn("stop", F.sum(size).over(upto))
    rows = rows.select("conv_id", "no", F.concat("head", "body", F.lit(t.end)).alias("seg"), F.struct(
        "no", "stop", F.when(F.col("role") == t.reply_role, F.col("stop") - len(t.end) - F.length("body")).alias("loss_start"),
        F.length("body").cast("long").alias("loss_chars")).alias("cut"))
    talk = (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("no", "seg"))).alias("segs"),
                                        F.sort_array(F.collect_list("cut")).alias("cuts"))
                .withColumn("full", F.array_join(F.transform("segs", lambda s: s["seg"]), "")))
    wanted = F.filter("cuts", lambda c, i: c["loss_start"].isNotNull() | (F.lit(keep_rest) & (i == F.size("cuts") - 1)))
    out = (talk.withColumn("cuts", wanted).select("conv_id", "full", F.size("cuts").alias("of"), F.posexplode("cuts").alias("example", "cut")))
    return out.select("conv_id", "example", F.col("cut.no").cast("long").alias("n_turns"),
                      F.substring(F.col("full"), F.lit(1), F.col("cut.stop").cast("int")).alias("text"),
                      F.col("cut.loss_start").alias("loss_start"),
                      F.when(F.col("cut.loss_start").isNotNull(), F.col("cut.loss_chars")).alias("loss_chars"),
                      (F.col("example") == F.col("of") - 1).alias("last"))


def loss_text(template: Template = Template()) -> Column:
    """What is under the loss mask of an example, unescaped ('' if nothing)."""
    part = F.substring(F.col("text"), F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int"))
    return F.when(F.col("loss_start").isNull(), F.lit("")).otherwise(unescape(part, template))


def read_back(text: Column, template: Template = Template()) -> Column:
    """The turns (role, text) of a formatted text."""
    t = template
    pieces = F.split(text, re.escape(t.end))
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda s: F.struct(
        unescape(F.substring(F.substring_index(s, t.middle, 1), len(t.begin) + 1, 1 << 30), t).alias("role"),
        unescape(F.substring_index(s, t.middle, -1), t).alias("text")))


def digests(ex: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, read back from its examples: turn count and digest,
    loss length and digest, characters of all examples together."""
    turn = read_back(F.col("text"), template)
    flat = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    read = (ex.withColumn("turns", F.when(F.col("last"), turn))
              .select("conv_id", "example", loss_text(template).alias("loss"), F.length("text").cast("long").alias("chars"),
                      F.when(F.col("last"), F.size("turns").cast("long")).alias("n_turns"),
                      F.when(F.col("last"), F.sha2(flat, 256)).alias("turns_sha256")))
    loss = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "")
    return (read.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"), loss.alias("loss"),
                                        F.sum("chars").alias("formatted_chars"))
                .select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"))
