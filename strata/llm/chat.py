"""Chat formatting with typed content parts, in DataFrame expressions only.

A turn's content is an ordered list of parts (text, image, audio, document).  A visitor flattens the parts in order:
text is escaped, every other part becomes a placeholder, and its reference and expanded token count are recorded.
Control strings all begin with ``<`` or ``[``; those characters and the escape sign ``%`` are written as ``%3C``,
``%5B`` and ``%25`` inside texts and roles, so no text can hold a control string and unescaping is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN, SEP, CLOSE = "<|start|>", "<|message|>", "<|end|>"
# placeholder and default expanded token count of each attachment type
KINDS = {"image": ("<|image|>", 256), "audio": ("<|audio|>", 128), "document": ("<|document|>", 512)}
OTHER = "<|other|>"
PARTS = "array<struct<type:string,text:string,ref:string,tokens:bigint>>"


def escape(c: Column) -> Column:
    for sign, code in (("%", "%25"), ("<", "%3C"), ("[", "%5B")):
        c = F.replace(c, F.lit(sign), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for sign, code in (("<", "%3C"), ("[", "%5B"), ("%", "%25")):
        c = F.replace(c, F.lit(code), F.lit(sign))
    return c


def text_part(c: Column) -> Column:
    """A content list of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), c.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("bigint").alias("tokens")))


def visit(parts: Column) -> Column:
    """Flatten a content list: struct ``text`` (escaped text and placeholders in order), ``attachments``
    (array of type, ref, tokens in order) and ``tokens`` (expanded tokens of the attachments).

    A null list or part is empty; a text part without a type counts as text; an unknown type becomes the placeholder
    ``<|other|>`` with its own token count or 0."""
    parts = F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: p.isNotNull())
    is_text = lambda p: F.coalesce(p["type"], F.lit("text")) == "text"

    def shown(p):
        out = F.when(is_text(p), escape(F.coalesce(p["text"], F.lit(""))))
        for kind, (mark, _) in KINDS.items():
            out = out.when(p["type"] == kind, F.lit(mark))
        return out.otherwise(F.lit(OTHER))

    def weight(p):
        out = F.when(p["tokens"].isNotNull(), p["tokens"])
        for kind, (_, n) in KINDS.items():
            out = out.when(p["type"] == kind, F.lit(n).cast("bigint"))
        return out.otherwise(F.lit(0).cast("bigint"))

    held = F.transform(F.filter(parts, lambda p: ~is_text(p)), lambda p: F.struct(
        p["type"].alias("type"), p["ref"].alias("ref"), weight(p).alias("tokens")))
    return F.struct(F.array_join(F.transform(parts, shown), "").alias("text"), held.alias("attachments"),
                    F.aggregate(held, F.lit(0).cast("bigint"), lambda a, h: a + h["tokens"]).alias("tokens"))


def format_chat(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str | None = "text", parts: str | None = None, learn: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv, formatted, loss_mask, attachments, expanded_tokens``.

    ``formatted`` is the turns in order, each ``<|start|>role<|message|>content<|end|>``.  ``loss_mask`` holds the
    (start, length) in code points of every ``learn`` content, in order.  Null roles and texts are empty.  Rows are
    ordered by (turn, role, content), nulls first; repeated rows stay.  Rows with a null conversation id form one
    conversation.  An empty table gives no rows."""
    content = F.col(f"`{parts}`") if parts else text_part(F.col(f"`{text}`"))
    x = turns.select(F.col(f"`{conv}`").alias("c"), F.col(f"`{turn}`").alias("t"),
                     F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("r"), visit(content).alias("v"))
    head = F.concat(F.lit(OPEN), escape(F.col("r")), F.lit(SEP))
    x = x.select("c", "t", "r", "v", head.alias("h"), F.concat(head, F.col("v.text"), F.lit(CLOSE)).alias("seg"))
    order = Window.partitionBy("c").orderBy("t", "r", "seg", "v")
    x = (x.withColumn("pos", F.row_number().over(order))
         .withColumn("before", F.sum(F.length("seg")).over(order.rowsBetween(Window.unboundedPreceding, 0))
                     - F.length("seg")))
    mask = F.when(F.col("r") == learn, F.struct((F.col("before") + F.length("h")).alias("start"),
                                                F.length("v.text").cast("bigint").alias("length")))
    x = x.select("c", F.struct("pos", "seg", mask.alias("mask"), F.col("v.attachments").alias("held"),
                               F.col("v.tokens").alias("tokens")).alias("s"))
    g = x.groupBy("c").agg(F.array_sort(F.collect_list("s")).alias("s"))
    return g.select(F.col("c").alias(conv), F.array_join(F.col("s.seg"), "").alias("formatted"),
                    F.filter(F.col("s.mask"), lambda m: m.isNotNull()).alias("loss_mask"),
                    F.flatten(F.col("s.held")).alias("attachments"),
                    F.aggregate(F.col("s.tokens"), F.lit(0).cast("bigint"), lambda a, b: a + b)
                    .alias("expanded_tokens"))


def read_chat(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Read :func:`format_chat` output back: ``conv, turns (array of role, text), loss_texts, formatted``."""
    q = lambda s: "\\Q" + s + "\\E"
    segs = F.split(F.col("formatted"), q(CLOSE))
    segs = F.slice(segs, 1, F.size(segs) - 1)

    def turn(seg):
        two = F.split(seg, q(SEP))
        return F.struct(unescape(F.substr(two[0], F.lit(len(OPEN) + 1))).alias("role"), unescape(two[1]).alias("text"))

    masked = F.transform("loss_mask", lambda m: unescape(
        F.substr(F.col("formatted"), (m["start"] + 1).cast("int"), m["length"].cast("int"))))
    return formatted.select(conv, F.transform(segs, turn).alias("turns"), masked.alias("loss_texts"), "formatted")
