"""Chat formatting with typed content parts.

A turn's content is an array of parts: text, image, audio or document. A visitor
turns the parts of a turn, in order, into one string: text is escaped, every
attachment becomes a placeholder ``<|image|>``, ``<|audio|>`` or ``<|document|>``; its reference
and the number of tokens it expands to are recorded in the same order. Turns are then laid out as

    <|im_start|>role\\n ... <|im_end|>\\n

Control strings inside texts and roles are escaped: ``&`` becomes ``&amp;``, ``<`` becomes ``&lt;``,
``[`` becomes ``&#91;`` and, in roles only, the line end ``&#10;``, so that no text can open or
close a turn, nor a part, in this or another bracketed template, and reading back is exact.
The loss mask covers the contents of the turns whose role is in ``loss_roles``.

All work is in Spark expressions. A conversation is one output row, so its turns meet
in one place by the nature of the result; they travel as already formatted strings.

Defined results: a null text is empty, a null role the empty role; turns go by number (null
first), equal numbers by role, then text, and repeated rows are turns of their own; a null
conversation id is a conversation; a part of unknown type is a document;
missing sizes expand to one token; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobscope.llm.common import let

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Tokens of an attachment: image patches of this side merged two by two, audio frames a second, tokens a page.
PATCH, FRAMES, PAGE = 28, 25, 256


def escape(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for safe, raw in (("&#10;", "\n"), ("&#91;", "["), ("&lt;", "<"), ("&amp;", "&")):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def text_parts(text: Column) -> Column:
    """A plain text as an array of one text part."""
    null = {f: F.lit(None) for f in ("ref", "width", "height", "seconds", "pages")}
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            *(v.alias(k) for k, v in null.items())).cast(PART))


def _kind(part: Column) -> Column:
    t = F.lower(F.coalesce(part["type"], F.lit("document")))
    return F.when(t.isin("text", "image", "audio"), t).otherwise("document")


def _tokens(part: Column) -> Column:
    kind = _kind(part)
    return F.greatest(F.lit(1), F.coalesce(
        F.when(kind == "image", F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH))
        .when(kind == "audio", F.ceil(part["seconds"] * FRAMES))
        .otherwise(part["pages"] * PAGE), F.lit(1))).cast("long")


def visit(parts: Column) -> tuple[Column, Column]:
    """(content string, attachments) of a turn's parts; a null array has no parts."""
    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    content = F.array_join(F.transform(parts, lambda p: F.when(
        _kind(p) == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), _kind(p), F.lit("|>")))), "")
    attachments = F.transform(F.filter(parts, lambda p: _kind(p) != "text"), lambda p: F.struct(
        _kind(p).alias("type"), p["ref"].alias("ref"), _tokens(p).alias("tokens")))
    return content, attachments


def format_chat(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), conv_id: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text", parts: str | None = None) -> DataFrame:
    """(conv_id, formatted, loss_mask, loss_spans, attachments, attachment_tokens) of each conversation.

    ``loss_mask`` says of each turn in ``formatted`` whether its content counts; ``loss_spans`` are the
    same contents as (start, length) in code points. ``parts`` names a column of
    typed parts, otherwise ``text`` is one text part.
    """
    content, attachments = visit(F.col(parts) if parts else text_parts(F.col(text)))
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        content.alias("content"), attachments.alias("attachments"))
    head = F.concat(F.lit(OPEN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&#10;")), F.lit("\n"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "content", F.xxhash64("attachments"))
    rows = rows.withColumn("piece", F.concat(head, F.col("content"), F.lit(CLOSE))).select(
        "conv_id", "role", "piece", "attachments", F.row_number().over(order).alias("k"), F.length("content").alias("n"),
        F.length(head).alias("skip"), F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
        F.length("piece").alias("size"))
    got = rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("k", "piece", F.col("role").isin(*loss_roles).alias("loss")))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("role").isin(*loss_roles), F.struct(
            (F.col("end") - F.col("size") + F.col("skip")).cast("long").alias("start"),
            F.col("n").cast("long").alias("length"))))).alias("loss_spans"),
        F.sort_array(F.collect_list(F.when(F.size("attachments") > 0, F.struct("k", "attachments")))).alias("found"))
    return got.select("conv_id", F.array_join(F.col("pieces.piece"), "").alias("formatted"), F.col("pieces.loss").alias("loss_mask"), "loss_spans",
                      F.flatten("found.attachments").alias("attachments")).withColumn(
        "attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns (role, text), loss_text), parsed from ``formatted`` and the loss mask alone."""
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>", -1), F.lit(2), F.size(F.split("formatted", r"<\|im_start\|>", -1)))
    turns = F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substr(p, F.locate("\n", p) + 1, F.length(p) - F.locate("\n", p) - len(CLOSE))).alias("text")))
    loss = F.zip_with("turns", "loss_mask", lambda t, m: F.when(m, t["text"]).otherwise(""))
    return formatted.select("conv_id", turns.alias("turns"), "loss_mask",
                            F.length("formatted").cast("long").alias("formatted_chars")).select(
        "conv_id", "turns", F.array_join(loss, "").alias("loss_text"), "formatted_chars")
