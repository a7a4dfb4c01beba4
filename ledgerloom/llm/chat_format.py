r"""Chat formatting of typed content parts, with a loss mask, and its way back.

A turn holds parts: array<struct<type, text, ref, units>>. A visitor flattens them in order: a text part becomes its
escaped text, an image, audio or document part a placeholder <|image|>, <|audio|>, <|document|>; the i-th placeholder
of a conversation belongs to the i-th entry of its `attachments`, which records kind, reference and the number of
tokens the placeholder expands to. A part of unknown type is treated as text.

Template of a turn: <|im_start|>ROLE\nBODY<|im_end|>\n. Inside texts and roles a backslash becomes two and `<|`
becomes `<\|`, so no text can hold a control string, and unescaping (drop each escaping backslash) restores it.

All of it is built-in expressions. A conversation's turns meet in one row because its string is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens that one unit of an attachment expands to: an image tile, a second of audio, a page.
EXPANSION = {"image": 256, "audio": 25, "document": 512}
PART = "array<struct<type:string,text:string,ref:string,units:double>>"
_HEADER = "(?s)^((?:[^\\\\\\n]|\\\\.)*+)\\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)\\\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """A plain text (null: empty) as the one part of its turn."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("double").alias("units"))).cast(PART)


def _expanded(part: Column) -> Column:
    rate = F.lit(0)
    for kind, n in EXPANSION.items():
        rate = F.when(part["type"] == kind, F.lit(n)).otherwise(rate)
    return F.ceil(rate * F.greatest(F.coalesce(part["units"], F.lit(1.0)), F.lit(0.0))).cast("long")


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row for each conversation: conv_id, formatted, n_turns, loss_spans, attachments, expanded_tokens.

    loss_spans: array<struct<start,length>> in code points of `formatted`, the bodies of turns in loss_roles.
    Turns are ordered by turn, then role, then text; repeated rows stay separate turns. Null role or text: empty;
    null or empty parts: an empty body. A null conversation id is a conversation of its own. No rows give no rows.
    """
    q = lambda c: F.col(f"`{c}`")
    parts = F.coalesce(q(parts_col).cast(PART), F.array().cast(PART))
    kind = lambda p: p["type"].isin(*EXPANSION)
    rows = df.select(q(conv_col).alias("conv_id"), q(turn_col).alias("turn"), F.coalesce(q(role_col), F.lit("")).alias("role"), parts.alias("parts"))
    shown = lambda p: F.when(kind(p), F.concat(F.lit("<|"), p["type"], F.lit("|>"))).otherwise(escape(F.coalesce(p["text"], F.lit(""))))
    rows = rows.select(
        "conv_id", "turn", "role",
        F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\\n")), F.lit("\n")).alias("head"),
        F.array_join(F.transform("parts", shown), "").alias("body"),
        F.transform(F.filter("parts", kind), lambda p: F.struct(p["type"].alias("kind"), p["ref"].alias("ref"), _expanded(p).alias("tokens"))).alias("attached"),
    )
    width = F.length("head") + F.length("body") + F.lit(len(END))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "body")
    rows = rows.withColumn("n", F.row_number().over(order)).withColumn("from", F.coalesce(F.sum(width).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    turn = F.struct("n", F.concat("head", "body", F.lit(END)).alias("shown"), "attached", F.col("role").isin(*loss_roles).alias("loss"), (F.col("from") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns")).select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
        F.size("turns").cast("long").alias("n_turns"),
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["attached"])).alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def parse_turns(formatted: Column) -> Column:
    """The way back: array<struct<role, text>> of a formatted conversation, read from the string alone."""
    pieces = F.split(formatted, "<\\|im_end\\|>\\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        rest = F.substr(piece, F.lit(len(START) + 1))
        body = F.substr(rest, F.length(F.regexp_extract(rest, _HEADER, 0)) + 1)
        return F.struct(unescape(F.regexp_extract(rest, _HEADER, 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def masked_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(loss_spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
