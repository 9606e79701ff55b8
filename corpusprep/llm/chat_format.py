"""Chat formatting with typed content parts, in DataFrame functions only.

A message's content is an array of parts ``(kind, text, ref, units)``. ``visit_parts`` flattens it: text is escaped,
image, audio and document parts become their placeholder repeated ``units`` times, in order, and each such part is
recorded as an attachment (place among the parts, kind, reference, expanded tokens). ``format_conversations`` renders a
turn as ``<|im_start|>role\\ntext<|im_end|>\\n`` and joins the turns; ``read_back`` undoes it.

Escaping puts one backslash behind the first character of each control string (``<|``, ``<s>``, ``</s>``, ``[INST]``,
``[/INST]``, with any backslashes already there), so no text can forge a mark and unescaping restores it exactly.
Roles also write ``%`` and line feeds as ``%25`` and ``%0A``, as a line feed ends the role.

Null text, kind or role counts as empty, null parts as none; a part of an unknown kind is text; negative or null units
count as one placeholder. Turns are ordered by turn (null first), then role and content, so ties and repeated rows have
one order; null ids form one conversation. An empty table gives an empty table. Only the named columns are read; other
columns are not carried. One conversation is one output row, so its turns meet in one task: the format asks for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
CONTROL = r"(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, r"$1$2$3")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def text_part(text: Column) -> Column:
    """A content of one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(0).alias("units")))


def _units(part: Column) -> Column:
    return F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1)).cast("int")


def _visit(part: Column) -> Column:
    out = escape(F.coalesce(part["text"], F.lit("")))
    for kind, mark in PLACEHOLDERS.items():
        out = F.when(part["kind"] == kind, F.repeat(F.lit(mark), _units(part))).otherwise(out)
    return out


def visit_parts(parts: Column) -> tuple[Column, Column]:
    """(flattened text, attachments) of a content column."""
    parts = F.coalesce(parts, F.array())
    flat = F.array_join(F.transform(parts, _visit), "")
    placed = F.transform(parts, lambda p, i: F.struct(i.alias("place"), p["kind"].alias("kind"), p["ref"].alias("ref"),
                                                      _units(p).alias("tokens")))
    return flat, F.filter(placed, lambda a: a["kind"].isin(*PLACEHOLDERS))


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per ``conv_id`` from rows of ``conv_id, turn, role, parts``.

    Columns: ``formatted``; ``loss_mask``, an entry per turn, null where the turn isn't trained, else where its text
    stands in the turn (``offset``) and its length (``chars``), in code points; ``attachments`` with their turn's number
    in ``turn_no``; ``placeholder_tokens``.
    """
    flat, attached = visit_parts(F.col("parts"))
    role = escape_role(F.coalesce(F.col("role"), F.lit("")))
    rows = turns.select("conv_id", "turn", role.alias("r"), flat.alias("t"), attached.alias("a"))
    mask = F.when(F.col("r") == trained_role,
                  F.struct((F.length("r") + 1).alias("offset"), F.length("t").alias("chars")))
    body = F.concat("r", F.lit("\n"), "t", F.lit(CLOSE))
    kept = rows.select("conv_id", F.struct("turn", body.alias("body"), mask.alias("mask"), "a").alias("s"))
    grouped = kept.groupBy("conv_id").agg(F.array_sort(F.collect_list("s")).alias("s"))
    one_each = F.flatten(F.transform("s", lambda s, i: F.transform(s["a"], lambda a: F.struct(
        i.alias("turn_no"), a["place"].alias("place"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    out = grouped.select(
        "conv_id",
        F.array_join(F.transform("s", lambda s: F.concat(F.lit(OPEN), s["body"])), "").alias("formatted"),
        F.transform("s", lambda s: s["mask"]).alias("loss_mask"), one_each.alias("attachments"))
    total = F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"])
    return out.withColumn("placeholder_tokens", total)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns (array of role, text) and loss text (array of the trained texts) from ``formatted`` and ``loss_mask``."""
    raw = F.split("formatted", r"<\|im_start\|>", -1)
    pieces = F.slice(raw, F.lit(2), F.greatest(F.size(raw) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        at = F.length(role) + 1
        text = F.substring(p, at + 1, F.length(p) - at - F.lit(len(CLOSE)))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    under = F.filter(F.zip_with("_pieces", "loss_mask", lambda p, m: F.when(
        m.isNotNull(), unescape(F.substring(p, m["offset"] + 1, m["chars"])))), lambda t: t.isNotNull())
    return (formatted.withColumn("_pieces", pieces)
            .withColumns({"turns": F.transform("_pieces", turn), "loss_texts": under}).drop("_pieces"))
