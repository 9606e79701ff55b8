"""Interactive-prompt repair of code snippets (S35, S36, S66-S69), inside the row.

A snippet is an array of lines with their prompt flags. Runs of prompt lines and of plain lines are islands: an island starts
where the array's neighbours differ, so islands, blocks and the repaired code are array functions of the row. No line is
exploded, nothing is shuffled, and a snippet's other columns stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.text import let, strip_ws

# Prompt patterns 1..5 (reference order), matched at the start of a line and
# removed wherever they occur in a prompt line.
PROMPTS = [
    r"In ?\[\d+\]: ?",
    r"Out ?\[\d+\]: ?",
    r"( )+\.+: ?",
    r">>> ?",
    r"\.\.\. ?",
]
OUT_FLAG = 2


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def prompt_flag(line) -> Column:
    """1..5 for the first prompt pattern that matches at the start of the line, else 0."""
    line = _c(line)
    expr = None
    for i, pattern in enumerate(PROMPTS, start=1):
        cond = line.rlike("^" + pattern)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(0))


def strip_prompt(line, flag) -> Column:
    """Remove every match of the line's prompt pattern."""
    line, flag = _c(line), _c(flag)
    expr = F.when(flag == 0, line)
    for i, pattern in enumerate(PROMPTS, start=1):
        expr = expr.when(flag == i, F.regexp_replace(line, pattern, ""))
    return expr


def repl_flags(code) -> Column:
    """S66 per snippet: the flags of all lines as one digit string."""
    return F.array_join(F.transform(F.split(_c(code), "\n"), lambda l: prompt_flag(l).cast("string")), "")


def layout_of_flags(flags) -> Column:
    """S67 from a snippet's flag string."""
    return let(_c(flags), lambda f: (
        F.when(~f.rlike("[1-5]"), F.lit("none"))
        .when(f.rlike("^0*[14]"), F.lit("typical"))
        .otherwise(F.lit("atypical"))))


def repl_layout(code) -> Column:
    """``none`` (no prompt), ``typical`` (first prompt is ``In [n]:`` or ``>>>``), else ``atypical``."""
    return layout_of_flags(repl_flags(code))


def _lines(code: Column) -> Column:
    """``struct(lines, flags, layout)`` of a snippet; null code gives null."""
    def flagged(lines: Column) -> Column:
        return let(F.transform(lines, prompt_flag), lambda flags: F.struct(
            lines.alias("lines"), flags.alias("flags"), layout_of_flags(F.array_join(flags.cast("array<string>"), "")).alias("layout")))

    return let(F.split(code, "\n"), flagged)


def _islands(s: Column) -> Column:
    """``array<struct(at, size, plain, text, before)>``: runs of prompt or of plain lines.

    ``at`` counts lines from 0, ``text`` holds the lines without their prompts and ``before`` the flag in front of the run.
    """
    flags = s["flags"]

    def begins(i: Column) -> Column:
        return (i == 0) | ((F.get(flags, i) == 0) != (F.get(flags, i - 1) == 0))

    def island(starts: Column) -> Column:
        def one(at: Column, k: Column) -> Column:
            size = F.coalesce(F.get(starts, k + 1), F.size(flags)) - at
            pairs = F.zip_with(F.slice(s["lines"], at + 1, size), F.slice(flags, at + 1, size), strip_prompt)
            return F.struct(at.alias("at"), size.alias("size"), (F.get(flags, at) == 0).alias("plain"), pairs.alias("text"),
                            F.coalesce(F.get(flags, at - 1), F.lit(0)).alias("before"))

        return F.transform(starts, one)

    return let(F.filter(F.sequence(F.lit(0), F.size(flags) - 1), begins), island)


def repaired_code(code) -> Column:
    """``struct(layout, repaired)``; code without prompts is unchanged.

    Typical layout: the plain lines in front of the first prompt and all prompt lines stay. Atypical layout: plain lines go
    that follow an ``Out`` line (S36).
    """
    def repair(s: Column) -> Column:
        def stays(i: Column) -> Column:
            return ~i["plain"] | F.when(s["layout"] == "typical", i["at"] == 0).otherwise(i["before"] != OUT_FLAG)

        kept = F.flatten(F.transform(F.filter(_islands(s), stays), lambda i: i["text"]))
        repaired = F.array_join(F.transform(kept, lambda line: F.concat(line, F.lit("\n"))), "")
        return F.struct(s["layout"].alias("layout"), F.when(s["layout"] == "none", F.array_join(s["lines"], "\n")).otherwise(repaired).alias("repaired"))

    return let(_lines(_c(code)), repair)


def code_blocks(code) -> Column:
    """S35 + S36: the code blocks between prompt and output runs.

    Typical layout: a leading plain block is kept even if blank; other runs are kept when
    not blank. Atypical layout: as typical without the leading rule, and the last run is
    dropped (the reference never flushes it). No prompts: one block, the code unchanged.
    """
    def blocks(s: Column) -> Column:
        def block(i: Column) -> Column:
            return F.struct(strip_ws(F.array_join(i["text"], "\n")).alias("text"), (i["plain"] & (i["at"] == 0)).alias("leading"),
                            (i["at"] + i["size"] == F.size(s["flags"])).alias("last"))

        def stays(b: Column) -> Column:
            return F.when(s["layout"] == "typical", b["leading"] | (b["text"] != "")).otherwise((b["text"] != "") & ~b["last"])

        kept = F.transform(F.filter(F.transform(_islands(s), block), stays), lambda b: b["text"])
        return F.when(s["layout"] == "none", F.array(F.array_join(s["lines"], "\n"))).otherwise(kept)

    return let(_lines(_c(code)), blocks)


def repl_repair(df: DataFrame, id_col: str = "id", code_col: str = "code") -> DataFrame:
    """``(id, layout, repaired)`` of every snippet."""
    return df.select(F.col(id_col).alias("id"), repaired_code(code_col).alias("r")).select("id", "r.layout", "r.repaired")


def repl_blocks(df: DataFrame, id_col: str = "id", code_col: str = "code") -> DataFrame:
    """S35 + S36: ``(id, block_no, block)``, one row for each block of a snippet."""
    return df.select(F.col(id_col).alias("id"), F.posexplode(code_blocks(code_col)).alias("block_no", "block"))
