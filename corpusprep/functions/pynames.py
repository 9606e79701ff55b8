"""Names that Python code stores or deletes (S63), from the lexemes of the raw code, as a fold with a bracket depth.

The lexer knows prefixed, triple-quoted and escaped strings, so nothing inside a string or a comment is code. The fold walks
the lexemes of a row once. Its state holds the bracket depth, the outermost call or subscript bracket that is open (a bracket
behind an operand; what stands in it is used, not stored), the first word of the statement and the names that become targets
if the statement turns out to be an assignment. A name in front of ``.``, ``[`` or ``(`` or behind ``.`` is no target.

Found are targets of assignments (chained, starred, in brackets, augmented, annotated, ``:=``), of ``for`` statements and
comprehensions, of ``del`` and of ``with … as``; with ``aliases`` also the names that ``import … as`` and ``except … as`` bind,
which a syntax tree holds as plain strings.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusprep.functions.text import _c, let

# Repeated groups are possessive: a row of any length is matched without recursion.
PREFIX = "[rRbBuUfF]{0,2}"
STRING = (rf"{PREFIX}(?:'''(?:[^'\\]++|\\[\s\S]|'(?!''))*+'''|" rf'"""(?:[^"\\]++|\\[\s\S]|"(?!""))*+"""|'
          r"'(?:[^'\\\n]++|\\[\s\S])*+'|" r'"(?:[^"\\\n]++|\\[\s\S])*+")')
NUMBER = (r"0[xX][0-9a-fA-F_]++|0[bB][01_]++|0[oO][0-7_]++|"
          r"(?:[0-9][0-9_]*+(?:\.[0-9_]*+)?|\.[0-9][0-9_]*+)(?:[eE][-+]?[0-9][0-9_]*+)?[jJ]?")
OPERATOR = r"\*\*=|//=|<<=|>>=|\.\.\.|->|:=|\*\*|//|<<|>>|[-+*/%&|^@=<>!]="
RAW_LEXEME = rf"{STRING}|#[^\n]*+|\\\r?\n|\n|{NUMBER}|[\p{{L}}_][\p{{L}}\p{{N}}_]*+|{OPERATOR}|\S"

# The words of Python that are no names.
KEYWORDS = """False None True and as assert async await break class continue def del elif else except finally for from global if
import in is lambda nonlocal not or pass raise return try while with yield""".split()
BLOCK_WORDS = "if elif else for while with try except finally def class async".split()
AUGMENTED = ["+=", "-=", "*=", "/=", "%=", "&=", "|=", "^=", "@=", "**=", "//=", "<<=", ">>="]
OPENERS, CLOSERS = ["(", "[", "{"], [")", "]", "}"]

NONE, FOR, AS, ALIAS = range(4)  # what the names read now would become
ENDS, BEFORE, QUOTES, DIGITS = ["\n", ";"], [".", "[", "("], "'\"", frozenset("0123456789")
ALIAS_WORDS = ["import", "from", "except"]
KEYWORD_SET = frozenset(KEYWORDS)
MARKS = frozenset([*OPENERS, *CLOSERS, *ENDS, *AUGMENTED, "=", ":=", ":", ",", "."])
SEPARATOR, LETTER = "\t", "\v"  # set between lexemes and before names that begin beyond ASCII
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_" + LETTER)


def raw_lexemes(code) -> Column:
    """Lexemes of raw code: strings, comments, line ends, numbers, names, operators; an unclosed quote stands alone."""
    return F.regexp_extract_all(_c(code), F.lit(RAW_LEXEME), 0)


def _fold(text: str, aliases: bool) -> list[str]:
    """The names stored or deleted by the lexemes of one row, in the form that ``stored_names`` gives them."""
    found, waiting, scope, head, name = set(), [], [], "", None
    mode = mode_depth = depth = used = scope_used = lambdas = 0
    closed = operand = dot = False
    for t in [*text.split(SEPARATOR), "\n"]:
        first = t[:1]
        if first in ("", "#", "\\"):
            continue
        if name is not None and t not in BEFORE:  # the name read before is settled by this lexeme
            (scope if mode else waiting).append(name)
        word = (first in LETTERS) and t[-1] not in QUOTES
        if not word and t not in MARKS:  # strings, numbers and operators without a rule
            head, name, dot = head if head and head != "async" else "-", None, False
            operand = first in DIGITS or (len(t) > 1 and (t[-1] in QUOTES or (first == "." and t[1] in DIGITS)))
            continue
        keyword = word and t in KEYWORD_SET
        if word and not keyword:
            free = not (scope_used if mode else used)
            head, operand = head if head and head != "async" else "-", True
            name, dot = t.removeprefix(LETTER) if free and not dot and (aliases or mode != ALIAS) else None, False
            continue

        top, closer = not depth, t in CLOSERS
        end = top and t in ENDS
        colon = top and t == ":" and not lambdas
        block = colon and head in BLOCK_WORDS
        left = closer and depth - 1 < mode_depth
        scope_done = (mode == FOR and t == "in" and depth == mode_depth) or (
            mode >= AS and ((t == "," and depth == mode_depth) or left or colon or end))
        assigned = top and not mode and not closed and not lambdas and (t == "=" or t in AUGMENTED or (colon and not block))
        if scope_done:
            found.update(scope)
        if assigned or (end and head == "del"):
            found.update(waiting)
        if t == ":=" and name is not None:
            found.add(name)

        starts = FOR if t == "for" else NONE
        if t == "as":
            starts = AS if head == "with" else ALIAS if head in ALIAS_WORDS else NONE
        fresh = end or block
        if fresh or assigned:
            waiting = []
        if starts or scope_done or fresh:
            scope = []
        call = t in OPENERS and operand
        if call and not used:
            used = depth + 1
        elif closer and used == depth:
            used = 0
        if starts:
            scope_used, mode_depth = 0, depth
        elif call and not scope_used:
            scope_used = depth + 1
        elif closer and scope_used == depth:
            scope_used = 0
        if starts:
            mode = starts
        elif scope_done or end or colon or left:
            mode = NONE
        if not aliases and mode == ALIAS:
            scope = []
        if fresh:
            head, closed, lambdas = "", False, 0
        else:
            if t != "\n" and head in ("", "async"):
                head = t if keyword else "-"
            closed = closed or (assigned and t != "=")
            if top and t == "lambda":
                lambdas += 1
            elif top and t == ":" and lambdas:
                lambdas -= 1
        operand = operand and not top if t == "\n" else closer
        depth = depth + 1 if t in OPENERS else max(depth - 1, 0) if closer else depth
        name, dot = None, t == "."
    return sorted(found)


def _names_udf(aliases: bool):
    def names(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else _fold(t, aliases) for t in texts.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(names, T.ArrayType(T.StringType()))


def stored_names(code, aliases: bool = True) -> Column:
    """Sorted distinct names that the raw code stores or deletes; null code gives null.

    The lexemes are found by Spark and reach the fold as one text a row: outside the lexemes' own text every blank is as good
    as another, so tabs are free to part them. The fold needs no text of a string. As a Python function it can't stand inside
    a lambda function of Spark.
    """
    lexemes = F.array_join(raw_lexemes(F.translate(_c(code), SEPARATOR + LETTER, "  ")), SEPARATOR)
    letters = let(lexemes, lambda v: F.when(F.octet_length(v) == F.char_length(v), v).otherwise(
        F.regexp_replace(v, rf"(?<![^{SEPARATOR}])(?=\p{{L}})(?=[^\x00-\x7F])", LETTER)))
    return _names_udf(aliases)(letters)
