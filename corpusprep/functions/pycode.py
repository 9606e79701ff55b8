"""Python code rules (S59-S65, S70, S38) as native column expressions.

The reference runs a grammar parser and the ``tokenize`` module per snippet. After its own
clean-up (S59) every snippet is a single line of space-separated words and punctuation
marks, so the same token kinds follow from one total regular-expression lexer evaluated
in the JVM: strings, comments, numbers, words, single punctuation marks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusprep.functions.pynames import stored_names
from corpusprep.functions.text import _c, filter_wide, let, snake_case, split_words

# Patterns that must equal the reference's variable heuristics.
# The repeated groups are possessive: a row of any length is matched without recursion.
IDENTIFIER = r"[_a-zA-Z][_a-zA-Z0-9]*"
TARGET_LIST = r"\s*+[_a-zA-Z][_a-zA-Z0-9]*+\s*+(?:,\s*+[_a-zA-Z][_a-zA-Z0-9]*+\s*+)*+"
ASSIGN_TARGETS = rf"^{TARGET_LIST}="
# The target list of a for statement is captured as group 1.
FOR_TARGETS_GROUPED = r"for\s+([_a-zA-Z][_a-zA-Z0-9]*+\s*(?:,\s*+[_a-zA-Z][_a-zA-Z0-9]*+)*+)\s+in"
# ``all_matches``: every target list of a chained assignment at the start of the line
# (``a = b = 1``); a ``=`` followed by another ``=`` is a comparison, not an assignment.
CHAINED_TARGETS = rf"^((?:{TARGET_LIST}=(?!\s*+=)\s*+)++)"

# The public number syntax of Python's lexer (no dots: the clean-up parts them).
DIGITS = r"[0-9](?:_?[0-9])*+"
NUMBER = (rf"{DIGITS}(?:[eE]{DIGITS})?[jJ]|{DIGITS}[eE]{DIGITS}|0[xX](?:_?[0-9a-fA-F])++|0[bB](?:_?[01])++|0[oO](?:_?[0-7])++|"
          r"0(?:_?0)*+|[1-9](?:_?[0-9])*+")
# Lexer over the cleaned one-line form; alternatives are tried left to right. The clean-up puts a space
# behind a backslash, so an escaped quote reads ``\ '``.
CODE_LEXEME = rf"""'(?:[^'\\]++|\\ ?[^ ])*+'|"(?:[^"\\]++|\\ ?[^ ])*+"|#.*|{NUMBER}|\w+|[^\s\w]"""
# The reading in which the parted backslash escapes nothing.
CODE_LEXEME_UNESCAPED = rf"""'[^']*'|"[^"]*"|#.*|{NUMBER}|\w+|[^\s\w]"""
OPENERS, CLOSERS = ["(", "[", "{"], [")", "]", "}"]


def python_clean(col) -> Column:
    """Wide filter, collapse dots, drop ``>>`` runs, split words and punctuation.

    Tab/newline/space squeezing and trimming of the reference are implied by the final
    word/punctuation split, which discards all whitespace. The dot and ``>>`` passes only
    run on text that contains ``..`` / ``>>``.
    """
    def dots(v: Column) -> Column:
        return F.when(F.instr(v, "..") > 0, F.regexp_replace(v, r"\.+", ".")).otherwise(v)

    def prompts(v: Column) -> Column:
        return split_words(F.when(F.instr(v, ">>") > 0, F.regexp_replace(v, r">>+", "")).otherwise(v))

    return let(let(filter_wide(col, "python"), dots), prompts)


def _identifiers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(IDENTIFIER), 0)


def assign_targets(clean, all_matches: bool = False) -> Column:
    """Names assigned at the start of the line (``a , b =``); with ``all_matches`` every
    target of a chained assignment (``a = b = 1``)."""
    if all_matches:
        return _identifiers(F.regexp_extract(_c(clean), CHAINED_TARGETS, 1))
    return _identifiers(F.regexp_extract(_c(clean), ASSIGN_TARGETS, 0))


def for_targets(clean, all_matches: bool = False) -> Column:
    """Targets of the first ``for ... in`` (of every one with ``all_matches``)."""
    c = _c(clean)
    if all_matches:
        return _identifiers(F.array_join(F.regexp_extract_all(c, F.lit(FOR_TARGETS_GROUPED), 1), " "))
    return _identifiers(F.regexp_extract(c, FOR_TARGETS_GROUPED, 1))


def python_vars(clean, all_matches: bool = False) -> Column:
    """S38 + S61 + S62 (+ S63 with ``all_matches``): sorted unique variable names.

    Default is the reference heuristic: the assignment targets at the start of the line and
    the targets of the first ``for ... in``. ``all_matches=True`` also takes every target of
    a chained assignment at the start and of every later ``for ... in``.
    """
    def names(c: Column) -> Column:
        found = [assign_targets(c), for_targets(c, all_matches)]
        if all_matches:
            found.append(assign_targets(c, True))
        return F.array_sort(F.array_distinct(F.concat(*found)))

    return let(_c(clean), names)


def python_lexemes(clean, escapes: bool = True) -> Column:
    """S60 (first half): the raw lexemes of the cleaned line; a quote that nothing closes stands alone."""
    return F.regexp_extract_all(_c(clean), F.lit(CODE_LEXEME if escapes else CODE_LEXEME_UNESCAPED), 0)


def python_code_tokens(col, append_newline: bool = True, all_matches: bool = False, escapes: bool = True, stored: bool = False) -> Column:
    """Raw Python code to tokens.

    Strings and numbers become ``string``/``number``, assigned names ``var``, comments are
    dropped, and a final ``newline`` closes a line with code (S60, S64, S48, S17). A line whose
    brackets don't balance is cut off by the lexer before its end, so it has no ``newline`` (S65).
    ``escapes=False`` lets a backslash escape nothing; ``stored`` takes the names from the raw
    code's statements (``pynames.stored_names``) instead of the line heuristics.
    """
    def count(lexemes: Column, of: list[str]) -> Column:
        return F.size(F.filter(lexemes, lambda t: t.isin(of)))

    def tokens(s: Column) -> Column:
        # The lexer makes every other punctuation mark a one-character lexeme, so a lexeme
        # that starts with a quote and is longer than one character is a whole string.
        kinds = F.transform(s["lex"], lambda t: (
            F.when(t.startswith("#"), F.lit(None))
            .when(F.substring(t, 1, 1).isin("'", '"') & (F.length(t) > 1), F.lit("STRING"))
            .when(F.substring(t, 1, 1).between("0", "9"), F.lit("NUMBER"))
            .when(F.array_contains(s["names"], t), F.lit("VAR"))
            .otherwise(t)))
        def finish(body: Column) -> Column:
            if append_newline:
                whole = (F.size(body) > 0) & (count(body, OPENERS) == count(body, CLOSERS))
                body = F.when(whole, F.concat(body, F.array(F.lit("NEWLINE")))).otherwise(body)
            words = F.split(snake_case(F.array_join(body, " ")), " ")
            return F.filter(words, lambda w: F.trim(w) != "")

        return let(F.filter(kinds, lambda t: t.isNotNull()), finish)

    def kinds_of(clean: Column, names: Column) -> Column:
        return let(F.struct(names.alias("names"), python_lexemes(clean, escapes).alias("lex")), tokens)

    if stored:
        return let(F.struct(python_clean(col).alias("clean"), stored_names(col, aliases=False).alias("names")),
                   lambda s: kinds_of(s["clean"], s["names"]))
    return let(python_clean(col), lambda clean: kinds_of(clean, python_vars(clean, all_matches)))
