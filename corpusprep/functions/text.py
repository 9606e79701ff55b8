"""Natural-language text rules (query and context text) as native column expressions.

Every function maps ``Column -> Column`` and compiles to JVM-side regular-expression
expressions, so a whole chain runs inside one projection with no Python per row.
Two dialects exist because the Python-corpus and SQL-corpus rule sets differ in small
ways; ``dialect`` is ``"python"`` or ``"sql"``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

DIALECTS = ("python", "sql")

# ---------------------------------------------------------------------------------------
# These character classes and patterns must equal the reference's rules so
# that the produced tokens are identical.
#
# Strict filter (query text) keeps:
#   python: ( ) | 0-9 a-z A-Z - _ ' " newline   -- a run of other characters becomes one space
#   sql:    0-9 a-z A-Z _ ' " ( ) - newline     -- each other character becomes one space
# Wide filter (context text and code) keeps:
#   python: ( ) | 0-9 a-z A-Z - # / _ , ' = > < " \ ? . * + [ ] ^ { } newline   (runs)
#   sql:    the same set without the backslash                                 (runs)
STRICT_FILTER = {
    "python": r"""[^()|0-9a-zA-Z_'"\n-]+""",
    "sql": r"""[^0-9a-zA-Z_'"()\n-]""",
}
WIDE_FILTER = {
    "python": r"""[^()|0-9a-zA-Z#/_,'=><"\\?.*+\[\]^{}\n-]+""",
    "sql": r"""[^()|0-9a-zA-Z#/_,'=><"?.*+\[\]^{}\n-]+""",
}

# Contraction rules, in application order. The reference writes the apostrophe as a double
# quote; "{q}" below stands for that quote character (parameter ``quote``). The Python
# dialect's rule list also has ``(?<=[a-zA-Z]){q}s`` -> "" second; it can never match after
# the first rule has replaced every ``{q}s``, so it is left out.
CONTRACTIONS = {
    "python": [
        ("{q}s", " is"),
        ("(?<=s){q}s?", ""),
        ("(?<=[a-zA-Z])n{q}t", " not"),
        ("(?<=[a-zA-Z]){q}d", " would"),
        ("(?<=[a-zA-Z]){q}ll", " will"),
        ("(?<=[I|i]){q}m", " am"),
        ("(?<=[a-zA-Z]){q}re", " are"),
        ("(?<=[a-zA-Z]){q}ve", " have"),
    ],
    "sql": [
        ("(?i)(it|he|she|that|this|there|here)({q}s)", "$1 is"),
        ("(?<=[a-zA-Z]){q}s", ""),
        ("(?<=s){q}s?", ""),
        ("(?<=[a-zA-Z])n{q}t", " not"),
        ("(?<=[a-zA-Z]){q}d", " would"),
        ("(?<=[a-zA-Z]){q}ll", " will"),
        ("(?<=[I|i]){q}m", " am"),
        ("(?<=[a-zA-Z]){q}re", " are"),
        ("(?<=[a-zA-Z]){q}ve", " have"),
    ],
}
# Python dialect only: case-sensitive whole-form replacements with a real apostrophe.
PY_APOSTROPHE_FORMS = [
    ("it's", "it is"),
    ("he's", "he is"),
    ("she's", "she is"),
    ("that's", "that is"),
    ("this's", "this is"),
    ("there's", "there is"),
    ("here's", "here is"),
]

# Bracketed text removed by the line rule (innermost, non-empty).
BRACKETS = {
    "python": r"\([^(|^)]+\)",
    "sql": r"\([^()]+\)",
}

WORD_OR_PUNCT = r"\w+|[^\s\w]"
WORD_OR_PUNCT_UNICODE = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"

# The marks that are tokens, by dialect and width (query tokens leave out parentheses).
MARKS = {
    ("python", False): r"""['"]""",
    ("sql", False): r"""['"]""",
    ("python", True): r"""[()#/,'=><"\\?.*+\[\]^{}]""",
    ("sql", True): r"""[()#/,'=><"?.*+\[\]^{}]""",
}
BEYOND_ASCII = r"[^\x00-\x7F]+"
# Capitals that snake_case sets an underscore before, both its rules at once.
CAMEL = r"[A-Z](?:(?<=[a-z\d][A-Z])|(?<=[A-Z]{2})(?=[a-z]))"

DECIMAL = r"\d++(?:\.\d++)++"  # possessive: no recursion on long rows
QUOTED = r'"[^"]+"'
HEX = r"0[xX][A-Fa-f0-9]+"
INTEGER = r"\s?\d+\s?"
DIGIT_WORD = r"(?<![A-Z|a-z|_|])\d+[A-Za-z]+"
# ---------------------------------------------------------------------------------------

MISSING_CONTEXT = "-10000"


def _check(dialect: str) -> str:
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {DIALECTS}, got {dialect!r}")
    return dialect


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda variable.

    An expression referenced inside an array lambda is otherwise re-evaluated for every
    element; binding it first keeps a regular-expression chain to one evaluation per row.
    """
    return F.get(F.transform(F.array(value), body), 0)


def strip_ws(col) -> Column:
    """Remove leading and trailing whitespace (spaces, tabs, newlines)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def filter_chars(col, dialect: str = "python", wide: bool = False) -> Column:
    """Strict (S44) or wide (S45) character filter, then squeeze ``-`` and ``_`` runs and blank bars."""
    pattern = (WIDE_FILTER if wide else STRICT_FILTER)[_check(dialect)]

    def squeeze_runs(v: Column) -> Column:
        has_run = (F.instr(v, "--") > 0) | (F.instr(v, "__") > 0)
        return F.translate(F.when(has_run, F.regexp_replace(v, r"([-_])\1+", "$1")).otherwise(v), "|\u00a6", "  ")

    return let(F.regexp_replace(_c(col), pattern, " "), squeeze_runs)


def filter_strict(col, dialect: str = "python") -> Column:
    return filter_chars(col, dialect, wide=False)


def filter_wide(col, dialect: str = "python") -> Column:
    return filter_chars(col, dialect, wide=True)


def expand_contractions(col, dialect: str = "python", quote: str = '"') -> Column:
    """Expand contractions written with ``quote`` as the apostrophe."""
    def rules(src: Column) -> Column:
        c = src
        for pattern, repl in CONTRACTIONS[dialect]:
            c = F.regexp_replace(c, pattern.replace("{q}", quote), repl)
        return c

    def forms(src: Column) -> Column:
        c = src
        for short, full in PY_APOSTROPHE_FORMS:
            c = F.replace(c, F.lit(short), F.lit(full))
        return c

    # Every rule needs the quote character (every form an apostrophe): text without one
    # skips the passes. ``let`` keeps the input to one evaluation.
    _check(dialect)
    out = let(_c(col), lambda v: F.when(F.instr(v, quote) > 0, rules(v)).otherwise(v))
    if dialect == "python":
        out = let(out, lambda v: F.when(F.instr(v, "'s") > 0, forms(v)).otherwise(v))
    return out


def squeeze_space(col, dialect: str = "python") -> Column:
    """Collapse tab/newline/space runs and trim the ends."""
    c = _c(col)
    if _check(dialect) == "python":
        c = let(c, lambda v: F.when(F.instr(v, "\t") > 0, F.regexp_replace(v, r"\t+", "\t")).otherwise(v))
        # newline runs -> one space, then space runs -> one space == [ newline]+ -> one space
        c = F.regexp_replace(c, r"[ \n]+", " ")
    else:
        c = F.regexp_replace(c, r"[\t\n]+", " ")
    return strip_ws(c)


def snake_case(col) -> Column:
    """camelCase to snake_case, dashes to underscores, lower-case."""
    c = F.regexp_replace(_c(col), r"([A-Z]+)([A-Z][a-z])", "$1_$2")
    c = F.regexp_replace(c, r"([a-z\d])([A-Z])", "$1_$2")
    return F.lower(F.translate(c, "-", "_"))


def strip_brackets(col, dialect: str = "python") -> Column:
    """Remove innermost non-empty bracketed text (one pass)."""
    pattern = BRACKETS[_check(dialect)]
    return let(_c(col), lambda v: F.when(F.instr(v, "(") > 0, F.regexp_replace(v, pattern, "")).otherwise(v))


def strip_dots(col) -> Column:
    """Remove trailing dots (at the very end of the text; ``$`` would also match before a final newline)."""
    return F.regexp_replace(_c(col), r"\.+\z", "")


def normalize_line(col, dialect: str = "python", quote: str = '"') -> Column:
    """S46-S50 in the order of the line rule."""
    c = squeeze_space(expand_contractions(col, dialect, quote), dialect)
    c = strip_brackets(snake_case(c), dialect)
    return strip_dots(c) if dialect == "sql" else strip_ws(c)


def split_words(col, unicode: bool = False) -> Column:
    """Words and single punctuation marks, joined by one space.

    The pipeline applies it to ASCII text, where ``\\w`` is exact; ``unicode=True`` uses
    letter/number classes for raw text.
    """
    pattern = WORD_OR_PUNCT_UNICODE if unicode else WORD_OR_PUNCT
    return F.array_join(F.regexp_extract_all(_c(col), F.lit(pattern), 0), " ")


def tag_decimals(col) -> Column:
    """Dotted decimals to TAGINT."""
    return F.regexp_replace(_c(col), DECIMAL, "TAGINT")


def tag_strings(col) -> Column:
    """Double-quoted text to TAGSTR."""
    return F.regexp_replace(_c(col), QUOTED, "TAGSTR")


def tag_hex(col) -> Column:
    """Hexadecimal literals to TAGINT (unanchored)."""
    return F.regexp_replace(_c(col), HEX, "TAGINT")


def tag_integers(col) -> Column:
    """Digit runs (with one optional space each side) to `` TAGINT ``."""
    return F.regexp_replace(_c(col), INTEGER, " TAGINT ")


def tag_digit_words(col) -> Column:
    """Digit-led words not preceded by a letter, bar or underscore to TAGOER."""
    return F.regexp_replace(_c(col), DIGIT_WORD, "TAGOER")


def tag_all(col) -> Column:
    """S52-S55 in rule order.

    All rules but the quoted-text one need a digit, and that one needs a double quote, so
    text without digits runs one pass at most.
    """
    def no_digits(v: Column) -> Column:
        return F.when(F.instr(v, '"') > 0, tag_strings(v)).otherwise(v)

    return let(_c(col), lambda v: F.when(v.rlike("[0-9]"), tag_digit_words(tag_integers(tag_hex(tag_strings(
        tag_decimals(v)))))).otherwise(no_digits(v)))


def lower_split(col) -> Column:
    """Lower-case and split on single spaces (empty strings kept, dropped later)."""
    return F.split(F.lower(_c(col)), " ")


def sentence_words(col) -> Column:
    """Split, tag, lower-case, split into an array."""
    return lower_split(tag_all(split_words(col)))


def drop_blank(arr) -> Column:
    """Drop tokens that are empty after trimming."""
    return F.filter(_c(arr), lambda w: F.trim(w) != "")


def drop_parens(arr) -> Column:
    """Drop tokens that contain a parenthesis."""
    return F.filter(_c(arr), lambda w: (F.instr(w, "(") == 0) & (F.instr(w, ")") == 0))


def _line_tokens(col, dialect: str, quote: str, wide: bool) -> Column:
    """S44-S56 and the dropping of blanks (query text: of parentheses, too) for text that is split into tokens.

    The tokens are read once, from text in which the characters that the filter drops still stand: none of them is a token,
    and like the space that the filter writes they keep their neighbours apart. Only what a rule could take for something
    else goes first: characters beyond ASCII (lower case may be ASCII) and bars. S55 finds nothing after S51: the dots stand
    alone and S54 has taken all digits. The tokens are those of ``sentence_words(normalize_line(filter_chars(...)))``.
    """
    kept = re.compile(rf"{MARKS[_check(dialect), wide]}|[0-9A-Za-z_()-]")

    def squeeze_runs(v: Column) -> Column:
        return F.when((F.instr(v, "--") > 0) | (F.instr(v, "__") > 0), F.regexp_replace(v, r"([-_])\1+", "$1")).otherwise(v)

    c = let(_c(col), lambda v: F.when(F.octet_length(v) == F.char_length(v), v).otherwise(F.regexp_replace(v, BEYOND_ASCII, " ")))
    for q in {"|", *(q for q in quote if not kept.match(q))}:  # a quote that the filter drops expands nothing
        c = F.replace(c, F.lit(q), F.lit(" "))
    c = expand_contractions(let(c, squeeze_runs), dialect, quote)
    if dialect == "sql" and wide:  # the trim decides which trailing dots S50 sees
        c = F.rtrim(c, F.lit("".join(chr(i) for i in range(128) if not kept.match(chr(i)))))
    c = F.lower(F.replace(F.regexp_replace(c, CAMEL, "_$0"), F.lit("-"), F.lit("_")))
    brackets = BRACKETS[dialect if wide else "sql"]  # the strict filter has dropped what the Python rule excepts
    c = let(c, lambda v: F.when(F.instr(v, "(") > 0, F.regexp_replace(v, brackets, "")).otherwise(v))
    if dialect == "sql" and wide:
        c = strip_dots(c)
    c = let(c, lambda v: F.when(F.instr(v, '"') > 0, F.regexp_replace(v, '"[^"]*"', " tagstr ")).otherwise(v))
    c = let(c, lambda v: F.when(F.instr(v, "0x") > 0, F.regexp_replace(v, HEX, "tagint")).otherwise(v))
    return F.regexp_extract_all(F.regexp_replace(c, "[0-9]+", " tagint "), F.lit(rf"\w+|{MARKS[dialect, wide]}"), 0)


def query_tokens(col, dialect: str = "python", quote: str = '"') -> Column:
    """Query text to tokens (pre-lemma)."""
    return _line_tokens(col, dialect, quote, wide=False)


def context_tokens(col, dialect: str = "python", quote: str = '"') -> Column:
    """S58 + S19: context text to tokens; the missing-context marker passes through."""
    c = _c(col)
    return F.when(c == MISSING_CONTEXT, F.array(F.lit(MISSING_CONTEXT))).otherwise(_line_tokens(c, dialect, quote, wide=True))
