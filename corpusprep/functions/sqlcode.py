"""SQL code rules (S71-S79, S32-S34, S20) as native column expressions.

The reference builds a parse tree per snippet and walks it (its constructor fails for every
input, so this module implements the documented intent). After clean-up a snippet is one
line of space-separated words, so the walk reduces to per-token rules over the lexeme
array of the row, written with array higher-order functions:

* look-ahead ``name (`` -> function name, kept; ``name .`` -> table;
* a running "inside FROM" state: the last of ``from`` / ``where on group order union``
  seen before the token decides;
* renaming columns and tables to ``col{n}`` / ``tab{n}`` by first appearance, one counter
  per kind;
* string literals expanded to regular-expression pattern tokens.

Everything stays inside the row: no explode, no shuffle, no window.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusprep.functions.fold import bracket_depths
from corpusprep.functions.text import DECIMAL, _c, filter_wide, let, snake_case, split_words, strip_ws

FAILED_CODE = "-1000"

# Words that get a "1" suffix during sanitising (reference rule).
SUFFIXED_WORDS = ["index", "table", "day", "year", "user", "text"]

# Scanner rules for the text of a string literal, in the reference's order.
# At each position the first rule that matches wins; KEEP keeps the matched text, None drops it.
KEEP = object()
STRING_SCANNER = [
    (r"\[[^\]]*\]", KEEP),
    (r"\+", "REGPLU"),
    (r"\*", "REGAST"),
    (r"%", "REGCOL"),
    (r"\^", "REGSTA"),
    (r"\$", "REGEND"),
    (r"\?", "REGQUE"),
    (r"[\.~``;_a-zA-Z0-9\s=:\{\}\-\\]+", "REFRE"),
    (r".", None),
]
STRING_PIECE = "|".join(f"(?:{pattern})" for pattern, _ in STRING_SCANNER)

# Keywords and built-in type names that are neither renamed nor classified as names.
# Public SQL vocabulary (ANSI reserved words and common dialect keywords and types); every
# SQL rule takes ``keywords=`` to use another set (e.g. a dialect's reserved words).
SQL_KEYWORDS = sorted(set("""
add all alter and any as asc authorization begin between bigint binary bit boolean both break by
cascade case cast char character check close coalesce collate column commit constraint continue
convert create cross current cursor database date datetime deallocate decimal declare default
delete desc distinct double drop else end escape except exec execute exists fetch float for
foreign from full function go goto grant group having identity if in index inner insert int
integer intersect into is join key left like limit merge natural nchar not null numeric nvarchar
of off offset on open option or order outer output over partition percent primary print
procedure real references return returns revoke right rollback row rows schema select set
smallint some table then tinyint to top transaction trigger truncate union unique update using
values varchar view when where while with
""".split()))

# Keywords that switch the running "inside FROM" state.
FROM_ON = "from"
FROM_OFF = ["where", "on", "group", "order", "union"]

# Lexer over the sanitised text.
SQL_LEXEME = r"""'[^']*'|"[^"]*"|\[[^\[\]]+\]|\w+|[^\s\w]"""
# The words that stay keywords in front of a dot; any other word there is a name.
KEYWORD_BEFORE_DOT = ["case", "in", "values", "using", "from", "as"]


def sql_clean(col) -> Column:
    """Wide filter, collapse dots, drop ``>>`` runs, dotted decimals -> ``number``, split."""
    c = filter_wide(col, "sql")
    c = F.regexp_replace(c, r"\.+", ".")
    c = F.regexp_replace(c, r">>+", "")
    c = F.regexp_replace(c, DECIMAL, "number")
    return split_words(c)


def sql_sanitise(clean) -> Column:
    """Lower-case, close with ``;``, pad parentheses, suffix reserved-looking words, drop ``#``.

    Returns NULL for empty input (the reference raises there and reports a failed parse).
    The end-of-text suffix rule of the reference can never fire after the ``;`` is added.
    """
    def body(t: Column) -> Column:
        s = F.when(t.endswith(";"), t).otherwise(F.concat(t, F.lit(";")))
        s = F.regexp_replace(s, r"\(", " ( ")
        s = F.regexp_replace(s, r"\)", " ) ")
        for word in SUFFIXED_WORDS:
            s = F.regexp_replace(s, rf"([^\w]){word}([^\w])", rf"$1{word}1$2")
        s = F.translate(s, "#", "")
        return F.when(t == "", F.lit(None)).otherwise(s)

    return let(F.lower(strip_ws(clean)), body)


# Lexer of raw SQL text for the structure of brackets: strings (a doubled quote stands for one), quoted names, comments.
RAW_SQL_LEXEME = (r"'(?:[^']++|'')*+'|" r'"(?:[^"]++|"")*+"|`[^`]*+`|\[[^\[\]]*+\]|--[^\n]*+|/\*(?:[^*]++|\*(?!/))*+\*/|\w++|[^\s\w]')


def subquery_groups(col) -> Column:
    """``array<struct(start, end, depth)>`` of the parenthesised groups that hold ``select`` at their own level.

    ``start`` and ``end`` are the lexeme numbers of the parentheses, ``depth`` is 1 for an outermost group. The depth is a
    running sum over the lexemes of the raw text; strings, quoted names and comments are one lexeme each, so nothing in them
    counts. A parenthesis without its partner forms no group.
    """
    def groups(lexemes: Column, depths: Column) -> Column:
        def close(i: Column, depth: Column) -> Column:
            later = F.slice(depths, i + 2, F.size(depths))  # the group ends where the depth falls below its own
            return F.array_position(F.transform(later, lambda d: d < depth), True).cast("int") + i

        opened = F.filter(F.transform(lexemes, lambda t, i: F.when(t == "(", i)), lambda i: i.isNotNull())
        each = F.transform(opened, lambda i: F.struct(i.alias("start"), close(i, F.get(depths, i)).alias("end"), F.get(depths, i).alias("depth")))

        def own_select(g: Column) -> Column:
            inner = F.slice(F.arrays_zip(lexemes.alias("t"), depths.alias("d")), g["start"] + 2, g["end"] - g["start"] - 1)
            return F.exists(inner, lambda x: (x["t"] == "select") & (x["d"] == g["depth"]))

        return F.filter(each, lambda g: (g["end"] > g["start"]) & own_select(g))

    def with_depths(lexemes: Column) -> Column:
        return let(bracket_depths(lexemes, ("(",), (")",)), lambda d: groups(lexemes, d))

    return let(F.regexp_extract_all(F.lower(_c(col)), F.lit(RAW_SQL_LEXEME), 0), with_depths)


def subquery_count(col) -> Column:
    """Number of parenthesised groups that hold a ``select`` of their own."""
    return F.size(subquery_groups(col))


def string_pattern_tokens(lit: Column, regex: bool = True) -> Column:
    """A string literal to pattern tokens (``regex=True``) or to ``CODSTR``."""
    if not regex:
        return F.lit("CODSTR")
    pieces = F.regexp_extract_all(lit, F.lit(STRING_PIECE), 0)

    def name(p: Column) -> Column:
        # A piece came from the first rule that matches it whole.
        expr = None
        for pattern, out in STRING_SCANNER:
            value = p if out is KEEP else F.lit(out)
            cond = p.rlike(f"^(?:{pattern})$")
            expr = F.when(cond, value) if expr is None else expr.when(cond, value)
        return expr

    return F.array_join(F.transform(pieces, name), " ")


def sql_lexemes(sanitised) -> Column:
    """Lexemes of the sanitised text without the closing ``;``."""
    lex = F.regexp_extract_all(_c(sanitised), F.lit(SQL_LEXEME), 0)
    return F.slice(lex, 1, F.greatest(F.size(lex) - 1, F.lit(0)))


def _kind(t: Column, nxt: Column, in_from: Column, keywords=SQL_KEYWORDS) -> Column:
    """Kind of one lexeme given the next lexeme and the FROM state.

    A bracketed name is one name, a placeholder a column, and a keyword in front of a dot a table.
    """
    return (F.when(t.rlike(r"""^('.*'|".*")$"""), F.lit("STRING"))
            .when(t.rlike(r"^0x[0-9a-f]+$"), F.lit("HEX"))
            .when(t.rlike(r"^\d+$"), F.lit("INTEGER"))
            .when(t.rlike(r"^\d+e\d+$"), F.lit("FLOAT"))
            .when(t == "*", F.lit("WILDCARD"))
            .when((nxt == ".") & t.rlike(r"^[a-z_]\w*$") & ~t.isin(*KEYWORD_BEFORE_DOT, "number"), F.lit("TABLE"))
            .when(t.isin(list(keywords)) | (t == "number"), F.lit("KEYWORD"))
            .when(t == "?", F.lit("COLUMN"))
            .when(~t.rlike(r"^([a-z_]\w*|\[.+\])$"), F.lit("OTHER"))
            .when(nxt == "(", F.lit("FUNCTION"))
            .when((nxt == ".") | in_from, F.lit("TABLE"))
            .otherwise(F.lit("COLUMN")))


def _switches(lex: Column) -> Column:
    # Switch points: 2*pos+1 for ``from``, 2*pos for a closing keyword; the largest switch
    # point before a position tells whether that position is inside FROM.
    return F.filter(F.transform(lex, lambda t, i: (
        F.when(t == FROM_ON, i * 2 + 1).when(t.isin(FROM_OFF), i * 2))), lambda x: x.isNotNull())


def _inside_from(switches: Column, i: Column) -> Column:
    return F.coalesce(F.array_max(F.filter(switches, lambda s: s < i * 2)) % 2, F.lit(0)) == 1


def sql_kinds(sanitised, keywords=SQL_KEYWORDS) -> Column:
    """Array of ``struct(tok, kind)`` for the sanitised text."""
    return let(sql_lexemes(sanitised), lambda lex: let(_switches(lex), lambda sw: F.transform(
        lex, lambda t, i: F.struct(t.alias("tok"), _kind(t, F.get(lex, i + 1), _inside_from(sw, i), keywords)
                                   .alias("kind")))))


def sql_from_region(sanitised) -> Column:
    """Per lexeme, whether it lies inside a FROM region."""
    return let(sql_lexemes(sanitised), lambda lex: let(_switches(lex), lambda sw: F.transform(
        lex, lambda t, i: _inside_from(sw, i))))


def sql_rename(kinds, regex: bool = True) -> Column:
    """S32 + S73 + S74: output text of every lexeme.

    Columns and tables are numbered by first appearance with separate counters; literals
    become ``CODINT`` / ``CODHEX`` / ``CODFLO``; strings become pattern tokens.
    """
    def names_of(k: Column, kind: str) -> Column:
        return F.array_distinct(F.transform(F.filter(k, lambda x: x["kind"] == kind), lambda x: x["tok"]))

    def rename(k: Column, names: Column) -> Column:
        return F.transform(k, lambda x: (
            F.when(x["kind"] == "COLUMN",
                   F.concat(F.lit("col"), (F.array_position(names["cols"], x["tok"]) - 1).cast("string")))
            .when(x["kind"] == "TABLE",
                  F.concat(F.lit("tab"), (F.array_position(names["tabs"], x["tok"]) - 1).cast("string")))
            .when(x["kind"] == "INTEGER", F.lit("CODINT"))
            .when(x["kind"] == "HEX", F.lit("CODHEX"))
            .when(x["kind"] == "FLOAT", F.lit("CODFLO"))
            .when(x["kind"] == "STRING", string_pattern_tokens(x["tok"], regex))
            .otherwise(x["tok"])))

    return let(_c(kinds), lambda k: let(
        F.struct(names_of(k, "COLUMN").alias("cols"), names_of(k, "TABLE").alias("tabs")),
        lambda names: rename(k, names)))


def sql_code_parse(col, regex: bool = True, keywords=SQL_KEYWORDS) -> Column:
    """S79 + S20: ``struct(tokens, ok)``; tokens are ``array('-1000')`` when nothing is left after cleaning."""
    def parse(s: Column) -> Column:
        words = F.split(snake_case(F.array_join(sql_rename(sql_kinds(s, keywords), regex), " ")), " ")
        tokens = F.filter(words, lambda w: F.trim(w) != "")
        return F.struct(F.when(s.isNull(), F.array(F.lit(FAILED_CODE))).otherwise(tokens).alias("tokens"),
                        s.isNotNull().alias("ok"))

    return let(sql_sanitise(sql_clean(col)), parse)


def sql_code_tokens(col, regex: bool = True, keywords=SQL_KEYWORDS) -> Column:
    """Raw SQL code to tokens; ``array('-1000')`` when nothing is left after cleaning."""
    return sql_code_parse(col, regex, keywords)["tokens"]


def sql_code_ok(col) -> Column:
    """False where the SQL tokeniser reports failure."""
    return sql_sanitise(sql_clean(col)).isNotNull()
