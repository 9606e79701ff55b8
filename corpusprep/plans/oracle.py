"""DuckDB SQL for the registered queries (the correctness oracle).

Written against DuckDB's dialect over the pre-registered views. DuckDB's regular
expressions have no look-behind, so those rules are rewritten with a captured preceding
character; the SQL tokeniser is expressed with unnested tokens and window functions
instead of the array functions used on the Spark side.
"""

from __future__ import annotations

# Written out here, so that a wrong word in the code under test shows.
SUFFIXED_WORDS = ["index", "table", "day", "year", "user", "text"]
SQL_KEYWORDS = """add all alter and any as asc authorization begin between bigint binary bit boolean both break by
cascade case cast char character check close coalesce collate column commit constraint continue convert create cross
current cursor database date datetime deallocate decimal declare default delete desc distinct double drop else end
escape except exec execute exists fetch float for foreign from full function go goto grant group having identity if in
index inner insert int integer intersect into is join key left like limit merge natural nchar not null numeric nvarchar
of off offset on open option or order outer output over partition percent primary print procedure real references
return returns revoke right rollback row rows schema select set smallint some table then tinyint to top transaction
trigger truncate union unique update using values varchar view when where while with""".split()


def L(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rr(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {L(pattern)}, {L(repl)}, 'g')"


NL = "chr(10)"

STRICT = {"python": r"""[^()|0-9a-zA-Z_'"\n-]+""", "sql": r"""[^0-9a-zA-Z_'"()\n-]"""}
WIDE = {"python": r"""[^()|0-9a-zA-Z#/_,'=><"\\?.*+\[\]^{}\n-]+""",
        "sql": r"""[^()|0-9a-zA-Z#/_,'=><"?.*+\[\]^{}\n-]+"""}

CONTRACT = {
    "python": [('"s', " is"), ('s"s?', "s"), ('([a-zA-Z])n"t', r"\1 not"), ('([a-zA-Z])"d', r"\1 would"),
               ('([a-zA-Z])"ll', r"\1 will"), ('([I|i])"m', r"\1 am"), ('([a-zA-Z])"re', r"\1 are"),
               ('([a-zA-Z])"ve', r"\1 have")],
    "sql": [('(?i)(it|he|she|that|this|there|here)("s)', r"\1 is"), ('([a-zA-Z])"s', r"\1"), ('s"s?', "s"),
            ('([a-zA-Z])n"t', r"\1 not"), ('([a-zA-Z])"d', r"\1 would"), ('([a-zA-Z])"ll', r"\1 will"),
            ('([I|i])"m', r"\1 am"), ('([a-zA-Z])"re', r"\1 are"), ('([a-zA-Z])"ve', r"\1 have")],
}
APOSTROPHE = [("it's", "it is"), ("he's", "he is"), ("she's", "she is"), ("that's", "that is"),
              ("this's", "this is"), ("there's", "there is"), ("here's", "here is")]


def strip(x):
    return rr(x, r"^\s+|\s+$", "")


def filt(x, dialect, wide):
    s = rr(x, (WIDE if wide else STRICT)[dialect], " ")
    s = rr(s, "-+", "-")
    s = rr(s, "_+", "_")
    return f"replace(replace({s}, '|', ' '), '\u00a6', ' ')"


def contract(x, dialect):
    s = x
    for p, r in CONTRACT[dialect]:
        s = rr(s, p, r)
    if dialect == "python":
        for a, b in APOSTROPHE:
            s = f"replace({s}, {L(a)}, {L(b)})"
    return s


def squeeze(x, dialect):
    if dialect == "python":
        s = rr(x, r"\t+", "\t")
        s = rr(s, r"\n+", "\n")
        s = f"replace({s}, {NL}, ' ')"
        s = rr(s, " +", " ")
    else:
        s = rr(x, r"[\t\n]+", " ")
    return strip(s)


def snake(x):
    s = rr(x, "([A-Z]+)([A-Z][a-z])", r"\1_\2")
    s = rr(s, "([a-z0-9])([A-Z])", r"\1_\2")
    return f"lower(replace({s}, '-', '_'))"


def brackets(x, dialect):
    return rr(x, r"\([^(|^)]+\)" if dialect == "python" else r"\([^()]+\)", "")


def dots(x):
    return f"rtrim({x}, '.')"


def nl_line(x, dialect):
    s = brackets(snake(squeeze(contract(x, dialect), dialect)), dialect)
    return strip(s) if dialect == "python" else dots(s)


def words(x, unicode=False):
    pat = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]" if unicode else r"\w+|[^\s\w]"
    return f"array_to_string(regexp_extract_all({x}, {L(pat)}), ' ')"


def tag_dec(x):
    return rr(x, r"\d+(\.\d+)+", "TAGINT")


def tag_str(x):
    return rr(x, r'"[^"]+"', "TAGSTR")


def tag_hex(x):
    return rr(x, r"0[xX][A-Fa-f0-9]+", "TAGINT")


def tag_int(x):
    return rr(x, r"\s?\d+\s?", " TAGINT ")


def tag_oer(x):
    return rr(x, r"(^|[^A-Za-z|_])\d+[A-Za-z]+", r"\1TAGOER")


def sent_words(x):
    return f"string_split(lower({tag_oer(tag_int(tag_hex(tag_str(tag_dec(words(x))))))}), ' ')"


def query_tokens(x, dialect):
    return (f"list_filter({sent_words(nl_line(filt(x, dialect, False), dialect))}, "
            f"lambda w: trim(w) <> '' AND NOT regexp_matches(w, '[()]'))")


def context_tokens(x, dialect):
    inner = f"list_filter({sent_words(nl_line(filt(x, dialect, True), dialect))}, lambda w: trim(w) <> '')"
    return f"(CASE WHEN {x} = '-10000' THEN ['-10000'] ELSE {inner} END)"


def J(lst):
    return f"array_to_string({lst}, ' ')"


# -- code ------------------------------------------------------------------------------------------

def py_clean(x):
    s = filt(x, "python", True)
    s = rr(s, r"\.+", ".")
    s = rr(s, r"\t+", "\t")
    s = rr(s, r"\n+", "\n")
    s = rr(s, ">>+", "")
    s = rr(s, " +", " ")
    return words(strip(s))


def _names(csv):
    return f"list_filter(list_transform(string_split({csv}, ','), lambda v: trim(v)), lambda v: v <> '')"


def py_vars(clean):
    eq = f"regexp_extract({clean}, {L(r'^(\s*[_a-zA-Z][_a-zA-Z0-9]*\s*)(,\s*[_a-zA-Z][_a-zA-Z0-9]*\s*)*=')}, 0)"
    fo = f"regexp_extract({clean}, {L(r'for\s+[_a-zA-Z][_a-zA-Z0-9]*\s*(,\s*[_a-zA-Z][_a-zA-Z0-9]*)*\s+in')}, 0)"
    eq_names = _names(f"(CASE WHEN length({eq}) > 0 THEN left({eq}, length({eq}) - 1) ELSE '' END)")
    fo_names = _names(f"(CASE WHEN length({fo}) > 0 THEN substr({fo}, 4, length({fo}) - 5) ELSE '' END)")
    return f"list_sort(list_distinct(list_concat({eq_names}, {fo_names})))"


def py_vars_all(clean):
    ident = r"[_a-zA-Z][_a-zA-Z0-9]*"
    chain = r"^((?:\s*" + ident + r"\s*(?:,\s*" + ident + r"\s*)*=\s*)+)(?:[^=\s]|$)"
    eq = f"regexp_extract({clean}, {L(r'^(\s*[_a-zA-Z][_a-zA-Z0-9]*\s*)(,\s*[_a-zA-Z][_a-zA-Z0-9]*\s*)*=')}, 0)"
    first_names = _names(f"(CASE WHEN length({eq}) > 0 THEN left({eq}, length({eq}) - 1) ELSE '' END)")
    chain_names = f"regexp_extract_all(regexp_extract({clean}, {L(chain)}, 1), {L(ident)})"
    eq_names = f"list_concat({first_names}, {chain_names})"
    grouped = r"for\s+([_a-zA-Z][_a-zA-Z0-9]*\s*(?:,\s*[_a-zA-Z][_a-zA-Z0-9]*)*)\s+in"
    fo_names = (f"flatten(list_transform(regexp_extract_all({clean}, {L(grouped)}, 1), "
                f"lambda m: {_names('m')}))")
    return f"list_sort(list_distinct(list_concat({eq_names}, {fo_names})))"


PY_NUMBER = (r"[0-9](?:_?[0-9])*(?:[eE][0-9](?:_?[0-9])*)?[jJ]|[0-9](?:_?[0-9])*[eE][0-9](?:_?[0-9])*|0[xX](?:_?[0-9a-fA-F])+|"
             r"0[bB](?:_?[01])+|0[oO](?:_?[0-7])+|0(?:_?0)*|[1-9](?:_?[0-9])*")
PY_LEX = r"""'(?:[^'\\]|\\ ?[^ ])*'|"(?:[^"\\]|\\ ?[^ ])*"|#.*|""" + PY_NUMBER + r"""|\w+|[^\s\w]"""


def py_kinds(clean_col, vars_col):
    return (f"list_filter(list_transform(regexp_extract_all({clean_col}, {L(PY_LEX)}), lambda t: CASE "
            f"WHEN starts_with(t, '#') THEN NULL "
            f"WHEN regexp_matches(t, {L(chr(94) + "('.*'|" + '".*")$')}) THEN 'STRING' "
            f"WHEN regexp_matches(t, '^[0-9]') THEN 'NUMBER' "
            f"WHEN list_contains({vars_col}, t) THEN 'VAR' ELSE t END), lambda t: t IS NOT NULL)")


def py_finish(k):
    opened = f"len(list_filter({k}, lambda t: t IN ('(', '[', '{{')))"
    closed = f"len(list_filter({k}, lambda t: t IN (')', ']', '}}')))"
    body = f"(CASE WHEN len({k}) > 0 AND {opened} = {closed} THEN list_append({k}, 'NEWLINE') ELSE {k} END)"
    return f"list_filter(string_split({snake(J(body))}, ' '), lambda w: trim(w) <> '')"


def py_token_select(src):
    """``(id, toks)`` for ``src(id, code)``."""
    return (f"SELECT id, {py_finish('k')} AS toks FROM (SELECT id, {py_kinds('c', 'v')} AS k FROM "
            f"(SELECT id, c, {py_vars('c')} AS v FROM (SELECT id, {py_clean('code')} AS c FROM ({src}))))")


def sql_clean(x):
    s = filt(x, "sql", True)
    s = rr(s, r"\.+", ".")
    s = rr(s, r"\t+", "\t")
    s = rr(s, r"\n+", "\n")
    s = rr(s, " +", " ")
    s = rr(s, ">>+", "")
    s = rr(s, r"\d+(\.\d+)+", "number")
    return words(strip(s))


def sql_sanitise(clean):
    t = f"lower({strip(clean)})"
    s = f"(CASE WHEN ends_with({t}, ';') THEN {t} ELSE {t} || ';' END)"
    s = f"replace(replace({s}, '(', ' ( '), ')', ' ) ')"
    for w in SUFFIXED_WORDS:
        s = rr(s, r"([^\w])" + w + r"([^\w])", r"\1" + w + r"1\2")
    s = f"replace({s}, '#', '')"
    return f"(CASE WHEN {t} = '' THEN NULL ELSE {s} END)"


SQL_LEX = r"""'[^']*'|"[^"]*"|\[[^\[\]]+\]|\w+|[^\s\w]"""
KW = ", ".join(L(k) for k in SQL_KEYWORDS)
PIECE = r"\[[^\]]*\]|[+*%^$?]|[.~`;_a-zA-Z0-9\s=:{}\\-]+|."
RUN = r"^[.~`;_a-zA-Z0-9\s=:{}\\-]+$"


def string_patterns(tok):
    named = (f"list_transform(regexp_extract_all({tok}, {L(PIECE)}), lambda p: CASE "
             f"WHEN starts_with(p, '[') AND length(p) > 1 THEN p "
             f"WHEN p = '+' THEN 'REGPLU' WHEN p = '*' THEN 'REGAST' WHEN p = '%' THEN 'REGCOL' "
             f"WHEN p = '^' THEN 'REGSTA' WHEN p = '$' THEN 'REGEND' WHEN p = '?' THEN 'REGQUE' "
             f"WHEN regexp_matches(p, {L(RUN)}) THEN 'REFRE' ELSE NULL END)")
    return f"array_to_string(list_filter({named}, lambda p: p IS NOT NULL), ' ')"


def sql_token_ctes(src: str) -> str:
    """CTEs ``san(id, s)`` and ``named(id, pos, tok, kind, out_plain, out_regex)`` over ``src(id, code)``."""
    kind = (f"CASE WHEN regexp_matches(tok, {L(chr(94) + "('.*'|" + '".*")$')}) THEN 'STRING' "
            f"WHEN regexp_matches(tok, '^0x[0-9a-f]+$') THEN 'HEX' "
            f"WHEN regexp_matches(tok, '^[0-9]+$') THEN 'INTEGER' "
            f"WHEN regexp_matches(tok, '^[0-9]+e[0-9]+$') THEN 'FLOAT' "
            f"WHEN tok = '*' THEN 'WILDCARD' "
            f"WHEN nxt = '.' AND regexp_matches(tok, '^[a-z_][a-z0-9_]*$') "
            f"AND tok NOT IN ('case', 'in', 'values', 'using', 'from', 'as', 'number') THEN 'TABLE' "
            f"WHEN tok IN ({KW}) OR tok = 'number' THEN 'KEYWORD' "
            f"WHEN tok = '?' THEN 'COLUMN' "
            f"WHEN NOT regexp_matches(tok, '^[a-z_][a-z0-9_]*$') AND NOT regexp_matches(tok, '^\\[.+\\]$') THEN 'OTHER' "
            f"WHEN nxt = '(' THEN 'FUNCTION' "
            f"WHEN nxt = '.' OR in_from = 1 THEN 'TABLE' ELSE 'COLUMN' END")
    return f"""
san AS (SELECT id, {sql_sanitise(sql_clean('code'))} AS s FROM ({src})),
lexed AS (SELECT id, regexp_extract_all(s, {L(SQL_LEX)}) AS l FROM san WHERE s IS NOT NULL),
toks AS (SELECT id, unnest(l) AS tok, unnest(range(1, len(l) + 1)) AS pos, len(l) AS n FROM lexed),
marked AS (
  SELECT id, pos, tok, lead(tok) OVER w AS nxt,
         coalesce(last_value(CASE WHEN tok = 'from' THEN 1
                                  WHEN tok IN ('where', 'on', 'group', 'order', 'union') THEN 0 END IGNORE NULLS)
                  OVER (PARTITION BY id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS in_from
  FROM toks WHERE pos < n WINDOW w AS (PARTITION BY id ORDER BY pos)),
kinded AS (SELECT *, {kind} AS kind FROM marked),
firsts AS (SELECT *, min(pos) OVER (PARTITION BY id, kind, tok) AS fp FROM kinded),
ranked AS (SELECT *, dense_rank() OVER (PARTITION BY id, kind ORDER BY fp) - 1 AS nr FROM firsts),
named AS (
  SELECT id, pos, tok, kind, in_from,
         CASE kind WHEN 'COLUMN' THEN 'col' || nr WHEN 'TABLE' THEN 'tab' || nr WHEN 'INTEGER' THEN 'CODINT'
                   WHEN 'HEX' THEN 'CODHEX' WHEN 'FLOAT' THEN 'CODFLO' WHEN 'STRING' THEN 'CODSTR' ELSE tok END
           AS out_plain,
         CASE kind WHEN 'COLUMN' THEN 'col' || nr WHEN 'TABLE' THEN 'tab' || nr WHEN 'INTEGER' THEN 'CODINT'
                   WHEN 'HEX' THEN 'CODHEX' WHEN 'FLOAT' THEN 'CODFLO' WHEN 'STRING' THEN {string_patterns('tok')}
                   ELSE tok END AS out_regex
  FROM ranked)"""


# -- derived inputs (mirror corpusprep.plans.derive) ---------------------------------------------

PY_SNIPPETS = f"""SELECT o_orderkey AS id, CASE o_orderkey % 4
  WHEN 0 THEN 'total_' || o_custkey || ' = count_' || o_custkey || ' = ' || o_orderkey || {NL}
       || 'for item, qty in lines(' || o_custkey
       || '):' || {NL} || '    status = "' || o_orderstatus || '"  # ' || o_orderpriority || {NL}
       || '    print(item, qty * total_' || o_custkey || ')'
  WHEN 1 THEN '# order ' || o_orderkey || {NL} || 'sumPrice = 0x1F' || {NL} || 'while sumPrice < ' || o_custkey
       || ':' || {NL} || '    sumPrice = sumPrice + 1.5' || {NL} || 'print(''done for x in it'', sumPrice)'
  WHEN 2 THEN 'def f(a, b=' || o_custkey || '):' || {NL} || '    return a->b >> ' || o_orderkey || {NL}
       || '>>> f(1)' || {NL} || 'result = [x for x in range(' || o_orderkey || ') if x != ''' || o_orderpriority
       || '''] + [y for y in range(' || o_custkey || ')]'
  ELSE 'customer_id, order_id = ' || o_custkey || ', ' || o_orderkey || {NL} || 'print("it''s " + ''' || o_orderstatus
       || ''')'
END AS code FROM orders"""

PY_STATEMENTS = rf"""SELECT o_orderkey AS id, CASE o_orderkey % 10
  WHEN 0 THEN 'note_' || o_custkey || ' = ''it\''s '' + ' || o_orderkey || ' + "a\"b = ' || o_orderstatus || '" '
  WHEN 1 THEN '(a_' || o_custkey || ', [b, *rest]) = ' || o_orderkey || ', [2]' || {NL} || 'last = first = rest[0]'
  WHEN 2 THEN 'print(''' || o_orderstatus || ' is open' || {NL} || 'x = ' || o_orderkey
  WHEN 3 THEN 'del z' || o_custkey || ', w[' || o_orderkey || '], (u, v.t)' || {NL} || 'print(d[''e = f''])'
  WHEN 4 THEN 'import numpy as np' || {NL} || 'with open(''' || o_orderstatus || ''') as h' || o_custkey
       || ', lock(k=1) as (p, q): line = h.read(' || o_orderkey || ')'
  WHEN 5 THEN 'rows = [x for x, (y, z) in items[' || o_orderkey || '] if x != ''for q in r'']' || {NL} || 'count_' || o_custkey
       || ' += sum(i for i in rows)'
  WHEN 6 THEN 'text = ''''''m = ' || o_orderkey || {NL} || 'n = 2'''''' ; pat = r''\d+''  # o = 1' || {NL} || 'for i, j in text: s[i] = j'
  WHEN 7 THEN 'size_' || o_custkey || ': int = ' || o_orderkey || {NL} || '*head, tail = parts' || {NL} || 'if (n := 3) >= tail: m = n == 4'
  WHEN 8 THEN 'x' || o_custkey || ' = 3rd + 0x1F + 1e5 + 007 + 2j # y = ' || o_orderkey
  ELSE 'a.b[' || o_custkey || '] = f(k=' || o_orderkey || ', *v); g = lambda u=1: u' || {NL} || 'return [s' || {NL} || ', (t'
END AS code FROM orders"""

# Lexemes of raw code; without look-ahead a triple-quoted string is written as characters with one or two quotes between them.
PY_RAW_LEX = (r"""[rRbBuUfF]{0,2}(?:'''(?:[^'\\]|\\[\s\S]|'[^'\\]|''[^'\\])*'''|'(?:[^'\\\n]|\\[\s\S])*'|"(?:[^"\\\n]|\\[\s\S])*")|#[^\n]*|\\\n|\n|"""
              r"0[xX][0-9a-fA-F_]+|0[bB][01_]+|0[oO][0-7_]+|(?:[0-9][0-9_]*(?:\.[0-9_]*)?|\.[0-9][0-9_]*)(?:[eE][-+]?[0-9][0-9_]*)?[jJ]?|"
              r"[\p{L}_][\p{L}\p{N}_]*|\*\*=|//=|<<=|>>=|\.\.\.|->|:=|\*\*|//|<<|>>|[-+*/%&|^@=<>!]=|\S")
PY_WORDS = ("False None True and as assert async await break class continue def del elif else except finally for from global if import in "
            "is lambda nonlocal not or pass raise return try while with yield")
PY_NAME = f"word AND NOT list_contains(string_split({L(PY_WORDS)}, ' '), t)"
PY_BLOCK = "head IN ('if', 'for', 'with', 'while')"
PY_LEXED = f"unnest(regexp_extract_all(code || chr(10), {L(PY_RAW_LEX)})) AS t, unnest(range(len(regexp_extract_all(code || chr(10), {L(PY_RAW_LEX)})))) AS i"

# Names stored by statements, with windows over the unnested lexemes: depth and open calls by running sums, lines and
# statements by counted ends, targets by the last assignment sign of a statement, scopes of for and as by their next end.
PY_STORED_NAMES = f"""WITH src AS ({PY_STATEMENTS}),
code AS (SELECT * FROM (SELECT id, {PY_LEXED} FROM src) WHERE t NOT LIKE '#%' AND NOT starts_with(t, chr(92))),
kind AS (SELECT *, regexp_matches(t, '^[a-zA-Z_]') AND NOT regexp_matches(t, {L('''['"]$''')}) AS word, t IN ('(', '[', '{{') AS op,
                t IN (')', ']', '}}') AS cl, lag(t) OVER w AS prev, lead(t) OVER w AS nxt FROM code WINDOW w AS (PARTITION BY id ORDER BY i)),
named AS (SELECT *, {PY_NAME} AS name, lag({PY_NAME} OR cl OR regexp_matches(t, {L('''['"]$|^[.]?[0-9]''')})) OVER w AS behind
          FROM kind WINDOW w AS (PARTITION BY id ORDER BY i)),
deep AS (SELECT *, sum(op::INT - cl::INT) OVER w AS d, sum(op::INT - cl::INT) OVER w + cl::INT AS lvl, op AND coalesce(behind, false) AS call
         FROM named WINDOW w AS (PARTITION BY id ORDER BY i)),
matched AS (SELECT *, coalesce(cl AND lag(call) OVER (PARTITION BY id, lvl, op OR cl ORDER BY i), false) AS uncall FROM deep),
calls AS (SELECT *, sum(call::INT - uncall::INT) OVER w AS used, sum((t IN (chr(10), ';') AND d = 0)::INT) OVER w - (t IN (chr(10), ';') AND d = 0)::INT AS line
          FROM matched WINDOW w AS (PARTITION BY id ORDER BY i)),
heads AS (SELECT *, first_value(t) OVER (PARTITION BY id, line ORDER BY i) AS head FROM calls),
colons AS (SELECT *, sum((t = 'lambda' AND d = 0)::INT) OVER w AS lambdas, t = ':' AND d = 0 AS colon, sum((t = ':' AND d = 0)::INT) OVER w AS colon_no
           FROM heads WINDOW w AS (PARTITION BY id, line ORDER BY i)),
stmts AS (SELECT *, {PY_BLOCK} AND colon_no - colon::INT > 0 AS tail FROM colons),
signs AS (SELECT *, d = 0 AND lambdas = 0 AND (t IN ('+=', '-=') OR (colon AND NOT {PY_BLOCK})) AS last_sign FROM stmts),
ends AS (SELECT *, max(CASE WHEN last_sign OR d = 0 AND lambdas = 0 AND t = '=' THEN i END) OVER w AS sign_at, min(CASE WHEN last_sign THEN i END) OVER w AS last_at
         FROM signs WINDOW w AS (PARTITION BY id, line, tail)),
scopes AS (SELECT *, max(CASE WHEN t IN ('for', 'as') THEN i END) OVER (PARTITION BY id ORDER BY i) AS f FROM ends),
opened AS (SELECT s.id, s.i AS f, s.used AS fused,
                  min(CASE WHEN e.d = s.d AND (CASE WHEN s.t = 'for' THEN e.t = 'in' ELSE e.t IN (',', ':', chr(10)) END) THEN e.i END) AS stop
           FROM scopes s JOIN scopes e ON s.id = e.id AND e.i > s.i WHERE s.t IN ('for', 'as') GROUP BY s.id, s.i, s.used),
names AS (SELECT s.id, s.t FROM scopes s LEFT JOIN opened o ON s.id = o.id AND s.f = o.f
          WHERE s.name AND coalesce(s.prev, '') <> '.' AND (s.nxt = ':=' OR s.nxt NOT IN ('.', '[', '(') AND (
             s.used = 0 AND s.i < s.sign_at AND (s.last_at IS NULL OR s.i < s.last_at) AND NOT coalesce(s.i < o.stop, false)
             OR s.used = 0 AND s.head = 'del' OR s.i < o.stop AND s.used = o.fused)))
SELECT src.id, coalesce(string_agg(DISTINCT t, ' ' ORDER BY t), '') AS names FROM src LEFT JOIN names ON src.id = names.id GROUP BY src.id"""

SQL_SNIPPETS = """SELECT p_partkey AS id, CASE p_partkey % 6
  WHEN 0 THEN 'SELECT p.p_name, COUNT(*) FROM part p WHERE p.p_size = ' || p_size || ' AND p.p_brand LIKE '''
       || p_brand || '%'' GROUP BY p.p_name'
  WHEN 1 THEN 'UPDATE Inventory SET retailPrice = 0x1F, qty = 2.5 WHERE p_type = ''' || p_type || ''' AND size >= '
       || p_size || ' ORDER BY day, year'
  WHEN 2 THEN 'SELECT t.id, MAX(o.total) FROM (SELECT * FROM stock s WHERE s.qty > ' || p_partkey
       || ') t JOIN orders o ON o.id = t.id WHERE o.note = "' || p_name || '" UNION SELECT 1e5, [' || p_brand || ']'
  WHEN 3 THEN 'SELECT order.id, key.name, [Unit Price] FROM [Order Details] d WHERE id = ? AND size = ' || p_size
       || ' AND [Category] = c.category_name'
  WHEN 4 THEN 'SELECT a FROM t WHERE b REGEXP ''^ab+[0-9]*c?$'' AND d LIKE ''%' || p_brand
       || '@{x}%'' AND e IN (SELECT ''it, all'' FROM u)'
  ELSE ':: @'
END AS code FROM part"""

SQL_NESTED = """SELECT p_partkey AS id, CASE p_partkey % 6
  WHEN 0 THEN 'SELECT (SELECT max(a) FROM t WHERE b IN (SELECT c FROM u WHERE d = ' || p_size || ')) FROM v'
  WHEN 1 THEN 'SELECT ''( select 1'', "(select" FROM t -- (select ' || p_partkey || chr(10) || 'WHERE x = (y + ' || p_size || ')'
  WHEN 2 THEN 'INSERT INTO t (a, b) (SELECT c, (d + ' || p_size || ') FROM u) ON CONFLICT (a) DO UPDATE SET b = (SELECT ' || p_partkey || ')'
  WHEN 3 THEN 'SELECT f((SELECT 1)), ((SELECT ' || p_size || '), ''it''''s ('') /* (select */ FROM t'
  WHEN 4 THEN 'SELECT a FROM t WHERE (b = (SELECT ' || p_partkey || ' FROM u) AND (c = ''' || p_brand || ''''
  ELSE ') SELECT 1) FROM (SELECT [' || p_brand || ' (select] FROM selected (x)) q WHERE (WITH w AS (SELECT 2) SELECT 3) > ' || p_size
END AS code FROM part"""

# Lexemes of raw SQL; the end of a comment is found without look-ahead.
SQL_RAW_LEX = r"""'(?:[^']|'')*'|"(?:[^"]|"")*"|`[^`]*`|\[[^\[\]]*\]|--[^\n]*|/\*(?:[^*]|\*[^/])*\*/|\w+|[^\s\w]"""
# Depth by running sums, less the unmatched closers so far; a group ends at the next closer of its depth.
SUBQUERY_SPANS = f"""WITH src AS ({SQL_NESTED}),
lex AS (SELECT id, unnest(regexp_extract_all(lower(code), {L(SQL_RAW_LEX)})) AS t, unnest(range(len(regexp_extract_all(lower(code), {L(SQL_RAW_LEX)})))) AS i FROM src),
sums AS (SELECT *, sum((t = '(')::INT - (t = ')')::INT) OVER w AS s FROM lex WINDOW w AS (PARTITION BY id ORDER BY i)),
deep AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY id ORDER BY i)) AS d FROM sums),
ends AS (SELECT o.id, o.i AS start, o.d AS depth, min(c.i) AS "end" FROM deep o JOIN deep c ON o.id = c.id AND c.i > o.i AND c.t = ')' AND c.d = o.d - 1
         WHERE o.t = '(' GROUP BY o.id, o.i, o.d)
SELECT e.id, e.start, e."end", e.depth::BIGINT AS depth FROM ends e
WHERE EXISTS (SELECT 1 FROM deep x WHERE x.id = e.id AND x.i > e.start AND x.i < e."end" AND x.t = 'select' AND x.d = e.depth)"""

CONTRACTION_TEXT = """SELECT c_custkey AS id, c_name || ' can"t say it"s ' || c_mktsegment
  || '. They"re sure I"m here, she"d say we"ll go; there"s ' || c_nationkey || ' boss"s, It"S fine, it''s that''s here''s'
  AS text FROM customer"""

PROMPT_SNIPPETS = """SELECT l_orderkey AS id, string_agg(line, chr(10) ORDER BY l_linenumber, line) AS code FROM (
  SELECT l_orderkey, l_linenumber, CASE (l_linenumber + l_partkey) % 6
    WHEN 0 THEN '>>> qty = ' || l_linenumber
    WHEN 1 THEN '... total += ' || l_partkey
    WHEN 2 THEN 'In [' || l_linenumber || ']: x = ' || l_suppkey
    WHEN 3 THEN 'Out[' || l_linenumber || ']: ' || l_partkey
    WHEN 4 THEN '   ...: y = ' || l_returnflag
    ELSE 'result ' || l_linestatus END AS line
  FROM lineitem) GROUP BY l_orderkey"""

RAW_CORPUS = f"""SELECT CAST(u.conv_id AS VARCHAR) AS question_id, CAST(u.turn AS BIGINT) AS cand,
  CASE WHEN u.conv_id % 2 = 0 THEN 'python' ELSE 'sql' END AS lang,
  coalesce(p.text, '-10000') AS ctx1, coalesce(n.text, '-10000') AS ctx2,
  CASE WHEN u.conv_id % 2 = 0
    THEN 'reply_' || u.turn || ' = ''' || u.role || '''' || {NL} || 'for w in words(' || u.conv_id || '):' || {NL}
         || '    print(w)'
    ELSE 'SELECT text FROM conversations c WHERE c.conv_id = ' || u.conv_id || ' AND turn > ' || u.turn END AS code,
  u.text AS query
FROM conversations u
LEFT JOIN conversations p ON p.conv_id = u.conv_id AND p.turn + 1 = u.turn
LEFT JOIN conversations n ON n.conv_id = u.conv_id AND n.turn - 1 = u.turn
WHERE u.role = 'user'"""


def text_ids(lst):
    return f"(CASE WHEN len({lst}) = 0 OR {lst}[1] = 1 THEN list_prepend(0, {lst}) ELSE {lst} END)"


def code_ids(lst):
    return f"list_concat([1], list_slice({lst}, 1, 348), [2])"


def fit(lst, n):
    return f"list_resize({lst}, {n}, 0)"


def SJ(lst):
    return f"array_to_string(list_transform({lst}, lambda v: CAST(v AS VARCHAR)), ' ')"


def doc_rule(expr):
    return f"SELECT doc_id, {expr('text')} AS out FROM documents"


def doc_tokens(expr):
    return f"SELECT doc_id, {J(expr('text'))} AS tokens FROM documents"


SPECIALS = "SELECT 0 AS idx, 'PAD' AS word UNION ALL SELECT 1, 'UNK' UNION ALL SELECT 2, 'SOS' UNION ALL SELECT 3, 'EOS'"


def vectors_over(words_sql):
    """``(word, vec_id, vec)``: four of five words take the embedding of their rank modulo the embeddings' number."""
    return (f"SELECT r.word, r.vec_id, e.embedding AS vec FROM (SELECT word, rank % (SELECT count(*) FROM embeddings) AS vec_id "
            f"FROM (SELECT word, row_number() OVER (ORDER BY word) - 1 AS rank FROM ({words_sql})) WHERE rank % 5 <> 4) r "
            f"JOIN embeddings e ON e.vec_id = r.vec_id")


DOC_VOCAB = f"SELECT DISTINCT unnest({query_tokens('text', 'python')}) AS word FROM documents"
BENCH_VOCAB = f"SELECT DISTINCT unnest({query_tokens('text', 'python')}) AS word FROM benchmark"
VT = vectors_over(f"SELECT word FROM ({DOC_VOCAB}) UNION SELECT word FROM ({BENCH_VOCAB})")
DOC_FOUND = f"SELECT d.word, v.vec FROM ({DOC_VOCAB}) d JOIN ({VT}) v ON v.word = d.word"
DOC_DICT = f"SELECT word, CAST(row_number() OVER (ORDER BY word) + 3 AS BIGINT) AS idx FROM ({DOC_FOUND})"


def encode_one(key, src_tokens_sql, dict_sql, keep=None):
    """``(key, l)``: id list of each row of ``src_tokens_sql(key, t)`` (whole list, or the first ``keep``)."""
    t = "t" if keep is None else f"list_slice(t, 1, {keep})"
    return f"""SELECT s.{key}, coalesce(list(i.idx ORDER BY i.pos) FILTER (WHERE i.idx IS NOT NULL), []) AS l
FROM ({src_tokens_sql}) s LEFT JOIN (
  SELECT x.{key}, x.pos, coalesce(d.idx, 1) AS idx
  FROM (SELECT {key}, unnest({t}) AS token, unnest(range(len({t}))) AS pos FROM ({src_tokens_sql})) x
  LEFT JOIN ({dict_sql}) d ON d.word = x.token) i ON i.{key} = s.{key}
GROUP BY s.{key}"""


DOC_QT = f"SELECT doc_id, {query_tokens('text', 'python')} AS t FROM documents"

SQL_TOKEN_RESULT = """SELECT s.id, CASE WHEN s.s IS NULL THEN ['-1000'] ELSE
  list_filter(string_split({snake}, ' '), lambda w: trim(w) <> '') END AS toks, s.s IS NOT NULL AS ok
FROM san s LEFT JOIN (SELECT id, string_agg(out_regex, ' ' ORDER BY pos) AS o FROM named GROUP BY id) a ON a.id = s.id"""
SQL_TOKEN_RESULT = SQL_TOKEN_RESULT.replace("{snake}", snake("coalesce(a.o, '')"))


def tokenised_corpus_ctes():
    """CTEs ``rid`` (raw corpus with id) and ``tc`` (token lists per record)."""
    ctx = {d: (context_tokens("ctx1", d), context_tokens("ctx2", d), query_tokens("query", d)) for d in ("python", "sql")}
    return f"""rid AS (SELECT question_id || ':' || cand AS id, * FROM ({RAW_CORPUS})),
{sql_token_ctes("SELECT id, code FROM rid WHERE lang = 'sql'")},
sqltok AS ({SQL_TOKEN_RESULT}),
pytok AS (SELECT id, toks, true AS ok FROM ({py_token_select("SELECT id, code FROM rid WHERE lang = 'python'")})),
codetok AS (SELECT * FROM sqltok UNION ALL SELECT * FROM pytok),
tc AS (SELECT r.id, r.question_id, r.cand, r.lang,
  CASE WHEN r.lang = 'python' THEN {ctx['python'][0]} ELSE {ctx['sql'][0]} END AS ctx1_tokens,
  CASE WHEN r.lang = 'python' THEN {ctx['python'][1]} ELSE {ctx['sql'][1]} END AS ctx2_tokens,
  c.toks AS code_tokens,
  CASE WHEN r.lang = 'python' THEN {ctx['python'][2]} ELSE {ctx['sql'][2]} END AS query_tokens,
  c.ok AS code_ok
  FROM rid r JOIN codetok c ON c.id = r.id)"""


def encoded_corpus_ctes():
    fields = [("ctx1", 100, "text"), ("ctx2", 100, "text"), ("code", 348, "code"), ("query", 25, "text")]
    ctes = [tokenised_corpus_ctes(),
            "cw AS (SELECT DISTINCT w AS word FROM (SELECT unnest(list_concat(ctx1_tokens, ctx2_tokens, code_tokens, "
            "query_tokens)) AS w FROM tc))",
            f"cvt AS ({vectors_over('SELECT word FROM cw')})",
            "cfound AS (SELECT cw.word FROM cw JOIN cvt ON cvt.word = cw.word)",
            "cdict AS (SELECT word, CAST(row_number() OVER (ORDER BY word) + 3 AS BIGINT) AS idx FROM cfound)"]
    for name, keep, _ in fields:
        ctes.append(f"e_{name} AS ({encode_one('id', f'SELECT id, {name}_tokens AS t FROM tc', 'SELECT * FROM cdict', keep)})")
    cols = []
    for name, _, kind in fields:
        n = {"ctx1": 100, "ctx2": 100, "code": 350, "query": 25}[name]
        wrapped = code_ids(f"e_{name}.l") if kind == "code" else text_ids(f"e_{name}.l")
        cols.append(f"{SJ(fit(wrapped, n))} AS {name}_ids")
    enc = (f"enc AS (SELECT tc.question_id, tc.cand, {', '.join(cols)}, CAST(4 AS BIGINT) AS block_length, "
           f"CAST(0 AS BIGINT) AS label FROM tc " +
           " ".join(f"JOIN e_{name} ON e_{name}.id = tc.id" for name, _, _ in fields) + ")")
    ctes.append(enc)
    return ",\n".join(ctes)


REPL_CTES = f"""src AS ({PROMPT_SNIPPETS}),
lines AS (SELECT id, unnest(string_split(code, chr(10))) AS line, unnest(range(len(string_split(code, chr(10))))) AS ln
          FROM src),
flagged AS (SELECT *, CASE WHEN regexp_matches(line, {L(r'^In ?\[\d+\]: ?')}) THEN 1
                           WHEN regexp_matches(line, {L(r'^Out ?\[\d+\]: ?')}) THEN 2
                           WHEN regexp_matches(line, {L(r'^( )+\.+: ?')}) THEN 3
                           WHEN regexp_matches(line, {L(r'^>>> ?')}) THEN 4
                           WHEN regexp_matches(line, {L(r'^\.\.\. ?')}) THEN 5 ELSE 0 END AS flag FROM lines),
rec AS (SELECT id, string_agg(CAST(flag AS VARCHAR), '' ORDER BY ln) AS flags FROM flagged GROUP BY id),
lay AS (SELECT id, flags, CASE WHEN NOT regexp_matches(flags, '[1-5]') THEN 'none'
                               WHEN regexp_matches(flags, '^0*[14]') THEN 'typical' ELSE 'atypical' END AS layout FROM rec),
x AS (SELECT f.*, l.layout,
        min(CASE WHEN flag <> 0 THEN ln END) OVER (PARTITION BY f.id) AS first_p,
        coalesce(last_value(CASE WHEN flag <> 0 THEN flag END IGNORE NULLS)
                 OVER (PARTITION BY f.id ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev_p,
        CASE flag WHEN 0 THEN line
                  WHEN 1 THEN {rr('line', r'In ?\[\d+\]: ?', '')}
                  WHEN 2 THEN {rr('line', r'Out ?\[\d+\]: ?', '')}
                  WHEN 3 THEN {rr('line', r'( )+\.+: ?', '')}
                  WHEN 4 THEN {rr('line', r'>>> ?', '')}
                  ELSE {rr('line', r'\.\.\. ?', '')} END AS text
      FROM flagged f JOIN lay l ON l.id = f.id)"""

REPL_BLOCKS = f"""WITH {REPL_CTES},
s1 AS (SELECT *, CASE WHEN ln = 0 OR ((flag <> 0) <> (lag(flag) OVER (PARTITION BY id ORDER BY ln) <> 0))
                      THEN 1 ELSE 0 END AS st, max(ln) OVER (PARTITION BY id) AS last_ln FROM x),
s2 AS (SELECT *, sum(st) OVER (PARTITION BY id ORDER BY ln ROWS UNBOUNDED PRECEDING) AS island FROM s1),
isl AS (SELECT id, layout, island, string_agg(text, chr(10) ORDER BY ln) AS joined, min(ln) AS first_ln,
               max(ln) AS end_ln, max(last_ln) AS last_ln, min(flag) AS min_flag FROM s2 GROUP BY id, layout, island),
blk AS (SELECT *, CASE WHEN layout = 'none' THEN joined ELSE {strip('joined')} END AS block FROM isl),
kept AS (SELECT * FROM blk WHERE CASE WHEN layout = 'none' THEN true
                                      WHEN layout = 'typical' THEN (first_ln = 0 AND min_flag = 0) OR block <> ''
                                      ELSE block <> '' AND end_ln < last_ln END)
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY island) - 1 AS BIGINT) AS block_no, block FROM kept"""

REPL_REPAIR = f"""WITH {REPL_CTES}
SELECT id, layout, CASE WHEN layout = 'none' THEN string_agg(line, chr(10) ORDER BY ln)
  ELSE coalesce(string_agg(CASE WHEN (layout = 'typical' AND (ln < first_p OR flag <> 0))
                                  OR (layout = 'atypical' AND (flag <> 0 OR prev_p <> 2))
                                THEN text || chr(10) END, '' ORDER BY ln), '') END AS repaired
FROM x GROUP BY id, layout"""


def _sql_named(select):
    return f"WITH {sql_token_ctes(SQL_SNIPPETS)}\n{select}"


RAW_COUNTS = f"SELECT question_id, count(*) AS n FROM ({RAW_CORPUS}) GROUP BY question_id"
SINGLE = f"SELECT r.* FROM ({RAW_CORPUS}) r JOIN ({RAW_COUNTS}) c USING (question_id) WHERE c.n = 1"
MULTIPLE = f"SELECT r.* FROM ({RAW_CORPUS}) r JOIN ({RAW_COUNTS}) c USING (question_id) WHERE c.n > 1"

OLD_FOUND = f"SELECT b.word FROM ({BENCH_VOCAB}) b JOIN ({VT}) v ON v.word = b.word"
OLD_DICT = f"SELECT CAST(row_number() OVER (ORDER BY word) + 3 AS BIGINT) AS idx, word FROM ({OLD_FOUND})"
NEW_FOUND = (f"SELECT d.word FROM ({DOC_VOCAB}) d JOIN ({VT}) v ON v.word = d.word "
             f"WHERE d.word NOT IN (SELECT word FROM ({OLD_FOUND}))")

TAG_NAMES = ["a", "n", "r", "v"]


def _tag_step(k: int) -> tuple[str, str]:
    """Best sum into class k and its path, from the columns of the token before; the earlier class wins a tie."""
    sums = [f"v.s_{p} - {1 + (3 * i + 2 * k) % 7}" for i, p in enumerate(TAG_NAMES)]
    best = f"greatest({', '.join(sums)})"
    path = "CASE " + " ".join(f"WHEN {s} = {best} THEN v.p_{p}" for s, p in zip(sums, TAG_NAMES)) + " END"
    return f"{best} + t.e_{TAG_NAMES[k]}", f"{path} || '{TAG_NAMES[k]}'"


# Best class sequences, token by token: one column of sums and one of paths for each class.
LEMMA_POS_JOIN = f"""WITH RECURSIVE turns AS (SELECT conv_id || '/' || turn AS id, {query_tokens('text', 'python')} AS toks FROM conversations),
words AS (SELECT id, unnest(toks) AS w, unnest(range(len(toks))) AS i FROM turns),
tok AS (SELECT id, w, i,
    CASE WHEN length(w) = 1 THEN 0 WHEN w LIKE '%e' OR w LIKE '%al' THEN -8 END AS e_a,
    CASE WHEN length(w) = 1 THEN 0 ELSE -10 - length(w) % 3 END AS e_n,
    CASE WHEN length(w) = 1 THEN 0 WHEN w LIKE '%ly' THEN -3 END AS e_r,
    CASE WHEN length(w) = 1 THEN 0 WHEN w LIKE '%ing' OR w LIKE '%ed' THEN -6 WHEN length(w) % 2 = 0 THEN -11 END AS e_v FROM words),
vit AS (
    SELECT id, i, {', '.join(f"CAST(e_{c} - {1 + (12 + 2 * k) % 7} AS BIGINT) AS s_{c}" for k, c in enumerate(TAG_NAMES))}, {', '.join(f"'{c}' AS p_{c}" for c in TAG_NAMES)}
    FROM tok WHERE i = 0
    UNION ALL
    SELECT t.id, t.i, {', '.join(f"CAST({_tag_step(k)[0]} AS BIGINT)" for k in range(4))}, {', '.join(_tag_step(k)[1] for k in range(4))}
    FROM vit v JOIN tok t ON t.id = v.id AND t.i = v.i + 1),
done AS (SELECT id, CASE {' '.join(f"WHEN s_{c} = greatest(s_a, s_n, s_r, s_v) THEN p_{c}" for c in TAG_NAMES)} END AS classes
         FROM vit QUALIFY row_number() OVER (PARTITION BY id ORDER BY i DESC) = 1),
base AS (SELECT words.id, i, CASE
        WHEN w LIKE '%s' AND length(w) > 3 THEN CASE WHEN classes[i + 1] = 'n' THEN left(w, length(w) - 1) ELSE w END
        WHEN w LIKE '%ing' AND length(w) > 5 THEN CASE WHEN classes[i + 1] = 'v' THEN left(w, length(w) - 3) ELSE w END
        WHEN w LIKE '%on' THEN left(w, length(w) - 2) ELSE w END AS t FROM words JOIN done ON words.id = done.id)
SELECT turns.id, coalesce(string_agg(t, ' ' ORDER BY i), '') AS tokens, coalesce(any_value(classes), '') AS classes
FROM turns LEFT JOIN base ON turns.id = base.id LEFT JOIN done ON turns.id = done.id GROUP BY turns.id"""


ORACLE_SQL: dict[str, str] = {
    "filter_strict_python": doc_rule(lambda x: filt(x, "python", False)),
    "filter_strict_sql": doc_rule(lambda x: filt(x, "sql", False)),
    "filter_wide_python": doc_rule(lambda x: filt(x, "python", True)),
    "filter_wide_sql": doc_rule(lambda x: filt(x, "sql", True)),
    "contractions_python": f"SELECT id, {contract('text', 'python')} AS out FROM ({CONTRACTION_TEXT})",
    "contractions_sql": f"SELECT id, {contract('text', 'sql')} AS out FROM ({CONTRACTION_TEXT})",
    "squeeze_space_python": doc_rule(lambda x: squeeze(x, "python")),
    "squeeze_space_sql": doc_rule(lambda x: squeeze(x, "sql")),
    "snake_case": doc_rule(snake),
    "strip_brackets_python": doc_rule(lambda x: brackets(x, "python")),
    "strip_brackets_sql": doc_rule(lambda x: brackets(x, "sql")),
    "strip_dots": doc_rule(dots),
    "split_words": doc_rule(lambda x: words(x, unicode=True)),
    "tag_strings": doc_rule(tag_str),
    "tag_hex": doc_rule(tag_hex),
    "tag_integers": doc_rule(tag_int),
    "tag_decimals": doc_rule(tag_dec),
    "tag_digit_words": doc_rule(tag_oer),
    "lower_split": doc_rule(lambda x: f"array_to_string(string_split(lower({x}), ' '), '|')"),
    "query_tokens_python": doc_tokens(lambda x: query_tokens(x, "python")),
    "query_tokens_sql": doc_tokens(lambda x: query_tokens(x, "sql")),
    "context_tokens_python": doc_tokens(lambda x: context_tokens(x, "python")),
    "context_tokens_sql": doc_tokens(lambda x: context_tokens(x, "sql")),
    "lemma_join": f"""WITH dt AS ({DOC_QT}),
vocab AS (SELECT DISTINCT unnest(t) AS word FROM dt),
lem AS (SELECT v.word AS token, left(v.word, length(v.word) - 1) AS lemma FROM vocab v
        JOIN vocab b ON b.word = left(v.word, length(v.word) - 1) WHERE regexp_matches(v.word, '^[a-z]{{3,}}s$')),
lng AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM dt),
j AS (SELECT l.doc_id, l.pos, coalesce(m.lemma, l.token) AS w FROM lng l LEFT JOIN lem m ON m.token = l.token)
SELECT dt.doc_id, coalesce(string_agg(j.w, ' ' ORDER BY j.pos), '') AS tokens
FROM dt LEFT JOIN j ON j.doc_id = dt.doc_id GROUP BY dt.doc_id""",
    "python_clean": f"SELECT id, {py_clean('code')} AS clean FROM ({PY_SNIPPETS})",
    "python_vars": f"SELECT id, {J(py_vars('c'))} AS vars FROM (SELECT id, {py_clean('code')} AS c FROM ({PY_SNIPPETS}))",
    "python_vars_all": f"SELECT id, {J(py_vars_all('c'))} AS vars FROM (SELECT id, {py_clean('code')} AS c "
                       f"FROM ({PY_SNIPPETS}))",
    "python_stored_names": PY_STORED_NAMES,
    "python_lexemes": f"SELECT id, array_to_string(list_transform(regexp_extract_all(code, {L(PY_RAW_LEX)}), lambda t: replace(t, {NL}, '~')), ' | ') "
                      f"AS lexemes FROM ({PY_STATEMENTS})",
    "python_statement_tokens": f"SELECT id, {J('toks')} AS tokens FROM ({py_token_select(PY_STATEMENTS)})",
    "python_code_tokens": f"SELECT id, {J('toks')} AS tokens FROM ({py_token_select(PY_SNIPPETS)})",
    "sql_clean": f"SELECT id, {sql_clean('code')} AS clean FROM ({SQL_SNIPPETS})",
    "sql_sanitise": f"SELECT id, coalesce({sql_sanitise(sql_clean('code'))}, '-1000') AS sanitised FROM ({SQL_SNIPPETS})",
    "sql_kinds": _sql_named("SELECT san.id, coalesce(string_agg(tok || '/' || kind, ' ' ORDER BY pos), '') AS kinds "
                            "FROM san LEFT JOIN named ON named.id = san.id WHERE san.s IS NOT NULL GROUP BY san.id"),
    "sql_from_region": _sql_named("SELECT san.id, coalesce(string_agg(CASE WHEN in_from = 1 THEN '1' ELSE '0' END, '' "
                                  "ORDER BY pos), '') AS in_from FROM san LEFT JOIN named ON named.id = san.id "
                                  "WHERE san.s IS NOT NULL GROUP BY san.id"),
    "sql_rename": _sql_named("SELECT san.id, coalesce(string_agg(out_plain, ' ' ORDER BY pos), '') AS renamed "
                             "FROM san LEFT JOIN named ON named.id = san.id WHERE san.s IS NOT NULL GROUP BY san.id"),
    "sql_string_patterns": _sql_named(
        "SELECT san.id, coalesce(string_agg(CASE WHEN kind = 'STRING' THEN " + string_patterns("tok") +
        " END, ' | ' ORDER BY pos), '') AS patterns FROM san LEFT JOIN named ON named.id = san.id "
        "WHERE san.s IS NOT NULL GROUP BY san.id"),
    "parse_records": """SELECT CAST(c_custkey AS VARCHAR) AS question_id, CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 2 END::BIGINT AS cand,
        CASE WHEN c_custkey % 6 = 0 THEN 'sql' END AS lang, CASE WHEN c_custkey % 6 = 0 THEN c_name END AS "query" FROM customer WHERE c_custkey % 6 IN (0, 5)""",
    "record_rejects": """SELECT CASE c_custkey % 6
          WHEN 1 THEN left('{"qid": {"question_id": "' || c_custkey || '", "cand": 1}, "lang": "sql", "query": "' || c_name || '"}', 30)
          WHEN 2 THEN '{"qid": {"question_id": "' || c_custkey || '", "cand": "many"}, "query": "x"}'
          ELSE '{"lang": "sql", "query": "' || c_mktsegment || '"}' END AS line,
        CASE WHEN c_custkey % 6 = 3 THEN 'no question' ELSE 'broken' END AS reason FROM customer WHERE c_custkey % 6 IN (1, 2, 3)""",
    "vector_rejects": """SELECT CASE p_partkey % 5 WHEN 1 THEN 'w' || p_partkey || ' ' || p_size WHEN 3 THEN 'w' || p_partkey || ' ' || p_size || ' x1'
          ELSE p_size || ' ' || p_size END AS line FROM part WHERE p_partkey % 5 IN (1, 3) OR p_partkey % 5 = 4 AND p_size <> 2""",
    "lemma_pos_join": LEMMA_POS_JOIN,
    "new_words_prefiltered": f"""SELECT DISTINCT w AS word FROM (SELECT unnest({query_tokens('text', 'python')}) AS w FROM conversations)
        WHERE w NOT IN (SELECT unnest({query_tokens('text', 'python')}) FROM documents)""",
    "roundtrip_diff_by_digest": """WITH b AS (SELECT doc_id, lang, "source", n_chars FROM documents),
        a AS (SELECT doc_id, CASE WHEN doc_id % 97 = 5 THEN NULL ELSE lang END AS lang, "source", n_chars FROM documents WHERE doc_id % 101 <> 7
              UNION ALL SELECT * FROM b WHERE doc_id % 211 = 3)
        (SELECT *, 'before' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) UNION ALL (SELECT *, 'after' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b))""",
    "subquery_spans": SUBQUERY_SPANS,
    "subquery_count": f"SELECT id, CAST(len(regexp_extract_all(lower(code), {L(r'\(\s*select\b')})) AS BIGINT) AS n "
                      f"FROM ({SQL_SNIPPETS})",
    "sql_code_tokens": _sql_named(f"SELECT id, {J('toks')} AS tokens, ok AS code_ok FROM ({SQL_TOKEN_RESULT})"),
    "repl_flags": f"WITH {REPL_CTES} SELECT id, flags FROM rec",
    "repl_layout": f"WITH {REPL_CTES} SELECT id, layout FROM lay",
    "repl_repair": REPL_REPAIR,
    "repl_blocks": REPL_BLOCKS,
    "flatten_record": f"SELECT question_id, cand, ctx1, ctx2, code, query FROM ({RAW_CORPUS})",
    "tokenise_corpus": f"""WITH {tokenised_corpus_ctes()}
SELECT question_id, cand, lang, {J('ctx1_tokens')} AS ctx1_tokens, {J('ctx2_tokens')} AS ctx2_tokens,
       {J('code_tokens')} AS code_tokens, {J('query_tokens')} AS query_tokens, code_ok FROM tc""",
    "candidate_counts": f"SELECT question_id, n AS n_candidates FROM ({RAW_COUNTS})",
    "split_single": f"SELECT question_id, cand, lang FROM ({SINGLE})",
    "split_multiple": f"SELECT question_id, cand, lang FROM ({MULTIPLE})",
    "label_singles": f"SELECT question_id, cand, CAST(1 AS BIGINT) AS label FROM ({SINGLE})",
    "count_value": f"SELECT doc_id, CAST(len(list_filter(t, lambda x: x = 'tagint')) AS BIGINT) AS n_tagint FROM ({DOC_QT})",
    "vocab_one": DOC_VOCAB,
    "vocab_union": f"""SELECT DISTINCT w AS word FROM (
  SELECT unnest({context_tokens('text', 'sql')}) AS w FROM documents
  UNION ALL SELECT unnest({context_tokens('text', 'sql')}) AS w FROM benchmark)""",
    "new_words": f"SELECT word FROM ({DOC_VOCAB}) EXCEPT SELECT word FROM ({BENCH_VOCAB})",
    "roundtrip_diff": f"""WITH a AS (SELECT id, {J(query_tokens('text', 'python'))} AS tokens FROM ({CONTRACTION_TEXT})),
b AS (SELECT id, {J(query_tokens('text', 'sql'))} AS tokens FROM ({CONTRACTION_TEXT}))
SELECT id, tokens, 'before' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT id, tokens, 'after' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
    "word_vectors": f"""SELECT word, CAST(vec_id AS BIGINT) AS vec_id, CAST(len(vec) AS BIGINT) AS dim,
  round(list_reduce(list_transform(vec, lambda x: CAST(x AS DOUBLE)), lambda a, b: a + b), 4) + 0.0 AS vec_sum
FROM ({VT})""",
    "unit_vectors": f"""SELECT word, round(sqrt(list_reduce(list_transform(u, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)),
  lambda a, b: a + b)), 4) + 0.0 AS norm, round(CAST(u[1] AS DOUBLE), 4) + 0.0 AS first,
  round(CAST(u[64] AS DOUBLE), 4) + 0.0 AS last
FROM (SELECT word, list_transform(vec, lambda x: CAST(CASE WHEN n > 0 THEN CAST(x AS DOUBLE) / n ELSE 0.0 END AS FLOAT)) AS u
      FROM (SELECT word, vec, sqrt(list_reduce(list_transform(vec, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)),
                                               lambda a, b: a + b)) AS n FROM ({VT})))""",
    "found_words": f"SELECT word, CAST(len(vec) AS BIGINT) AS dim FROM ({DOC_FOUND})",
    "failed_words": f"SELECT word FROM ({DOC_VOCAB}) WHERE word NOT IN (SELECT word FROM ({VT}))",
    "dictionary_numbering": f"SELECT CAST(idx AS BIGINT) AS idx, word FROM ({SPECIALS}) UNION ALL "
                            f"SELECT idx, word FROM ({DOC_DICT})",
    "append_numbering": f"""WITH old AS ({OLD_DICT})
SELECT CAST(idx AS BIGINT) AS idx, word FROM ({SPECIALS}) UNION ALL SELECT idx, word FROM old UNION ALL
SELECT CAST(row_number() OVER (ORDER BY word) + (SELECT coalesce(max(idx), 3) FROM old) AS BIGINT) AS idx, word
FROM ({NEW_FOUND})""",
    "verify_dictionary": f"""SELECT CAST(count(*) AS BIGINT) AS checked,
  CAST(count(*) FILTER (WHERE d.vec <> v.vec OR len(d.vec) <> len(v.vec)) AS BIGINT) AS mismatched
FROM ({DOC_FOUND}) d JOIN ({VT}) v ON v.word = d.word""",
    "lookup_ids": f"SELECT doc_id, {SJ('l')} AS ids FROM ({encode_one('doc_id', DOC_QT, DOC_DICT)})",
    "encode_text": f"SELECT doc_id, {SJ(fit(text_ids('l'), 100))} AS ids FROM ({encode_one('doc_id', DOC_QT, DOC_DICT, 100)})",
    "fit_length": f"""SELECT doc_id, {SJ(fit('l', 50))} AS ids FROM ({encode_one(
        'doc_id', f"SELECT doc_id, {context_tokens('text', 'python')} AS t FROM documents", DOC_DICT, 50)})""",
    "encode_code": f"""WITH ct AS ({py_token_select(PY_SNIPPETS)}),
cw AS (SELECT DISTINCT unnest(toks) AS word FROM ct),
cvt AS ({vectors_over('SELECT word FROM cw')}),
cdict AS (SELECT cw.word, CAST(row_number() OVER (ORDER BY cw.word) + 3 AS BIGINT) AS idx FROM cw
          JOIN cvt ON cvt.word = cw.word)
SELECT id, {SJ(fit(code_ids('l'), 350))} AS ids FROM ({encode_one('id', 'SELECT id, toks AS t FROM ct',
                                                                  'SELECT * FROM cdict', 348)})""",
    "encode_corpus": f"WITH {encoded_corpus_ctes()}\nSELECT * FROM enc",
    "corpus_report": f"""WITH {encoded_corpus_ctes()}
SELECT 'records' AS metric, CAST(count(*) AS BIGINT) AS value FROM tc
UNION ALL SELECT 'code_failed', CAST(count(*) FILTER (WHERE NOT code_ok) AS BIGINT) FROM tc
UNION ALL SELECT 'single', CAST(count(*) AS BIGINT) FROM ({SINGLE})
UNION ALL SELECT 'multiple', CAST(count(*) AS BIGINT) FROM ({MULTIPLE})
UNION ALL SELECT 'questions_multiple', CAST(count(DISTINCT question_id) AS BIGINT) FROM ({MULTIPLE})
UNION ALL SELECT 'vocab', CAST(count(*) AS BIGINT) FROM cw
UNION ALL SELECT 'dictionary', CAST(count(*) + 4 AS BIGINT) FROM cfound
UNION ALL SELECT 'failed_words', CAST((SELECT count(*) FROM cw) - count(*) AS BIGINT) FROM cfound
UNION ALL SELECT 'encoded', CAST(count(*) AS BIGINT) FROM enc""",
}
ORACLE_SQL["run_report"] = ORACLE_SQL["corpus_report"]
