"""Lexing, stored names and bracket groups against Python's own parser and plain loops."""

import ast
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import fold, pycode, pynames, sqlcode
from corpusprep.operators import repl

STATEMENTS = [
    "a = b = 1", "( a , b ) = 1 , 2", "del z", "del a, b[0], (c)", "with open(x) as h: y = 1", "with (A as a, B(c) as (d, e)):\n  pass",
    "import numpy as np, os as o\nfrom x import y as z", "[q for q in r if s]", "f(k=1, *v)", "x += 1; y -= 2", "*a, b = c",
    "[a, [b, *c]] = d", "a.b = c; d[e] = g", "x: int = 5", "x: int", "if (n := 10) > 5: m = n", "'a = 1' ; s = 'for z in q'", "# c = 1\nd = 2",
    "for i, (j, k) in zip(a, b):\n    l = i", "f = lambda a=1: a", "def g(a, b=2):\n    return a", "print('x', end='')",
    "t = '''m = 1\nn = 2'''\nu = r'\\'' \nv = 1", "{k: w for k, w in d.items() for e in w}", "foo(x for x in y)",
    "try:\n  p = 1\nexcept E as e:\n  q = 2", "x == y", "a <= b", "class A(B, m=C):\n  z = 1", "async def f():\n  async for w in z: pass",
    "for a[0] in b: pass", "global g1\ng1 = 2", "x = d['k = 1']", "for (a, b), c in z: q.r = 1", "lambda x: x", "", "@dec(a=1)\ndef f(): pass",
    "x = [\n1,\n2]\ny = 3", "p, = q", "x = {**a, 'b': c}\nfor i in x: print(i, end='')", "x = y = z = [i for i in range(3)][0]",
    "with a, b as c, d: e=1", "x = 1 if y else 2\nwhile x: x -= 1", "f\"{a}\" ; b = f'{c!r}'", "a = \\\n b\nc = d", "x = not y in z", "été = 1",
]


def parsed(code, aliases):
    tree = ast.parse(code)
    names = {n.id for n in ast.walk(tree) if isinstance(n, ast.Name) and not isinstance(n.ctx, ast.Load)}
    if aliases:
        for n in ast.walk(tree):
            if isinstance(n, (ast.Import, ast.ImportFrom)):
                names |= {a.asname for a in n.names if a.asname}
            if isinstance(n, ast.ExceptHandler) and n.name:
                names.add(n.name)
    return sorted(names)


@pytest.mark.parametrize("aliases", [True, False])
def test_stored_names_equal_the_parser(spark, aliases):
    random.seed(3)
    joined = ["\n".join(random.sample([s for s in STATEMENTS if s], 4)) for _ in range(40)]
    codes = STATEMENTS + joined
    df = spark.createDataFrame(enumerate(codes), "id int, code string")
    got = {r["id"]: r["n"] for r in df.select("id", pynames.stored_names("code", aliases).alias("n")).collect()}
    assert got == {i: parsed(c, aliases) for i, c in enumerate(codes)}


def test_stored_names_of_null_unparsable_and_long_code(spark):
    df = spark.createDataFrame([(0, None), (1, ")) = ( x = '"), (2, ", ".join(f"n{i}" for i in range(3000)) + " = x"), (3, "(" * 3000 + "a")], "id int, code string")
    got = {r["id"]: r["n"] for r in df.select("id", pynames.stored_names("code").alias("n")).collect()}
    assert got[0] is None and isinstance(got[1], list) and len(got[2]) == 3000 and got[3] == []


def test_stored_names_fold_each_lexeme_once(spark):
    rows = {"x\t=\v1": ["x"], "été, b.ñ = '\té = 2'": ["été"], "s = r\"\"\"a\n\tb = 1\"\"\"; ٣ = 4": ["s"], "名 += \\\n\t1 # c = d": ["名"], "\t": [], "": []}
    df = spark.createDataFrame([(c,) for c in [*rows, None]], "code string")
    names = df.select("code", pynames.stored_names("code").alias("n"))
    plan = names._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and plan.count("regexp_extract_all") == 1  # no fold of structs, one lexer
    assert {r["code"]: r["n"] for r in names.collect()} == rows | {None: None}


TOKENS = {
    r"'it\'s' + y": "string + y newline",
    r'"a\"b" + c': "string + c newline",
    "x = 'open": "var = ' open newline",
    "print ( x": "print ( x",
    "f(a]) + ')'": "f ( a ] ) + string",
    "a = 3rd + 0x1F + 1e5 + 007 + 2j + 1_000": "var = number rd + number + number + number number + number + number newline",
    "# only": "",
    "y = 1 # b = 2": "var = number newline",
    "'": "' newline",
}


def test_code_tokens_of_edge_cases(spark):
    df = spark.createDataFrame([(c,) for c in TOKENS], "code string")
    got = {r["code"]: " ".join(r["t"]) for r in df.select("code", pycode.python_code_tokens("code").alias("t")).collect()}
    assert got == TOKENS
    literal = df.filter(F.col("code").startswith("'it")).select(pycode.python_code_tokens("code", escapes=False).alias("t")).first()["t"]
    assert literal == ["string", "s", "'", "+", "y", "newline"]
    names = spark.createDataFrame([("(a, b) = c\nprint(a)",)], "code string").select(pycode.python_code_tokens("code", stored=True).alias("t")).first()["t"]
    assert " ".join(names) == "( var , var ) = c print ( var ) newline"


def test_raw_lexemes_join_to_the_code(spark):
    df = spark.createDataFrame([(c,) for c in STATEMENTS + list(TOKENS)], "code string")
    for r in df.select("code", pynames.raw_lexemes("code").alias("l")).collect():
        rest = r["code"]
        for t in r["l"]:
            rest = rest.lstrip(" \t")
            assert rest.startswith(t)
            rest = rest[len(t):]
        assert not rest.strip()


def spans(code):
    """Groups by a stack over the same lexemes."""
    lexemes = re.findall(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`|\[[^\[\]]*\]|--[^\n]*|/\*(?:[^*]|\*(?!/))*\*/|\w+|[^\s\w]", code.lower())
    stack, out = [], []
    for i, t in enumerate(lexemes):
        if t == "(":
            stack.append([i, False])
        elif t == ")" and stack:
            start, own = stack.pop()
            if own:
                out.append((start, i, len(stack) + 1))
        elif t == "select" and stack:
            stack[-1][1] = True
    return sorted(out)


def test_subquery_groups_equal_a_stack(spark):
    random.seed(9)
    words = ["(", ")", "(", ")", "select", "a", ",", "'( select'", "[select (]", "-- (select\n", "/* ( */", "selected", "\"(\""]
    codes = ["", "select 1", "(select 1", "(select 1) )", None] + [" ".join(random.choices(words, k=random.randrange(1, 40))) for _ in range(300)]
    df = spark.createDataFrame(enumerate(codes), "id int, code string")
    for r in df.select("code", sqlcode.subquery_groups("code").alias("g"), sqlcode.subquery_count("code").alias("n")).collect():
        if r["code"] is None:
            assert r["g"] is None
        else:
            assert sorted((g["start"], g["end"], g["depth"]) for g in r["g"]) == spans(r["code"]), r["code"]
            assert r["n"] == len(spans(r["code"]))


def test_running_fold(spark):
    df = spark.createDataFrame([(list(range(n)),) for n in (0, 1, 63, 64, 65, 200)], "a array<int>")
    for r in df.select("a", fold.running(F.col("a"), F.lit(0), lambda s, x: s + x).alias("s")).collect():
        assert r["s"] == [sum(r["a"][:i + 1]) for i in range(len(r["a"]))]


def repaired(code):
    """The prompt rules as plain loops: (layout, repaired code, blocks)."""
    lines = code.split("\n")
    flags = [next((k for k, p in enumerate(repl.PROMPTS, 1) if re.match(p, line)), 0) for line in lines]
    bare = [re.sub(repl.PROMPTS[f - 1], "", line) if f else line for line, f in zip(lines, flags)]
    if not any(flags):
        return "none", code, [code]
    typical = re.match("0*[14]", "".join(map(str, flags))) is not None
    runs, kept = [], []
    for i, f in enumerate(flags):
        if not i or (f == 0) != (flags[i - 1] == 0):
            runs.append([])
        runs[-1].append(i)
        last = next((g for g in reversed(flags[:i]) if g), 0)
        if f or (not any(flags[:i]) if typical else last != 2):
            kept.append(bare[i] + "\n")
    blocks = ["\n".join(bare[i] for i in run).strip() for run in runs]
    if typical:
        blocks = [b for k, b in enumerate(blocks) if b or (k == 0 and flags[0] == 0)]
    else:
        blocks = [b for b in blocks[:-1] if b]
    return "typical" if typical else "atypical", "".join(kept), blocks


def test_repair_equals_plain_loops(spark):
    random.seed(4)
    kinds = ["In [1]: a", "Out[2]: b", "   ...: c", ">>> d >>> e", "... f", "plain", "", "  "]
    codes = ["\n".join(random.choices(kinds, k=random.randrange(1, 12))) for _ in range(400)] + ["", "plain\n" * 5000 + ">>> x\n" * 5000]
    df = spark.createDataFrame(enumerate(codes), "id int, code string")
    got = {r["id"]: (r["layout"], r["repaired"]) for r in repl.repl_repair(df).collect()}
    blocks = {}
    for r in repl.repl_blocks(df).collect():
        blocks.setdefault(r["id"], {})[r["block_no"]] = r["block"]
    for i, c in enumerate(codes):
        layout, text, parts = repaired(c)
        assert got[i] == (layout, text), c[:200]
        assert [b for _, b in sorted(blocks.get(i, {}).items())] == parts, c[:200]
