"""Hand-derived goldens (FIXTURES.md section B), from the reference's demo inputs."""

from pyspark.sql import functions as F

from corpusprep.functions import pycode, sqlcode, text
from corpusprep.operators import corpus, encode, repl


def _one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(fn(F.col("v")).alias("out")).first()["out"]


NL = [
    ("change row_height and column_width in libreoffice calc use python tagint", "query", "python",
     "change row_height and column_width in libreoffice calc use python tagint"),
    ("What is the standard way to add N seconds to datetime.time in Python?", "query", "python",
     "what is the standard way to add n seconds to datetime time in python"),
    ("Convert INT to VARCHAR SQL 11?", "query", "python", "convert int to varchar sql tagint"),
    ("python construct a dictionary {0: [0, 0, 0], 1: [0, 0, 1], 2: [0, 0, 2], 3: [0, 0, 3], ...,999: [9, 9, 9]}",
     "query", "python", "python construct a dictionary" + " tagint" * 20),
    ("How to calculateAnd the value of the sum of squares defined as \n 1^2 + 2^2 + 3^2 + ... +n2 until a user "
     "specified sum has been reached sql()", "context", "python",
     "how to calculate_and the value of the sum of squares defined as tagint ^ tagint + tagint ^ tagint + tagint ^ "
     "tagint + . . . + n tagint until a user specified sum has been reached sql ( )"),
    ("how do i display records (containing specific) information in sql() 11?", "context", "python",
     "how do i display records information in sql ( ) tagint ?"),
    ("Convert INT to VARCHAR SQL 11?", "context", "python", "convert int to varchar sql tagint ?"),
    ('MySQL Administrator Backups: "Compatibility Mode", What Exactly is this doing?', "query", "sql",
     "my_sql administrator backups tagstr what exactly is this doing"),
    ("-10000", "context", "python", "-10000"),
    ("-10000", "context", "sql", "-10000"),
]


def test_drop_blank_and_parens(spark):
    df = spark.createDataFrame([(["a", "", " ", "(b", "c)", "()", "d"],)], "t array<string>")
    r = df.select(text.drop_blank("t").alias("x"), text.drop_parens("t").alias("y")).first()
    assert r["x"] == ["a", "(b", "c)", "()", "d"]
    assert r["y"] == ["a", "", " ", "d"]


def test_trailing_dots_only_at_the_very_end(spark):
    assert _one(spark, "abc.\n", text.strip_dots) == "abc.\n"
    assert _one(spark, "abc..", text.strip_dots) == "abc"
    # SQL line rule: newline -> space, trim, brackets removed, then trailing dots; "abc. " keeps its dot.
    assert _one(spark, "abc.\n(x)", lambda c: text.query_tokens(c, "sql")) == ["abc"]  # strict filter drops "."
    assert _one(spark, "abc.\n(x)", lambda c: text.context_tokens(c, "sql")) == ["abc", "."]
    assert _one(spark, "abc.", lambda c: text.context_tokens(c, "sql")) == ["abc"]


def test_natural_language_goldens(spark):
    for value, kind, dialect, expected in NL:
        fn = text.query_tokens if kind == "query" else text.context_tokens
        got = _one(spark, value, lambda c: fn(c, dialect))
        assert " ".join(got) == expected, (value, kind, dialect)


PY = [
    ("root -> 0.0 \n while root_ * root < n: \n root = root + 1 \n print(root * root)",
     "root _ > number . number while root_ * root < n root = root + number print ( root * root ) newline"),
    ("root = 0.0 \n while root * root < n: \n print(root * root) \n root = root + 1",
     "var = number . number while var * var < n print ( var * var ) var = var + number newline"),
    ("n = 1 \n while n <= 100: \n n = n + 1 \n if n > 10: \n  break print(n)",
     "var = number while var < = number var = var + number if var > number break print ( var ) newline"),
    ("d = {'x': 1, 'y': 2, 'z': 3} \n for key in d: \n  print (key, 'corresponds to', d[key])",
     "var = { string number , string number , string number } for var in var print ( var , string , var [ var ] ) newline"),
    ("  #       page  hour  count\n # 0     3727441     1   2003\n # 1     3727441     2    654\n", ""),
    ("", ""),
]


def test_python_code_goldens(spark):
    for value, expected in PY:
        assert " ".join(_one(spark, value, pycode.python_code_tokens)) == expected, value


SQL = [
    (">UPDATE Table1 \n SET Table1.col1 = Table2.col1 \n Table1.col2 = Table2.col2 FROM \n Table2 WHERE \n "
     "Table1.id =  Table2.id",
     "> update col0 set tab0 . col1 = tab1 . col1 tab0 . col2 = tab1 . col2 from tab1 where tab0 . col3 = tab1 . col3"),
    ("SELECT\n@supplyFee:= 0\n@demandFee := 0\n@charedFee := 0\n", "select col0 = codint col1 = codint col2 = codint"),
    ("@prev_sn := SerialNumber,\n@prev_toner := Remain_Toner_Black\n", "col0 = col1 , col2 = col3"),
    ("", "-1000"),
    ("select a from t where b like 'x*y+[a-z]?' and c = 0x1F and d = 1e5 and e = 2.5",
     "select col0 from tab0 where col1 like refre regast refre regplu refre [ a _ z ] refre regque refre "
     "and col2 = codhex and col3 = codflo and col4 = number"),
]


def test_sql_code_goldens(spark):
    for value, expected in SQL:
        assert " ".join(_one(spark, value, sqlcode.sql_code_tokens)) == expected, value
    assert _one(spark, "", sqlcode.sql_code_ok) is False
    assert _one(spark, "select 1", sqlcode.sql_code_ok) is True


REPL = [
    (1, "x = 1", "none", "x = 1", ["x = 1"]),
    # Zero-flag lines after the first prompt are output lines and leave the repaired code.
    (2, "intro\n>>> a = 1\n... b\nout\n>>> c", "typical", "intro\na = 1\nb\nc\n", ["intro", "a = 1\nb", "out", "c"]),
    (3, "Out[1]: 3\nmore\nIn [2]: b\nlast", "atypical", "3\nb\nlast\n", ["3", "more", "b"]),
    (4, "\n>>> a\nres", "typical", "\na\n", ["", "a", "res"]),
]


def test_repl_goldens(spark):
    df = spark.createDataFrame([(i, c) for i, c, *_ in REPL], "id int, code string")
    flags = {r["id"]: r["f"] for r in df.select("id", repl.repl_flags("code").alias("f")).collect()}
    assert flags[2] == "04504" and flags[3] == "2010"
    repaired = {r["id"]: (r["layout"], r["repaired"]) for r in repl.repl_repair(df).collect()}
    blocks = {}
    for r in repl.repl_blocks(df).orderBy("id", "block_no").collect():
        blocks.setdefault(r["id"], []).append(r["block"])
    for i, _, layout, fixed, blist in REPL:
        assert repaired[i] == (layout, fixed), i
        assert blocks[i] == blist, i


def test_encoding_goldens(spark):
    d = spark.createDataFrame([(0, "PAD"), (1, "UNK"), (2, "SOS"), (3, "EOS"), (4, "a"), (5, "b")],
                              "idx int, word string")
    rows = [((str(1), 0), ["a", "zz"], ["zz", "a"], ["a", "b"], []),
            ((str(2), 0), [], [], [], ["a"] * 30),
            ((str(3), 0), [], [], ["a"] * 400, [])]
    df = spark.createDataFrame(rows, "qid struct<question_id:string,cand:int>, ctx1_tokens array<string>, "
                                     "ctx2_tokens array<string>, code_tokens array<string>, query_tokens array<string>")
    out = {r["qid"]["question_id"]: r for r in
           encode.encode_corpus(df, d, lengths={"ctx1": 5, "ctx2": 5, "code": 6, "query": 25}).collect()}
    assert out["1"]["ctx1_ids"] == [4, 1, 0, 0, 0]
    assert out["1"]["ctx2_ids"] == [0, 1, 4, 0, 0]
    assert out["2"]["ctx1_ids"] == [0, 0, 0, 0, 0]
    assert out["1"]["code_ids"] == [1, 4, 5, 2, 0, 0]
    assert out["2"]["code_ids"] == [1, 2, 0, 0, 0, 0]
    assert out["2"]["query_ids"] == [4] * 25
    assert out["1"]["block_length"] == 4 and out["1"]["label"] == 0
    long = encode.encode_corpus(df, d).filter(F.col("qid.question_id") == "3").first()
    assert long["code_ids"] == [1] + [4] * 348 + [2]


def test_split_and_label_goldens(spark):
    df = spark.createDataFrame([((q, i), q) for i, q in enumerate(["q1", "q2", "q2", "q3"])],
                               "qid struct<question_id:string,cand:int>, query string")
    single, multiple = corpus.split_candidates(df)
    assert corpus.split_candidates(df).single.count() == 2
    assert sorted(r["query"] for r in single.collect()) == ["q1", "q3"]
    assert sorted(r["query"] for r in multiple.collect()) == ["q2", "q2"]
    labels = [(r["qid"]["question_id"], r["label"]) for r in corpus.label_singles(single).collect()]
    assert labels == [("q1", 1), ("q3", 1)]


def test_python_variable_heuristics(spark):
    cases = {
        "a = b = 1": (["a"], ["a", "b"]),
        "a = b == c": (["a"], ["a"]),
        "a , b = c = d = 5 print ( a )": (["a", "b"], ["a", "b", "c", "d"]),
        "print ( a = 1 )": ([], []),
        "for x in y print ( x ) for z in w": (["x"], ["x", "z"]),
    }
    for code, (default, everything) in cases.items():
        assert _one(spark, code, lambda c: pycode.python_vars(pycode.python_clean(c))) == default, code
        assert _one(spark, code, lambda c: pycode.python_vars(pycode.python_clean(c), True)) == everything, code


def test_sql_keywords_are_a_parameter(spark):
    code = "select total from sales"
    assert _one(spark, code, sqlcode.sql_code_tokens) == ["select", "col0", "from", "tab0"]
    custom = sorted(set(sqlcode.SQL_KEYWORDS) | {"total"})
    assert _one(spark, code, lambda c: sqlcode.sql_code_tokens(c, keywords=custom)) == ["select", "total", "from", "tab0"]
