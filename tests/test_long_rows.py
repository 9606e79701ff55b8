"""Rows far longer than any fixture: no pattern may recurse, no record may be lost or merged."""

import pytest
from pyspark.sql import functions as F

from corpusprep.functions import pycode, sqlcode, text
from corpusprep.operators import encode, lemma, repl, vectors
from corpusprep.operators.tokenise import tokenise_corpus, unknown_languages
from corpusprep.sources import io

N = 20_000


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").repartition(2).select(expr.alias("o")).first()["o"]


def test_twenty_thousand_names(spark):
    names = ", ".join(f"n{i}" for i in range(N))
    assert one(spark, names, F.size(pycode.assign_targets(pycode.python_clean("v")))) == 0
    assert one(spark, names + " = f ( )", F.size(pycode.assign_targets(pycode.python_clean("v")))) == N
    assert one(spark, names, F.size(pycode.python_code_tokens("v"))) > N


def test_long_chains_and_for_lists(spark):
    chain = " = ".join(f"n{i}" for i in range(N)) + " = 1"
    assert one(spark, chain, F.size(pycode.assign_targets(pycode.python_clean("v"), True))) == N
    loop = "for a " + " ".join(f",b{i}" for i in range(3)) + " in x : pass"
    assert one(spark, loop, F.array_join(pycode.for_targets("v"), " ")) == ""
    wide = "for a" + "".join(f",b{i}" for i in range(N)) + " in x"
    assert one(spark, wide, F.size(pycode.for_targets("v"))) == N + 1


@pytest.mark.parametrize("line,names", [
    ("a = b = 1", ["a", "b"]), ("a = b == c", ["a"]), ("a == b", []), ("a , b = c , d = e", ["a", "b", "c", "d"]),
    ("a = ", ["a"]), ("a = b = = c", ["a"]), ("a = = b", []), ("x . y = 1", [])])
def test_chained_targets(spark, line, names):
    assert one(spark, line, pycode.assign_targets("v", True)) == names


def test_twenty_thousand_part_number(spark):
    dotted = ".".join(["23"] * N)
    assert one(spark, dotted, text.tag_decimals("v")) == "TAGINT"
    assert one(spark, f"SELECT {dotted} FROM t", sqlcode.sql_clean("v")) == "SELECT number FROM t"
    assert one(spark, f"SELECT {dotted} FROM t", F.size(sqlcode.sql_code_tokens("v"))) == 4


@pytest.mark.parametrize("rule", ["query", "context", "python", "sql"])
def test_other_repeated_groups(spark, rule):
    fn = {"query": text.query_tokens, "context": lambda c: text.context_tokens(c, "sql"),
          "python": pycode.python_code_tokens, "sql": sqlcode.sql_code_tokens}[rule]
    for unit in ("(a)", "aB", "x_y-", "'q' ", '"s" ', "a.b ", "it's ", "12a ", "0x1f ", "[t] ", "--", "__"):
        assert one(spark, unit * N, F.size(fn("v"))) >= 0  # it ends


def test_records_with_one_key_stay_apart(spark):
    records = spark.createDataFrame([("k", ["a", "b"]), ("k", ["c"]), ("k", None)], "qid string, t array<string>")
    dictionary = spark.createDataFrame([(4, "a"), (5, "b"), (6, "c")], "idx int, word string")
    assert sorted(r["ids"] for r in encode.encode_tokens(records, "qid", "t", dictionary).collect()) == [[], [4, 5], [6]]
    lemmas = spark.createDataFrame([("c", "d")], "token string, lemma string")
    assert sorted(r["t"] for r in lemma.lemma_join(records.filter("t IS NOT NULL"), lemmas, "qid", "t").collect()) == [["a", "b"], ["d"]]
    fields = spark.createDataFrame([("k", ["a"], [], ["b"], ["c"])] * 2, "qid string, ctx1_tokens array<string>, "
                                   "ctx2_tokens array<string>, code_tokens array<string>, query_tokens array<string>")
    assert encode.encode_corpus(fields, dictionary).count() == 2
    code = spark.createDataFrame([("k", "a\nb"), ("k", ">>> c\nd")], "id string, code string")
    assert sorted(r["repaired"] for r in repl.repl_repair(code).collect()) == ["a\nb", "c\n"]


def test_unknown_languages_are_not_dropped(spark):
    raw = spark.createDataFrame([(1, "python", "", "", "a = 1", "q"), (2, "java", "", "", "x", "q"), (3, None, "", "", "x", "q")],
                                "qid int, lang string, ctx1 string, ctx2 string, code string, query string")
    assert {(r["lang"], r["records"]) for r in unknown_languages(raw).collect()} == {("java", 1), (None, 1)}
    assert tokenise_corpus(raw, unknown="skip").count() == 1
    with pytest.raises(Exception, match="no rule set for language"):
        tokenise_corpus(raw).collect()


def test_vector_lines_are_parsed_or_rejected(spark):
    lines = spark.createDataFrame([(x,) for x in ("4 2", "a 1 2", "new york 3 4", "short 1", "b 0.1 oops", "", "3 4")], "value string")
    good, rejects = io.parse_word_vectors(lines, 2)
    assert {(r["word"], tuple(r["vec"])) for r in good.collect()} == {("a", (1.0, 2.0)), ("new york", (3.0, 4.0))}
    assert {r["line"] for r in rejects.collect()} == {"short 1", "b 0.1 oops", "3 4"}


def test_vectors_with_nulls_and_missing_sources(spark):
    vecs = spark.createDataFrame([("a", [3.0, 4.0]), ("b", [1.0, None]), ("z", [0.0, 0.0])], "word string, vec array<float>")
    unit = {r["word"]: r["vec"] for r in vectors.unit_vectors(vecs).collect()}
    assert unit["b"] is None and unit["z"] == [0.0, 0.0] and abs(unit["a"][0] - 0.6) < 1e-6
    stored = spark.createDataFrame([(4, "a", [1.0]), (5, "q", [1.0])], "idx int, word string, vec array<float>")
    source = spark.createDataFrame([("a", [1.0])], "word string, vec array<float>")
    row = vectors.verify_dictionary(stored, source).first()
    assert (row["checked"], row["mismatched"]) == (2, 1)
