"""Plan shape checks and randomized property checks."""

import random
import re
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusprep.functions import sqlcode, text
from corpusprep.operators import corpus, encode, lemma, repl, vectors
from corpusprep.operators.lookup import left_lookup, measured_size
from corpusprep.operators.numbering import dense_number
from corpusprep.operators.tokenise import tokenise_corpus
from corpusprep.plans import derive

from conftest import SF_SMALL


def _executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokenise_plan_has_no_python_and_no_shuffle(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = _executed(docs.select(text.query_tokens("text"), text.context_tokens("text", "sql")))
    assert "Python" not in plan and "Exchange" not in plan
    raw = derive.raw_corpus(spark, SF_SMALL)
    plan = _executed(tokenise_corpus(raw))
    assert "Python" not in plan


def test_scan_prunes_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = docs.select("doc_id", text.query_tokens("text"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_repl_needs_no_shuffle(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit(">>> x = "), F.col("o_custkey").cast("string"),
                                                  F.lit("\nout")).alias("code"))
    for out in (repl.repl_blocks(df), repl.repl_repair(df)):
        plan = _executed(out)
        assert "Exchange" not in plan and "Window" not in plan


def test_lookup_broadcasts_small_dictionary(spark):
    d = spark.createDataFrame([(4, "a"), (5, "b")], "idx int, word string")
    toks = spark.createDataFrame([(1, ["a", "b", "c"])], "id long, t array<string>")
    plan = _executed(encode.encode_tokens(toks, "id", "t", d))
    assert "BroadcastHashJoin" in plan
    plan = _executed(encode.encode_tokens(toks, "id", "t", d, limit_bytes=1))
    assert "BroadcastHashJoin" not in plan or "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


def test_lookup_and_fold_share_a_partitioning(spark):
    """One exchange, of whole records in front of the explode; none between the lookup and the fold."""
    d = spark.createDataFrame([(4, "a"), (5, "b")], "idx int, word string")
    toks = spark.createDataFrame([(1, ["a", "b", "c"]), (2, []), (3, None)], "id long, t array<string>")
    records = spark.createDataFrame([((("q", 1)), ["a"], ["b"], ["c"], ["a", "a"])],
                                    "qid struct<question_id:string,cand:int>, ctx1_tokens array<string>, ctx2_tokens array<string>, code_tokens array<string>, query_tokens array<string>")
    lemmas = spark.createDataFrame([("a", "b")], "token string, lemma string")
    for out in (encode.encode_tokens(toks, "id", "t", d), encode.encode_corpus(records, d), lemma.lemma_join(toks, lemmas, "id", "t")):
        plan = _executed(out)
        final = plan.split("== Initial Plan ==")[0]
        assert len(re.findall(r"Exchange hashpartitioning", final)) == 1 and "Generate" in final
        assert final.index("Generate") < final.index("Exchange hashpartitioning")  # the exchange lies below the explode


def test_lookup_bucket_by_bucket(spark):
    words = spark.createDataFrame([(f"w{i}", i) for i in range(500)], "word string, idx int")
    long = spark.createDataFrame([(i, f"w{i * 7 % 800}") for i in range(900)] + [(901, None)], "id int, token string")
    size = measured_size(words)
    want = sorted(map(tuple, left_lookup(long, words, "token", "word").collect()))
    for limit in (size // 2, size // 3, size // 50, 0):
        got = left_lookup(long, words, "token", "word", limit)
        assert got.columns == ["id", "token", "idx"] and sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    plan = _executed(left_lookup(long, words, "token", "word", size // 3))
    assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") >= 3


def test_measured_size_counts_arrays_and_refuses_the_unknown(spark):
    arrays = spark.createDataFrame([("a", [1.0] * 100)], "word string, vec array<float>")
    assert measured_size(arrays) > 800
    with pytest.raises(TypeError):
        measured_size(spark.createDataFrame([({"a": 1},)], "m map<string,int>"))


def test_dense_number_is_contiguous_across_partitions(spark):
    words = [f"w{random.Random(5).random():.6f}{i}" for i in range(3000)]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = dense_number(df, "word", start=10, partitions=7).orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(10, 10 + len(words)))
    assert [r["word"] for r in got] == sorted(words)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "zz", "yy"]), max_size=400), min_size=1, max_size=12))
def test_encoded_lengths_and_id_range(spark, fields):
    d = spark.createDataFrame([(0, "PAD"), (1, "UNK"), (2, "SOS"), (3, "EOS"), (4, "a"), (5, "b"), (6, "c")],
                              "idx int, word string")
    rows = [((str(i), 0), f, f[::-1], f, f[:30]) for i, f in enumerate(fields)]
    df = spark.createDataFrame(rows, "qid struct<question_id:string,cand:int>, ctx1_tokens array<string>, "
                                     "ctx2_tokens array<string>, code_tokens array<string>, "
                                     "query_tokens array<string>")
    out = encode.encode_corpus(df, d).collect()
    assert len(out) == len(fields)
    for r in out:
        assert (len(r["ctx1_ids"]), len(r["ctx2_ids"]), len(r["code_ids"]), len(r["query_ids"])) == (100, 100, 350, 25)
        for col in ("ctx1_ids", "ctx2_ids", "code_ids", "query_ids"):
            assert all(0 <= x <= 6 for x in r[col])
        assert r["code_ids"][0] == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from(["q1", "q2", "q3", "q4", "q5"]), min_size=1, max_size=40))
def test_split_is_a_partition(spark, qids):
    df = spark.createDataFrame([((q, i), i) for i, q in enumerate(qids)],
                               "qid struct<question_id:string,cand:int>, n int")
    single, multiple = corpus.split_candidates(df)
    s = sorted(r["n"] for r in single.collect())
    m = sorted(r["n"] for r in multiple.collect())
    assert sorted(s + m) == list(range(len(qids)))
    counts = {q: qids.count(q) for q in qids}
    assert s == [i for i, q in enumerate(qids) if counts[q] == 1]


ALPHABET = string.ascii_letters + string.digits + " \t\n.,;:'\"()[]{}#@!?-_=+*/\\|^%$" + "éü"


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=200), min_size=1, max_size=20))
def test_tokens_never_blank(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    cols = [text.query_tokens("t", "python"), text.query_tokens("t", "sql"), text.context_tokens("t", "python"),
            text.context_tokens("t", "sql")]
    from corpusprep.functions.pycode import python_code_tokens
    cols += [python_code_tokens("t"), sqlcode.sql_code_tokens("t")]
    for r in df.select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect():
        for arr in r:
            assert all(tok.strip() != "" for tok in arr)
            assert all(" " not in tok for tok in arr)


NAMES = ["alpha", "beta", "gamma", "delta", "eps"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(NAMES + ["from", "where", ",", "=", ".", "1"]), min_size=1, max_size=30),
                min_size=1, max_size=10))
def test_sql_renaming_is_injective_per_kind(spark, statements):
    codes = ["select " + " ".join(s) for s in statements]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    rows = df.select(sqlcode.sql_kinds(sqlcode.sql_sanitise(sqlcode.sql_clean("code"))).alias("k"),
                     sqlcode.sql_code_tokens("code").alias("t")).collect()
    for r in rows:
        renamed = [x for x in r["t"] if re.fullmatch(r"(col|tab)\d+", x)]
        named = [x["tok"] for x in r["k"] if x["kind"] in ("COLUMN", "TABLE")]
        kinds = [x["kind"] for x in r["k"] if x["kind"] in ("COLUMN", "TABLE")]
        assert len(renamed) == len(named)
        mapping = {}
        for name, kind, new in zip(named, kinds, renamed):
            assert new.startswith("col" if kind == "COLUMN" else "tab")
            assert mapping.setdefault((kind, name), new) == new
        assert len(set(mapping.values())) == len(mapping)


def test_appended_dictionary_keeps_old_prefix(spark):
    old = vectors.special_vectors(spark, 4, 1).unionByName(
        spark.createDataFrame([(4, "b", [1.0] * 4), (5, "d", [2.0] * 4)], "idx int, word string, vec array<float>"))
    vecs = spark.createDataFrame([(w, [0.5] * 4) for w in "abcdef"], "word string, vec array<float>")
    new = spark.createDataFrame([(w,) for w in "fedcba"], "word string")
    ext = {r["word"]: r["idx"] for r in vectors.append_dictionary(old, new, vecs).collect()}
    assert {k: v for k, v in ext.items() if v <= 5} == {"PAD": 0, "UNK": 1, "SOS": 2, "EOS": 3, "b": 4, "d": 5}
    assert [ext[w] for w in "acef"] == [6, 7, 8, 9]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET + "ABCxyz019", max_size=160), min_size=1, max_size=25))
def test_composite_shortcuts_equal_rule_by_rule_chain(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for dialect in ("python", "sql"):
        fast_q = text.query_tokens("t", dialect)
        slow_q = F.filter(text.sentence_words(text.normalize_line(text.filter_strict("t", dialect), dialect)),
                          lambda w: (F.trim(w) != "") & ~w.rlike(r"[()]"))
        fast_c = text.context_tokens("t", dialect)
        slow_c = text.drop_blank(text.sentence_words(text.normalize_line(text.filter_wide("t", dialect), dialect)))
        for r in df.select(fast_q.alias("a"), slow_q.alias("b"), fast_c.alias("c"), slow_c.alias("d"),
                           "t").collect():
            assert r["a"] == r["b"], (dialect, r["t"])
            if r["t"] != "-10000":
                assert r["c"] == r["d"], (dialect, r["t"])


def test_tokens_are_read_in_one_pass(spark):
    rows = ["it's 0x1Fg, \u212aing|\"m \"\" (a|b) HTTPServer a--b", "abc. (x)", "abc.;", "x \"1 (2) 3\" y1.5z", "(^)", "\u00e9t\u00e9 I|\"m", None, ""]
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    for dialect in ("python", "sql"):
        for fn, narrow in ((text.query_tokens, text.filter_strict), (text.context_tokens, text.filter_wide)):
            tokens = df.select("t", fn("t", dialect).alias("a"))
            plan = tokens._jdf.queryExecution().optimizedPlan().toString()
            assert "array_join" not in plan and "split(" not in plan  # not joined, tagged and split again
            rules = text.drop_blank(text.sentence_words(text.normalize_line(narrow("t", dialect), dialect)))
            for r in tokens.withColumn("b", text.drop_parens(rules) if fn is text.query_tokens else rules).collect():
                assert r["a"] == r["b"], (dialect, r["t"])


def test_split_with_a_hot_question_uses_aggregate_and_join(spark):
    # One question holds a third of all records.
    rows = [(("hot", i), i) for i in range(3000)] + [((f"q{i // 2}", i), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "qid struct<question_id:string,cand:int>, n int").repartition(8)
    single, multiple = corpus.split_candidates(df)
    plan = _executed(multiple)
    assert "Window" not in plan and "HashAggregate" in plan
    assert multiple.count() == 9000 and single.count() == 0


def test_vocab_with_a_hot_word_combines_before_the_shuffle(spark):
    from corpusprep.operators.vocab import build_vocab

    df = spark.createDataFrame([(["the"] * 50 + [f"w{i}"],) for i in range(2000)], "t array<string>").repartition(8)
    v = build_vocab(df, fields=["t"])
    plan = _executed(v)
    assert plan.count("HashAggregate") >= 2  # partial (map-side) and final
    assert v.count() == 2001


def test_salted_lookup_matches_broadcast_lookup(spark):
    d = spark.createDataFrame([(4 + i, f"w{i}") for i in range(50)], "idx int, word string")
    # "w0" is a third of all tokens.
    toks = spark.createDataFrame([(i, ["w0"] * 20 + [f"w{(i * 7 + j) % 60}" for j in range(40)]) for i in range(60)],
                                 "id long, t array<string>")
    fast = {r["id"]: r["ids"] for r in encode.encode_tokens(toks, "id", "t", d).collect()}
    salted_df = encode.encode_tokens(toks, "id", "t", d, limit_bytes=1)
    salted = {r["id"]: r["ids"] for r in salted_df.collect()}
    assert fast == salted
    assert "xxhash64" in salted_df._jdf.queryExecution().optimizedPlan().toString()


def test_salted_lemma_join_matches_broadcast(spark):
    from corpusprep.operators import lemma

    lem = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "token string, lemma string")
    toks = spark.createDataFrame([(i, ["cats"] * 10 + ["dogs", "x", "cats"][: i % 4]) for i in range(30)],
                                 "id long, t array<string>")
    a = {r["id"]: r["t"] for r in lemma.lemma_join(toks, lem, "id", "t").collect()}
    b = {r["id"]: r["t"] for r in lemma.lemma_join(toks, lem, "id", "t", limit_bytes=1).collect()}
    assert a == b and a[3] == ["cat"] * 10 + ["dog", "x", "cat"]


def test_salted_split_matches(spark):
    from corpusprep.operators import lookup

    rows = [(("hot", i), i) for i in range(300)] + [((f"q{i}", 0), 1000 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "qid struct<question_id:string,cand:int>, n int")
    counts = corpus.candidate_counts(df).withColumnRenamed("question_id", "_qid")
    salted = lookup.left_lookup(df.withColumn("question_id", F.col("qid.question_id")), counts, "question_id",
                                "_qid", limit_bytes=1, salt_by=["qid"])
    got = sorted((r["n"], r["n_candidates"]) for r in salted.collect())
    assert got == sorted([(i, 300) for i in range(300)] + [(1000 + i, 1) for i in range(50)])
