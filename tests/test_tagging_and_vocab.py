"""Class sequences against plain dynamic programming, filtered new words and digest comparison against the plain forms."""

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import tagging, vocab

from conftest import SF_SMALL

CLASSES = ["a", "n", "v"]


def tables(spark, rng):
    emissions = [(w, c, rng.randrange(-9, 0)) for w in "pqrst" for c in CLASSES if rng.random() < 0.7] + [("p", "n", -20), ("q", "zz", 5), (None, "a", 1)]
    transitions = [(p, c, rng.randrange(-5, 0)) for p in [None, *CLASSES] for c in CLASSES if rng.random() < 0.8] + [(None, "v", -1), ("n", "v", -1), ("a", "n", -1)]
    transitions = list({(p, c): (p, c, s) for p, c, s in transitions}.values())
    return (emissions, transitions, spark.createDataFrame(emissions, "token string, class string, score long"),
            spark.createDataFrame(transitions, "previous string, class string, score long"))


def best(tokens, emissions, transitions, missing):
    own = {}
    for w, c, s in emissions:
        if c in CLASSES and w is not None:
            own.setdefault(w, {})[c] = max(s, own.get(w, {}).get(c, s))
    step = {(p, c): s for p, c, s in transitions}
    choices = [own.get(w, {c: 0 for c in CLASSES}) for w in tokens]
    sums = {}
    for path in product(*map(sorted, choices)):
        sums[path] = sum(e[c] for e, c in zip(choices, path)) + sum(step.get(x, missing) for x in zip((None, *path), path))
    return max(sums.values()), sums


def test_classes_have_the_best_sum(spark):
    rng = random.Random(2)
    emissions, transitions, e, t = tables(spark, rng)
    rows = [(i % 30, [rng.choice("pqrstxy") for _ in range(rng.randrange(0, 7))]) for i in range(60)] + [(99, None), (99, ["p", None])]
    df = spark.createDataFrame(rows, "id int, t array<string>")
    got = tagging.tag_tokens(df, "id", "t", e, t, missing=-50).collect()
    assert len(got) == len(rows)
    for r in got:
        top, sums = best(r["t"], emissions, transitions, -50)
        assert len(r["classes"]) == len(r["t"]) and sums[tuple(r["classes"])] == top


def test_base_forms_by_class_and_long_records(spark):
    e = spark.createDataFrame([("saw", "n", -2), ("saw", "v", -1), ("the", "a", 0), ("we", "a", 0)], "token string, class string, score long")
    t = spark.createDataFrame([(None, "a", 0), ("a", "n", 0), ("a", "v", -3), ("n", "v", 0), ("n", "a", 0), ("v", "a", 0)], "previous string, class string, score long")
    lemmas = spark.createDataFrame([("saw", "v", "see"), ("we", None, "I"), ("the", "n", "wrong")], "token string, class string, lemma string")
    df = spark.createDataFrame([(1, ["the", "saw"]), (2, ["the", "saw", "saw", "we"]), (3, [])], "id int, t array<string>")
    got = {r["id"]: (r["t"], "".join(r["classes"])) for r in tagging.lemma_pos_join(df, "id", "t", e, t, lemmas).collect()}
    assert got == {1: (["the", "saw"], "an"), 2: (["the", "saw", "see", "I"], "anva"), 3: ([], "")}
    salted = {r["id"]: (r["t"], "".join(r["classes"])) for r in tagging.lemma_pos_join(df, "id", "t", e, t, lemmas, limit_bytes=0).collect()}
    assert salted == got
    long = spark.createDataFrame([(1, ["the", "saw"] * 2000)], "id int, t array<string>")
    assert "".join(tagging.tag_tokens(long, "id", "t", e, t).first()["classes"]) == "an" * 2000
    plan = tagging.tag_tokens(df, "id", "t", e, t)
    plan.write.format("noop").mode("overwrite").save()
    final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    records = final[final.index("ObjectHashAggregate") if "ObjectHashAggregate" in final else 0:]
    assert records.index("Generate") < records.index("REPARTITION_BY_COL")


def test_tables_without_or_with_too_many_classes(spark):
    df = spark.createDataFrame([(1, ["a"])], "id int, t array<string>")
    e = spark.createDataFrame([], "token string, class string, score long")
    with pytest.raises(ValueError):
        tagging.tag_tokens(df, "id", "t", e, spark.createDataFrame([], "previous string, class string, score long"))
    many = spark.range(70).select(F.lit(None).cast("string").alias("previous"), F.col("id").cast("string").alias("class"), F.col("id").alias("score"))
    with pytest.raises(ValueError):
        tagging.tag_tokens(df, "id", "t", e, many)


def test_prefiltered_new_words(spark):
    corpus = spark.createDataFrame([([f"w{i}" for i in range(200)] + [None, "w1"],)], "t array<string>")
    old = spark.range(50_000).select(F.concat(F.lit("w"), (F.col("id") * 2).cast("string")).alias("word")).unionByName(spark.createDataFrame([(None,), ("w2",)], "word string"))
    want = sorted(r["word"] for r in vocab.new_words(corpus, old, ["t"]).collect())
    assert sorted(r["word"] for r in vocab.new_words(corpus, old, ["t"], prefilter=True).collect()) == want == sorted(f"w{i}" for i in range(1, 200, 2))
    left = vocab.likely_in(old, vocab.build_vocab(corpus, fields=["t"]))
    assert 100 <= left.count() < 300  # of 50,002 old words the shuffle has these


def test_digest_diff_equals_plain_diff(spark):
    rows = [(i % 400, random.Random(i).choice([None, "a", "b"]), i / 3) for i in range(500)]
    before = spark.createDataFrame(rows, "id int, s string, x double")
    after = spark.createDataFrame([r for i, r in enumerate(rows) if i % 50] + rows[7:9] + [(None, "a", None), (None, None, None)], before.schema)
    for buckets in (1, 64, 1 << 16):
        got = vocab.roundtrip_diff_by_digest(before, after, buckets)
        assert sorted(map(str, got.collect())) == sorted(map(str, vocab.roundtrip_diff(before, after).collect()))
    assert vocab.roundtrip_diff_by_digest(before, before.orderBy("x")).collect() == []
    assert vocab.roundtrip_diff_by_digest(before.limit(0), before).count() == 500
    swapped = spark.createDataFrame([("a", None)], "s string, t string"), spark.createDataFrame([(None, "a")], "s string, t string")
    assert vocab.roundtrip_diff_by_digest(*swapped).count() == 2
