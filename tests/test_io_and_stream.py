"""Write-then-read round trips (S1-S9), word2vec text reading (S4) and the streaming forms."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusprep.operators import corpus, vectors
from corpusprep.operators.tokenise import tokenise_corpus
from corpusprep.plans import derive
from corpusprep.sources import io
from corpusprep.streaming import stream

from conftest import SF_SMALL


def _fresh():
    return tempfile.mkdtemp(prefix="corpusprep-test-")


def test_corpus_split_tokens_roundtrip(spark):
    root = _fresh()
    raw = derive.raw_corpus(spark, SF_SMALL)
    raw.write.parquet(f"{root}/raw")
    back = io.read_corpus(spark, f"{root}/raw")
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0

    corpus.nest_record(raw).write.json(f"{root}/nested")
    flat = io.read_corpus(spark, f"{root}/nested", fmt="json", nested=True)
    assert flat.count() == raw.count()

    io.write_split(corpus.candidate_kind(raw), f"{root}/split")
    single, multiple = corpus.split_candidates(raw)
    assert io.read_split(spark, f"{root}/split", "single").select(*single.columns).exceptAll(single).count() == 0
    assert io.read_split(spark, f"{root}/split", "multiple").count() == multiple.count()

    tokens = tokenise_corpus(raw)
    io.write_tokens(tokens, f"{root}/tokens")
    again = io.read_tokens(spark, f"{root}/tokens").select(*tokens.columns)
    assert again.exceptAll(tokens).count() == 0 and tokens.exceptAll(again).count() == 0

    io.write_labels(corpus.label_singles(single), f"{root}/labels", fmt="csv")
    assert spark.read.option("header", True).csv(f"{root}/labels").count() == single.count()


def test_word2vec_text_reader(spark):
    root = _fresh()
    rng = np.random.default_rng(3)
    words = ["alpha", "beta", "gamma"]
    vecs = rng.normal(size=(3, 5)).astype(np.float32)
    path = os.path.join(root, "vectors.txt")
    with open(path, "w") as f:
        f.write("3 5\n")
        for w, v in zip(words, vecs):
            f.write(w + " " + " ".join(repr(float(x)) for x in v) + " \n")
    got = {r["word"]: r["vec"] for r in io.read_word_vectors(spark, path, dim=5).collect()}
    assert sorted(got) == words
    for w, v in zip(words, vecs):
        assert np.allclose(got[w], v)
    assert io.read_word_vectors(spark, path).count() == 3

    io.write_word_vectors_text(io.read_word_vectors(spark, path), f"{root}/text_out")
    again = {r["word"]: r["vec"] for r in io.read_word_vectors(spark, f"{root}/text_out", dim=5).collect()}
    assert again == got

    unit = vectors.unit_vectors(io.read_word_vectors(spark, path))
    io.write_vectors(unit, f"{root}/unit")
    norms = [float(np.linalg.norm(r["vec"])) for r in io.read_vectors(spark, f"{root}/unit").collect()]
    assert np.allclose(norms, 1.0, atol=1e-6)


def test_dictionary_roundtrip_and_specials(spark):
    root = _fresh()
    specials = vectors.special_vectors(spark, 8, seed=11).collect()
    again = vectors.special_vectors(spark, 8, seed=11).collect()
    assert [r["word"] for r in specials] == ["PAD", "UNK", "SOS", "EOS"]
    assert specials == again
    assert specials[0]["vec"] == [0.0] * 8
    assert all(-0.25 <= x <= 0.25 for r in specials[1:] for x in r["vec"])

    vocab = spark.createDataFrame([(w,) for w in ["b", "a", "c", "d"]], "word string")
    vecs = spark.createDataFrame([(w, [float(i)] * 8) for i, w in enumerate(["a", "b", "c"])],
                                 "word string, vec array<float>")
    d = vectors.build_dictionary(vocab, vecs, seed=11)
    io.write_dictionary(d, f"{root}/dict")
    back = {r["word"]: r["idx"] for r in io.read_dictionary(spark, f"{root}/dict").collect()}
    assert back == {"PAD": 0, "UNK": 1, "SOS": 2, "EOS": 3, "a": 4, "b": 5, "c": 6}
    assert vectors.failed_words(vocab, vecs).collect()[0]["word"] == "d"
    assert vectors.verify_dictionary(d, vecs).first().asDict() == {"checked": 3, "mismatched": 0}
    bad = vecs.withColumn("vec", F.transform("vec", lambda x: x + 1))
    assert vectors.verify_dictionary(d, bad).first()["mismatched"] == 3

    more = spark.createDataFrame([(w,) for w in ["a", "e", "f", "zz"]], "word string")
    mvecs = vecs.unionByName(spark.createDataFrame([(w, [1.0] * 8) for w in ["e", "f"]], "word string, vec array<float>"))
    ext = {r["word"]: r["idx"] for r in vectors.append_dictionary(d, more, mvecs).collect()}
    assert ext["a"] == 4 and ext["e"] == 7 and ext["f"] == 8 and "zz" not in ext


def test_streaming_tokenise_and_encode_match_batch(spark):
    root = _fresh()
    raw = derive.raw_corpus(spark, SF_SMALL)
    raw.repartition(3).write.parquet(f"{root}/in")
    q = stream.tokenise_stream(stream.read_corpus_stream(spark, f"{root}/in", 1), f"{root}/tokens",
                               f"{root}/ck1", available_now=True)
    q.awaitTermination(300)
    streamed = io.read_tokens(spark, f"{root}/tokens")
    batch = tokenise_corpus(raw)
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0
    assert streamed.count() == batch.count()

    d = spark.createDataFrame([(0, "PAD"), (1, "UNK"), (2, "SOS"), (3, "EOS"), (4, "var"), (5, "print")],
                              "idx int, word string")
    tok_stream = spark.readStream.schema(io.TOKEN_SCHEMA).parquet(f"{root}/tokens")
    q2 = stream.encode_stream(tok_stream, d, f"{root}/encoded", f"{root}/ck2", available_now=True)
    q2.awaitTermination(300)
    from corpusprep.operators.encode import encode_corpus
    enc = io.read_encoded(spark, f"{root}/encoded").drop("batch_id")
    assert enc.exceptAll(encode_corpus(batch, d)).count() == 0
    assert enc.count() == batch.count()


def test_convert_vectors_and_dictionary_job(spark):
    from corpusprep.plans import stages

    root = _fresh()
    path = os.path.join(root, "v.txt")
    with open(path, "w") as f:
        f.write("2 3\nx 3 0 4\ny 0 0 0\n")
    out = {r["word"]: r["vec"] for r in stages.convert_vectors(spark, path, f"{root}/unit", 3).collect()}
    assert np.allclose(out["x"], [0.6, 0.0, 0.8]) and out["y"] == [0.0, 0.0, 0.0]
    vocab = spark.createDataFrame([("x",), ("q",)], "word string")
    job = stages.dictionary_job(vocab, io.read_vectors(spark, f"{root}/unit"))
    assert {r["word"]: r["idx"] for r in job["dictionary"].collect()}["x"] == 4
    assert [r["word"] for r in job["failed"].collect()] == ["q"]
    assert job["check"].first()["mismatched"] == 0


def test_end_to_end_stages_written_and_consistent(spark):
    from corpusprep.plans import stages

    root = _fresh()
    raw = derive.raw_corpus(spark, SF_SMALL)
    embeddings = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    out = stages.encode_raw_corpus(raw, lambda words: derive.word_vectors(words, embeddings))
    io.write_split(corpus.candidate_kind(raw), f"{root}/split")
    io.write_tokens(out["tokens"], f"{root}/tokens")
    io.write_vocab(out["vocab"], f"{root}/vocab")
    io.write_dictionary(out["dictionary"], f"{root}/dictionary")
    io.write_encoded(out["encoded"], f"{root}/encoded")
    io.write_labels(corpus.label_singles(out["single"]), f"{root}/labels")

    tokens = io.read_tokens(spark, f"{root}/tokens")
    vocab_n = io.read_vocab(spark, f"{root}/vocab").count()
    dictionary = io.read_dictionary(spark, f"{root}/dictionary")
    ids = sorted(r["idx"] for r in dictionary.select("idx").collect())
    assert ids == list(range(len(ids)))                       # contiguous, specials first
    assert vocab_n == (len(ids) - 4) + out["failed"].count()  # every word is found or failed
    enc = io.read_encoded(spark, f"{root}/encoded")
    assert enc.count() == tokens.count() == raw.count()
    assert enc.filter(F.exists("code_ids", lambda x: x >= len(ids))).count() == 0
    assert spark.read.parquet(f"{root}/labels").count() == io.read_split(spark, f"{root}/split", "single").count()


def test_broken_lines_come_back_as_rows(spark, tmp_path):
    path = str(tmp_path / "lines.json")
    good = '{"qid": {"question_id": "1", "cand": 2}, "query": "q"}'
    bad = ['{"qid": {"question_id"', "[1]", "null", "word", '{"qid": {"question_id": "1", "cand": "x"}}', '{"query": "q"}', '{"qid": null}', good + good[:5], good + good, good + ", " + good]
    with open(path, "w") as f:
        f.write("\n".join([good, "", *bad, "   ", good]) + "\n")
    rows, rejects = io.read_corpus_checked(spark, path)
    assert [(r["qid"]["question_id"], r["query"], r["lang"]) for r in rows.collect()] == [("1", "q", None)] * 2
    assert sorted(r["line"] for r in rejects.collect() if r["reason"]) == sorted(bad)
    with pytest.raises(Exception, match="(?i)malformed"):
        io.read_corpus(spark, path, fmt="json").collect()
    nested = '{"qid": {"question_id": "1", "cand": 0}, "ctx": [["a"], ["b"]], "code": [["c"]], "query": ["q"]}'
    found = io.parse_records(spark.createDataFrame([(nested,), ("{",)], "value string"), nested=True)
    assert [tuple(r)[1:] for r in found.rows.collect()] == [("a", "b", "c", "q")] and found.rejects.count() == 1


def test_malformed_vector_lines_come_back_as_rows(spark, tmp_path):
    path = str(tmp_path / "vectors.txt")
    with open(path, "w") as f:
        f.write("3 2\na 1 2\nb 1\nc d 1 2\ne x 2\n\n")
    rows, rejects = io.read_word_vectors_checked(spark, path)
    assert sorted(r["word"] for r in rows.collect()) == ["a", "c d"] and sorted(r["line"] for r in rejects.collect()) == ["b 1", "e x 2"]


def test_a_written_run_reports_without_a_pass(spark, tmp_path):
    from conftest import SF_SMALL
    from corpusprep.plans import stages

    raw = derive.raw_corpus(spark, SF_SMALL)
    pairs = lambda words: derive.word_vectors(words, spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    report = stages.write_run(raw, pairs, str(tmp_path / "run"))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.startswith("LocalTableScan") or "Scan ExistingRDD" in plan and "FileScan" not in plan
    got = {r["metric"]: r["value"] for r in report.collect()}
    want = {r["metric"]: r["value"] for r in stages.corpus_report(stages.encode_raw_corpus(raw, pairs)).collect()}
    assert got == want
    assert io.read_encoded(spark, str(tmp_path / "run" / "encoded")).count() == got["encoded"] == raw.count()
    assert io.read_dictionary(spark, str(tmp_path / "run" / "dictionary")).count() == got["dictionary"]
