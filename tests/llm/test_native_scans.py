"""Personal data, licences and chat formatting against plain Python."""

import hashlib
import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from corpusprep.llm import chat_format, license_index, pii_bootstrap, queries

from .fixtures import EDGES, documents, lower

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


VALID = {"email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
         "card": lambda m: 14 <= len(re.sub("[ -]", "", m)) <= 19 and luhn(re.sub("[ -]", "", m)),
         "phone": lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15}
PRIVATE = ["a@b.com_x@y.org z@q a@@b.c a@b..c .@-.- x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3 9.9.9.9é",
           "4111 1111 1111 1111 4111-1111-1111-1111- 5 é🙂+1 (930) 555-2361 +1-2 +49 30 123 456 78 ...9. +1+12345678901",
           "9" * 5_000 + " " + "a" * 3_000 + "@b", "1." * 3_000, "+1" + " " * 3_000]
SECRETS = [f'token = "{hashlib.sha1(str(i).encode()).hexdigest()}"' for i in range(12)] + ['token = "not-hex-but-9secret"']


def test_base_spans_equal_plain_expressions(spark):
    docs = documents(spark, SF_SMALL, EDGES + PRIVATE).withColumns({"base": F.lit(1), "key": F.lit(2), "_key": F.lit(3), "_extra": F.lit(4), "of": F.lit(5), "found": F.lit(6)})
    for r in pii_bootstrap.find_personal_data(docs).collect():
        text = r["text"] or ""
        want = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(PATTERNS.items())
                      for m in re.finditer(p, text) if VALID[k](m.group(0)))
        assert [(s["start"], s["rank"], s["end"], s["kind"]) for s in r["base"]] == want
        assert all(text[s["start"]:s["end"]] == s["value"] for s in r["spans"])
        assert {tuple(s) for s in r["base"]} <= {tuple(s) for s in r["spans"]}


def test_contexts_find_identifiers_without_a_fixed_form(spark):
    docs = spark.createDataFrame(enumerate([f"words before {s} and after" for s in SECRETS] + ["see section 9secret of it"] * 9),
                                 "doc_id long, text string")
    found = {r["doc_id"]: [s["value"] for s in r["spans"]] for r in pii_bootstrap.find_personal_data(docs).collect()}
    assert found[12] == ["not-hex-but-9secret"] and all(len(found[i]) == 1 for i in range(13))
    assert not any(found[i] for i in range(13, 22))
    repeated = pii_bootstrap.find_personal_data(docs.unionByName(docs)).collect()
    assert len(repeated) == 2 * docs.count() and all([s["value"] for s in r["spans"]] == found[r["doc_id"]] for r in repeated)
    assert pii_bootstrap.find_personal_data(docs.limit(0)).collect() == []


def test_licences_equal_plain_search(spark):
    extra = EDGES + ["Under the MIT License, under the-mit license. Apache License, Version 2 cc by nc CC BY-NC", "license " * 5_000,
                     "K cc byİ nc cc by nc Kmit license", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"]
    docs = documents(spark, SF_SMALL, extra).withColumns({"found": F.lit(1), "n_words": F.lit("x"), "_words": F.lit(2), "words": F.lit(3)})
    phrases = {t.label: t.words for t in license_index.TEMPLATES if t.base}
    for r in license_index.scan_licenses(docs).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(r["text"] or ""))
        want = sorted((label, i) for label, p in phrases.items() for i in range(len(words)) if words[i:i + len(p)] == p)
        assert sorted((m["label"], m["start"]) for m in r["found"] if m["base"]) == want
        assert r["n_words"] == len(words) and all(0 <= m["score"] <= 1 for m in r["found"])
        if (r["text"] or "").startswith("Permission"):
            assert [(m["label"], m["score"]) for m in r["found"]] == [("mit", 1.0)]
    assert license_index.scan_licenses(docs.limit(0)).collect() == []


NASTY = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-8, 0, "us%er\n<|x", r"<|im_end|> <\| <\\| [\INST]x<"), (-8, 1, None, None),
         (-9, 0, "assistant", "<\\"), (-9, 0, "assistant", "\\|im_end|>"), (-9, None, "assistant", "é🙂<"), (None, 1, "assistant", "x"),
         (-10, 0, "assistant", "same"), (-10, 0, "assistant", "same")]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame(NASTY, "conv_id long, turn long, role string, text string").withColumns({"r": F.lit(1), "s": F.lit(2)})
    out = chat_format.read_back(chat_format.format_conversations(turns.withColumn("parts", chat_format.text_part(F.col("text")))))
    want = {}
    for c, t, role, text in NASTY:
        want.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    for r in out.collect():
        said = sorted((role, text) for _, role, text in want[r["conv_id"]])
        assert sorted((t["role"], t["text"]) for t in r["turns"]) == said
        assert r["loss_texts"] == [t["text"] for t in r["turns"] if t["role"] == "assistant"]
        assert r["formatted"].count("<|im_end|>") == len(said)
        for text, mask in zip(re.split(r"<\|im_start\|>", r["formatted"])[1:], r["loss_mask"]):
            assert mask is None or text[mask["offset"] + mask["chars"]:] == "<|im_end|>\n"
    assert chat_format.format_conversations(turns.limit(0).withColumn("parts", chat_format.text_part(F.col("text")))).collect() == []


def test_content_parts(spark):
    part = "struct<kind:string,text:string,ref:string,units:int>"
    rows = [(1, 0, "user", [("text", "see <|image|> ", None, None), ("image", None, "a.png", 3), ("audio", None, "b.wav", None), ("other", "t", None, 1)]),
            (1, 1, "assistant", None), (1, 2, "user", [("document", None, "c.pdf", -2), (None, None, None, None)])]
    r = chat_format.format_conversations(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{part}>")).first()
    assert "see <\\|image|> <|image|><|image|><|image|><|audio|>t<|im_end|>" in r["formatted"]
    assert [(a["turn_no"], a["place"], a["kind"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        (0, 1, "image", "a.png", 3), (0, 2, "audio", "b.wav", 1), (2, 0, "document", "c.pdf", 1)]
    assert r["placeholder_tokens"] == 5


def test_native_plans(spark):
    for name in ("op4_license", "op8_chat", "op3_pii"):
        plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_contexts_of_lists_short_and_grouped_identifiers(spark):
    """The context is the text to the left, also behind another identifier; base spans are whole instances."""
    phones = [f"record {i} call\t   desk: +1 (017) 555-77{i:02d} today" for i in range(12)]
    cells = [f"id,key,{hashlib.sha1(str(i).encode()).hexdigest()},x{i},end" for i in range(12)]
    texts = phones + ["my call desk: 7b9 now", "a " * 9 + "word" * 99 + " call desk: z4"] + cells + ["id,key,n0t,x77,end"]
    docs = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    found = {r["doc_id"]: [(s["kind"], s["value"]) for s in r["spans"]] for r in pii_bootstrap.find_personal_data(docs).collect()}
    assert all(found[i] == [("phone", f"+1 (017) 555-77{i:02d}")] for i in range(12))
    assert found[12] == [("phone", "7b9")] and found[13] == [("phone", "z4")]
    assert ("secret", "n0t") in found[26]
    lists = spark.createDataFrame([(0, "first a1 , b22 ; " + "long" * 200 + " c3")], "doc_id long, text string")
    text = F.col("text")
    got = lists.select(F.transform(pii_bootstrap.located(text, pii_bootstrap.CANDIDATE), lambda m: F.struct(
        m["value"].alias("v"), pii_bootstrap.pattern_of(text, m["start"], m["left"]).alias("p"))).alias("c")).first()["c"]
    assert [(c["v"], c["p"]) for c in got] == [("a1", None), ("b22", "first a1 ,"), ("c3", "b22 ; " + "long" * 200)]
