import math
import random
import re
from collections import Counter, defaultdict
from functools import partial

from conftest import SF_SMALL
from pyspark.sql import functions as F

from corpusprep.llm import kneser_ney as kn

from .fixtures import EDGES, WORD, documents

START, END, ORDER = kn.START, kn.END, 5


def reference_model(rows):
    """lang -> function (context, symbol) -> probability: interpolated modified Kneser-Ney with plain dictionaries."""
    top = defaultdict(Counter)
    for lang, text in rows:
        for w in re.findall(WORD, text.lower()):
            w = START * (ORDER - 1) + w + END
            top[lang].update(w[i:i + ORDER] for i in range(len(w) - ORDER + 1))
    models = {}
    for lang, counts in top.items():
        levels = {ORDER: Counter({g: c for g, c in counts.items() if c > 1})}
        for m in range(ORDER - 1, 0, -1):
            levels[m] = Counter(g[1:] for g in levels[m + 1])
        discount = {m: kn.discounts(Counter(min(c, 5) for c in level.values())) for m, level in (levels | {ORDER: counts}).items()}
        total, freed = defaultdict(float), defaultdict(float)
        for m, level in levels.items():
            for g, c in level.items():
                total[g[:-1], m] += c
                freed[g[:-1], m] += discount[m][min(c, 3) - 1]

        def p(context, symbol, own=(levels, discount, total, freed)):
            levels, discount, total, freed = own
            m = len(context) + 1
            below = p(context[1:], symbol, own) if context else 1 / kn.LETTERS
            if not total[context, m]:
                return below
            c = levels[m].get(context + symbol, 0)
            seen = (c - discount[m][min(c, 3) - 1]) / total[context, m] if c else 0.0
            return seen + freed[context, m] / total[context, m] * below
        models[lang] = levels[ORDER] and partial(p, own=(levels, discount, total, freed))
    return models


def reference_score(p, text):
    """0 without words, and for a language none of whose n-grams stands twice."""
    out = []
    if not p:
        return 0.0
    for w in re.findall(WORD, text.lower()):
        w = START * (ORDER - 1) + w + END
        out += [math.log(p(w[i:i + ORDER - 1], w[i + ORDER - 1])) for i in range(len(w) - ORDER + 1)]
    return -sum(out) / len(out) if out else 0.0


def base(text):
    words = re.findall(WORD, text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_counts_and_scores_equal_the_reference(spark):
    docs = documents(spark, SF_SMALL, EDGES + ["a b c a b c\na b c a b c\n \n \nx"]).filter("doc_id < 60")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") == -5, F.lit(None)).otherwise(F.col("lang"))).withColumn("score", F.lit("x")).cache()
    rows = docs.collect()
    models = reference_model([(r["lang"] or "", r["text"] or "") for r in rows])
    texts = {r["doc_id"]: (r["lang"] or "", r["text"] or "") for r in rows}
    got = kn.score_documents(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, text = texts[r["doc_id"]]
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == base(text)
        assert abs(r["score"] - reference_score(models.get(lang), text)) < 1e-4


def test_probabilities_sum_to_one(spark):
    docs = documents(spark, SF_SMALL).filter("doc_id < 30").withColumn("lang", F.lit("x"))
    model = kn.build_models(kn.count_grams(docs.select("lang", "text"), ORDER), ORDER)["x"]
    p = reference_model([("x", r["text"]) for r in docs.collect()])["x"]
    letters = {c for r in docs.collect() for c in r["text"].lower() if not c.isspace()} | {END}
    for context in (START * 4, "then", "zzzz"):
        assert 0.9 < sum(p(context, c) for c in letters) <= 1 + 1e-9
    assert all((h[1:] > h[:-1]).all() for h, _ in model.grams + model.contexts)


def test_bands_reject_what_reads_unlike_the_language(spark):
    good = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("lang = 'en'").select("doc_id", "text", "lang").limit(80)
    letters = random.Random(4)
    noise = " ".join("".join(letters.choices("bcdfgjkpqvwxz", k=8)) for _ in range(80))
    junk = spark.createDataFrame([(-1, noise, "en"), (-2, "q " * 80, "en"), (-3, None, "en")],
                                 "doc_id long, text string, lang string")
    docs = good.unionByName(junk).withColumn("kept", F.lit(1))
    judged = {r["doc_id"]: r for r in kn.judge(docs).collect()}
    assert not judged[-1]["kept"] and not judged[-1]["base_failed"] and judged[-1]["score"] > judged[-1]["upper"]
    assert judged[-2]["base_failed"] and judged[-3]["base_failed"] and not judged[-3]["kept"]
    fine = [r for i, r in judged.items() if i >= 0 and not r["base_failed"]]
    assert sum(r["kept"] for r in fine) >= 0.9 * len(fine)
    kept = kn.keep_good(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in judged.items() if r["kept"]}
    twice = docs.unionByName(docs)
    assert kn.keep_good(twice, broadcast_rows=0).count() == sum(r["kept"] for r in kn.judge(twice).collect())


def test_empty_table_and_pruned_model(spark):
    docs = documents(spark, SF_SMALL)
    assert kn.keep_good(docs.limit(0)).collect() == []
    full, pruned = (kn.score_documents(docs.filter("doc_id < 40"), max_entries=n).count() for n in (10**9, 2_000))
    assert full == pruned


def test_held_out_labels(spark):
    """The verdict separates labelled junk from labelled good documents of the small tables."""
    sf = SF_SMALL.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = kn.judge(docs.select("doc_id", "text", "lang")).join(labels, "doc_id").filter("NOT base_failed").toPandas()
    assert judged[judged.quality == 1].kept.mean() > 0.97
    assert judged[judged.quality == 0].kept.mean() < judged[judged.quality == 1].kept.mean()


def test_scores_do_not_depend_on_the_size_of_the_model(spark):
    """A model too large to broadcast keeps all n-grams, also those of a small language beside a large one."""
    docs = documents(spark, SF_SMALL, EDGES).filter("doc_id < 40").withColumn("lang", F.when(F.col("doc_id") == -5, F.lit(None)).otherwise(F.col("lang")))
    small = [(9_000, "tere maailm tere maailm", "et"), (9_001, "tere", "et"), (9_002, "xyz", "qq"), (None, "tere maa", "et")]
    docs = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(small, "doc_id long, text string, lang string"))
    docs = docs.unionByName(docs.filter("doc_id < 5")).cache()
    broadcast, joined = ([tuple(r) for r in kn.score_documents(docs, max_entries=n).collect()] for n in (10**9, 20))
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert len(broadcast) == len(joined) == docs.count()
    for a, b in zip(sorted(broadcast, key=order), sorted(joined, key=order)):
        assert a[:-1] == b[:-1] and abs(a[-1] - b[-1]) < 1e-4
    assert all(r[-1] > 0 for r in joined if r[0] in (9_000, 9_001, None))
