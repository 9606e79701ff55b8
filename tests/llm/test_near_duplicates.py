import random

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from corpusprep.llm import line_dedup, ngram_jaccard, queries, setjoin

from .fixtures import EDGES, SPACE, documents, jaccard_components

random.seed(5)


def family(n, words=60, edits=2):
    """Near copies of one text, most of them close to few others."""
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        copy = list(base)
        for _ in range(random.randint(0, edits)):
            copy[random.randrange(words)] = f"x{random.randrange(9)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("k,percent,pairs,triples", [(3, 90, 4096, 32768), (3, 90, 2, 5), (5, 80, 3, 8)])
def test_components_equal_brute_force(spark, k, percent, pairs, triples):
    docs = documents(spark, SF_SMALL, EDGES + family(40) + ["shared passage of ten words stands in many texts " + t for t in EDGES[4:9]])
    docs = docs.withColumns({"n": F.lit(1), "node": F.lit("clash"), "component_id": F.lit("clash")}).cache()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in ngram_jaccard.jaccard_components(docs, k, percent, pairs, triples).collect()}
    assert got == jaccard_components([(r["doc_id"], r["text"]) for r in docs.collect()], k, percent)


@pytest.mark.parametrize("percent", [50, 70])
def test_links_of_few_common_tokens(spark, percent):
    """Small sets link below 80 percent, too, whatever the classes of their tokens are."""
    random.seed(percent)
    texts = [" ".join(random.sample("abcdefgh", random.randint(1, 6))) for _ in range(60)] + ["x y z", "x y z w", "x y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for pair_from, triple_from in ((1, 3), (2, 4)):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_jaccard.jaccard_components(docs, 1, percent, pair_from, triple_from).collect()}
        assert got == jaccard_components(list(enumerate(texts)), 1, percent)


def long_texts(n, words=1500, vocabulary=200):
    return [" ".join(f"w{random.randrange(vocabulary)}" for _ in range(words)) for _ in range(n)]


def edited(text, edits):
    words = text.split()
    for i in random.sample(range(len(words)), edits):
        words[i] = f"x{random.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_long_texts_link_as_by_brute_force(spark, k, percent):
    """Sizes on both sides of the one from which sets have neighbours, links of just enough and not enough."""
    random.seed(k)
    large = ngram_jaccard.setjoin.large_from(percent)
    texts = []
    for words in (large * percent // 100 + 5, large - 20, large + k, 3 * large):
        base = long_texts(1, words)[0]
        most = words * (100 - percent) // (100 + percent) // k  # edits that a link bears
        texts += [base, *[edited(base, round(most * share)) for share in (0.2, 0.9, 1.0, 1.1)], base + " " + " ".join(base.split()[::-1][:words // 12])]
        texts += [" ".join(base.split()[:words * percent // 100 + i]) for i in (-2, 2, 6)]
    random.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_jaccard.jaccard_components(docs, k, percent).collect()}
    assert got == jaccard_components(list(enumerate(texts)), k, percent)


def test_similar_large_sets_have_neighbours_in_common():
    rng = np.random.default_rng(3)
    for percent in (60, 80, 90, 97):
        for _ in range(200):
            n = int(rng.integers(200, 3000))
            a = np.unique(rng.integers(-2**63, 2**63 - 1, n))
            part = rng.random()
            lost = int(len(a) * (100 - percent) / (100 + percent) * 2 * part) if part < 0.5 else len(a) * (100 - percent) // 100
            b = rng.permutation(a)[lost:]
            more = max(0, len(b) * 100 // percent - len(a))
            b = np.unique(np.r_[b, rng.integers(-2**63, 2**63 - 1, more)])
            both = len(np.intersect1d(a, b))
            assert 100 * both >= percent * (len(a) + len(b) - both)
            assert len(np.intersect1d(ngram_jaccard.neighbours(a, percent), ngram_jaccard.neighbours(b, percent)))


def test_long_texts_of_chance_matches_are_no_candidates(spark):
    random.seed(8)
    docs = spark.createDataFrame(list(enumerate(long_texts(40, words=3000))), "doc_id long, text string")
    sets = ngram_jaccard._sets(ngram_jaccard._rows(docs, "doc_id", "text"), 3, 90, whole=False).cache()
    index = setjoin.index_signatures(sets, 4096, 32768, 1000, 90)
    apart = index.withColumn("label", F.col("node"))
    assert setjoin.bucket_pairs(apart, 90, "label").count() <= 2


def test_components_of_repeated_rows_null_ids_and_nothing(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(2, text), (2, text), (None, text), (7, text + " more"), (9, None)], "doc_id long, text string")
    rows = ngram_jaccard.jaccard_components(docs, 3, 90).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in rows) == [(0, 2), (2, 2), (2, 2), (7, 2), (9, 9)]
    assert ngram_jaccard.jaccard_components(docs.limit(0)).collect() == []


def test_keep_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(3, text, 1), (3, text, 1), (5, text + " z", 2), (8, "quite another text than those", 3)],
                                 "doc_id long, text string, n_shingles int")
    kept = ngram_jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 8]
    assert ngram_jaccard.keep_one(docs.limit(0)).count() == 0


def test_keep_one_with_shared_and_null_ids(spark):
    """A row is known by its id and text: another text under the same id stays, null ids come last in their group."""
    a, b = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(1, a), (5, a), (5, b), (None, a), (None, a), (None, "quite another text"), (None, "quite another text"), (7, None), (7, None), (8, " "), (9, b + " z"), (9, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "h": F.lit(2), "label": F.lit("clash")})
    for broadcast_rows in (1_000_000, -1):
        kept = ngram_jaccard.keep_one(docs, broadcast_rows=broadcast_rows)
        assert kept.columns == docs.columns
        got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()))
        assert got == sorted([(1, a), (5, b), (0, "quite another text"), (7, ""), (7, ""), (8, " ")])


def test_keep_one_equals_brute_force(spark):
    texts = family(30) + EDGES
    rows = [(random.choice([None, *range(20)]), random.choice(texts)) for _ in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = jaccard_components(list(enumerate(t for _, t in rows)), 5, 80)
    want = {}
    for n, (i, t) in enumerate(rows):
        if groups[n][0]:
            want.setdefault(groups[n][1], set()).add((i is None, i or 0))
    got = [tuple(r) for r in ngram_jaccard.keep_one(docs).collect()]
    blank = [r for n, r in enumerate(rows) if not groups[n][0]]
    assert sorted((i is None, i or 0) for i, t in got) == sorted([min(g) for g in want.values()] + [(i is None, i or 0) for i, _ in blank])
    assert all(r in rows for r in got)


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["label"] for r in setjoin.components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def kept_lines(rows, k=5, percent=80):
    import re
    lines = []
    for i, t in rows:
        for j, line in enumerate((t or "").split("\n")):
            words = [w for w in re.split(SPACE, line.lower()) if w]
            if len(words) >= k:
                lines.append(((i, j), frozenset(tuple(words[q:q + k]) for q in range(len(words) - k + 1))))
    lines.sort(key=lambda x: x[0])
    return {at for n, (at, s) in enumerate(lines) if not any(
        100 * len(s & o) >= percent * len(s | o) for _, o in lines[:n] if s & o)}, {at for at, _ in lines}


def test_line_dedup_equals_brute_force(spark):
    extra = EDGES + ["\n".join(family(8, 30, 3)), "a b c d e\nA  b c d e\n\na b c d\na b c d", "tie " * 6 + "\n" + "tie " * 7]
    docs = documents(spark, SF_SMALL, extra).filter("doc_id < 120").withColumns({"line": F.lit(1), "key": F.lit(2), "_id": F.lit(3), "_h": F.lit(4), "_key": F.lit(5),
                                                                                "_removed": F.lit(6), "lines": F.lit(7), "h": F.lit(8)}).cache()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    keep, all_lines = kept_lines(rows)
    for r in line_dedup.dedup_lines(docs).collect():
        old = dict(rows)[r["doc_id"]]
        gone = [] if old is None else [j for j in range(len(old.split("\n"))) if (r["doc_id"], j) in all_lines - keep]
        assert r["n_removed_lines"] == len(gone) and r["line"] == 1
        assert r["text"] == (None if old is None else "\n".join(x for j, x in enumerate(old.split("\n")) if j not in gone))


def test_line_dedup_without_broadcast_and_on_nothing(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "one two three four five six\nshort"), (2, "one two three four five six\nshort"),
                                  (None, "other words stand in this line")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["text"]) for r in line_dedup.dedup_lines(docs, broadcast_rows=0).collect())
    assert got == [(0, "other words stand in this line"), (1, "one two three four five six"), (2, "short"), (2, "short")]
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []


def test_line_dedup_is_native(spark):
    docs = documents(spark, SF_SMALL)
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeats_of_short_lines_are_removed(spark):
    docs = spark.createDataFrame([(1, "Read more\n\none two three four five six\nread  MORE\nthree words here\n\n"), (2, "\tread more\nother\n \nthree words"),
                                  (3, "other"), (3, "other"), (None, "Other\nx"), (4, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["text"], r["n_removed_lines"]) for r in line_dedup.dedup_lines(docs, short_lines=True).collect() if r["doc_id"] != 4)
    assert got == [(0, "Other\nx", 0), (1, "Read more\n\none two three four five six\nthree words here\n\n", 1), (2, " \nthree words", 2),
                   (3, "", 1), (3, "", 1)]
    query = queries.QUERIES["op10_line_dedup"](spark, SF_SMALL).collect()
    short, seen = 0, set()
    for r in sorted(query, key=lambda r: r["doc_id"]):
        for words in (tuple(line.lower().split()) for line in (r["text"] or "").split("\n")):
            if 0 < len(words) < 5:
                short += 1
                assert words not in seen
                seen.add(words)
    assert short
