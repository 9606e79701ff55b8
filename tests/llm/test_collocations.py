"""Collocations against counters over all phrases."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict
from functools import partial

import numpy as np
from conftest import SF_CHECK, SF_SMALL
from pyspark.sql import functions as F

from corpusprep.llm import collocations, queries

from .fixtures import EDGES


def plain(rows, least=30, cover=80, top=2000, scale=2_000_000):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, 5):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        covered = {q[i:i + k] for q, b in candidates.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if 100 * b >= cover * c[q[i:i + k]]}
        best = []
        for p, a in candidates.items():
            if p not in covered:
                score, _, left, right = min((scale * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, words[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(best)[:top])]
    return sorted(out)


def test_query_equals_counters(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("lang", "text").collect()
    want = plain([tuple(r) for r in rows])
    assert len(want) > 100 and sorted(map(tuple, queries.QUERIES["op13_collocations"](spark, SF_CHECK).collect())) == want


def test_edges_chunks_slices_and_lookups(spark, monkeypatch):
    random.seed(8)
    texts = ["The cat. the CAT sat, the cat sat on a mat; the cat sat on", "x\ty\x0bx y\u2028x y z", "new york city " * 12, "a a a a a a a", "é É x\x1cy . ." * 4]
    rows = [(random.choice(["en", "de", None, "und", ""]), random.choice(texts + EDGES)) for _ in range(400)]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({"prefix": F.lit(1), "n": F.lit(2), "total": F.lit(3)}).repartition(5)
    want = plain(rows, least=3, top=25)
    assert sorted(map(tuple, collocations.collocations(docs, min_count=3, top=25).collect())) == want
    # Small chunks, every prefix in slices, lookups by shuffle.
    monkeypatch.setattr(collocations, "LOOKUP_BYTES", 0)
    assert sorted(map(tuple, collocations.collocations(docs, min_count=3, top=25, chunk_words=50, wide_from=2).collect())) == want


def test_nothing(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(docs.withColumn("text", F.lit(None).cast("string"))).collect() == []


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits: counts of 10^14 in the score and in the cover rule."""
    a = 10 ** 14
    grams = spark.createDataFrame([("en", "x", "y", a)], "lang string, prefix string, next string, a long")
    words = spark.createDataFrame([("en", "", "x", a + 1), ("en", "", "y", 3 * a)], "lang string, prefix string, next string, a long")
    r = collocations.scored(grams, words, 2_000_000).first()
    assert r["score"] == 2_000_000 * a // (a + 1 + 3 * a) and (r["l"], r["r"]) == (a + 1, 3 * a)


def test_memory_of_a_chunk_is_bounded_by_its_words():
    """numpy's peak while a chunk's longer stripes are counted, in bytes a word."""
    rng = np.random.default_rng(1)
    chunk = collocations.Chunk()
    for _ in range(50):
        chunk.add("en", b" ".join(b"w%d" % i for i in rng.integers(0, 3000, 4000)))
    everything = np.full(1, ~np.uint64(0), np.uint64)
    for level, most in ((partial(collocations.longer_level, size=2), 210), (collocations.pairs_level, 64)):
        chunk.numbers()
        tracemalloc.start()
        rows = sum(batch.num_rows for batch in level(chunk, everything, {}))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows
        assert peak <= most * chunk.size
