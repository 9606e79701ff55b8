"""Small inputs and plain Python references for the operators' tests."""

import re
from collections import Counter, defaultdict

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingle_set(text, k):
    words = re.findall(WORD, lower(text or ""))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def jaccard_components(rows, k, percent):
    """id -> (set size, least reachable id) by comparing every pair that shares a shingle."""
    sets = {i: shingle_set(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in having[s])
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in sets[i]:
            having[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def documents(spark, sf_dir, extra=()):
    """The documents of a small scale and some more: ids below zero, clashing column names."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    more = spark.createDataFrame([(-i - 1, t, "en") for i, t in enumerate(extra)], "doc_id long, text string, lang string")
    return docs.unionByName(more)


EDGES = [None, "", " ", "\n\n", "one", "One", "a b", "x" * 20_000, "é 🙂 日本語\tß", "same words here again and again", "same words here again and again",
         "\x00 \x1c ▁ <s> <|endoftext|>", "w " * 5_000]
