"""The Merkle manifest against a plain tree over sorted rows."""

import hashlib
import zlib

from conftest import SF_SMALL
from pyspark.sql import functions as F

from corpusprep.llm import merkle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        a = levels[-1]
        levels.append([digest("".join(a[i:i + 8])) for i in range(0, len(a), 8)])
    return levels


def siblings(levels, i):
    out = []
    for a in levels[:-1]:
        run = a[i // 8 * 8:i // 8 * 8 + 8]
        out.append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
        i //= 8
    return out


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        groups[x].sort(key=lambda r: (LEAST if r[0] is None else r[0], leaf(r)))
        trees[x] = tree([leaf(r) for r in groups[x]])
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, r in enumerate(groups[x]):
            path = siblings(trees[x], i) + siblings(top, k)
            h = r
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                h = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            h = leaf(h)
            for left, right in path:
                h = digest(left + h + right)
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], digest("".join(a + b for a, b in path)), h, h == top[-1][0]))
    return ordered(out)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


def found(docs):
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    m = merkle.manifest(docs, tampered)
    return ordered(m.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")), "folded_root", F.col("folded_root") == F.col("root")).collect())


def test_query_equals_plain_tree(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*merkle.FIELDS).collect()]
    got = queries.QUERIES["op11_merkle"](spark, SF_SMALL)
    assert ordered(got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()) == plain(rows)
    assert {r["verified"] for r in got.collect()} == {True, False}


def test_repeated_and_null_ids_and_many_equal_rows(spark):
    rows = ([(None, None, None, None, None)] * 3 + [(None, "s", None, 1, "AbC")] + [(5, "s", "xx", 1, "Q")] * 9001
            + [(5, "s", "xx", 1, f"t{i}") for i in range(40)] + [(-9, "a", "zz", 2, "Only")] + [(-3 * i, "a", "", 2, "W Q" * i) for i in range(70)]
            + [(LEAST, "s", None, 1, "low"), (MOST, "s", None, 1, "HIGH"), (1, "é", "=", None, "x" * 100_000)] + [(i << 40, "s", "é", 1, "x") for i in range(100)])
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"g": F.lit(1), "at": F.lit("clash"), "key": F.lit(2), "leaf": F.lit(3)})
    assert found(docs) == plain(rows)


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(7, "s", "en", 2, "Hi")], SCHEMA)
    assert found(docs) == plain([(7, "s", "en", 2, "Hi")])
    assert found(docs.limit(0)) == []


def test_places_are_the_order_of_ids(spark):
    ids = [i * 37 - 20_000 for i in range(5_000)]
    docs = spark.createDataFrame([(i, "s", "en", 1, "x") for i in ids], SCHEMA).repartition(7)
    got = {r["doc_id"]: r["at"] for r in merkle.manifest(docs).select("doc_id", "at").collect()}
    assert got == {d: n for n, d in enumerate(sorted(ids))}
