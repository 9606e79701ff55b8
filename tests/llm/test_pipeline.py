import sys

import pytest
from conftest import SF_SMALL

import corpus_pipeline
from corpusprep.llm import bm25_decontam, kneser_ney
from corpusprep.llm.queries import ORACLE_SQL, QUERIES

from .fixtures import jaccard_components, lower
from .test_near_duplicates import kept_lines


def stages(spark, docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF_SMALL).checkpoint())
    return out


def test_each_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    start, good, lined, single, clean, encoded = stages(spark, docs)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontaminate", "encode"]
    assert all(x.columns == docs.columns for x in (good, lined, single, clean))
    judged = {r["doc_id"]: r["kept"] for r in kneser_ney.judge(start).collect()}
    assert {r["doc_id"] for r in good.collect()} == {i for i, k in judged.items() if k}

    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    keep, every = kept_lines(rows)
    first = {}  # lines of fewer than five words go where an earlier line has the same words
    for i, t in sorted(rows):
        for j, x in enumerate(t.split("\n")):
            words = tuple(lower(x).split())
            if 0 < len(words) < 5:
                every.add((i, j))
                if first.setdefault(words, (i, j)) == (i, j):
                    keep.add((i, j))
    want = {i: "\n".join(x for j, x in enumerate(t.split("\n")) if (i, j) not in every - keep) for i, t in rows}
    want = {i: t for i, t in want.items() if t.strip() or t == dict(rows)[i]}
    got = {r["doc_id"]: r for r in lined.collect()}
    assert {i: r["text"] for i, r in got.items()} == want and all(r["n_chars"] == len(r["text"]) for r in got.values())

    groups = jaccard_components([(r["doc_id"], r["text"]) for r in lined.collect()], 5, 80)
    assert {r["doc_id"] for r in single.collect()} == {i for i, (_, c) in groups.items() if c == i}
    leaked = {r["doc_id"] for r in bm25_decontam.find_leaks(single, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in single.collect()} - leaked
    assert encoded.count() == clean.count()
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_SMALL).collect())) == sorted(map(tuple, encoded.collect()))


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    assert all(x.count() == 0 for x in stages(spark, docs))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("conversations", "documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want, got = con.sql(ORACLE_SQL[name]), QUERIES[name](spark, SF_SMALL)
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(want.fetchall(), key=repr) == sorted((tuple(r[c] for c in want.columns) for r in got.collect()), key=repr)


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries().keys()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")} and "pipeline" in names
    assert "corpusprep.llm" in sys.modules and not any("llm" in m for m in vars(sys.modules["corpusprep"]).get("__all__", []))
