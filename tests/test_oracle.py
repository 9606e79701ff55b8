"""Every query of the library's own operators against its DuckDB SQL on the smallest tables (the driver repeats this at sf0.01).

The training-data queries are optional and tested with their folder.
"""

import pytest

import __spark_entry__ as entry
from corpusprep.plans.oracle import ORACLE_SQL
from corpusprep.plans.queries import QUERIES
from tools.check_oracle import compare, duck

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], ORACLE_SQL[name], SF_SMALL)
    assert r["status"] == "ok", r


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["question_id", "cand", "ctx1_ids", "ctx2_ids", "code_ids", "query_ids", "block_length", "label"]
