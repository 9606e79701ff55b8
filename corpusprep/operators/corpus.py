"""Corpus record jobs: flatten, split by candidate count, label, count."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.lookup import left_lookup

# Raw record, reference layout: key, [[ctx1], [ctx2]], [[code]], [query].
NESTED_SCHEMA = ("qid struct<question_id:string,cand:int>, ctx array<array<string>>, "
                 "code array<array<string>>, query array<string>")
# Flat raw record used by every job here.
RAW_SCHEMA = "qid struct<question_id:string,cand:int>, lang string, ctx1 string, ctx2 string, code string, query string"


def flatten_record(df: DataFrame) -> DataFrame:
    """Pull the four text fields out of the nested layout (pruned columns only)."""
    return df.select(
        "qid",
        F.col("ctx")[0][0].alias("ctx1"),
        F.col("ctx")[1][0].alias("ctx2"),
        F.col("code")[0][0].alias("code"),
        F.col("query")[0].alias("query"),
    )


def nest_record(df: DataFrame) -> DataFrame:
    """Inverse of :func:`flatten_record` (for writing the reference layout)."""
    return df.select(
        "qid",
        F.array(F.array("ctx1"), F.array("ctx2")).alias("ctx"),
        F.array(F.array("code")).alias("code"),
        F.array("query").alias("query"),
    )


def candidate_counts(df: DataFrame, key: str = "qid.question_id") -> DataFrame:
    """Number of records per question id (partial + final hash aggregate)."""
    return df.groupBy(F.col(key).alias("question_id")).agg(F.count(F.lit(1)).alias("n_candidates"))


def with_candidate_count(df: DataFrame, key: str = "qid.question_id") -> DataFrame:
    """Attach ``n_candidates`` to every record.

    The count is a map-side-combined aggregate on the key alone, joined back on the key.
    A question holding a large share of all records cannot overload one task: the
    aggregate combines before the shuffle, and the count table is broadcast when its
    measured size allows, else joined with salted keys (every record's question has a count).
    """
    counts = candidate_counts(df, key).withColumnRenamed("question_id", "_qid")
    records = df.withColumn("question_id", F.col(key))
    record_key = key.split(".")[0]
    return left_lookup(records, counts, "question_id", "_qid", salt_by=[record_key])


class Split(NamedTuple):
    single: DataFrame
    multiple: DataFrame


def split_candidates(df: DataFrame, key: str = "qid.question_id") -> Split:
    """S13 + S14 + S88: ``Split(single, multiple)`` — single- and multi-candidate records."""
    tagged = with_candidate_count(df, key)
    cols = df.columns
    return Split(tagged.filter(F.col("n_candidates") == 1).select(*cols),
                 tagged.filter(F.col("n_candidates") > 1).select(*cols))


def candidate_kind(df: DataFrame, key: str = "qid.question_id") -> DataFrame:
    """Both splits in one DataFrame with a ``candidate_kind`` column, for one partitioned write."""
    tagged = with_candidate_count(df, key)
    kind = F.when(F.col("n_candidates") == 1, F.lit("single")).otherwise(F.lit("multiple"))
    return tagged.withColumn("candidate_kind", kind).drop("question_id", "n_candidates")


def label_singles(single: DataFrame, label: int = 1) -> DataFrame:
    """S15 + S37 + S89: ``(qid, 1)`` per single-candidate record, sorted by (qid, label)."""
    return single.select("qid", F.lit(label).alias("label")).orderBy("qid", "label")


def count_value(arr, value) -> Column:
    """Occurrences of ``value`` inside an array column."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    return F.size(F.filter(arr, lambda x: x == F.lit(value)))
