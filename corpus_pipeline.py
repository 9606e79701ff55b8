"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, benchmark decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
``documents``. Between stages the rows are written as Parquet to the shared checkpoint folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import bm25_decontam, kneser_ney, line_dedup, ngram_jaccard, sp_backtrack
from corpusprep.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return kneser_ney.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which nothing is left; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs, short_lines=True)
    emptied = (F.col("n_removed_lines") > 0) & (F.trim(F.col("text")) == "")
    return kept.filter(~emptied | F.col("text").isNull()).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one of the smallest id."""
    return ngram_jaccard.keep_one(docs, shingle=5, percent=80).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return bm25_decontam.remove_leaks(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document left."""
    done = sp_backtrack.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return done.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"),
                       F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


STAGES = [("quality", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("encode", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
