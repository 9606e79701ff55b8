"""Registered queries of this subpackage, and DuckDB SQL where it can express the result.

The operators keep their own outputs (spans, texts, ids); the queries derive the digest columns from them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm import (
    bm25_decontam,
    chat_format,
    collocations,
    html_wrapper,
    kneser_ney,
    license_index,
    line_dedup,
    merkle,
    ngram_jaccard,
    pii_bootstrap,
    sp_backtrack,
    token_count,
    url_filter,
)
from corpusprep.llm.common import ascii_lower, table
from corpusprep.llm.oracle import COLLOCATIONS, MERKLE


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3, percent=90)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = kneser_ney.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         F.round("score", 6).alias("score"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_bootstrap.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")
              for rank, kind in enumerate(pii_bootstrap.BASE)]
    return found.select("doc_id", *counts, F.sha2(pii_bootstrap.span_digest(F.col("base")), 256).alias("base_sha256"),
                        pii_bootstrap.span_digest(F.col("spans")).alias("spans"))


def op4_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_index.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("found", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda m: m["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda m: m["score"])), F.lit(0.0)).alias("score"))


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a test item that it holds."""
    pairs = bm25_decontam.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return pairs.select("doc_id", "item_id", *[F.round(c, 6).alias(c) for c in ("score", "question_overlap", "answer_overlap")])


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_wrapper.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    parts = turns.unionByName(control).withColumn("parts", chat_format.text_part(F.col("text")))
    back = chat_format.read_back(chat_format.format_conversations(parts))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = sp_backtrack.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text after line dedup, its length and the number of lines taken out."""
    docs = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), short_lines=True)
    return docs.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), "n_removed_lines")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    found = merkle.manifest(docs, tampered)
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES, url_filter.labelled_table(spark)).select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard, op2_quality, op3_pii, op4_license, op5_decontam, op6_html, op7_token_count, op8_chat, op9_sentencepiece,
    op10_line_dedup, op11_merkle, op12_url_filter, op13_collocations)}

ORACLE_SQL = {
    "op11_merkle": MERKLE,
    "op13_collocations": COLLOCATIONS,
    "op8_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        escaped AS (
            SELECT *, regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS t FROM turns)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(length('<|im_start|>') + length(role) + 1 + length(t) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id""",
}
