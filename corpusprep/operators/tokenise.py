"""Tokenise a raw corpus: four fields, rule set chosen by language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.pycode import python_code_tokens
from corpusprep.functions.sqlcode import sql_code_parse
from corpusprep.functions.text import context_tokens, query_tokens

TOKEN_FIELDS = ["ctx1_tokens", "ctx2_tokens", "code_tokens", "query_tokens"]


LANGS = ("python", "sql")


def _code(lang: str):
    if lang == "python":
        return F.struct(python_code_tokens("code").alias("tokens"), F.lit(True).alias("ok"))
    if lang == "sql":
        return sql_code_parse("code")
    raise ValueError(f"unknown language {lang!r}")


def _per_language(rule) -> F.Column:
    """``rule(lang)`` for the row's language; only the matching branch is evaluated per row."""
    return F.when(F.col("lang") == "python", rule("python")).otherwise(rule("sql"))


def tokenise_fields(df: DataFrame, lang: str | None) -> DataFrame:
    """Token arrays; one projection, no shuffle. ``lang=None`` picks the rule set per row."""
    if lang is None:
        pick, lang_col = _per_language, F.col("lang")
    elif lang in LANGS:
        pick, lang_col = (lambda rule: rule(lang)), F.lit(lang)
    else:
        raise ValueError(f"unknown language {lang!r}")
    staged = df.select(
        "qid",
        lang_col.alias("lang"),
        pick(lambda d: context_tokens("ctx1", d)).alias("ctx1_tokens"),
        pick(lambda d: context_tokens("ctx2", d)).alias("ctx2_tokens"),
        pick(_code).alias("_code"),
        pick(lambda d: query_tokens("query", d)).alias("query_tokens"),
    )
    # Two references to ``_code`` keep Catalyst from inlining (and so repeating) the code rules.
    return staged.select("qid", "lang", "ctx1_tokens", "ctx2_tokens", F.col("_code.tokens").alias("code_tokens"),
                         "query_tokens", F.col("_code.ok").alias("code_ok"))


def unknown_languages(df: DataFrame) -> DataFrame:
    """``(lang, records)`` of the languages without a rule set, NULL included."""
    known = F.coalesce(F.col("lang").isin(*LANGS), F.lit(False))
    return df.filter(~known).groupBy("lang").agg(F.count(F.lit(1)).alias("records"))


def tokenise_corpus(df: DataFrame, lang: str | None = None, unknown: str = "error") -> DataFrame:
    """Raw records to token records.

    With ``lang`` the whole input uses one rule set (the reference's ``main(lang_type, ...)``);
    without it, the ``lang`` column selects the rule set per row in the same projection, so the
    input is read once. A record of another (or NULL) language fails the job with its language;
    ``unknown="skip"`` leaves such records out, and ``unknown_languages`` counts them.
    """
    if lang is not None:
        return tokenise_fields(df, lang)
    known = F.coalesce(F.col("lang").isin(*LANGS), F.lit(False))
    if unknown == "skip":
        return tokenise_fields(df.filter(known), None)
    if unknown != "error":
        raise ValueError(f"unknown must be 'error' or 'skip', got {unknown!r}")
    message = F.concat(F.lit("no rule set for language "), F.coalesce(F.col("lang"), F.lit("NULL")))
    return tokenise_fields(df.withColumn("lang", F.when(known, F.col("lang")).otherwise(
        F.raise_error(message).cast("string"))), None)
