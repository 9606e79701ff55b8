"""Base-form lookup (S25), re-aimed as a join with a ``(token, lemma)`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.lookup import BROADCAST_LIMIT_BYTES, SALT_BUCKETS, by_record, left_lookup


def lemma_join(df: DataFrame, lemmas: DataFrame | None, key: str, tokens: str,
               limit_bytes: int = BROADCAST_LIMIT_BYTES, salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """Replace every token of the array column ``tokens`` by its lemma, keeping order.

    ``lemmas`` is a ``(token, lemma)`` table with unique tokens; without one the tokens are
    returned unchanged. Records are
    numbered before the explode, so a repeated ``key`` merges nothing. The table is broadcast when its
    measured size is within ``limit_bytes``, else joined by a salted shuffle.
    """
    if lemmas is None:
        return df.select(key, tokens)
    numbered = by_record(df.select(key, tokens))
    long = numbered.select("_row", key, F.posexplode_outer(tokens).alias("pos", "token"))
    side = lemmas.select(F.col("token").alias("_tok"), "lemma")
    joined = left_lookup(long, side, "token", "_tok", limit_bytes, salt_buckets)
    entry = F.when(F.col("token").isNotNull(), F.struct("pos", F.coalesce("lemma", "token").alias("t")))
    folded = joined.groupBy("_row", key).agg(F.array_sort(F.collect_list(entry)).alias("_e"))
    return folded.select(key, F.col("_e.t").alias(tokens))


def plural_lemmas(vocab: DataFrame) -> DataFrame:
    """A ``(token, lemma)`` table from a vocabulary: ``words`` -> ``word`` when both are words of it."""
    plural = vocab.filter(F.col("word").rlike(r"^[a-z]{3,}s$")).select(
        F.col("word").alias("token"), F.expr("substr(word, 1, length(word) - 1)").alias("lemma"))
    return plural.join(vocab.select(F.col("word").alias("lemma")), "lemma", "inner").select("token", "lemma")
