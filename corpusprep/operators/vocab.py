"""Vocabulary jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.operators.tokenise import TOKEN_FIELDS


def corpus_words(df: DataFrame, fields=TOKEN_FIELDS) -> DataFrame:
    """Every token occurrence of the given array fields as rows ``(word)``.

    ``explode_outer`` + a null filter keeps Catalyst from inferring a ``size(...) > 0``
    filter that would evaluate an inline token expression a second time.
    """
    arrays = [F.coalesce(F.col(f), F.array().cast("array<string>")) for f in fields]
    words = df.select(F.explode_outer(F.concat(*arrays)).alias("word"))
    return words.filter(F.col("word").isNotNull())


def build_vocab(*dfs: DataFrame, fields=TOKEN_FIELDS) -> DataFrame:
    """S28 + S41: distinct words over the token fields of one or more corpora.

    Each corpus is reduced with a map-side partial aggregate before the shuffle, so a word
    that makes up a large share of all tokens costs one row per task, not one per use.
    """
    if not dfs:
        raise ValueError("build_vocab needs at least one corpus")
    words = None
    for df in dfs:
        part = corpus_words(df, fields).distinct()
        words = part if words is None else words.unionByName(part)
    return words.distinct()


FILTER_SLOTS = 1 << 18  # slots of 64 bits each: the broadcast filter has at most so many rows, whatever the vocabulary


def _slot(word: str) -> tuple[Column, Column]:
    """Slot and bit of a word in the filter."""
    h = F.xxhash64(word)
    return F.pmod(h, F.lit(FILTER_SLOTS)), F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 40).bitwiseAND(F.lit(63)).cast("int"))


def likely_in(words: DataFrame, other: DataFrame) -> DataFrame:
    """The rows of ``words`` whose word may be in ``other``; none that is in it is lost.

    The filter is a bitmap of ``other`` built by an aggregate and broadcast; its size is bounded by ``FILTER_SLOTS``.
    """
    slot, bit = _slot("word")
    bits = other.groupBy(slot.alias("_slot")).agg(F.bit_or(bit).alias("_bits"))
    marked = words.withColumns({"_at": slot, "_bit": bit})
    hit = (F.col("_at") == F.col("_slot")) & (F.col("_bits").bitwiseAND(F.col("_bit")) != 0)
    return marked.join(F.broadcast(bits), hit, "left_semi").drop("_at", "_bit")


def new_words(corpus: DataFrame, old_vocab: DataFrame, fields=TOKEN_FIELDS, prefilter: bool = False) -> DataFrame:
    """S42 + S90: words of ``corpus`` that the old vocabulary lacks (anti join on unique words).

    ``prefilter`` is for an old vocabulary much larger than the corpus's: old words that can't be in the corpus are left out
    by a bitmap of the corpus's words before anything of the old vocabulary is shuffled; the anti join stays exact.
    """
    fresh = build_vocab(corpus, fields=fields)
    old = old_vocab.select("word").filter("word IS NOT NULL")
    if prefilter:
        fresh = fresh.checkpoint()  # read for the bitmap and for the join
        old = likely_in(old, fresh)
    return fresh.join(old.distinct(), "word", "left_anti")


def roundtrip_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows present on one side only, with their multiplicity difference and a ``side`` column."""
    left = before.exceptAll(after).withColumn("side", F.lit("before"))
    right = after.exceptAll(before).withColumn("side", F.lit("after"))
    return left.unionByName(right)


def _digest_table(df: DataFrame, buckets: int, side: str) -> DataFrame:
    """(bucket, n, sums of two row hashes): order-free, with map-side combination."""
    wide = "decimal(20,0)"
    return df.groupBy("_bucket").agg(F.count(F.lit(1)).alias(f"n_{side}"), F.sum(F.col("_h").cast(wide)).alias(f"h_{side}"), F.sum(F.col("_g").cast(wide)).alias(f"g_{side}"))


def roundtrip_diff_by_digest(before: DataFrame, after: DataFrame, buckets: int = 1 << 16) -> DataFrame:
    """S43 for tables that are mostly equal: the rows of ``roundtrip_diff``, comparing only buckets whose digests differ.

    Rows fall into ``buckets`` by a hash of all columns; a bucket's digest is its number of rows and the sums of two 64-bit
    row hashes. Equal buckets, all but certainly of equal rows, are not looked at again, so the rows shuffled are those of
    the buckets that differ and one digest a bucket and task. The list of differing buckets, at most ``buckets``, is broadcast.
    """
    if before.columns != after.columns:
        raise ValueError("both tables need the same columns")

    def hashed(df: DataFrame) -> DataFrame:
        cols = [c for name in before.columns for c in (F.col(name), F.col(name).isNull())]  # a hash passes over nulls
        h = df.withColumns({"_h": F.xxhash64(*cols), "_g": F.xxhash64(F.lit(1), *cols)})
        return h.withColumn("_bucket", F.pmod("_h", F.lit(buckets)))

    left, right = hashed(before), hashed(after)
    both = _digest_table(left, buckets, "l").join(_digest_table(right, buckets, "r"), "_bucket", "full")
    same = F.expr("n_l <=> n_r AND h_l <=> h_r AND g_l <=> g_r")
    differing = F.broadcast(both.filter(~same).select("_bucket").checkpoint())

    def rest(df: DataFrame) -> DataFrame:
        return df.join(differing, "_bucket", "left_semi").select(*before.columns)

    return roundtrip_diff(rest(left), rest(right))
