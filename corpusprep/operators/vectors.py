"""Word vectors and the numbered dictionary."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.text import let
from corpusprep.operators.numbering import dense_number

# Special entries at the head of every dictionary, in id order, and the
# range of their random vectors.
SPECIAL_TOKENS = ["PAD", "UNK", "SOS", "EOS"]
PAD, UNK, SOS, EOS = 0, 1, 2, 3
SPECIAL_RANGE = 0.25


def unit_vector(vec) -> Column:
    """L2-normalise an ``array<float>`` column; an all-zero vector stays zero, one with a NULL element is NULL."""
    v = F.col(vec) if isinstance(vec, str) else vec
    norm = F.sqrt(F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x))
    return let(F.struct(v.alias("v"), norm.alias("n")), lambda s: F.when(s["n"].isNotNull(), F.transform(
        s["v"], lambda x: F.when(s["n"] > 0, x / s["n"]).otherwise(F.lit(0.0)).cast("float"))))


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """S80 over a ``(word, vec)`` table."""
    return vectors.withColumn("vec", unit_vector("vec"))


def special_vectors(spark: SparkSession, dim: int, seed: int = 0) -> DataFrame:
    """PAD = zeros, UNK/SOS/EOS = uniform(-0.25, 0.25) from a seeded generator (4 rows)."""
    rng = np.random.default_rng(seed)
    rows = [(0, SPECIAL_TOKENS[0], [0.0] * dim)]
    for i, name in enumerate(SPECIAL_TOKENS[1:], start=1):
        rows.append((i, name, [float(x) for x in rng.uniform(-SPECIAL_RANGE, SPECIAL_RANGE, dim)]))
    return spark.createDataFrame(rows, "idx int, word string, vec array<float>")


def found_words(vocab: DataFrame, vectors: DataFrame) -> DataFrame:
    """Vocabulary words that have a vector (inner join on the unique word); a NULL vector is none."""
    return vocab.select("word").join(vectors.select("word", "vec").filter(F.col("vec").isNotNull()), "word", "inner")


def failed_words(vocab: DataFrame, vectors: DataFrame) -> DataFrame:
    """Vocabulary words without a vector (anti join; only the vector table's word column is read)."""
    return vocab.select("word").join(vectors.filter(F.col("vec").isNotNull()).select("word"), "word", "left_anti")


def build_dictionary(vocab: DataFrame, vectors: DataFrame, dim: int | None = None, seed: int = 0,
                     specials: bool = True) -> DataFrame:
    """``(idx, word, vec)``; specials at 0..3, then found words numbered by word ascending."""
    found = found_words(vocab, vectors)
    numbered = dense_number(found, "word", start=len(SPECIAL_TOKENS))
    body = numbered.select("idx", "word", "vec")
    if not specials:
        return body
    if dim is None:
        first = vectors.select(F.size("vec").alias("d")).first()
        dim = int(first["d"]) if first else 0
    return special_vectors(vocab.sparkSession, dim, seed).unionByName(body)


def append_dictionary(old: DataFrame, words: DataFrame, vectors: DataFrame) -> DataFrame:
    """S31 + S86: extend a dictionary with new words that have vectors, numbered after the old maximum.

    Words already in the old dictionary keep their id (the reference would add a second row).
    """
    new = found_words(words.select("word").distinct().join(old.select("word"), "word", "left_anti"), vectors)
    top = old.agg(F.max("idx").alias("top")).first()["top"]
    start = len(SPECIAL_TOKENS) if top is None else int(top) + 1
    extra = dense_number(new, "word", start=start).select("idx", "word", "vec")
    return old.select("idx", "word", "vec").unionByName(extra)


def verify_dictionary(dictionary: DataFrame, vectors: DataFrame, first_idx: int = len(SPECIAL_TOKENS)) -> DataFrame:
    """One row ``(checked, mismatched)`` comparing stored vectors with the source vectors."""
    pairs = (dictionary.filter(F.col("idx") >= first_idx).select("word", F.col("vec").alias("stored"))
             .join(vectors.select("word", F.col("vec").alias("source")), "word", "left"))
    same = (F.size("stored") == F.size("source")) & F.forall(
        F.arrays_zip("stored", "source"), lambda p: p["stored"].eqNullSafe(p["source"]))
    differs = ~F.coalesce(same, F.lit(False))  # no source vector is a mismatch
    return pairs.agg(F.count(F.lit(1)).alias("checked"),
                     F.coalesce(F.sum(differs.cast("long")), F.lit(0)).alias("mismatched"))
