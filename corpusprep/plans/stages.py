"""Composite stages: raw corpus -> tokens -> vocabulary -> dictionary -> encoded records (E1-E3), and the report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusprep.operators import corpus, encode, vectors, vocab
from corpusprep.operators.tokenise import tokenise_corpus
from corpusprep.session import ensure_checkpoint_dir


class Stage(dict):
    """Outputs of one run; ``single``, ``multiple`` and ``counted`` are built on first use."""

    def __missing__(self, key):
        if key in ("single", "multiple"):
            self["single"], self["multiple"] = corpus.split_candidates(self["raw"])
        elif key == "counted":
            self["counted"] = corpus.with_candidate_count(self["raw"].select("qid"))
        else:
            raise KeyError(key)
        return self[key]


def encode_raw_corpus(raw: DataFrame, word_vectors: DataFrame | Callable[[DataFrame], DataFrame], seed: int = 7,
                      lang: str | None = None) -> dict:
    """Run split, tokenise, vocabulary, dictionary and encode over one raw corpus.

    ``word_vectors`` is a ``(word, vec)`` table, or a function that gives one for the vocabulary.

    The token records are checkpointed once (the reference writes them to a file between
    stages): the regular-expression chains run once, and later stages restart from the
    checkpoint rather than from the raw text after a lost executor.
    """
    ensure_checkpoint_dir(raw.sparkSession)
    tokens = tokenise_corpus(raw, lang).checkpoint(eager=True)
    words = vocab.build_vocab(tokens).checkpoint(eager=True)  # read by the vectors, the dictionary and the report
    vecs = word_vectors(words) if callable(word_vectors) else word_vectors
    dictionary = vectors.build_dictionary(words, vecs, seed=seed)
    failed = vectors.failed_words(words, vecs)
    encoded = encode.encode_corpus(tokens, dictionary)
    return Stage(raw=raw, tokens=tokens, vocab=words, vectors=vecs, dictionary=dictionary, failed=failed,
                 encoded=encoded)


def _metrics(df: DataFrame, **exprs) -> DataFrame:
    """One aggregation pass over ``df``, returned as ``(metric, value)`` rows."""
    row = df.agg(*[F.coalesce(e, F.lit(0)).cast("long").alias(k) for k, e in exprs.items()])
    pairs = ", ".join(f"'{k}', `{k}`" for k in exprs)
    return row.selectExpr(f"stack({len(exprs)}, {pairs}) as (metric, value)")


def corpus_report(stage: dict) -> DataFrame:
    """``(metric, value)`` counts of one run, as rows rather than prints (one pass per table)."""
    multi = F.col("n_candidates") > 1
    parts = [
        _metrics(stage["tokens"], records=F.count(F.lit(1)),
                 code_failed=F.sum(F.when(~F.col("code_ok"), 1).otherwise(0))),
        _metrics(stage["counted"], single=F.sum(F.when(F.col("n_candidates") == 1, 1).otherwise(0)),
                 multiple=F.sum(F.when(multi, 1).otherwise(0)),
                 questions_multiple=F.countDistinct(F.when(multi, F.col("question_id")))),
        _metrics(stage["vocab"], vocab=F.count(F.lit(1))),
        _metrics(stage["dictionary"], dictionary=F.count(F.lit(1))),
        _metrics(stage["failed"], failed_words=F.count(F.lit(1))),
        _metrics(stage["encoded"], encoded=F.count(F.lit(1))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_run(raw: DataFrame, word_vectors: DataFrame | Callable[[DataFrame], DataFrame], folder: str, seed: int = 7,
              lang: str | None = None) -> DataFrame:
    """Run and write every stage below ``folder``, and return the report (S29) without a pass of its own.

    Written are ``candidates`` (question_id, n_candidates), ``tokens``, ``vocab``, ``dictionary``, ``failed`` and ``encoded``.
    The counts are observed by the jobs that write the tables, so each row is counted once, as it passes; a stage reads what
    its predecessor wrote. The result is a small local table; it starts no job.
    """
    from corpusprep.sources import io

    spark = raw.sparkSession
    ensure_checkpoint_dir(spark)
    counts: dict[str, int] = {}

    def observed(df: DataFrame, write: Callable[[DataFrame], None], **exprs) -> None:
        seen = Observation()
        write(df.observe(seen, *[F.coalesce(e, F.lit(0)).cast("long").alias(k) for k, e in exprs.items()]))
        counts.update(seen.get)

    one = F.count(F.lit(1))
    many = F.col("n_candidates") > 1
    observed(corpus.candidate_counts(raw), lambda df: df.write.parquet(f"{folder}/candidates"),
             single=F.sum(F.when(~many, 1).otherwise(0)), multiple=F.sum(F.when(many, F.col("n_candidates")).otherwise(0)),
             questions_multiple=F.sum(F.when(many & F.col("question_id").isNotNull(), 1).otherwise(0)))
    observed(tokenise_corpus(raw, lang), lambda df: io.write_tokens(df, f"{folder}/tokens"), records=one,
             code_failed=F.sum(F.when(~F.col("code_ok"), 1).otherwise(0)))
    tokens = io.read_tokens(spark, f"{folder}/tokens")
    observed(vocab.build_vocab(tokens), lambda df: io.write_vocab(df, f"{folder}/vocab"), vocab=one)
    words = io.read_vocab(spark, f"{folder}/vocab")
    vecs = word_vectors(words) if callable(word_vectors) else word_vectors
    observed(vectors.build_dictionary(words, vecs, seed=seed), lambda df: io.write_dictionary(df, f"{folder}/dictionary"), dictionary=one)
    observed(vectors.failed_words(words, vecs), lambda df: io.write_vocab(df, f"{folder}/failed"), failed_words=one)
    encoded = encode.encode_corpus(tokens, io.read_dictionary(spark, f"{folder}/dictionary"))
    observed(encoded, lambda df: io.write_encoded(df, f"{folder}/encoded"), encoded=one)
    return spark.createDataFrame(sorted(counts.items()), "metric string, value long")


def convert_vectors(spark, text_path: str, out_path: str, dim: int | None = None) -> DataFrame:
    """word2vec text -> unit-length vectors -> parquet; returns the written table."""
    from corpusprep.sources import io

    io.write_vectors(vectors.unit_vectors(io.read_word_vectors(spark, text_path, dim)), out_path)
    return io.read_vectors(spark, out_path)


def dictionary_job(vocab_df: DataFrame, vectors_df: DataFrame, seed: int = 7) -> dict:
    """Dictionary (specials first, words ascending), failed words, and the stored-vector check."""
    dictionary = vectors.build_dictionary(vocab_df, vectors_df, seed=seed)
    return {"dictionary": dictionary, "failed": vectors.failed_words(vocab_df, vectors_df),
            "check": vectors.verify_dictionary(dictionary, vectors_df)}
