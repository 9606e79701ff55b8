"""Readers and writers (S1-S9). Every stage boundary is a columnar table; word vectors also read from word2vec text."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.operators.corpus import NESTED_SCHEMA, RAW_SCHEMA, flatten_record

TOKEN_SCHEMA = ("qid struct<question_id:string,cand:int>, lang string, ctx1_tokens array<string>, "
                "ctx2_tokens array<string>, code_tokens array<string>, query_tokens array<string>, code_ok boolean")
ENCODED_SCHEMA = ("qid struct<question_id:string,cand:int>, ctx1_ids array<int>, ctx2_ids array<int>, "
                  "code_ids array<int>, query_ids array<int>, block_length int, label int")
DICTIONARY_SCHEMA = "idx int, word string, vec array<float>"


def spread_input(df: DataFrame, partitions: int) -> DataFrame:
    """Deal the rows of a single-file input out over ``partitions`` tasks; other inputs are returned unchanged.

    The text rules are CPU-bound per row, and a file of one row group would be tokenised by a
    single task. Inputs of several files have splits of their own and are never shuffled.
    """
    return df.repartition(partitions) if len(df.inputFiles()) == 1 else df


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet", nested: bool = False,
                spread: int | None = None) -> DataFrame:
    """Raw records with an explicit schema (flat, or the nested reference layout flattened by S10).

    The read has no exchange; ``spread`` deals a single-file input out over so many tasks. A broken
    line of a text format fails the job (``read_corpus_checked`` returns broken lines as rows).
    """
    schema = NESTED_SCHEMA if nested else RAW_SCHEMA
    reader = spark.read.schema(schema).format(fmt)
    df = (reader.option("mode", "FAILFAST") if fmt in ("json", "csv") else reader).load(path)
    if spread:
        df = spread_input(df, spread)
    return flatten_record(df) if nested else df


class Checked(NamedTuple):
    """Good rows and the lines that could not be read."""

    rows: DataFrame
    rejects: DataFrame


def parse_records(lines: DataFrame, nested: bool = False, value: str = "value") -> Checked:
    """JSON lines to records and ``rejects (line, reason)``; blank lines are neither.

    A line is a reject if it is no JSON object, if a field has another type than the schema's, or if it names no question
    (``qid`` or its ``question_id``), so that no record of nulls stands for a broken line. Every non-blank line is in one of
    the two tables.
    """
    schema = NESTED_SCHEMA if nested else RAW_SCHEMA
    parsed = F.from_json(F.col(value), f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    rows = lines.filter(F.trim(F.coalesce(F.col(value), F.lit(""))) != "").select(F.col(value).alias("line"), parsed.alias("r"))
    # The parser stops behind the first object; as an array's only element the line must be that object and nothing else.
    alone = F.coalesce(F.json_array_length(F.concat(F.lit("["), F.col("line"), F.lit("]"))) == 1, F.lit(False))
    reason = (F.when(F.col("r").isNull() | F.col("r._broken").isNotNull() | ~alone, F.lit("broken"))
              .when(F.col("r.qid.question_id").isNull(), F.lit("no question")))
    rows = rows.withColumn("reason", reason)
    good = rows.filter(F.col("reason").isNull()).select("r.*").drop("_broken")
    return Checked(flatten_record(good) if nested else good, rows.filter(F.col("reason").isNotNull()).select("line", "reason"))


def read_corpus_checked(spark: SparkSession, path: str, nested: bool = False) -> Checked:
    """S1 for JSON lines with broken ones: ``Checked(rows, rejects)``, the file being read once for each."""
    return parse_records(spark.read.text(path), nested)


def write_split(df_with_kind: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Single and multiple candidates in one write, one folder per ``candidate_kind``."""
    df_with_kind.write.mode(mode).partitionBy("candidate_kind").parquet(path)


def read_split(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Read one split back; the kind filter prunes the other folder."""
    return spark.read.parquet(path).filter(F.col("candidate_kind") == kind).drop("candidate_kind")


def write_tokens(tokens: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S3: token records, one folder per language."""
    tokens.write.mode(mode).partitionBy("lang").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOKEN_SCHEMA).parquet(path)


def parse_word_vectors(lines: DataFrame, dim: int, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """word2vec lines to ``((word, vec), rejects)``; ``dim`` numbers from the right, the rest is the word.

    A word may hold spaces. Lines with fewer fields, without a word or with a malformed number are the
    rejects ``(line)``; blank lines and the header (two whole numbers, the second being ``dim``) are neither.
    """
    text = F.regexp_replace(F.col(value), r"\s+$", "")
    parts = F.split(text, " ")
    head = F.col("line").rlike(rf"^\d+ {dim}$") if dim != 1 else F.lit(False)
    rows = lines.select(text.alias("line"), parts.alias("p")).filter((F.col("line") != "") & ~head)
    numbers = F.expr(f"transform(slice(p, greatest(size(p) - {dim} + 1, 1), {dim}), x -> try_cast(x AS float))")
    word = F.expr(f"array_join(slice(p, 1, greatest(size(p) - {dim}, 0)), ' ')")
    rows = rows.select("line", word.alias("word"), numbers.alias("vec"))
    good = F.coalesce((F.col("word") != "") & (F.size("vec") == dim) & F.forall("vec", lambda x: x.isNotNull()), F.lit(False))
    return rows.filter(good).select("word", "vec"), rows.filter(~good).select("line")


def _header_dim(lines: DataFrame) -> int:
    first = lines.first()
    head = (first["value"].split() if first else [])
    if len(head) != 2 or not all(x.isdigit() for x in head):
        raise ValueError("the file has no 'count dim' header: give dim")
    return int(head[1])


def read_word_vectors_checked(spark: SparkSession, path: str, dim: int | None = None) -> Checked:
    """S4 with the lines that are no vector of this length: ``Checked(rows, rejects)``."""
    lines = spark.read.text(path)
    return Checked(*parse_word_vectors(lines, _header_dim(lines) if dim is None else dim))


def read_word_vectors(spark: SparkSession, path: str, dim: int | None = None) -> DataFrame:
    """word2vec text (``count dim`` header, then ``word v1 ... vdim`` per line) to ``(word, vec)``.

    Without ``dim`` the header's is used. The file is read in parallel splits; lines that are no
    vector of this length are left out (``read_word_vectors_checked`` returns them, too).
    """
    return read_word_vectors_checked(spark, path, dim).rows


def write_word_vectors_text(vectors: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``(word, vec)`` as word2vec-style text lines (without the header), e.g. for exchange."""
    line = F.concat_ws(" ", F.col("word"), F.array_join(F.col("vec").cast("array<string>"), " "))
    vectors.select(line.alias("value")).write.mode(mode).text(path)


def write_vectors(vectors: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Normalised vectors as parquet for fast columnar reload."""
    vectors.select("word", "vec").write.mode(mode).parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word string, vec array<float>").parquet(path)


def write_vocab(vocab: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One ``word`` column."""
    vocab.select("word").write.mode(mode).parquet(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word string").parquet(path)


def write_dictionary(dictionary: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Dictionary and vector matrix as one ``(idx, word, vec)`` table, sorted by ``idx``."""
    dictionary.select("idx", "word", "vec").sortWithinPartitions("idx").write.mode(mode).parquet(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DICTIONARY_SCHEMA).parquet(path)


def write_encoded(encoded: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Encoded records."""
    encoded.write.mode(mode).parquet(path)


def read_encoded(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENCODED_SCHEMA).parquet(path)


def write_labels(labels: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """``(question_id, cand, label)`` rows, as parquet or csv."""
    flat = labels.select(F.col("qid.question_id").alias("question_id"), F.col("qid.cand").alias("cand"), "label")
    writer = flat.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
