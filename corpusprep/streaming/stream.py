"""Structured Streaming forms of the tokenise and encode stages.

The reference only processes whole files; the tokenisers here are stateless column
expressions, so the same projection runs on a streaming source unchanged. Encoding needs a
lookup join and a fold back per record, which ``foreachBatch`` runs with the batch job on
each micro-batch against a fixed dictionary. Checkpoint locations must be on storage that
survives executor and driver loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpusprep.operators.corpus import RAW_SCHEMA
from corpusprep.operators.encode import encode_corpus
from corpusprep.operators.tokenise import tokenise_corpus


def read_corpus_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw records arriving as parquet files in ``path`` (explicit schema, as streaming requires)."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def tokenise_stream(raw: DataFrame, sink_path: str, checkpoint_location: str, lang: str | None = None,
                    available_now: bool = False) -> StreamingQuery:
    """Append token records for every new raw record to parquet at ``sink_path``."""
    writer = (tokenise_corpus(raw, lang).writeStream.format("parquet").outputMode("append")
              .option("path", sink_path).option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def encode_stream(tokens: DataFrame, dictionary: DataFrame, sink_path: str, checkpoint_location: str,
                  available_now: bool = False) -> StreamingQuery:
    """Encode each micro-batch of token records against ``dictionary`` into its own folder of ``sink_path``.

    A micro-batch that is retried after a failure overwrites its folder ``batch_id=n``, so no
    record is written twice; reading ``sink_path`` gives ``batch_id`` as a column.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        encode_corpus(batch, dictionary).write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")

    writer = (tokens.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
