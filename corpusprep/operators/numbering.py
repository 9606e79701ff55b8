"""Contiguous numbering of a sorted key without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.session import ensure_checkpoint_dir


def dense_number(df: DataFrame, key: str, start: int = 0, out: str = "idx", partitions: int | None = None,
                 checkpoint: bool = True) -> DataFrame:
    """Number the rows of ``df`` by ``key`` ascending as ``start, start+1, ...``.

    ``key`` must be unique. A global ``row_number()`` window sorts everything in one task;
    instead the rows are range-partitioned on ``key`` and sorted inside each partition, each
    row takes its position inside the partition, and a per-partition offset (one row per
    partition, so a table of bounded size that is safe to broadcast) is added.

    The range-partitioned rows are checkpointed to the session's checkpoint folder, so the
    offsets and the positions come from one materialisation, and a lost executor does not
    recompute a different layout.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, F.col(key))
              .sortWithinPartitions(F.col(key))
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_row", F.monotonically_increasing_id()))
    if checkpoint:
        ensure_checkpoint_dir(spark)
        ranged = ranged.checkpoint(eager=True)
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    offsets = sizes.select(
        "_part", "_first",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    numbered = ranged.join(F.broadcast(offsets), "_part")
    idx = F.coalesce(F.col("_before"), F.lit(0)) + (F.col("_row") - F.col("_first")) + F.lit(start)
    return numbered.withColumn(out, idx.cast("int")).drop("_part", "_row", "_first", "_before")
