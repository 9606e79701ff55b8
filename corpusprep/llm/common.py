"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.session import ensure_checkpoint_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other code point unchanged."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores in front as no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a Parquet table in the shared checkpoint folder and read again: lineage ends, columns stay apart."""
    # Shuffle files live until the driver's collector finds their plan unused; between two tables it is asked to look.
    df.sparkSession._jvm.System.gc()
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``stored`` that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class BoundedCache(dict):
    """``cache[key]`` computes a missing value with ``make``; holds two generations of at most ``limit`` entries each.

    ``map(cache.__getitem__, keys)`` runs at C speed for keys already present.
    """

    def __init__(self, make, limit: int = 1 << 17):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        if len(key) <= 256:  # one very long word must not stay in memory
            self[key] = value
        return value
