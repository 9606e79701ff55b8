"""Left lookup of a long token table against a word table (dictionary, lemma table)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tables up to this estimated size are broadcast to the lookup.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
# A table of up to so many times that size is broadcast bucket by bucket, one join after the other.
MAX_BUCKETS = 4
# Salt buckets for the shuffle-join lookup of larger tables.
SALT_BUCKETS = 16
ROW_BYTES = 48


def _extra_bytes(name: str, kind: T.DataType) -> Column:
    """Bytes of a value beyond its place in the row: characters of strings, elements of arrays."""
    if isinstance(kind, T.StringType):
        return F.coalesce(F.octet_length(name), F.lit(0)).cast("long")
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.coalesce(F.aggregate(name, F.lit(0).cast("long"), lambda n, x: n + 16 + F.coalesce(F.octet_length(x), F.lit(0))), F.lit(0).cast("long"))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType)):
        return F.greatest(F.size(name), F.lit(0)).cast("long") * 8
    if isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
        return F.lit(0).cast("long")
    raise TypeError(f"the size of column {name} of type {kind.simpleString()} isn't known")


def measured_size(table: DataFrame) -> int:
    """Estimated bytes of a table of numbers, strings and arrays of them; other types are refused."""
    extra = sum((_extra_bytes(f.name, f.dataType) for f in table.schema.fields), F.lit(0).cast("long"))
    stats = table.agg(F.count(F.lit(1)).alias("n"), F.sum(extra).alias("bytes")).first()
    return int(stats["n"] or 0) * ROW_BYTES + int(stats["bytes"] or 0)


def by_record(df: DataFrame, out: str = "_row") -> DataFrame:
    """``df`` with a record number, hash-partitioned by it: rows exploded from a record and looked up by broadcast stay in
    its partition, so that folding them back by the number needs no exchange."""
    return df.withColumn(out, F.monotonically_increasing_id()).repartition(out)


def left_lookup(long: DataFrame, table: DataFrame, left_key: str, right_key: str,
                limit_bytes: int = BROADCAST_LIMIT_BYTES, salt_buckets: int = SALT_BUCKETS,
                salt_by: list[str] | None = None) -> DataFrame:
    """``long`` left-joined with ``table`` on ``long[left_key] == table[right_key]`` (unique right keys).

    A table within ``limit_bytes`` (measured) is broadcast. One of up to ``MAX_BUCKETS`` times that size is cut into buckets
    by the key's hash, each broadcast to a join of its own, so ``long`` isn't shuffled. A larger one is joined by shuffle
    on ``(key, salt)``: each row of ``long`` takes a salt from a hash of the whole row
    (deterministic on recomputation) and the table is repeated once per salt, so a key that
    makes up a third of all rows is spread over ``salt_buckets`` partitions instead of one.
    ``salt_by`` names the columns hashed for the salt (default: all); they must differ
    between rows of one key. The right key column is dropped from the result.
    """
    size = measured_size(table)
    if size <= limit_bytes:
        return long.join(F.broadcast(table), long[left_key] == table[right_key], "left").drop(table[right_key])
    buckets = -(-size // limit_bytes) if limit_bytes else 0
    if 1 < buckets <= MAX_BUCKETS:
        return _bucket_lookup(long, table, left_key, right_key, buckets)
    if salt_buckets <= 1:
        return long.join(table, long[left_key] == table[right_key], "left").drop(table[right_key])
    salted = long.withColumn("_salt", F.pmod(F.xxhash64(*(salt_by or long.columns)), F.lit(salt_buckets)))
    copies = table.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)).cast("array<bigint>")))
    cond = (salted[left_key] == copies[right_key]) & (salted["_salt"] == copies["_s"])
    return salted.join(copies, cond, "left").drop("_salt", "_s").drop(copies[right_key])


def _bucket_lookup(long: DataFrame, table: DataFrame, left_key: str, right_key: str, buckets: int) -> DataFrame:
    """The left join, one bucket of the table after the other; a key has its row in one bucket only."""
    values = [c for c in table.columns if c != right_key]
    out = long
    for b in range(buckets):
        part = table.filter(F.pmod(F.xxhash64(right_key), F.lit(buckets)) == b).select(
            F.col(right_key).alias("_bucket_key"), F.struct(*values).alias(f"_bucket_{b}"))
        out = out.join(F.broadcast(part), F.col(left_key) == F.col("_bucket_key"), "left").drop("_bucket_key")
    hit = F.coalesce(*[F.col(f"_bucket_{b}") for b in range(buckets)])
    return out.select(*[F.col(c) for c in long.columns], *[hit[v].alias(v) for v in values])
