"""Encode token records as fixed-length id arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.text import let
from corpusprep.operators.lookup import BROADCAST_LIMIT_BYTES, SALT_BUCKETS, by_record, left_lookup
from corpusprep.operators.vectors import PAD, UNK

# Encoded lengths of ctx1, ctx2, code, query; the code cap and the code
# markers (the reference wraps code ids with 1 ... 2); constant block length and label.
LENGTHS = {"ctx1": 100, "ctx2": 100, "code": 350, "query": 25}
CODE_CAP = 348
CODE_START, CODE_END = 1, 2
BLOCK_LENGTH, LABEL = 4, 0

def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fit_length(arr, n: int, pad: int = PAD) -> Column:
    """First ``n`` ids, right-padded with ``pad``."""
    return F.slice(F.concat(_c(arr), F.array_repeat(F.lit(pad), n)), 1, n)


def text_ids(ids, unk: int = UNK) -> Column:
    """Prepend 0 when the id list is empty or starts with UNK."""
    return let(_c(ids), lambda a: F.when((F.size(a) == 0) | (F.get(a, 0) == unk),
                                         F.concat(F.array(F.lit(0)), a)).otherwise(a))


def code_ids(ids, cap: int = CODE_CAP, start: int = CODE_START, end: int = CODE_END) -> Column:
    """S83 + S39: ``[start] + first cap ids + [end]``."""
    return F.concat(F.array(F.lit(start)), F.slice(_c(ids), 1, cap), F.array(F.lit(end)))


def _packed(order: Column, idx: Column) -> Column:
    """``order * 2^32 + idx`` as a long: sorting the packed values sorts by ``order`` (ids are ints >= 0)."""
    return F.shiftleft(order.cast("long"), 32) + idx.cast("long")


def _unpacked(packed: Column) -> Column:
    return F.transform(packed, lambda x: (x % F.lit(1 << 32)).cast("int"))


def lookup_ids(tokens_long: DataFrame, dictionary: DataFrame, token: str = "token", unk: int = UNK,
               limit_bytes: int = BROADCAST_LIMIT_BYTES, salt_buckets: int = SALT_BUCKETS) -> DataFrame:
    """Add ``idx`` to a long token table; unknown tokens get ``unk``.

    The dictionary is broadcast when its measured size is within ``limit_bytes``, else joined
    by a salted shuffle (see :func:`corpusprep.operators.lookup.left_lookup`).
    """
    side = dictionary.select(F.col("word").alias("_word"), "idx")
    joined = left_lookup(tokens_long, side, token, "_word", limit_bytes, salt_buckets)
    return joined.withColumn("idx", F.coalesce(F.col("idx"), F.lit(unk)).cast("int"))


def encode_tokens(df: DataFrame, key: str, tokens: str, dictionary: DataFrame, keep: int | None = None,
                  unk: int = UNK, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``(key, ids)``: the dictionary ids of one token-array column, in token order.

    With ``keep`` only the first ``keep`` tokens are looked up (callers that truncate the
    result anyway); without it the whole array is encoded. Records are numbered before the
    explode, so a repeated ``key`` merges nothing; the input should be a stored table.
    """
    arr = F.coalesce(F.col(tokens), F.array().cast("array<string>"))
    if keep is not None:
        arr = F.slice(arr, 1, keep)
    # The records are partitioned before the explode, so the fold below needs no exchange.
    numbered = by_record(df.select(key, arr.alias("_tokens")))
    arr = F.col("_tokens")
    long = numbered.select("_row", key, F.posexplode_outer(arr).alias("pos", "token"))
    looked = lookup_ids(long, dictionary, "token", unk, limit_bytes)
    entry = F.when(F.col("token").isNotNull(), _packed(F.col("pos"), F.col("idx")))
    folded = looked.groupBy("_row", key).agg(F.sort_array(F.collect_list(entry)).alias("_e"))
    return folded.select(key, _unpacked(F.col("_e")).alias("ids"))


def encode_corpus(df: DataFrame, dictionary: DataFrame, lengths: dict | None = None, cap: int = CODE_CAP,
                  block_length: int = BLOCK_LENGTH, label: int = LABEL, unk: int = UNK,
                  limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Token records ``(qid, ctx1_tokens, ctx2_tokens, code_tokens, query_tokens)`` to id arrays.

    The four fields are stacked into one long table so a single lookup join serves all of
    them; arrays are cut to the positions that can reach the output before the explode
    (the text rule only prepends, so later tokens can never appear). The cut records are
    numbered, so records that share a ``qid`` stay apart, and partitioned by that number before
    the explode; the ids, at most 575 a record, are folded back without an exchange. The input
    should be a stored table.
    """
    n = dict(LENGTHS, **(lengths or {}))
    fields = [("ctx1", "ctx1_tokens", n["ctx1"]), ("ctx2", "ctx2_tokens", n["ctx2"]),
              ("code", "code_tokens", min(cap, n["code"])), ("query", "query_tokens", n["query"])]
    cut = df.select("qid", *[F.slice(F.coalesce(F.col(src), F.array().cast("array<string>")), 1, keep).alias(src) for _, src, keep in fields])
    stacked = by_record(cut).select("_row", "qid", F.explode(F.array(*[
        F.struct(F.lit(i).alias("field"), F.col(src).alias("toks")) for i, (_, src, _) in enumerate(fields)])).alias("f"))
    long = stacked.select("_row", "qid", F.col("f.field").alias("field"),
                          F.posexplode_outer("f.toks").alias("pos", "token"))
    looked = lookup_ids(long, dictionary, "token", unk, limit_bytes)
    # Sort key: field, then position (both small: positions are cut to at most 350 above).
    order = F.col("field") * F.lit(1 << 20) + F.col("pos")
    entry = F.when(F.col("token").isNotNull(), _packed(order, F.col("idx")))
    folded = looked.groupBy("_row", "qid").agg(F.sort_array(F.collect_list(entry)).alias("entries"))

    def ids_of(i: int) -> Column:
        lo, hi = i << 52, (i + 1) << 52
        return _unpacked(F.filter("entries", lambda e: (e >= F.lit(lo)) & (e < F.lit(hi))))

    out = [F.col("qid")]
    for i, (name, _, _) in enumerate(fields):
        ids = code_ids(ids_of(i), cap) if name == "code" else text_ids(ids_of(i), unk)
        out.append(fit_length(ids, n[name]).alias(f"{name}_ids"))
    out += [F.lit(block_length).alias("block_length"), F.lit(label).alias("label")]
    return folded.select(*out)
