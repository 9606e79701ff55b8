"""Line dedup as an exact set-similarity join, in DataFrame functions only.

A line's tokens are its distinct shingles of five words (lower-cased, between white space), hashed to 64 bits. A line of
at least five words is removed if an earlier one, in order of (document id, line number), has the same words or a
Jaccard similarity of ``percent`` or more; whether the earlier line is itself removed doesn't matter, so the result
does not depend on the order of work. With ``short_lines`` a shorter line has one token, its whole words, and is removed
if an earlier line has the same words; without it shorter lines stay. Blank lines stay.

1. Lines with equal words become one line at its first place.
2. Reduction: similar lines share one of their n - ceil(t n) + 1 lowest hashes; lines that share none have no match.
3. The tokens of the lines left are counted and ordered by rarity. Prefixes in this order are indexed; pairs of a bucket
   pass length, positional and bitmap filters in the join's condition and are verified on the whole sets. Each line meets
   the first line of its buckets before the lines not yet removed meet all earlier ones.

Null text is kept as it is. Rows repeated under one id with equal text count as one document, so each keeps the same
lines; a null id sorts first. Other columns are kept, an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.session import ensure_checkpoint_dir

from .common import free_name, release, stored
from .setjoin import enough, may_match

WHITE = r"[\x20\x09-\x0D]+"
BITMAP_WORDS = 2


def shingles(norm: Column, k: int) -> Column:
    """Sorted distinct hashes of the word shingles of a text whose words are parted by single spaces."""
    words = F.transform(F.split(norm, " "), lambda w: F.xxhash64(w))
    # the hashed words stand in a one-element array, so that each word is hashed once and not for each shingle
    windows = F.get(F.transform(F.array(words), lambda w: F.transform(
        F.slice(w, F.lit(1), F.size(w) - (k - 1)), lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, k)]))), F.lit(0))
    return F.sort_array(F.array_distinct(windows))


def bitmap(tokens: Column) -> Column:
    def part(w: int) -> Column:
        return F.aggregate(tokens, F.lit(0).cast("long"), lambda bits, h: F.when(
            h.bitwiseAND(F.lit(1)) == w, bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 1).bitwiseAND(F.lit(63)).cast("int")))
        ).otherwise(bits))
    return F.array(*[part(w) for w in range(BITMAP_WORDS)])


def has_words(norm: Column, n: int) -> Column:
    return F.substring_index(norm, " ", n - 1) != norm  # n - 1 spaces or more


def lines_of(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(pos, key, norm): place, words as 128-bit hash, and words of every line of at least ``min_words`` words."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"), F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))
    line = F.lower("line")
    uneven = reduce(lambda a, b: a | b, [F.contains("line", F.lit(x)) for x in ("  ", "\t", "\r", "\v", "\f")])
    norm = F.trim(F.when(uneven, F.regexp_replace(line, WHITE, " ")).otherwise(line))
    rows = rows.select(F.struct("doc_id", "h", "line_no").alias("pos"), norm.alias("norm"))
    rows = rows.filter(has_words(F.col("norm"), min_words) if min_words > 1 else F.col("norm") != "")
    return rows.select("pos", F.struct(F.xxhash64("norm").alias("k1"), F.xxhash64("norm", F.lit(1)).alias("k2")).alias("key"), "norm")


def sets_to_compare(lines: DataFrame, shingle: int, percent: int, broadcast_rows: int) -> tuple[DataFrame, DataFrame]:
    """Token sets and (key, line) of those distinct lines (key, pos, norm) that share one of their lowest hashes with another."""
    tokens = shingles(F.col("norm"), shingle)
    ceil = F.floor((F.size("tokens") * percent + 99) / 100).cast("int")
    # Numbers stand for the keys from here on: rows of tokens are most of what is shuffled.
    lowest = stored(lines.select("key", F.monotonically_increasing_id().alias("line"), tokens.alias("tokens"))
                    .select("key", "line", F.slice("tokens", 1, F.size("tokens") - ceil + 1).alias("zone")))
    entries = lowest.select("line", F.explode("zone").alias("token"))
    shared = entries.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").select("token")  # a line has a token once
    left = stored(lowest.select("key", "line").join(entries.join(shared, "token").select("line").distinct(), "line", "left_semi"))
    release(lowest)
    some = F.broadcast(left) if left.count() <= broadcast_rows else left
    sets = stored(lines.join(some, "key").select("line", "pos", tokens.alias("tokens"))
                  .withColumns({"n": F.size("tokens").cast("long"), "bits": bitmap(F.col("tokens"))}))
    return sets, left


def later_lines(sets: DataFrame, left: DataFrame, percent: int) -> DataFrame:
    """The keys of the lines that are similar to a line at an earlier place; both tables are released."""
    # Order by rarity: tokens of one line come first, then the shared ones by count and hash.
    each = sets.select("line", F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # Sent by line before they are collected: lists of one token each would be longer than the rows.
    ordered = (each.join(counts, "token").select("line", "df", "token").repartition("line")
               .groupBy("line").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("own")))
    prefix = F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1
    index = (sets.select("line", "pos", "n", "bits").join(ordered, "line")
             .select("line", "pos", "n", "bits", prefix.alias("p"), (F.col("n") - F.size("own")).alias("alone"), F.posexplode("own").alias("i", "t"))
             .withColumn("rank", F.col("alone") + F.col("i")).filter(F.col("rank") < F.col("p"))
             .select(F.col("t.token").alias("sig"), "line", "pos", "n", "rank", "bits"))
    index = stored(index)
    first = index.groupBy("sig").agg(F.min_by(F.struct("line", "pos", "n", "rank", "bits"), "pos").alias("f"), F.count(F.lit(1)).alias("k"))
    first = first.filter("k > 1").select("sig", "f.*")
    x, y = sets.select(F.col("line").alias("a"), F.col("tokens").alias("x")), sets.select(F.col("line").alias("b"), F.col("tokens").alias("y"))

    def similar(later: DataFrame, earlier: DataFrame) -> DataFrame:
        pairs = later.alias("a").join(earlier.alias("b"), (F.col("a.sig") == F.col("b.sig")) & (F.col("b.pos") < F.col("a.pos"))
                                      & may_match("a", "b", percent, BITMAP_WORDS))
        # stored, so that the shuffled index leaves the disk before the sets are sent
        pairs = stored(pairs.select(F.col("a.line").alias("a"), F.col("b.line").alias("b")).distinct())
        overlap = F.size(F.array_intersect("x", "y")).cast("long")
        found = stored(pairs.join(x, "a").join(y, "b").filter(enough(overlap, F.size("x"), F.size("y"), percent)).select(F.col("a").alias("line")).distinct())
        release(pairs)
        return found

    removed = similar(index, first)
    rest = index.join(removed, "line", "left_anti")
    more = similar(rest, index)
    release(index, sets)
    keys = stored(left.join(removed.union(more), "line", "left_semi").select("key"))
    release(left, removed, more)
    return keys


def dedup_lines(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                broadcast_rows: int = 200_000, short_lines: bool = False) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, and ``n_removed_lines``."""
    ensure_checkpoint_dir(docs.sparkSession)
    lines = lines_of(docs, id_col, text_col, 1 if short_lines else shingle)
    distinct = stored(lines.groupBy("key").agg(F.min("pos").alias("pos"), F.first("norm").alias("norm"), F.count(F.lit(1)).alias("copies")))
    places = stored(distinct.select("key", F.col("pos").alias("first"), "copies"))
    sets, left = sets_to_compare(distinct.filter(has_words(F.col("norm"), shingle)).select("key", "pos", "norm"), shingle, percent, broadcast_rows)
    release(distinct)  # the words of the lines take most of the disk
    later = later_lines(sets, left, percent).withColumn("gone", F.lit(True))
    verdict = places.join(later, "key", "left").filter("gone OR copies > 1")
    hit = (lines.select("key", "pos").join(verdict, "key").filter(F.col("gone").isNotNull() | (F.col("pos") != F.col("first"))))
    by_doc = stored(hit.groupBy("pos.doc_id", "pos.h").agg(F.collect_set("pos.line_no").alias("removed")))
    own = free_name(docs, "lines")  # one column under a name that the input doesn't use
    by_doc_lines = by_doc.select(F.struct("doc_id", "h", "removed").alias(own))
    small = F.broadcast(by_doc_lines) if by_doc.count() <= broadcast_rows else by_doc_lines
    text, removed = docs[text_col], F.col(own)["removed"]
    joined = docs.join(small, (F.xxhash64(text) == F.col(own)["h"]) & docs[id_col].eqNullSafe(F.col(own)["doc_id"]), "left")
    text = F.col(text_col)
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains(removed, i)), "\n")
    return joined.withColumns({
        text_col: F.when(removed.isNull(), text).otherwise(kept),
        "n_removed_lines": F.coalesce(F.size(removed), F.lit(0)).cast("long")}).drop(own)
