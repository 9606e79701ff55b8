"""Exact set-similarity joins: filters, verification and components shared by the near-duplicate operators.

Sets are arrays of 64-bit token hashes. A token's place in the global order is its hash; ``rank`` is its place in the
sorted set. The similarity is given in percent, so that all bounds are integer arithmetic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, stored

WORDS = 4  # a bitmap has 64 * WORDS bits unless said otherwise


def enough(overlap: Column, n: Column, m: Column, percent: int) -> Column:
    """100 * overlap >= percent * union."""
    return overlap * (100 + percent) >= F.lit(percent) * (n + m)


def may_match(a: str, b: str, percent: int, words: int = WORDS) -> Column:
    """Length, positional and bitmap filters for two aliased rows with ``n``, ``rank`` and ``bits``; none loses a match.

    Bit i of a bitmap is the parity of the tokens that hash to i, so sets that differ in d tokens differ in at most d
    bits.
    """
    col = lambda side, name: F.col(f"{side}.{name}")
    n, m, i, j = col(a, "n"), col(b, "n"), col(a, "rank"), col(b, "rank")
    length = (n * 100 >= m * percent) & (m * 100 >= n * percent)
    position = enough(1 + F.least(i, j) + F.least(n - i, m - j) - 1, n, m, percent)
    differing = reduce(lambda x, y: x + y, [
        F.bit_count(F.get(col(a, "bits"), F.lit(w)).bitwiseXOR(F.get(col(b, "bits"), F.lit(w)))) for w in range(words)])
    return length & position & enough(F.floor((n + m - differing) / 2), n, m, percent)


def large_from(percent: int) -> int:
    """Size from which sets are indexed by neighbours: beyond it sets that differ in half of a bitmap may still be similar."""
    return 12 * WORDS * (100 + percent) // (100 - percent) if 60 <= percent < 100 else 1 << 62


def index_signatures(reps: DataFrame, pair_from: int, triple_from: int, broadcast_rows: int, percent: int) -> DataFrame:
    """(sig, node, n, rank, bits) from rows of (node, n, zone, near, bits); ``zone`` is a prefix, extended by three tokens.

    Tokens of one set are dropped. The others fall into classes by their number of sets: up to ``pair_from`` a token is a
    signature by itself, up to ``triple_from`` pairs of such tokens are, above that triples. The prefix of length p
    leaves at most p - 1 tokens unmatched, the extension by three keeps four tokens in common, hence one single, pair or
    triple whatever the classes are. A link of fewer than four common tokens joins two sets of which ``percent`` is fewer
    than four (possible below 80 percent); such sets have each of their tokens as a signature besides. What is in ``near``
    is a signature as it is, where two sets have it.
    """
    entries = reps.select("node", "n", F.posexplode("zone").alias("rank", "token"))
    shared = stored(entries.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"))

    def few(counted: DataFrame) -> DataFrame:
        return F.broadcast(counted) if counted.count() <= broadcast_rows else counted  # else both sides are shuffled

    own = (entries.join(few(shared), "token").groupBy("node")
           .agg(F.sort_array(F.collect_list(F.struct("rank", "token", "df"))).alias("own"), F.first("n").alias("n")))

    def of_class(low: int, high: int | None) -> Column:
        return F.filter("own", lambda e: (e["df"] > low) & (F.lit(True) if high is None else e["df"] <= high))

    def sig(first: Column, *tokens: Column) -> Column:
        value = tokens[0] if len(tokens) == 1 else F.xxhash64(*tokens, F.lit(len(tokens)))
        return F.struct(value.alias("sig"), first["rank"].alias("rank"))

    def later(of: Column, i: Column) -> Column:
        return F.slice(of, i + 2, F.size(of))

    few_common = F.col("n") * percent <= 300
    single = F.transform(F.filter("own", lambda e: few_common | (e["df"] <= pair_from)), lambda e: sig(e, e["token"]))
    two, three = F.col("two"), F.col("three")
    pairs = F.flatten(F.transform(two, lambda a, i: F.transform(later(two, i), lambda b: sig(a, a["token"], b["token"]))))
    triples = F.flatten(F.transform(three, lambda a, i: F.flatten(F.transform(later(three, i), lambda b, k: F.transform(
        later(three, i + k + 1), lambda c: sig(a, a["token"], b["token"], c["token"]))))))
    sigs = own.select("node", single.alias("single"), of_class(pair_from, triple_from).alias("two"),
                      of_class(triple_from, None).alias("three")).select("node", F.concat("single", pairs, triples).alias("sigs"))
    exploded = sigs.select("node", F.explode("sigs").alias("s")).select("node", "s.sig", "s.rank")
    near = reps.select("node", F.posexplode("near").alias("rank", "sig"))
    again = stored(near.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").select("sig"))
    exploded = exploded.unionByName(near.join(few(again), "sig"))
    index = stored(exploded.join(reps.select("node", "n", "bits"), "node").select("sig", "node", "n", "rank", "bits"))
    release(shared, again)
    return index


def pivot_pairs(index: DataFrame, percent: int) -> DataFrame:
    """(a, b): each set with the first set of each of its buckets; linear in the index."""
    first = index.groupBy("sig").agg(F.min_by(F.struct("node", "n", "rank", "bits"), "node").alias("p"), F.count(F.lit(1)).alias("k"))
    first = first.filter("k > 1").select("sig", "p.*")
    joined = index.alias("a").join(first.alias("b"), (F.col("a.sig") == F.col("b.sig")) & (F.col("a.node") != F.col("b.node"))
                                   & may_match("a", "b", percent))
    return joined.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def bucket_pairs(index: DataFrame, percent: int, apart: str) -> DataFrame:
    """(a, b): all pairs of a bucket that pass the filters and differ in the column ``apart``.

    The filters are part of the join's condition, so only pairs that may match become rows.
    """
    joined = index.alias("a").join(index.alias("b"), (F.col("a.sig") == F.col("b.sig")) & (F.col("a.node") < F.col("b.node"))
                                   & (F.col(f"a.{apart}") != F.col(f"b.{apart}")) & may_match("a", "b", percent))
    return joined.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets (node, n, tokens, sketch) are similar enough.

    The sketches, wide bitmaps of a fixed size, rule out most pairs of large sets before the sets are sent. A node may
    have several rows.
    """
    def side(of: str, node: str) -> DataFrame:
        return sets.select(F.col("node").alias(node), F.col("n").alias(f"n_{node}"), F.col(of).alias(f"{of}_{node}"))

    differing = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    likely = (pairs.join(side("sketch", "a"), "a").join(side("sketch", "b"), "b")
              .filter(enough(F.floor((F.col("n_a") + F.col("n_b") - differing) / 2), F.col("n_a"), F.col("n_b"), percent)).select("a", "b"))
    overlap = F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long")
    return (likely.join(side("tokens", "a"), "a").join(side("tokens", "b"), "b")
            .filter(enough(overlap, F.col("n_a"), F.col("n_b"), percent)).select("a", "b").distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every linked node: the smallest node reachable, by least neighbours and pointer jumping."""
    edges = links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").distinct().checkpoint()
    labels = edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label")).checkpoint()
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near")))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = lower.select(F.col("node").alias("new"), F.col("new").alias("far"))
        after = lower.join(jump, "new").select("node", "label", F.least("new", "far").alias("to")).checkpoint()
        changed = not after.filter("label != to").isEmpty()
        labels = after.select("node", F.col("to").alias("label"))
        if not changed:
            return labels
