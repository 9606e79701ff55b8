"""N-gram Jaccard join by token-combination prefixes.

Tokens are word shingles, hashed to 64 bits; the hash is the global order. Texts with equal sets are one node. A node's
prefix (its lowest n - ceil(t n) + 1 tokens, extended by three) is indexed: rare tokens singly, frequent ones as pairs,
very frequent ones as triples, so that a passage shared by many texts does not bring all of them together. Large sets, which
share single tokens by chance and are too large for the bitmaps, have pairs of neighbours of a longer prefix instead.
Candidates of a bucket pass length, positional and bitmap filters inside the join and are verified on the whole sets.

Two rounds keep large groups of copies linear: first every node meets the first node of each of its buckets; links join
nodes to components; then only pairs from different components are looked at. Every link between different components
is found, so the components are exact.

Null or empty texts have no shingle and link with nothing; fewer words than a shingle form one token; repeated rows and
equal texts share a component; a null id takes part without naming a component; an empty table gives an empty table.
Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.session import ensure_checkpoint_dir

from . import setjoin
from .common import BoundedCache, free_name, release, stored, text_or_empty

ODD = 0x9E3779B97F4A7C15
SKETCH_BITS = 8192


class Shingler:
    """Sorted distinct hashes of a text's word shingles (words between ASCII white space, A-Z lower-cased)."""

    def __init__(self, k: int):
        self.k = k
        self.factors = [np.uint64(pow(ODD, i + 1, 1 << 64)) for i in range(k)]
        self.words = BoundedCache(xxhash.xxh3_64_intdigest)

    def tokens(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII letters and white space only
        if not words:
            return np.empty(0, np.int64)
        w = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        k = min(self.k, len(w))
        h = np.full(len(w) - k + 1, k, np.uint64)  # a short text's token differs from every whole shingle
        with np.errstate(over="ignore"):
            for i in range(k):
                h += w[i:len(w) - k + 1 + i] * self.factors[i]
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return np.unique((h ^ (h >> np.uint64(31))).view(np.int64))


def node_of(tokens: np.ndarray) -> int:
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def bitmap(tokens: np.ndarray, bits: int = 64 * setjoin.WORDS) -> np.ndarray:
    odd = np.bincount((tokens >> 7) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def neighbours(tokens: np.ndarray, percent: int) -> np.ndarray:
    """A hash for each two tokens that follow each other in the prefix that similar sets need to have one in common.

    Let A have x tokens that B lacks and B y that A lacks. Of the gaps between the common tokens at most x + y hold another
    token, so one of the first x + y + 1 is free: its two tokens are neighbours in both sets, the second at place
    2x + y + 2 of A at most. As x <= (1 - t) n - t y, that is no more than 2 (1 - t) n + 2 for t >= 1/2.
    """
    z = tokens[:len(tokens) * (100 - percent) // 50 + 2].view(np.uint64)
    return (z[:-1] * np.uint64(ODD) + (z[1:] ^ (z[1:] >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = pa.array([0, *accumulate(map(len, arrays))], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))


def _sets(docs: DataFrame, k: int, percent: int, whole: bool) -> DataFrame:
    """(doc_id, h, node, n) of rows (doc_id, text, h), with ``tokens`` and ``sketch``, or with ``zone``, ``near`` and ``bits``.

    ``zone`` is the prefix of a small set, ``near`` the neighbours of a large one; sets that may be similar to both have both.
    """
    large = setjoin.large_from(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(k)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingler.tokens(t) for t in part.column(1).to_pylist()]
                cols = [part.column(0), part.column(2), pa.array([node_of(s) for s in sets], pa.int64()), pa.array(list(map(len, sets)), pa.int64())]
                if whole:
                    yield pa.RecordBatch.from_arrays([*cols, _lists(sets), _lists([bitmap(s, SKETCH_BITS) for s in sets])],
                                                     names=["doc_id", "h", "node", "n", "tokens", "sketch"])
                    continue
                zones = [s[:len(s) - -(-len(s) * percent // 100) + 4] if len(s) * (100 - percent) >= percent and len(s) < large else s[:0] for s in sets]
                near = [neighbours(s, percent) if len(s) * 100 >= large * percent else s[:0] for s in sets]
                yield pa.RecordBatch.from_arrays([*cols, _lists(zones), _lists(near), _lists([bitmap(s) for s in sets])],
                                                 names=["doc_id", "h", "node", "n", "zone", "near", "bits"])

    extra = "tokens array<long>, sketch array<long>" if whole else "zone array<long>, near array<long>, bits array<long>"
    return docs.mapInArrow(run, f"doc_id long, h long, node long, n long, {extra}")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))


def _labelled(rows: DataFrame, shingle: int, percent: int, pair_from: int, triple_from: int, broadcast_rows: int) -> DataFrame:
    """(doc_id, h, node, n, label) of rows (doc_id, text, h): ``label`` is the smallest node that links lead to, null without words."""
    ensure_checkpoint_dir(rows.sparkSession)
    sets = stored(_sets(rows, shingle, percent, whole=False))
    # Sets too small to have a similar but different partner have an empty prefix.
    reps = stored(sets.filter((F.size("zone") > 0) | (F.size("near") > 0)).groupBy("node")
                  .agg(*[F.first(c).alias(c) for c in ("n", "zone", "near", "bits")]))
    index = setjoin.index_signatures(reps, pair_from, triple_from, broadcast_rows, percent)
    nodes_of = stored(sets.select("doc_id", "h", "node", "n"))
    release(reps, sets)
    ids = nodes_of.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"))

    def links(pairs: DataFrame) -> DataFrame:
        pairs = pairs.checkpoint()
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().checkpoint()
        chosen = nodes.join(ids, "node").select("first").distinct()
        if nodes.count() <= broadcast_rows:
            chosen, nodes = F.broadcast(chosen), F.broadcast(nodes)
        texts = rows.join(chosen, rows["doc_id"].eqNullSafe(chosen["first"]), "left_semi")
        whole = stored(_sets(texts, shingle, percent, whole=True).join(nodes, "node", "left_semi").drop("doc_id", "h"))
        found = setjoin.verify(pairs, whole, percent).checkpoint()
        release(whole)
        return found

    near = links(setjoin.pivot_pairs(index, percent))
    first = setjoin.components(near)
    apart = index.join(first, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rest = links(setjoin.bucket_pairs(apart, percent, "label"))
    release(index)
    labels = first if rest.isEmpty() else setjoin.components(near.union(rest))
    own = F.when(F.col("n") > 0, F.coalesce("label", "node"))
    return nodes_of.join(labels, "node", "left").select("doc_id", "h", "node", "n", own.alias("label"))


def jaccard_components(docs: DataFrame, shingle: int = 5, percent: int = 80, pair_from: int = 4096, triple_from: int = 32768,
                       id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the smallest id reachable by links of ``percent`` or more."""
    found = _labelled(_rows(docs, id_col, text_col), shingle, percent, pair_from, triple_from, broadcast_rows)
    # First by node, so that a large component is one row for each distinct text before its smallest id is looked for.
    by_node = found.filter("n > 0").groupBy("node", "label").agg(F.min("doc_id").alias("first"))
    least = by_node.groupBy("label").agg(F.min("first").alias("component_id"))
    named = by_node.join(least, "label").select("node", "component_id")
    return (found.select("doc_id", "node", F.col("n").alias("n_shingles")).join(named, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, pair_from: int = 4096, triple_from: int = 32768,
             id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 1_000_000) -> DataFrame:
    """``docs`` with one row of each group of similar texts, that of the smallest id (null last, then by text hash).

    A row is known by its id and text, so another text under the same id stays unless its own group has an earlier row. Rows
    without words stay; of rows equal in id and text one stays.
    """
    found = stored(_labelled(_rows(docs, id_col, text_col), shingle, percent, pair_from, triple_from, broadcast_rows))
    per_text = found.filter("n > 0").groupBy("label", "doc_id", "h").agg(F.count(F.lit(1)).alias("copies"))
    first = per_text.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "copies")).alias("p"))
    first = stored(first.select("label", "p.doc_id", "p.h", "p.copies"))
    later = per_text.select("doc_id", "h").exceptAll(first.select("doc_id", "h"))
    again = first.filter("copies > 1").select("doc_id", "h")
    gone = stored(later.unionByName(again))
    own = free_name(docs, "row")

    def same(listed: DataFrame) -> tuple[DataFrame, Column]:
        listed = listed.select(F.struct("doc_id", "h").alias(own))
        if listed.count() <= broadcast_rows:
            listed = F.broadcast(listed)
        return listed, docs[id_col].cast("long").eqNullSafe(listed[own]["doc_id"]) & (F.xxhash64(text_or_empty(text_col)) == listed[own]["h"])

    kept = docs.join(*same(gone), "left_anti")
    return kept.unionByName(docs.join(*same(again), "left_semi").dropDuplicates([id_col, text_col]))
