"""Benchmark decontamination with a BM25 index of the test items and block-max WAND.

The test items are the indexed documents, every passage of the training texts is a query. A passage is a window of twice
the longest item's words, and windows start at every such half, so that any item stands whole in one passage. Scores are
divided by the score an item gives its own words, so one threshold serves all items. Postings are sorted by item and cut
into blocks with their greatest weight; WAND skips items whose blocks cannot reach the threshold, and passages whose
essential terms cannot bring what the frequent ones leave open are never evaluated. Everything at or above the threshold is retrieved and
verified: enough of the question's and of the answer's word pairs must stand in the passage. The answer is the last third of an item
(or what follows an ``Answer:``).

The index is broadcast in shards of at most ``shard_chars`` characters of item text; more items mean more passes over the
texts, not a larger broadcast. Mean length and window come from all items, so shards do not change a result. A document
is removed by its id, null being an id like others, and the hash of its text. Null or empty texts and items match nothing, repeated rows are reported once per id and
item, empty tables give no pairs, and only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.session import ensure_checkpoint_dir

from .common import text_or_empty

# Lower-case runs of ASCII letters, digits, underscores and characters above U+007F, as UTF-8: other bytes part words.
PARTING = bytes(b if b >= 0x80 or chr(b).isalnum() or b == 0x5F else 0x20 for b in range(256))
PAIRS = "doc_id long, h long, item_id long, score double, question_overlap double, answer_overlap double"
BLOCK = 16


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8").translate(PARTING).split()


def parts(item: str) -> tuple[list[bytes], list[bytes]]:
    """Words of the question and of the answer."""
    asked, mark, answered = re.split(r"(?i)(\banswer\s*:)", item, maxsplit=1) if re.search(r"(?i)\banswer\s*:", item) else (item, "", "")
    if mark and words_of(answered):
        return words_of(asked), words_of(answered)
    words = words_of(item)
    at = len(words) - len(words) // 3
    return words[:at], words[at:]


def share(part: list[bytes], passage: set[tuple[bytes, bytes]], alone: set[bytes]) -> float:
    """How much of the part's word pairs (its one word) stands in the passage; 1 for an empty part."""
    pairs = set(zip(part, part[1:]))
    if pairs:
        return len(pairs & passage) / len(pairs)
    return float(set(part) <= alone)


class Index:
    """Postings of one shard, with BM25 weights relative to the item's score for its own words."""

    def __init__(self, items: list[tuple[int, str]], df: dict[bytes, int], n_items: int, mean: float, k1: float = 1.2, b: float = 0.75):
        self.ids = [i for i, t in items if words_of(t)]
        texts = [t for _, t in items if words_of(t)]
        self.parts = [parts(t) for t in texts]
        self.longest = max((len(words_of(t)) for t in texts), default=0)
        postings: dict[bytes, list[tuple[int, float]]] = {}
        for at, text in enumerate(texts):
            words = words_of(text)
            norm = k1 * (1 - b + b * len(words) / mean)
            weights = {w: log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * tf * (k1 + 1) / (tf + norm) for w, tf in Counter(words).items()}
            own = sum(weights.values())
            for w, x in weights.items():
                postings.setdefault(w, []).append((at, x / own))
        self.postings = {w: ([p for p, _ in ps], [x for _, x in ps]) for w, ps in postings.items()}
        self.most = {w: max(xs) for w, (_, xs) in self.postings.items()}
        self.blocks = {w: [max(xs[i:i + BLOCK]) for i in range(0, len(xs), BLOCK)] for w, (_, xs) in self.postings.items()}

    def essential(self, threshold: float, frequency: dict[bytes, int]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Essential postings: of each item the terms rarest in the texts, until the others give at most half the threshold.

        Returns (place of each essential term, where its postings begin, items, weights, what an item needs from its
        essential terms): a passage that scores the threshold has at least the needed sum for that item.
        """
        of: list[list[tuple[int, bytes, float]]] = [[] for _ in self.ids]
        for w, (ids, weights) in self.postings.items():
            for item, x in zip(ids, weights):
                of[item].append((frequency.get(w, 0), w, x))
        chosen: dict[bytes, list[tuple[int, float]]] = {}
        needed = np.zeros(len(self.ids))
        for item, terms in enumerate(of):
            left = sum(x for _, _, x in terms)
            for _, w, x in sorted(terms):
                if left <= threshold / 2:
                    break
                chosen.setdefault(w, []).append((item, x))
                left -= x
            needed[item] = threshold - left - 1e-9
        flat = [p for ps in chosen.values() for p in ps]
        begins = np.cumsum([0, *map(len, chosen.values())])
        return ({w: i for i, w in enumerate(chosen)}, begins, np.array([i for i, _ in flat], np.int64),
                np.array([x for _, x in flat], float), needed)

    def retrieve(self, terms: list[bytes], threshold: float) -> list[tuple[int, float]]:
        """All (place of item, score) at or above the threshold, by block-max WAND over the terms' postings."""
        slack = threshold - 1e-9
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]
        out = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += self.most[c[2]]
                if bound >= slack:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            ahead, limit = 0.0, None
            for c in cursors[:pivot + 1]:
                ids = self.postings[c[2]][0]
                at = self._seek(ids, c[1], item)
                if at < len(ids):
                    block = at // BLOCK
                    ahead += self.blocks[c[2]][block]
                    last = ids[min(len(ids), (block + 1) * BLOCK) - 1]
                    limit = last if limit is None else min(limit, last)
            if ahead < slack:  # no item up to the end of these blocks can reach the threshold
                goal = item + 1 if limit is None else limit + 1
                if pivot + 1 < len(cursors):
                    goal = min(goal, cursors[pivot + 1][0])
                self._advance(cursors, pivot + 1, goal)
                continue
            if cursors[0][0] == item:
                score = 0.0
                for c in cursors[:pivot + 1]:
                    score += self.postings[c[2]][1][c[1]]
                if score >= slack:
                    out.append((item, score))
                self._advance(cursors, pivot + 1, item + 1)
            else:
                self._advance(cursors, pivot, item)
        return out

    @staticmethod
    def _seek(ids: list[int], at: int, goal: int) -> int:
        while at < len(ids) and ids[at] < goal:
            at += 1
        return at

    def _advance(self, cursors: list[list], n: int, goal: int) -> None:
        for c in cursors[:n]:
            ids = self.postings[c[2]][0]
            c[1] = self._seek(ids, c[1], goal)
            c[0] = ids[c[1]] if c[1] < len(ids) else None
        cursors[:] = [c for c in cursors if c[0] is not None]


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [w for t in batch.column(0).to_pylist() for w in sorted(set(words_of(t)))]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary())], names=["w"])


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [len(words_of(t)) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=["n"])


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.5, question_share: float = 0.6, answer_share: float = 0.6,
               shard_chars: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): the best verified passage of each document and item.

    ``items`` has ``item_id`` and ``text``.
    """
    pairs = _leaks(docs, items, threshold, question_share, answer_share, shard_chars, id_col, text_col)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap"))
    return pairs.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def _leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.5, question_share: float = 0.6, answer_share: float = 0.6,
           shard_chars: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every verified passage, with the id and a hash of the text of its document."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("h"),
                       text_or_empty(text_col).alias("text"))
    test = items.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).filter("text != ''")
    size = test.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, ceil(size / shard_chars))
    found = []
    counts = test.select("text").mapInArrow(_distinct_words, "w binary").groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    lengths = test.select("text").mapInArrow(_lengths, "n long")
    n_items, total, longest = lengths.agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first()
    mean = (total or 0) / max(1, n_items) or 1.0
    for shard in range(shards):
        part = test.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        own = [(r["item_id"], r["text"]) for r in part.collect()]  # at most about shard_chars characters
        words = spark.createDataFrame([(w,) for w in {w for _, t in own for w in words_of(t)}] or [(b"",)], "w binary")
        df = {bytes(r["w"]): r["df"] for r in counts.join(F.broadcast(words), "w").collect()}
        index = Index(own, df, max(n_items, 1), mean)
        index.longest = longest or 0
        found.append(_query(rows, index, term_frequency(rows, list(index.postings)), threshold, question_share, answer_share))
    return reduce(DataFrame.unionByName, found)


def term_frequency(rows: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """How often each of the index's terms stands in all texts."""
    shared = rows.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, total = shared.value, np.zeros(len(shared.value) + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                at = np.fromiter(map(places.get, words, repeat(len(places))), np.int64, len(words))
                total += np.bincount(at, minlength=len(total))
        seen = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["term", "n"])

    counted = rows.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {terms[r["term"]]: r["n"] for r in counted.collect()}  # at most one row for each term of the shard


def _query(rows: DataFrame, index: Index, frequency: dict[bytes, int], threshold: float, question_share: float,
           answer_share: float) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((index, index.essential(threshold, frequency)))

    def windows(words: list[bytes], step: int, places: dict, begins: np.ndarray, posted: np.ndarray, weight: np.ndarray,
                needed: np.ndarray) -> np.ndarray:
        """The windows, numbered by their first half, whose essential terms suffice for some item."""
        at = np.fromiter(map(places.get, words, repeat(-1)), np.int64, len(words))
        hits = np.flatnonzero(at >= 0)
        if not len(hits):
            return hits
        low = begins[at[hits]]
        many = begins[at[hits] + 1] - low
        each = np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)
        half, items, weights = np.repeat(hits // step, many), posted[each], weight[each]
        halves = int(half[-1]) + 1
        keys, where = np.unique(items * (halves + 1) + half, return_inverse=True)
        sums = np.bincount(where, weights)
        # a window is a half and the next one: add to each half what the item has in the following half, and alike before
        after = np.searchsorted(keys, keys + 1)
        both = sums + np.where((after < len(keys)) & (keys[np.minimum(after, len(keys) - 1)] == keys + 1), sums[np.minimum(after, len(keys) - 1)], 0.0)
        enough = both >= needed[keys // (halves + 1)]
        alone = sums >= needed[keys // (halves + 1)]
        first = keys % (halves + 1)
        return np.unique(np.concatenate([first[enough], np.maximum(first[alone] - 1, 0)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, essential = shared.value
        step, most = max(1, ix.longest), ix.most
        for batch in batches:
            out: list[tuple] = []
            for doc, h, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                for i in windows(words, step, *essential):
                    passage = words[i * step:(i + 2) * step]
                    terms = [w for w in dict.fromkeys(passage) if w in most]
                    hits = ix.retrieve(terms, threshold)
                    if not hits:
                        continue
                    pairs, alone = set(zip(passage, passage[1:])), set(passage)
                    for item, score in hits:
                        asked, answered = (share(p, pairs, alone) for p in ix.parts[item])
                        if asked >= question_share and answered >= answer_share:
                            out.append((doc, h, ix.ids[item], score, asked, answered))
            cols = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)],
                                             names=[f.split()[0] for f in PAIRS.split(", ")])

    return rows.mapInArrow(run, PAIRS)


def remove_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", broadcast_rows: int = 1_000_000, text_col: str = "text",
                 **options) -> DataFrame:
    """``docs`` without the documents in which a test item was verified."""
    leaked = (_leaks(docs, items, id_col=id_col, text_col=text_col, **options)
              .select(F.col("doc_id").alias("_leaked"), F.col("h").alias("_h")).distinct().checkpoint())
    some = F.broadcast(leaked) if leaked.count() <= broadcast_rows else leaked
    same = (F.xxhash64(docs[text_col]) == some["_h"]) & docs[id_col].cast("long").eqNullSafe(some["_leaked"])
    return docs.join(some, same, "left_anti")
