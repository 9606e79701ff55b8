"""Phrase collocations by merged stripes.

A stripe belongs to a prefix of zero to three words and counts the words that follow it: ``next -> count``. Each task builds
the stripes of a bounded chunk of text with numpy, Spark shuffles them by (language, prefix), and a sorted stream merges the
stripes of one prefix elementwise. The merged stripes hold everything asked for: a prefix's extensions are its entries, its
total is the entry of its own last word (for words, the stripe of the empty prefix, whose sum is the language's number of
words), and the largest count of a phrase that adds one word to a shorter one is the largest entry of its stripe or of a
stripe that its words end.

A phrase is never more frequent than the phrases inside it, so a stripe of a longer prefix holds only what the shorter ones
allow: words that are frequent enough, then pairs, then triples. These reach the tasks as a bit filter of bounded
size; a filter lets too much through at worst, and the exact counts decide afterwards. By the same rule a candidate that any
longer one covers is covered by one that is longer by one word.

The stripe of a very frequent prefix is cut into slices by the hash of the next word, so that no task holds it whole. Such
prefixes are those of more than ``wide_from`` or 1/65,536 of all occurrences, so their list has at most 65,536 entries.

Null text is empty, a null language is ``und``, repeated rows count each time, an empty table gives an empty table, and only
the two named columns are read. A text is cut only between chunks, never inside: a very long one is one chunk by itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.operators.lookup import left_lookup
from corpusprep.session import ensure_checkpoint_dir

from .common import release, stored

UNKNOWN_LANG = "und"
CUT = b"."  # every cutting character becomes this one, which is in no word
_SEPARATORS = b".,;:!?\n\v\f\r"
BYTES = bytes(CUT[0] if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))
LONGEST = 4
ODD1, ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
STRIPES = "lang string, prefix string, slice int, next array<string>, count array<int>"  # a chunk's counts are small
MERGED = "lang string, prefix string, total long, next array<string>, count array<long>"
WORD_SLICES = 1024  # slices of a language's stripe of the empty prefix
MAX_FILTER_BITS = 1 << 28
LOOKUP_BYTES = 32 << 20  # a larger table of counts is joined by shuffle


def words_of(text: bytes) -> list[bytes]:
    """Words of a text in order, ``CUT`` between its pieces."""
    return text.translate(BYTES).replace(CUT, b" . ").split()


class Words(dict):
    """Word -> local number within a chunk, one such table a language; number 0 is the cut."""

    def __init__(self, lang: str, numbers: Chunk):
        super().__init__({CUT: 0})
        self.lang, self.numbers = lang, numbers

    def __missing__(self, word: bytes) -> int:
        all_ = self.numbers
        self[word] = n = len(all_.words)
        all_.words.append(word)
        all_.langs.append(self.lang)
        return n


class Chunk:
    """The numbered words of some texts, a cut behind each text."""

    def __init__(self):
        self.words, self.langs, self.tables, self.parts, self.size = [b""], [""], {}, [], 0  # number 0 is the cut

    def add(self, lang: str, text: bytes) -> None:
        table = self.tables.get(lang)
        if table is None:
            table = self.tables[lang] = Words(lang, self)
        words = words_of(text)
        self.parts += [np.fromiter(map(table.__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
        self.size += len(words)

    def numbers(self) -> np.ndarray:
        self.parts = [np.concatenate(self.parts)]
        return self.parts[0]

    def hashes(self) -> np.ndarray:
        heads = {lang: lang.encode() + b"\0" for lang in self.tables}
        heads[""] = heads.get("", b"\0")
        return np.fromiter((xxhash.xxh3_64_intdigest(heads[lang] + w) for lang, w in zip(self.langs, self.words)), np.uint64, len(self.words))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    h = first * ODD1 + (second ^ (second >> np.uint64(29))) * ODD2
    return h ^ (h >> np.uint64(32))


def in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(len(bits) * 64 - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _following(a: np.ndarray, n: int) -> np.ndarray:
    """``a`` moved n places to the left, 0 (or False) at the end."""
    out = np.zeros_like(a)
    out[:len(a) - n] = a[n:]
    return out


def _counted(prefix: np.ndarray, nxt: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (prefix, next) in order, with their counts; in place and in 32 bits, as a chunk's arrays are most of a task's memory."""
    keys = prefix.astype(np.int64)
    keys *= limit
    keys += nxt
    keys.sort()
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    counts = np.diff(np.r_[start, len(keys)]).astype(np.int32)
    keys = keys[start]
    return (keys // limit).astype(np.int32), (keys % limit).astype(np.int32), counts


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and each key's place among them."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.r_[True, keys[1:] != keys[:-1]][:len(keys)]
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return keys[new], place


class Stripes:
    """Output rows of one chunk: the counted (prefix, next) grouped by prefix and slice."""

    def __init__(self, chunk: Chunk):
        self.chunk, self.hash = chunk, chunk.hashes()
        self.words = pa.array(chunk.words, pa.binary()).cast(pa.string())
        self.langs = pa.array(chunk.langs, pa.string())

    def rows(self, heads: list[np.ndarray], prefix: np.ndarray, nxt: np.ndarray, count: np.ndarray, slices: np.ndarray, lang: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``heads``: word numbers of each prefix; ``slices`` and ``lang`` (a word of the language) by prefix; entries by prefix."""
        if not len(prefix):
            return
        part = np.zeros(len(prefix), np.int32)  # slices count from 1, a whole stripe is 0
        cut = np.flatnonzero((slices > 1)[prefix])
        if len(cut):
            part[cut] = 1 + (self.hash[nxt[cut]] % slices[prefix[cut]].astype(np.uint64)).astype(np.int32)
            order = np.lexsort((part, prefix))
            prefix, nxt, count, part = prefix[order], nxt[order], count[order], part[order]
        start = np.flatnonzero(np.r_[True, (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])])
        for at in range(0, len(start), 20_000):
            s = start[at:at + 20_000]
            end = start[at + 20_000] if at + 20_000 < len(start) else len(prefix)
            of, offsets = prefix[s], pa.array(np.r_[s, end] - s[0], pa.int32())
            text = [self.words.take(pa.array(h[of])) for h in heads]
            text = pc.binary_join_element_wise(*text, " ") if text else pa.array([""] * len(of))
            yield pa.RecordBatch.from_arrays([
                self.langs.take(pa.array(lang[of])), text, pa.array(part[s]),
                pa.ListArray.from_arrays(offsets, self.words.take(pa.array(nxt[s[0]:end]))),
                pa.ListArray.from_arrays(offsets, pa.array(count[s[0]:end], pa.int32()))], names=["lang", "prefix", "slice", "next", "count"])


def words_level(chunk: Chunk, bits: np.ndarray | None, wide: dict) -> Iterator[pa.RecordBatch]:
    """Stripes of the empty prefix: each language's words."""
    out = Stripes(chunk)
    count = np.bincount(chunk.numbers(), minlength=len(chunk.words))
    first = {}
    of_lang = np.array([first.setdefault(lang, i) for i, lang in enumerate(chunk.langs)])
    of_lang[0] = -1
    order = np.argsort(of_lang, kind="stable")[1:]
    langs, prefix = np.unique(of_lang[order], return_inverse=True)
    yield from out.rows([], prefix, order, count[order], np.full(len(langs), WORD_SLICES), langs)


def pairs_level(chunk: Chunk, bits: np.ndarray, wide: dict) -> Iterator[pa.RecordBatch]:
    """Stripes of frequent words."""
    out = Stripes(chunk)
    good = in_filter(bits, out.hash)
    good[0] = False
    w = chunk.numbers()
    w = np.where(good[w], w, 0)
    nxt = _following(w, 1)
    at = np.flatnonzero((w > 0) & (nxt > 0))
    w, nxt = w[at], nxt[at]
    prefix, nxt, count = _counted(w, nxt, len(good))
    slices = np.ones(len(good), np.int64)
    if wide:
        slices[:] = [wide.get((lang, word), 1) for lang, word in zip(chunk.langs, chunk.words)]
    yield from out.rows([np.arange(len(good))], prefix, nxt, count, slices, np.arange(len(good)))


def longer_level(chunk: Chunk, bits: np.ndarray, wide: dict, size: int) -> Iterator[pa.RecordBatch]:
    """Stripes of frequent prefixes of ``size`` words, two or more."""
    out = Stripes(chunk)
    v = len(chunk.words)
    w = chunk.numbers()
    gram, hashes, heads = w, out.hash, [np.arange(v, dtype=np.int32)]
    for k in range(1, size):  # number the distinct phrases of k + 1 words; -1 where a cut is inside
        after = _following(w, k)
        at = np.flatnonzero((gram > 0 if k == 1 else gram >= 0) & (after > 0))
        keys = gram[at].astype(np.int64)
        keys *= v
        keys += after[at]
        keys, number = _numbered(keys)
        first, last = (keys // v).astype(np.int32), (keys % v).astype(np.int32)
        heads = [*[h[first] for h in heads], last]
        hashes = pair_hash(hashes[first], out.hash[last])
        gram = np.full(len(w), -1, np.int32)
        gram[at] = number
        del keys, number, first, last, after, at
    good = in_filter(bits, hashes)
    del hashes
    fits = gram >= 0
    fits[fits] = good[gram[fits]]
    slices = np.ones(len(good), np.int64)
    if wide:
        lang = [chunk.langs[i] for i in heads[0]]
        slices[good] = [wide.get((lang[i], b" ".join([chunk.words[h[i]] for h in heads])), 1) for i in np.flatnonzero(good)]
    at = np.flatnonzero(fits & _following(fits, 1))  # a longer phrase is frequent only if its last part is, too
    after, gram = _following(w, size)[at], gram[at]
    del fits, at
    prefix, after, count = _counted(gram, after, v)
    del gram
    yield from out.rows(heads, prefix, after, count, slices, heads[0])


def stripes(docs: DataFrame, level: Callable, chunk_words: int, bits=None, wide: dict | None = None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, many = None if bits is None else bits.value, {} if wide is None else wide.value
        chunk = Chunk()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                chunk.add(lang, text)
                if chunk.size >= chunk_words:
                    yield from level(chunk, table, many)
                    chunk = Chunk()
        if chunk.size:
            yield from level(chunk, table, many)

    return docs.mapInArrow(run, STRIPES)


def _merged(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(first row of each run of equal keys, run of each entry, its word's number, words, counts) with equal entries added up."""
    rows = rows.combine_chunks()
    n = rows.num_rows
    same = np.ones(n - 1, bool)
    for name in ("lang", "prefix", "slice"):
        col = rows.column(name)
        same &= pc.equal(col.slice(1), col.slice(0, n - 1)).to_numpy()
    first = np.flatnonzero(np.r_[True, ~same])
    run = np.cumsum(np.r_[True, ~same]) - 1
    lists = rows.column("next").combine_chunks()
    coded = pc.list_flatten(lists).dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    counts = pc.list_flatten(rows.column("count").combine_chunks()).to_numpy(zero_copy_only=False).astype(np.int64)
    key = np.repeat(run, pc.list_value_length(lists).to_numpy(zero_copy_only=False)) * max(len(words), 1) + codes
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    sums = np.add.reduceat(counts[order], start) if len(key) else counts
    return first, key[start] // max(len(words), 1), key[start] % max(len(words), 1), words, sums


def merge_stripes(rows: DataFrame, min_count: int, keep_all: bool) -> DataFrame:
    """Merged stripes: each (language, prefix, slice) with its total and its entries of ``min_count`` or more.

    The rows of one key follow each other in their task, so one key's entries are held at a time. A stripe without such an
    entry is left out unless ``keep_all``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = None

        def merged(table: pa.Table, last: bool) -> tuple[pa.RecordBatch | None, pa.Table | None]:
            first, of, code, words, sums = _merged(table)
            runs = len(first) if last else len(first) - 1
            rest = None
            if not last:  # the last key may go on in the next batch
                mine = of == runs
                one = table.slice(int(first[-1]), 1)
                rest = pa.table([one.column("lang"), one.column("prefix"), one.column("slice"),
                                 pa.array([words.take(pa.array(code[mine]))], pa.list_(pa.string())),
                                 pa.array([sums[mine]], pa.list_(pa.int64()))], names=one.column_names)
            if not runs:
                return None, rest
            done = of < runs
            of, code, sums = of[done], code[done], sums[done]
            total = np.zeros(runs, np.int64)
            np.add.at(total, of, sums)
            good = sums >= min_count
            offsets = np.r_[0, np.cumsum(np.bincount(of[good], minlength=runs))]
            keys = table.take(pa.array(first[:runs]))
            out = pa.table([keys.column("lang"), keys.column("prefix"), pa.array(total),
                            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.take(pa.array(code[good]))),
                            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(sums[good]))],
                           names=["lang", "prefix", "total", "next", "count"])
            if not keep_all:
                out = out.filter(pa.array(np.diff(offsets) > 0))
            return out, rest

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            counted = table.set_column(4, "count", table.column("count").cast(pa.list_(pa.int64())))
            out, pending = merged(counted if pending is None else pa.concat_tables([pending.cast(counted.schema), counted]), False)
            if out is not None:
                yield from out.to_batches()
        if pending is not None:
            yield from merged(pending, True)[0].to_batches()

    keys = ["lang", "prefix", "slice"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, MERGED)


def bit_filter(grams: DataFrame, number: int) -> np.ndarray:
    """Bit filter of (lang, prefix, next) rows, about 16 bits a gram up to ``MAX_FILTER_BITS``; merged by bitwise or."""
    bits = min(MAX_FILTER_BITS, max(1 << 16, 1 << (number * 16 - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            heads = [lang.encode() + b"\0" for lang in batch.column(0).to_pylist()]

            phrases = [p.split(b" ") if p else [] for p in batch.column(1).cast(pa.binary()).to_pylist()]
            phrases = [[*p, w] for p, w in zip(phrases, batch.column(2).cast(pa.binary()).to_pylist())]  # all of one length
            h = None
            for k in range(len(phrases[0]) if phrases else 0):
                word = np.fromiter((xxhash.xxh3_64_intdigest(head + p[k]) for head, p in zip(heads, phrases)), np.uint64, len(heads))
                h = word if h is None else pair_hash(h, word)
            if h is None:
                continue
            at = h & np.uint64(bits - 1)
            np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(words)
        for s in range(0, len(used), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(used[s:s + (1 << 16)]), pa.array(words[used[s:s + (1 << 16)]].view(np.int64))], names=["at", "bits"])

    merged = grams.select("lang", "prefix", "next").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    rows = merged.toArrow()  # at most bits / 64 rows
    out = np.zeros(bits // 64, np.uint64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def grams_of(merged: DataFrame) -> DataFrame:
    """(lang, prefix, next, a): one row for each entry of a merged stripe."""
    return (merged.select("lang", "prefix", F.explode(F.arrays_zip("next", "count")).alias("e"))
            .select("lang", "prefix", F.col("e.next").alias("next"), F.col("e.count").alias("a")))


def _key(lang: Column, phrase: Column) -> Column:
    return F.concat(phrase, F.lit("\t"), lang)  # no word holds a tab


def scored(grams: DataFrame, words: DataFrame, scale: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases of two words and more: the cut of the lowest score."""
    phrase = F.concat_ws(" ", "prefix", "next")
    known = words.select(F.col("next").alias("phrase"), "lang", "a").union(grams.select(phrase, "lang", "a"))
    known = known.select(_key(F.col("lang"), F.col("phrase")).alias("_part"), F.col("a").alias("f"))
    def piece(w: Column, start: Column, length: Column) -> Column:
        return F.array_join(F.slice(w, start, length), " ")

    w = F.col("w")
    cuts = F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda k: F.struct(k.alias("k"), piece(w, F.lit(1), k).alias("left"), piece(w, k + 1, F.size(w) - k).alias("right")))
    each = (grams.withColumn("w", F.split(phrase, " ")).select("lang", F.array_join("w", " ").alias("phrase"), "a", F.explode(cuts).alias("c"))
            .select("lang", "phrase", "a", "c.k", "c.left", "c.right"))
    each = left_lookup(each.withColumn("part", _key(F.col("lang"), F.col("right"))), known, "part", "_part", LOOKUP_BYTES).withColumnRenamed("f", "r")
    other = known.withColumnRenamed("_part", "_other")
    both = left_lookup(each.withColumn("part", _key(F.col("lang"), F.col("left"))), other, "part", "_other", LOOKUP_BYTES).withColumnRenamed("f", "l")
    wide = "decimal(20,0)"
    score = F.expr(f"({scale} * cast(a as {wide})) div (cast(l as {wide}) + cast(r as {wide}))")
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    return best.select("lang", "phrase", "a", "c.l", "c.r", "c.score")


def collocations(docs: DataFrame, min_count: int = 30, cover_percent: int = 80, top: int = 2000, scale: int = 2_000_000, text_col: str = "text",
                 lang_col: str = "lang", chunk_words: int = 1 << 22, wide_from: int = 1 << 20) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two to four words.

    ``a``, ``l`` and ``r`` are the occurrences of the phrase and of the two parts of its worst cut, ``n`` the language's
    words, ``score`` = floor(scale * a / (l + r)). A phrase is left out where a longer candidate with it inside has
    ``cover_percent`` of its occurrences.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def wide_of(grams: DataFrame, number: int):
        limit = max(wide_from, number >> 16)
        many = grams.filter(F.col("a") > limit).select("lang", F.concat_ws(" ", F.nullif("prefix", F.lit("")), "next").alias("p"), "a").collect()
        return spark.sparkContext.broadcast({(r["lang"], r["p"].encode()): -(-r["a"] // limit) for r in many})

    first = stored(merge_stripes(stripes(rows, words_level, chunk_words), min_count, keep_all=True))
    totals = stored(first.groupBy("lang").agg(F.sum("total").alias("n")))
    number = totals.agg(F.sum("n")).first()[0] or 0
    words = stored(grams_of(first))
    frequent = spark.sparkContext.broadcast(bit_filter(words, words.count()))
    longer = [stored(merge_stripes(stripes(rows, pairs_level, chunk_words, frequent, wide_of(words, number)), min_count, keep_all=False))]
    for size in range(2, LONGEST):
        last = stored(grams_of(longer[-1]))
        frequent = spark.sparkContext.broadcast(bit_filter(last, last.count()))
        level = partial(longer_level, size=size)
        longer.append(stored(merge_stripes(stripes(rows, level, chunk_words, frequent, wide_of(last, number)), min_count, keep_all=False)))
        release(last)
    release(first)

    longer = reduce(DataFrame.unionByName, longer)
    grams = grams_of(longer)
    rest = F.concat_ws(" ", F.expr("substring(prefix, instr(prefix, ' ') + 1)"), "next")
    inner = grams.filter(F.instr("prefix", " ") > 0).select("lang", F.col("a").alias("longer"), F.explode(F.array("prefix", rest)).alias("phrase"))
    covers = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = (scored(grams, words, scale).join(covers, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | F.expr(f"100 * cast(longer as decimal(20,0)) < {cover_percent} * cast(a as decimal(20,0))")))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    for parts in (1024, 32, 1):  # no task sees more than 32 * top rows of a language
        some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*best)
        kept = kept.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
