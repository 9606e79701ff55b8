"""Quality rules by n-gram perplexity: a modified Kneser-Ney model for each language, and bands of perplexity.

The model's symbols are characters: a word is read with ``order`` - 1 start marks and an end mark, and every n-gram ends
inside its word. Tasks count the n-grams of their distinct words and Spark sums the counts over all texts. The counts of
a language then give continuation counts, discounts and interpolated probabilities, as sorted arrays of hashes with
log-probabilities and back-off weights. The model grows with the text's variety: up to ``max_entries`` n-grams it is
broadcast; a larger one stays a table, its probabilities come from aggregates and joins by n-gram and context, and the
distinct words are scored by joins. Both give the same scores and no n-gram is left out for the size of the input.

A document's score is its mean negative log-probability per symbol. For each language, quartiles of the scores of all
documents that pass the base rule give the band [lower, upper] outside which documents are rejected.

Null text has no words and fails the base rule; a null language is a language of its own; repeated rows are scored row
by row and an empty table gives an empty table. A language none of whose n-grams stands twice
scores 0, and one too small to have spread keeps what is at its median.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.session import ensure_checkpoint_dir

from .common import stored, text_or_empty

START, END = "\x02", "\x03"
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
LETTERS = 1 << 16  # the share of an unseen character: one of so many
COUNTS = "lang string, gram string, n long"


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, as UTF-8."""
    return text.encode("utf-8").split()


# --- base rule ------------------------------------------------------------------------------------------------------

def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def repeated_words(words: list[bytes], k: int = 3) -> int:
    """Words that stand in a window of ``k`` words which the text has twice or more."""
    windows = list(zip(*(words[i:] for i in range(k))))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    covered = bytearray(len(words))
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered[i:i + k] = b"\x01" * k
    return sum(covered)


# --- counting -------------------------------------------------------------------------------------------------------

def count_grams(docs: DataFrame, order: int, flush_at: int = 300_000) -> DataFrame:
    """(lang, gram, n) of the highest order over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        grams: dict[str, Counter] = {}

        def split() -> None:
            for lang, counter in words.items():
                into = grams.setdefault(lang, Counter())
                for word, n in counter.items():
                    w = START * (order - 1) + word.decode("utf-8") + END
                    for i in range(len(w) - order + 1):
                        into[w[i:i + order]] += n
            words.clear()

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, counter in grams.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counter), pa.string()), pa.array(list(counter), pa.string()),
                     pa.array(list(counter.values()), pa.int64())], names=["lang", "gram", "n"])
            grams.clear()

        for whole in batches:
            for at in range(0, whole.num_rows, 256):  # few texts at a time as Python strings
                batch = whole.slice(at, 256)
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    words.setdefault(lang, Counter()).update(words_of(text.lower()))
                    if sum(map(len, words.values())) > flush_at:
                        split()
                if sum(map(len, grams.values())) > flush_at * 2:
                    yield from rows()
        split()
        yield from rows()

    return (docs.select("lang", "text").mapInArrow(run, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n")))


# --- estimation -----------------------------------------------------------------------------------------------------

def discounts(n: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from the numbers of n-grams counted 1 to 4 times."""
    n1, n2, n3, n4 = (n.get(i, 0) for i in range(1, 5))
    if not n1 or not n2:
        return 0.5, 0.75, 1.0  # too few n-grams to tell
    y = n1 / (n1 + 2 * n2)
    ds = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(ds))


@dataclass
class HashArrays:
    """One language. For each order the sorted hashes of n-grams with their log-probabilities, and for each length the
    sorted hashes of contexts with their log back-off weights."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]

    @property
    def unseen(self) -> float:
        """Log-probability of a character that no text has."""
        return float(self.contexts[0][1][0]) - log(LETTERS)


def look_up(table: tuple[np.ndarray, np.ndarray], h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, found) of hashes in a sorted table; the value is 0 where none is found."""
    keys, values = table
    if not len(keys):
        return np.zeros(len(h)), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    hit = keys[at] == h
    return np.where(hit, values[at], 0.0), hit


def mix(out: np.ndarray, code: np.ndarray) -> np.ndarray:
    out = (out ^ code) * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def hash_windows(codes: np.ndarray, m: int) -> np.ndarray:
    """Hash of the ``m`` code points that end at each place from ``m`` - 1 on."""
    out = np.full(len(codes) - m + 1, m, np.uint64)
    for i in range(m):
        out = mix(out, codes[i:len(codes) - m + 1 + i])
    return out


def hash_rows(codes: np.ndarray) -> np.ndarray:
    """Hash of each row of code points; equals ``hash_windows`` of the row."""
    out = np.full(len(codes), codes.shape[1], np.uint64)
    for column in codes.T:
        out = mix(out, column)
    return out


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def estimate(grams: list[str], n: np.ndarray, order: int, of_top: tuple[float, float, float]) -> HashArrays:
    """Interpolated probabilities of one language from the counts of its highest order, whose discounts are given.

    Lower orders are counted by the distinct characters in front.
    """
    codes, counts = {order: codes_of("".join(grams)).reshape(-1, order)}, {order: np.asarray(n, np.int64)}
    for m in range(order - 1, 0, -1):
        _, first, counts[m] = np.unique(hash_rows(codes[m + 1][:, 1:]), return_index=True, return_counts=True)
        codes[m] = codes[m + 1][first, 1:]
    out = HashArrays([(np.empty(0, np.uint64), np.empty(0))], [])
    for m in range(1, order + 1):
        held = np.bincount(np.minimum(counts[m], 5), minlength=6)
        ds = np.array(of_top if m == order else discounts(dict(enumerate(held.tolist()))))
        d = ds[np.minimum(counts[m], 3) - 1]
        contexts, at = np.unique(hash_rows(codes[m][:, :-1]), return_inverse=True)
        total, freed = np.bincount(at, counts[m]), np.bincount(at, d)
        below = np.exp(look_up(out.grams[m - 1], hash_rows(codes[m][:, 1:]))[0]) if m > 1 else 1 / LETTERS
        p = (counts[m] - d) / total[at] + (freed / total)[at] * below
        h = hash_rows(codes[m])
        by = np.argsort(h)
        out.grams.append((h[by], np.log(p[by])))
        out.contexts.append((contexts, np.log(freed / total)))
    return out


def discounts_of(counts: DataFrame) -> dict[str, tuple[float, float, float]]:
    """language -> discounts, from rows of (lang, n)."""
    held: dict[str, dict[int, int]] = {}
    for r in counts.groupBy("lang", F.least("n", F.lit(5)).alias("c")).count().collect():  # five rows a language at most
        held.setdefault(r["lang"], {})[r["c"]] = r["count"]
    return {lang: discounts(n) for lang, n in held.items()}


def build_models(counts: DataFrame, order: int, min_count: int = 2) -> dict[str, HashArrays]:
    """language -> model, from (lang, gram, n); a language's n-grams meet in one task, their number was bounded before.

    N-grams counted less than ``min_count`` times are left out, after they have entered the discounts: what only one
    text says must not vouch for that text.
    """
    of_top = discounts_of(counts)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        lang = pdf["lang"].iloc[0]
        model = estimate(pdf["gram"].tolist(), pdf["n"].to_numpy(), order, of_top[lang])
        rows = [(lang, kind, m, h.tobytes(), v.astype(np.float64).tobytes())
                for kind, tables in (("gram", model.grams), ("context", model.contexts)) for m, (h, v) in enumerate(tables)]
        return pd.DataFrame(rows, columns=["lang", "kind", "m", "hashes", "vals"])

    fitted = counts.filter(F.col("n") >= min_count).groupBy("lang").applyInPandas(fit, "lang string, kind string, m int, hashes binary, vals binary")
    models: dict[str, HashArrays] = {}
    for r in sorted(fitted.collect(), key=lambda r: r["m"]):
        model = models.setdefault(r["lang"], HashArrays([], []))
        of = model.grams if r["kind"] == "gram" else model.contexts
        of.append((np.frombuffer(r["hashes"], np.uint64), np.frombuffer(r["vals"], np.float64).astype(np.float32)))
    return models


def score_words(model: HashArrays, order: int, words: list[str]) -> np.ndarray:
    """Log-probability of each word with its end mark."""
    padded = [START * (order - 1) + w + END for w in words]
    codes = codes_of("".join(padded))
    lengths = np.array([len(w) for w in padded])
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    inside = np.ones(len(codes), bool)
    for i in range(order - 1):
        inside[begins + i] = False
    at = np.flatnonzero(inside)  # the symbols to predict
    hashes = {m: hash_windows(codes, m) for m in range(1, order + 1)}
    total = np.zeros(len(at))
    open_ = np.arange(len(at))
    for m in range(order, 0, -1):
        value, hit = look_up(model.grams[m], hashes[m][at[open_] - (m - 1)])
        total[open_] += value
        open_ = open_[~hit]
        if m > 1 and len(open_):  # the context, without its last symbol
            total[open_] += look_up(model.contexts[m - 1], hashes[m - 1][at[open_] - (m - 1)])[0]
    total[open_] += model.unseen
    firsts = np.concatenate([[0], np.cumsum(lengths - (order - 1))[:-1]])
    return np.add.reduceat(total, firsts)


class Scorer:
    def __init__(self, models: dict[str, HashArrays], order: int, limit: int = 1 << 18):
        self.models, self.order, self.limit = models, order, limit
        self.known: dict[str, dict[bytes, float]] = {}

    def negative(self, lang: str, texts: list[list[bytes]]) -> list[float]:
        """Mean negative log-probability per symbol of lower-cased texts of one language; 0 without words."""
        known = self.known.setdefault(lang, {})
        if len(known) > self.limit:
            known.clear()
        new = list(set().union(*texts) - known.keys())
        model = self.models.get(lang)
        if new and model:
            scores = score_words(model, self.order, [w.decode("utf-8") for w in new])
            known.update(zip(new, scores.tolist()))
        out = []
        for words in texts:
            if not words or model is None:
                out.append(0.0)
                continue
            symbols = sum(len(w.decode("utf-8")) for w in words) + len(words)
            out.append(-sum(map(known.__getitem__, words)) / symbols)
        return out


SCORES = ("doc_id long, h long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, score double")


def score_documents(docs: DataFrame, order: int = 5, min_count: int = 2, max_entries: int = 4_000_000, id_col: str = "doc_id",
                    text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts of the base rule and the score of every row, with the id and a hash of the text."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("h"),
                       F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), text_or_empty(text_col).alias("text"))
    counts = count_grams(rows, order).checkpoint()
    if counts.filter(F.col("n") >= min_count).count() > max_entries:
        return score_by_joins(measure(rows, {}, order).drop("score"), rows, counts, order, min_count)
    return measure(rows, build_models(counts, order, min_count), order)


def measure(rows: DataFrame, models: dict[str, HashArrays], order: int) -> DataFrame:
    """Counts of the base rule and the scores by ``models``."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, order)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts, langs = batch.column(3).to_pylist(), batch.column(2).to_pylist()
                base = [base_counts(t, words_of(t)) for t in texts]
                scores = [0.0] * len(texts)
                for lang in set(langs):
                    own = [i for i, x in enumerate(langs) if x == lang]
                    for i, s in zip(own, scorer.negative(lang, [words_of(texts[i].lower()) for i in own])):
                        scores[i] = s
                cols = [pa.array(c, pa.int64()) for c in zip(*base)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *cols, pa.array(scores, pa.float64())],
                                                 names=[f.split()[0] for f in SCORES.split(", ")])

    return rows.mapInArrow(run, SCORES)


# --- models too large to broadcast ----------------------------------------------------------------------------------

def gram_scores(counts: DataFrame, order: int, min_count: int) -> DataFrame:
    """(lang, gram, lp): the log-probability of the last character of every n-gram of (lang, gram, n), also of those
    that are left out of the model. Languages without a model have no rows.

    A key of these aggregates and joins has at most as many rows as there are characters.
    """
    spark = counts.sparkSession
    shorter = F.expr("substring(gram, 2)")
    levels, asked = {order: counts.filter(F.col("n") >= min_count)}, {order: counts.select("lang", "gram")}
    for m in range(order - 1, 0, -1):
        levels[m] = stored(levels[m + 1].groupBy("lang", shorter.alias("gram")).agg(F.count(F.lit(1)).alias("n")))
        asked[m] = stored(asked[m + 1].select("lang", shorter.alias("gram")).distinct())
    below = None
    for m in range(1, order + 1):
        of = discounts_of(counts if m == order else levels[m])
        ds = F.broadcast(spark.createDataFrame([(lang, *d) for lang, d in of.items()], "lang string, d1 double, d2 double, d3 double"))
        d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        context = F.expr(f"left(gram, {m - 1})").alias("context")
        level = levels[m].join(ds, "lang").select("lang", "gram", "n", d.alias("d"))
        contexts = level.groupBy("lang", context).agg(F.sum("n").alias("total"), F.sum("d").alias("freed"))
        rows = (asked[m].join(level, ["lang", "gram"], "left").withColumn("context", context)
                .join(contexts, ["lang", "context"], "left" if m > 1 else "inner"))
        rest = F.lit(1 / LETTERS)
        if m > 1:
            rows = rows.withColumn("rest", shorter).join(below.select("lang", F.col("gram").alias("rest"), F.col("p").alias("rest_p")), ["lang", "rest"])
            rest = F.col("rest_p")
        p = F.coalesce((F.col("n") - F.col("d")) / F.col("total"), F.lit(0.0)) + F.coalesce(F.col("freed") / F.col("total"), F.lit(1.0)) * rest
        below = stored(rows.select("lang", "gram", p.alias("p")))
    return below.select("lang", "gram", F.log("p").alias("lp"))


def dealt_join(many: DataFrame, table: DataFrame, keys: list[str], salt: Column, rows: int = 100_000) -> DataFrame:
    """``many`` joined with the rows of ``table``, unique by ``keys``; a key of more than ``rows`` rows meets in several tasks."""
    hot = (many.groupBy(*keys).agg(F.count(F.lit(1)).alias("_k")).filter(F.col("_k") > rows)
           .select(*keys, F.ceil(F.col("_k") / rows).alias("_parts"))).checkpoint()
    some = F.broadcast(hot)  # at most one for each ``rows`` rows
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    dealt = many.join(some, keys, "left").withColumn("_salt", F.pmod(salt, parts)).drop("_parts")
    copies = table.join(some, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
    return dealt.join(copies, [*keys, "_salt"]).drop("_salt")


def score_by_joins(measured: DataFrame, rows: DataFrame, counts: DataFrame, order: int, min_count: int) -> DataFrame:
    """``measured`` with the scores, from a model that stays a table. The distinct words of a language are scored once."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                out = [(lang, doc, h, w.decode("utf-8"), n)
                       for lang, doc, h, text in zip(*(c.to_pylist() for c in whole.slice(at, 256).columns))
                       for w, n in Counter(words_of(text.lower())).items()]
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                                 names=["lang", "doc_id", "h", "word", "n"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lang, word in zip(*(c.to_pylist() for c in whole.columns)):
                w = START * (order - 1) + word + END
                grams = Counter(w[i:i + order] for i in range(len(w) - order + 1))
                key = hashlib.md5(word.encode("utf-8")).hexdigest()
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array([key] * len(grams)), pa.array(list(grams)),
                                                  pa.array(list(grams.values()), pa.int64())], names=["lang", "w", "gram", "n"])

    said = stored(rows.select("lang", "doc_id", "h", "text").mapInArrow(words, "lang string, doc_id long, h long, word string, n long"))
    parts = stored(said.select("lang", "word").distinct().mapInArrow(split, "lang string, w string, gram string, n long"))
    known = dealt_join(parts, gram_scores(counts, order, min_count), ["lang", "gram"], F.xxhash64("w"))
    known = stored(known.groupBy("lang", "w").agg(F.sum(F.col("n") * F.col("lp")).alias("lp")))
    said = said.select("lang", "doc_id", "h", F.md5("word").alias("w"), "n", (F.col("n") * (F.length("word") + 1)).alias("symbols"))
    # Rows repeated under one id and text add alike to both sums.
    scores = (dealt_join(said, known, ["lang", "w"], F.xxhash64("doc_id", "h")).groupBy("lang", "doc_id", "h")
              .agg((-F.sum(F.col("n") * F.col("lp")) / F.sum("symbols")).alias("score"))
              .withColumnsRenamed({"lang": "_lang", "doc_id": "_id", "h": "_h"}))
    joined = measured.join(scores, (F.col("lang") == F.col("_lang")) & (F.col("h") == F.col("_h")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return joined.select(*measured.columns, F.coalesce("score", F.lit(0.0)).alias("score"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def judge(docs: DataFrame, spread: float = 10.0, least: float = 0.005, **options) -> DataFrame:
    """Scores with ``base_failed``, ``lower``, ``upper`` and ``kept``: within ``spread`` quartile distances of the median.

    ``least`` is the least quartile distance, so that a language of equal texts rejects nothing.
    """
    scored = score_documents(docs, **options).checkpoint().withColumn("base_failed", base_failed())
    at = F.percentile_approx("score", [0.25, 0.5, 0.75], 10_000)
    bands = (scored.filter(~F.col("base_failed")).groupBy("lang").agg(at.alias("q"))
             .select("lang", F.col("q")[1].alias("median"),
                     F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(least)).alias("down"),
                     F.greatest(F.col("q")[2] - F.col("q")[1], F.lit(least)).alias("up")))
    bands = bands.checkpoint()
    if bands.count() <= 10_000:  # a row for each language; else joined by a shuffle
        bands = F.broadcast(bands)
    judged = scored.join(bands, "lang", "left").withColumns({
        "lower": F.col("median") - spread * F.col("down"), "upper": F.col("median") + spread * F.col("up")})
    inside = F.coalesce(F.col("score").between(F.col("lower"), F.col("upper")), F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & inside).drop("median", "down", "up")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 1_000_000, **options) -> DataFrame:
    """``docs`` without the documents that the rules reject."""
    judged = judge(docs, id_col=id_col, text_col=text_col, **options)
    bad = judged.filter(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct().checkpoint()
    some = F.broadcast(bad) if bad.count() <= broadcast_rows else bad
    return docs.join(some, docs[id_col].eqNullSafe(some["_id"]) & (F.xxhash64(docs[text_col]) == some["_h"]), "left_anti")
