"""URL filter: a list of rules, and logistic regression on hashed character n-grams where no rule fits. Native.

Host and path are cut from the url as text. A rule is a host with a path prefix (``net/``); it fits its host and every
subdomain if the path starts with the rule's, and the longest fitting one decides (of equally long ones the first by name,
``allow`` before ``block``).

The model is trained from a small labelled table (url, blocked). Features are the distinct hashed n-grams of the host, its
words between dots, and of the path. Training is adaptive gradient descent over all rows of that table (at most ``max_labelled``, those of the smallest url hashes),
the classes weighted alike; margins are summed in the order of the features and gradients as integers, so the weights do not
depend on partitions. The weights, ``buckets`` numbers and an intercept, are the only thing that the driver holds.

A null url or one without ``://`` has an empty host and path and no rule; the method judges it by the intercept alone.
Labelled rows with a null url or label are left out; without both classes nothing is blocked but by rules. Repeated rows are
judged row by row, an empty table gives an empty table, and input columns named like an output are replaced.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.text import let
from corpusprep.session import ensure_checkpoint_dir

from .common import ascii_lower, stored

GRAMS = (3, 4, 5)
BUCKETS = 1 << 13
UNIT = 1 << 30  # gradients are whole multiples of 1 / UNIT
ALLOW, BLOCK = "allow", "block"

# The small labelled table. Words that stand in hosts and paths of pages to be blocked, and of others.
BLOCKED_WORDS = """adult ads adserver affiliate bets betting bitcoin-doubler bonus casino cheap clickbait coupons crack crypto-win
dating diet-pills download-free escort farm-links fake-news free-money gambling get-rich hacked hot-girls jackpot keygen lottery
loan malware miracle-cure nude payday pharmacy phishing pills poker popup porn prize proxy-free replica sex slots spam spyware
sweepstakes torrent track tracker traffic-bot viagra warez webcam win win-now xxx""".split()
ALLOWED_WORDS = """academy archive art article astronomy bakery bank biology blog books botany bridge chemistry choir city climate club
coast college community concert cooking council craft culture daily data dictionary docs economy education engineering example
family farm film forest forum garden geography guide harbour health history hospital house institute journal kitchen
language law letters library lake magazine maps market mathematics medicine meadow memory mountain museum music news notes
ocean office opera orchard paper people philosophy photo physics poetry press project radio recipes research review river
school science sea society sport station stories studio theatre tools town travel university valley village weather wiki
winter women work world writing youth""".split()
NAMES = ("{0}", "{0}-{1}", "{1}-{0}", "{0}{1}", "the{0}")
SUBDOMAINS, ENDINGS = ("", "www.", "blog.", "m."), ("com", "org", "net")
PATHS = ("/en/{}.html", "/de/{}/", "/fr/{}?page=2", "/es/{}#top", "/{}")
# Names of no meaning are no reason to block: syllables put together.
SYLLABLES = "ba chi do fen gra hou in ker lo mer nou ou pre qua ri sto the ti ul ver wen xi yo zan".split()


def labelled_table(spark: SparkSession) -> DataFrame:
    """(url, blocked) built from the word lists; subdomains, endings and paths are dealt alike to both classes."""
    names = []
    for words, blocked in ((BLOCKED_WORDS, True), (ALLOWED_WORDS, False)):
        names += [(form.format(word, words[(i * 7 + 3) % len(words)]), blocked) for i, word in enumerate(words) for form in NAMES]
    n = len(SYLLABLES)
    names += [("".join(SYLLABLES[(i * a + i // n) % n] for a in (1, 5, 11)[:2 + i % 2]), False) for i in range(len(names))]
    rows = [(f"https://{SUBDOMAINS[i // 5 % 4]}{name}.example.{ENDINGS[i % 3]}{PATHS[(i // 3) % 5].format(100 + i)}", blocked) for i, (name, blocked) in enumerate(names)]
    return spark.createDataFrame(rows, "url string, blocked boolean")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where it is null or has no ``://``."""
    after = F.nullif(F.instr(url, "://"), F.lit(0)) + 3
    tail = F.coalesce(F.substr(url, after), F.lit(""))
    host = F.regexp_extract(tail, r"\A[^/?#]*+", 0)
    path = F.regexp_extract(tail, r"\A[^/?#]*+(/?[^?#]*+)", 1)
    return ascii_lower(host), path


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null; ``rules`` are (verdict, rule)."""
    order = sorted({(-len(rule), rule, verdict) for verdict, rule in rules})
    found = None
    for _, rule, verdict in order:
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if found is None else found


def features(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Sorted distinct buckets of the n-grams of host and path; none for an empty host."""
    def grams(text: Column, seed: int) -> Column:
        def of(chars: Column, n: int) -> Column:
            starts = F.sequence(F.lit(0), F.size(chars) - n)
            gram = F.transform(starts, lambda i: F.pmod(F.xxhash64(F.concat(*[F.get(chars, i + k) for k in range(n)]), F.lit(seed)), F.lit(buckets)).cast("int"))
            return F.when(F.size(chars) >= n, gram).otherwise(F.array().cast("array<int>"))

        # Characters once as an array: a place within a long text is found without a walk to it.
        return let(F.regexp_extract_all(text, F.lit("(?s)."), 0), lambda chars: F.concat(*[of(chars, n) for n in GRAMS]))

    ends = F.concat(F.lit("."), F.translate(host, "-", "."), F.lit("."))  # words of a name begin and end alike
    return F.when(host == "", F.array().cast("array<int>")).otherwise(F.array_sort(F.array_distinct(F.concat(grams(ends, 1), grams(F.translate(path, "123456789", "000000000"), 2)))))


def margin(found: Column, weights: list[float]) -> Column:
    """Intercept and weights of the features, summed in order, over the root of their number."""
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")  # one literal after constant folding
    total = F.aggregate(found, F.lit(0.0).cast("double"), lambda s, i: s + F.element_at(table, i + 2))
    return F.element_at(table, 1) + total / F.sqrt(F.greatest(F.size(found), F.lit(1)).cast("double"))


def train(labelled: DataFrame, buckets: int = BUCKETS, steps: int = 12, rate: float = 0.3, max_labelled: int = 20_000) -> list[float] | None:
    """Intercept and weights from (url, blocked); None without both classes."""
    rows = labelled.filter("url IS NOT NULL AND blocked IS NOT NULL").select("url", "blocked").distinct()
    rows = rows.orderBy(F.xxhash64("url"), "url", "blocked").limit(max_labelled)
    host, path = host_and_path(F.col("url"))
    rows = stored(rows.select(host.alias("host"), path.alias("path"), "blocked").select(features(F.col("host"), F.col("path"), buckets).alias("x"), F.col("blocked").cast("int").alias("y")))
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None
    share = {y: 1 / (2 * n) for y, n in sizes.items()}
    weights, squares = [0.0] * (buckets + 1), [0.0] * (buckets + 1)
    for _ in range(steps):
        p = 1 / (1 + F.exp(-margin(F.col("x"), weights)))
        pull = (p - F.col("y")) * F.when(F.col("y") == 1, share[1]).otherwise(share[0])
        unit = F.round(pull * UNIT).cast("long")
        scaled = F.round(pull * UNIT / F.sqrt(F.greatest(F.size("x"), F.lit(1)).cast("double"))).cast("long")
        each = rows.select(F.explode(F.concat(F.array(F.struct(F.lit(0).alias("i"), unit.alias("g"))), F.transform("x", lambda i: F.struct((i + 1).alias("i"), scaled.alias("g"))))).alias("e"))
        gradient = {r["i"]: r["g"] / UNIT for r in each.groupBy("e.i").agg(F.sum("e.g").alias("g")).collect()}  # at most buckets + 1 rows
        for i, g in gradient.items():  # each weight by its own step size: rare features move as far as common ones
            squares[i] += g * g
            weights[i] -= (rate if i else rate / 10) * g / (math.sqrt(squares[i]) + 1e-6)
    return weights


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame, url_col: str = "url", threshold: float = 0.5, **training) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` (probability of being blocked) and ``verdict``."""
    ensure_checkpoint_dir(pages.sparkSession)
    weights = train(labelled, **training)
    host, path = host_and_path(F.col(url_col))
    out = pages.withColumns({"host": host, "path": path})
    if weights is None:
        score = F.lit(0.0)
    else:
        score = 1 / (1 + F.exp(-margin(features(F.col("host"), F.col("path"), len(weights) - 1), weights)))
    out = out.withColumns({"rule": rule_for(F.col("host"), F.col("path"), rules), "score": score})
    judged = F.coalesce(F.col("rule.verdict"), F.when(F.col("score") > threshold, BLOCK).otherwise(ALLOW))
    return out.withColumn("verdict", judged).withColumn("rule", F.col("rule.rule"))

