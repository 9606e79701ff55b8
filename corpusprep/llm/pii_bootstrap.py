"""Personal data by fixed patterns and by bootstrapped contextual extraction, in DataFrame functions only.

Base spans come from fixed expressions (email, ip, card, phone). For the method, every identifier-like token (with a
digit or an at sign) of any length that touches no base span is a candidate instance, and so is every base span as a
whole. The three words and marks to its left, whatever they are, are its lexical pattern (two where the text has no more).
Seeds are the base spans and strings of an unmistakable form (long hexadecimal secrets). Pattern and instance nodes of the resulting
graph score each other for some rounds: a pattern's confidence in a kind is the mean score of its distinct instances, an
instance's score is one minus the product of its patterns' doubts. Patterns with enough distinct instances and a high
confidence mark all their other instances, seen before or not, as identifiers of that kind.

Positions are code points, end exclusive. Null text is empty. Repeated rows each get their spans, a table without rows
or without candidates gives no extra spans, ties in a pattern's kind go to the alphabetically first one, and input
columns named like an output are replaced. The graph holds counted distinct edges, no texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, text_or_empty

SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
LEFT = 256
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
# kind -> (cheap test, leftmost non-overlapping matches). Possessive runs and the look-behinds keep every match of the
# plain expression and spare the attempts that must fail inside a run.
BASE = {
    "email": (r"@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9](?:[ -]?[0-9]){13}", r"(?<![0-9])[0-9]++(?:[ -][0-9]++)*+"),
    "phone": (r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
}
CANDIDATE = (r"(?<![A-Za-z0-9._%+@:/-])(?=[A-Za-z._%+:/-]*+[0-9@])"
             r"[A-Za-z0-9_%+@-]++(?:[.:/][A-Za-z0-9_%+@-]++)*+")
SECRET = r"^(?=.*[0-9])(?=.*[a-fA-F])[0-9a-fA-F]{32,64}$"


def located(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` in order, as array of (start, value, left): what stands between them is measured and summed.

    ``left`` is the end of the text before a match, at most ``LEFT`` characters, with runs of white space as one space.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.array().cast("array<struct<start:int,value:string,left:string>>").alias("out"))

    def tail(*parts: Column) -> Column:
        return F.right(F.regexp_replace(F.concat(*parts), r"\s+", " "), F.lit(LEFT))

    pairs = F.zip_with(matches, between, lambda m, b: F.struct(m.alias("m"), b.alias("b")))
    return F.aggregate(
        F.filter(pairs, lambda p: p["m"].isNotNull()), start,
        lambda s, p: F.struct(
            (s["at"] + F.length(p["b"]) + F.length(p["m"])).alias("at"), tail(s["tail"], p["b"], p["m"]).alias("tail"),
            F.concat(s["out"], F.array(F.struct((s["at"] + F.length(p["b"])).alias("start"), p["m"].alias("value"),
                                                tail(s["tail"], p["b"]).alias("left")))).alias("out")),
        lambda s: s["out"])


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(value, "[ -]", "")
        return F.when(F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def base_instances(text: Column) -> Column:
    """All base spans in order of start, then kind as listed in ``BASE``, with the text to their left."""
    def of(kind: str, rank: int, pattern: str) -> Column:
        return F.transform(F.filter(located(text, pattern), lambda m: _valid(kind, m["value"])), lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), (m["start"] + F.length(m["value"])).alias("end"),
            F.lit(kind).alias("kind"), m["value"].alias("value"), m["left"].alias("left")))

    kinds = [F.when(text.rlike(test), of(kind, rank, pattern)).otherwise(F.array().cast(SPAN.replace("value:string", "value:string,left:string")))
             for rank, (kind, (test, pattern)) in enumerate(BASE.items())]
    return F.array_sort(F.concat(*kinds))


def base_spans(text: Column) -> Column:
    return F.transform(base_instances(text), lambda b: F.struct(*[b[c].alias(c) for c in ("start", "rank", "end", "kind", "value")]))


def pattern_of(text: Column, start: Column, left: Column) -> Column:
    """The last three words or marks before a candidate; null where there are fewer than two.

    ``left`` serves if it is all the text before ``start`` or has a fourth token, so that the third is not cut.
    """
    def tokens_of(t: Column) -> Column:
        return F.regexp_extract_all(F.lower(t), F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"), F.lit(0))

    tokens = F.when((F.length(left) < LEFT) | (F.size(tokens_of(left)) > 3), tokens_of(left)).otherwise(tokens_of(F.substring(text, F.lit(1), start)))
    return F.when(F.size(tokens) >= 2, F.array_join(F.slice(tokens, F.greatest(F.size(tokens) - 2, F.lit(1)), 3), " "))


def bootstrap(edges: DataFrame, rounds: int, min_instances: int, min_confidence: float) -> DataFrame:
    """(pattern, kind, confidence) from rows of (pattern, instance, seed); seed is a kind or null."""
    graph = edges.groupBy("pattern", "instance").agg(F.min("seed").alias("seed"))
    enough = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_instances)
    graph = graph.join(enough, "pattern").checkpoint()
    scores = graph.filter(F.col("seed").isNotNull()).select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    seeds, patterns = scores, None
    for r in range(rounds):
        patterns = (graph.join(scores, "instance").groupBy("pattern", "kind")
                    .agg((F.sum("score") / F.first("n")).alias("confidence")))
        if r + 1 < rounds:
            doubt = F.sum(F.log1p(-F.least("confidence", F.lit(0.999999))))
            found = (graph.filter(F.col("seed").isNull()).join(patterns, "pattern").groupBy("instance", "kind")
                     .agg((1 - F.exp(doubt)).alias("score")))
            scores = seeds.unionByName(found)
    ranked = patterns.filter(F.col("confidence") >= min_confidence).groupBy("pattern").agg(
        F.min(F.struct((-F.col("confidence")).alias("c"), F.col("kind").alias("kind"))).alias("top"))
    return ranked.select("pattern", F.col("top.kind").alias("kind"), (-F.col("top.c")).alias("confidence"))


def find_personal_data(docs: DataFrame, rounds: int = 3, min_instances: int = 5, min_confidence: float = 0.8,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add ``base`` and ``spans`` (base and discovered), arrays of (start, rank, end, kind, value), to ``docs``."""
    text = text_or_empty(text_col)
    # One key for equal (id, text) rows: their spans are equal, so the rows need not be told apart.
    key = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), text))
    of, found = free_name(docs, "of"), free_name(docs, "found")  # helper columns under names that the input doesn't use
    keyed = docs.withColumns({"base": base_spans(text), of: key})
    base = base_instances(text)

    def node(kind: Column, m: Column) -> Column:
        return F.struct(kind.alias("in_base"), m["start"].alias("start"), m["value"].alias("value"),
                        pattern_of(text, m["start"], m["left"]).alias("pattern"))

    def untouched(m: Column) -> Column:
        end = m["start"] + F.length(m["value"])
        return ~F.exists("base", lambda b: (b["start"] < end) & (b["end"] > m["start"]))

    nodes = F.concat(F.transform("base", lambda b: node(b["kind"], b)),
                     F.transform(F.filter(located(text, CANDIDATE), untouched), lambda m: node(F.lit(None).cast("string"), m)))
    rows = (docs.filter(text.rlike("[0-9@]")).select(key.alias("_key"), F.col(text_col), base.alias("base"))
            .select("_key", F.explode(nodes).alias("c")).select("_key", "c.*").filter(F.col("pattern").isNotNull()))
    end = F.col("start") + F.length("value")
    rows = (rows.withColumn("seed", F.coalesce("in_base", F.when(F.col("value").rlike(SECRET), F.lit("secret"))))
            .select("_key", "start", "value", "pattern", "in_base", "seed").checkpoint())
    accepted = bootstrap(rows.select("pattern", F.md5(F.lower("value")).alias("instance"), "seed"),
                         rounds, min_instances, min_confidence)
    extra = rows.filter(F.col("in_base").isNull()).join(accepted, "pattern").select(
        "_key", F.struct(F.col("start"), F.lit(len(BASE)).alias("rank"), end.alias("end"), F.col("kind"), F.col("value")).alias("s"))
    by_doc = extra.groupBy(F.col("_key").alias(of)).agg(F.collect_set("s").alias(found))
    joined = keyed.drop("spans").join(by_doc, of, "left")
    spans = F.array_sort(F.concat("base", F.coalesce(F.col(found).cast(SPAN), F.array().cast(SPAN))))
    return joined.withColumn("spans", spans).drop(of, found)


def span_digest(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
