"""Part of speech and base form of tokens (S25): the best class sequence of each record, then a lookup by token and class.

Classes come from two tables of the user, ``emissions (token, class, score)`` and ``transitions (previous, class, score)``, whose
scores are whole numbers that add up (logarithms times a factor); ``previous`` is null in front of the first token. The sequence
of the highest sum is found by dynamic programming inside the row: a fold over the tokens keeps, for each class, the best sum
that ends there and the class before it, and a fold back follows the latter. Ties go to the class that sorts first.

Records are partitioned by their number once, before their tokens become rows for the lookups, so that neither fold back
shuffles. The emissions are measured before they are broadcast; the transitions are an array of the plan, at most
``MAX_CLASSES`` squared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.fold import running
from corpusprep.functions.text import let
from corpusprep.operators.lookup import BROADCAST_LIMIT_BYTES, by_record, left_lookup

MAX_CLASSES = 64
NEVER = -(10 ** 15)  # the sum of a class that the token doesn't have
STATE = "struct<best:array<bigint>,back:array<int>>"


def _transition_array(transitions: DataFrame, missing: int) -> tuple[list[str], list[int]]:
    """Classes in order, and the score of (previous, class) at previous * classes + class; the last row is the start."""
    rows = transitions.select("previous", "class", F.col("score").cast("long").alias("score")).limit(MAX_CLASSES * (MAX_CLASSES + 1) + 1).collect()
    classes = sorted({c for r in rows for c in (r["previous"], r["class"]) if c is not None})
    if len(classes) > MAX_CLASSES or len(rows) > MAX_CLASSES * (MAX_CLASSES + 1):
        raise ValueError(f"more than {MAX_CLASSES} classes, or repeated transitions")
    number = {c: i for i, c in enumerate(classes)}
    scores = [missing] * (len(classes) * (len(classes) + 1))
    for r in rows:
        before = len(classes) if r["previous"] is None else number[r["previous"]]
        scores[before * len(classes) + number[r["class"]]] = r["score"]
    return classes, scores


def best_classes(options: Column, classes: list[str], scores: list[int]) -> Column:
    """The class of each token; ``options`` is an array of ``struct(cs, ss)``: a token's class numbers and their scores."""
    n = len(classes)
    table = F.from_json(F.lit(str(scores)), "array<bigint>")
    zero = F.expr(f"cast(named_struct('best', concat(array_repeat({NEVER}L, {n}), array(0L)), 'back', array_repeat(0, {n})) as {STATE})")

    def step(state: Column, token: Column) -> Column:
        def into(c: Column) -> Column:
            from_each = F.transform(state["best"], lambda s, p: F.struct((s + F.get(table, p * n + c)).alias("s"), (-p).alias("p")))
            return F.array_max(from_each)  # of equal sums the class that sorts first

        def with_best(best: Column) -> Column:
            def own(b: Column, c: Column) -> Column:
                at = F.array_position(token["cs"], c).cast("int")
                return F.when(at > 0, b["s"] + F.get(token["ss"], at - 1)).otherwise(F.lit(NEVER))
            return F.struct(F.concat(F.transform(best, own), F.array(F.lit(NEVER))).alias("best"), F.transform(best, lambda b: -b["p"]).alias("back")).cast(STATE)

        return let(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), into), with_best)

    def follow(states: Column) -> Column:
        last = F.element_at(states, -1)["best"]
        end = (F.array_position(last, F.array_max(last)) - 1).cast("int")
        # From the last token to the first: each state tells the class in front of the one chosen for it.
        before = running(F.reverse(F.slice(states, 2, F.size(states))), end, lambda c, s: F.get(s["back"], c))
        return F.reverse(F.concat(F.array(end), before))

    names = F.array(*[F.lit(c) for c in classes])
    numbers = let(running(options, zero, step), lambda states: F.when(F.size(states) > 0, follow(states)).otherwise(F.array().cast("array<int>")))
    return F.transform(numbers, lambda c: F.get(names, c))


def tag_tokens(df: DataFrame, key: str, tokens: str, emissions: DataFrame, transitions: DataFrame, unknown: list[str] | None = None,
               missing: int = -100, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``(_row, key, tokens, classes)``: the best class of every token, in token order.

    A token without emissions may have any class of ``unknown`` (default: all) at score 0; a pair of classes that the
    transitions lack scores ``missing``. Null tokens count as unknown, a null array as empty; records may share a key.
    """
    classes, scores = _transition_array(transitions, missing)
    if not classes:
        raise ValueError("the transitions name no class")
    number = F.from_json(F.lit("{" + ", ".join(f'"{c}": {i}' for i, c in enumerate(classes)) + "}"), "map<string,int>")
    listed = emissions.select("token", F.element_at(number, F.col("class")).alias("c"), F.col("score").cast("long").alias("s")).filter("token IS NOT NULL AND c IS NOT NULL")
    listed = listed.groupBy("token", "c").agg(F.max("s").alias("s")).groupBy("token").agg(F.sort_array(F.collect_list(F.struct("c", "s"))).alias("o"))
    side = listed.select(F.col("token").alias("_token"), F.col("o.c").alias("cs"), F.col("o.s").alias("ss"))
    anything = [classes.index(c) for c in (classes if unknown is None else unknown)]
    long = by_record(df.select(key, F.col(tokens).alias("_tokens"))).select("_row", key, F.posexplode_outer("_tokens").alias("pos", "token"))
    looked = left_lookup(long, side, "token", "_token", limit_bytes)
    own = F.coalesce(F.col("cs"), F.array(*[F.lit(c) for c in anything]))
    score = F.coalesce(F.col("ss"), F.array_repeat(F.lit(0).cast("long"), len(anything)))
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "token", own.alias("cs"), score.alias("ss")))
    folded = looked.groupBy("_row", key).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    return folded.select("_row", key, F.col("e.token").alias(tokens), best_classes(F.col("e"), classes, scores).alias("classes"))


def lemma_pos_join(df: DataFrame, key: str, tokens: str, emissions: DataFrame, transitions: DataFrame, lemmas: DataFrame, unknown: list[str] | None = None,
                   missing: int = -100, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``(key, tokens, classes)`` with every token replaced by its base form.

    ``lemmas`` is ``(token, class, lemma)``; a row whose class is null holds for any class that has no row of its own.
    Tokens without a row stay.
    """
    tagged = tag_tokens(df, key, tokens, emissions, transitions, unknown, missing, limit_bytes)
    pairs = F.arrays_zip(F.col(tokens).alias("token"), F.col("classes").alias("class"))
    long = tagged.select("_row", key, F.posexplode_outer(pairs).alias("pos", "p")).select("_row", key, "pos", "p.token", "p.class")
    long = long.withColumns({"exact": F.concat("token", F.lit("\t"), "class"), "any": F.col("token")})
    exact = lemmas.filter("class IS NOT NULL").select(F.concat("token", F.lit("\t"), "class").alias("_exact"), F.col("lemma").alias("by_class"))
    loose = lemmas.filter("class IS NULL").select(F.col("token").alias("_any"), F.col("lemma").alias("by_token"))
    both = left_lookup(left_lookup(long, exact, "exact", "_exact", limit_bytes), loose, "any", "_any", limit_bytes)
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("by_class", "by_token", "token").alias("t"), "class"))
    folded = both.groupBy("_row", key).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    return folded.select(key, F.col("e.t").alias(tokens), F.col("e.class").alias("classes"))
