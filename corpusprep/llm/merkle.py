"""Merkle manifest of a dataset by bitmap ranks.

Every row is a leaf; a group's leaves (a language's) ascend by id, every ``FAN`` nodes become one, the groups' roots likewise.
Where a leaf stands follows from a rank query, so nothing is sorted:

1. A group's ids form a compressed bitmap: only its non-empty 64-bit words exist, merged by bitwise or.
2. A directory of popcounts lies over the words: blocks of 2^13 words, blocks of 2^15 blocks and so on up to the whole range
   of 64-bit ids. A block's count of earlier ids needs its siblings only, at most 2^15 rows, whatever the ids are.
3. A leaf's place is the count before its word and the popcount of the lower bits.
4. Level by level, the nodes of one parent meet by (group, place / FAN) in an array of slots keyed by place % FAN.

Rows that share an id are told apart by their leaf digests in a second bitmap over the digests' leading 60 bits, equal rows
are counted, not compared. Null ids count as the smallest long. Other columns of the input are not read; a null field enters
a leaf as ``-``; a group of one leaf has it as root; an empty table gives no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusprep.operators.numbering import dense_number
from corpusprep.session import ensure_checkpoint_dir

from .common import stored

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WORD_BITS = 6
BLOCKS = (13, 15, 15)  # places by which a key is shifted from one level of the directory to the next; the last has the rest
LEAST = -(1 << 63)
RUN = 4096  # equal rows expanded by one task at a time


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_of(fields: list[Column]) -> Column:
    """Digest of the fields: ``-`` for null, else the value behind its length in bytes."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return digest(F.concat(*map(one, fields)))


def ranks(keys: DataFrame, group: list[str]) -> DataFrame:
    """``keys`` (group, key, weight; distinct keys) with ``before``: the weight of the group's smaller keys."""
    word = F.shiftright("key", WORD_BITS).alias("word")
    low = F.col("key").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), low)
    surplus = F.when(F.col("weight") > 1, F.struct("key", (F.col("weight") - 1).alias("more")))  # what the bitmap doesn't count
    words = stored(keys.groupBy(*group, word).agg(F.bit_or(bit).alias("bits"), F.sum("weight").alias("total"), F.collect_list(surplus).alias("surplus")))

    levels = [words.select(*group, F.col("word").alias("at"), "total")]
    for shift in BLOCKS:
        levels.append(levels[-1].groupBy(*group, F.shiftright("at", shift).alias("at")).agg(F.sum("total").alias("total")))

    def earlier(by: list) -> Column:
        return F.coalesce(F.sum("total").over(Window.partitionBy(*by).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    above = levels[-1].select(*group, "at", earlier(group).alias("before"))
    for shift, level in zip(reversed(BLOCKS), reversed(levels[:-1])):
        own = level.withColumn("up", F.shiftright("at", shift))
        own = own.withColumn("inside", earlier([*group, "up"]))
        above = own.join(above.withColumnRenamed("at", "up"), [*group, "up"]).select(*group, "at", (F.col("before") + F.col("inside")).alias("before"))
    index = words.join(above.withColumnRenamed("at", "word"), [*group, "word"]).select(*group, "word", "bits", "surplus", F.col("before").alias("base"))
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), low))
    lower = F.bit_count(F.col("bits").bitwiseAND(below))
    more = F.aggregate(F.filter("surplus", lambda s: s["key"] < F.col("key")), F.lit(0).cast("long"), lambda n, s: n + s["more"])
    return keys.withColumn("word", word).join(index, [*group, "word"]).select(*keys.columns, (F.col("base") + lower + more).alias("before"))


def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (g, key, leaf, ...) with ``at``, each row's place among the rows of its group by (key, leaf)."""
    kinds = leaves.groupBy(*leaves.columns).agg(F.count(F.lit(1)).alias("weight"))
    kinds = stored(kinds.withColumn("head", F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long")))
    ids = ranks(kinds.groupBy("g", "key").agg(F.sum("weight").alias("weight")), ["g"])
    start = stored(kinds.join(ids.select("g", "key", "before", F.col("weight").alias("of_id")), ["g", "key"]))
    alone, crowded = start.filter("of_id = weight"), start.filter("of_id > weight")
    crowded = crowded.withColumnRenamed("key", "id").withColumnRenamed("before", "first")
    heads = crowded.groupBy("g", "id", F.col("head").alias("key")).agg(F.sum("weight").alias("weight"))
    inner = ranks(heads, ["g", "id"]).select("g", "id", F.col("key").alias("head"), F.col("before").alias("ahead"))
    same = Window.partitionBy("g", "id", "head").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    crowded = (crowded.join(inner, ["g", "id", "head"]).withColumn("before", F.col("first") + F.col("ahead") + F.coalesce(F.sum("weight").over(same), F.lit(0)))
               .withColumnRenamed("id", "key"))
    rows = alone.unionByName(crowded.select(*alone.columns))
    few = rows.filter(F.col("weight") <= RUN).withColumn("length", F.col("weight"))
    runs = rows.filter(F.col("weight") > RUN).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(weight - 1) div {RUN}"))))
    runs = (runs.withColumns({"before": F.col("before") + F.col("k") * RUN, "length": F.least(F.lit(RUN), F.col("weight") - F.col("k") * RUN)})
            .drop("k").repartition("g", "before"))
    every = few.unionByName(runs).withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1)))
    return every.select(*leaves.columns, (F.col("before") + F.col("step")).alias("at"))


def gather(nodes: DataFrame, carried: Column) -> DataFrame:
    """Nodes (g, n, at, node, ...) of groups of n > 1 to parents (g, n, at, node, slots)."""
    n = F.expr(f"(n + {FAN - 1}) div {FAN}")
    slot = F.pmod("at", F.lit(FAN)).cast("int")
    slots = F.map_from_entries(F.collect_list(F.struct(slot, carried)))
    met = nodes.groupBy("g", "n", F.expr(f"at div {FAN}").alias("up")).agg(slots.alias("m"))
    in_place = F.transform(F.sequence(F.lit(0), F.size("m") - 1), lambda i: F.element_at("m", i))
    met = met.select("g", n.alias("n"), F.col("up").alias("at"), in_place.alias("slots"))
    return met.withColumn("node", digest(F.array_join(F.transform("slots", lambda s: s["node"]), "")))


def siblings(slots: Column, i: Column) -> Column:
    """Digests left and right of slot i, joined."""
    nodes = F.transform(slots, lambda s: s["node"])
    return F.struct(F.array_join(F.slice(nodes, F.lit(1), i), "").alias("left"), F.array_join(F.slice(nodes, i + 2, F.lit(FAN)), "").alias("right"))


STEP = "array<struct<left:string,right:string>>"


def grow(first: DataFrame, height: int) -> list[DataFrame]:
    """Parents by level, from the first nodes (g, n, at, node, row) up; the last level has one node a group."""
    levels, nodes = [], first
    for k in range(height):
        row = F.struct("node", "row") if k == 0 else F.struct("node")
        levels.append(stored(gather(nodes.filter("n > 1"), row)))
        nodes = levels[-1].select("g", "n", "at", "node")
    return levels


def paths(levels: list[DataFrame], tops: DataFrame | None = None) -> DataFrame:
    """Rows (g, row, node, path) of the first nodes: ``path`` has their siblings from the bottom up, then those in ``tops`` (g, path)."""
    up = None
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        done = level.filter("n = 1")
        done = done.withColumn("path", F.array().cast(STEP)) if tops is None else done.join(tops, "g")
        done = done.select("g", "at", "slots", "path")
        if up is not None:
            going = level.filter("n > 1").join(up, ["g", "at"]).select("g", "at", "slots", "path")
            done = done.unionByName(going)
        each = done.select("g", "at", "slots", "path", F.posexplode("slots").alias("i", "s"))
        longer = F.concat(F.array(siblings(F.col("slots"), F.col("i"))), "path").alias("path")
        if k == 0:
            return each.select("g", "s.row", "s.node", longer)
        up = each.select("g", (F.col("at") * FAN + F.col("i")).alias("at"), longer)
    raise ValueError("no level")


def height_of(n: int) -> int:
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def manifest(docs: DataFrame, tampered: Column | None = None, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text",
             fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(doc_id, leaf, at, subroot, root, path, other_leaf, folded_root) of every row.

    ``path`` lists the siblings left and right on the way to the root. ``tampered`` is the text to test a row with; its leaf
    is ``other_leaf`` and ``folded_root`` is what that leaf and the original siblings give.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    other = F.col(text_col) if tampered is None else tampered
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))  # null before any name
    leaf = leaf_of([F.col(f) for f in fields])
    leaves = docs.select(group.alias("g"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("key"), leaf.alias("leaf"),
                         leaf_of([other if f == text_col else F.col(f) for f in fields]).alias("other_leaf"))
    at = stored(placed(leaves))
    sizes = stored(at.groupBy("g").agg(F.count(F.lit(1)).alias("n")))
    row = F.struct("doc_id", "other_leaf", "at").alias("row")
    first = at.join(sizes, "g").select("g", "n", "at", F.col("leaf").alias("node"), row)
    tallest = height_of(sizes.agg(F.max("n")).first()[0] or 0)
    levels = grow(first, tallest)
    lone = first.filter("n = 1").select("g", "row", "node")
    roots = reduce(DataFrame.unionByName, [x.filter("n = 1").select("g", "node") for x in levels], lone.select("g", "node"))

    # The groups' roots form one more tree, in order of the groups' names.
    tops = stored(dense_number(roots, "g", start=0, out="at"))
    many = tops.count()
    base = tops.select(F.lit("").alias("g"), F.lit(many).cast("long").alias("n"), F.col("at").cast("long").alias("at"), "node", F.struct("g").alias("row"))
    upper = grow(base, height_of(many))
    if upper:
        root = upper[-1].select(F.col("node").alias("root"))
        top_paths = paths(upper).select("row.g", F.col("node").alias("subroot"), "path")
    else:
        root = tops.select(F.col("node").alias("root"))
        top_paths = tops.select("g", F.col("node").alias("subroot"), F.array().cast(STEP).alias("path"))
    top_paths = stored(top_paths)
    single = lone.join(top_paths, "g").select("g", "row", "node", "path")
    every = single if not levels else single.unionByName(paths(levels, top_paths.select("g", "path")))
    value = root.first()
    fold = F.aggregate("path", F.col("row.other_leaf"), lambda h, s: digest(F.concat(s["left"], h, s["right"])))
    return (every.join(top_paths.select("g", "subroot"), "g")
            .select("row.doc_id", F.col("node").alias("leaf"), "row.at", "subroot", F.lit(value[0] if value else None).cast("string").alias("root"), "path",
                    "row.other_leaf", fold.alias("folded_root")))


def proof(path: Column) -> Column:
    """Digest of all siblings from the bottom up."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))
