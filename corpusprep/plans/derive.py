"""Corpus inputs derived from the provided tables.

The provided tables hold prose but no code, prompts, camelCase or contractions, so code and
prompt text is composed per row from table columns (integers and short strings only, so
every engine renders it identically). Each derivation reads the whole table and grows
with it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.operators.numbering import dense_number
from corpusprep.operators.vocab import build_vocab


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table, spread over the cores when its file has fewer splits than that."""
    from corpusprep.sources.io import spread_input

    return spread_input(spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism)


def _s(name: str) -> Column:
    return F.col(name).cast("string")


def python_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, code)``: one Python snippet per order, four shapes by ``o_orderkey % 4``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    k, c, st, pr = _s("o_orderkey"), _s("o_custkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    shapes = [
        F.concat(F.lit("total_"), c, F.lit(" = count_"), c, F.lit(" = "), k, F.lit("\nfor item, qty in lines("), c,
                 F.lit("):\n    status = \""), st, F.lit("\"  # "), pr,
                 F.lit("\n    print(item, qty * total_"), c, F.lit(")")),
        F.concat(F.lit("# order "), k, F.lit("\nsumPrice = 0x1F\nwhile sumPrice < "), c,
                 F.lit(":\n    sumPrice = sumPrice + 1.5\nprint('done for x in it', sumPrice)")),
        F.concat(F.lit("def f(a, b="), c, F.lit("):\n    return a->b >> "), k,
                 F.lit("\n>>> f(1)\nresult = [x for x in range("), k, F.lit(") if x != '"), pr,
                 F.lit("'] + [y for y in range("), c, F.lit(")]")),
        F.concat(F.lit("customer_id, order_id = "), c, F.lit(", "), k,
                 F.lit("\nprint(\"it's \" + '"), st, F.lit("')")),
    ]
    m = F.col("o_orderkey") % 4
    code = F.when(m == 0, shapes[0]).when(m == 1, shapes[1]).when(m == 2, shapes[2]).otherwise(shapes[3])
    return o.select(F.col("o_orderkey").alias("id"), code.alias("code"))


def python_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, code)``: one Python snippet per order for the lexer and the names it stores, ten shapes by ``o_orderkey % 10``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    k, c, st = _s("o_orderkey"), _s("o_custkey"), F.col("o_orderstatus")

    def code(form: str) -> Column:
        """``form`` with the order's number, customer and status in the places ``{k}``, ``{c}`` and ``{s}``."""
        parts = [F.lit(p) if i % 2 == 0 else {"k": k, "c": c, "s": st}[p] for i, p in enumerate(re.split(r"\{([kcs])\}", form))]
        return F.concat(*parts)

    shapes = [
        r"""note_{c} = 'it\'s ' + {k} + "a\"b = {s}" """,
        "(a_{c}, [b, *rest]) = {k}, [2]\nlast = first = rest[0]",
        "print('{s} is open\nx = {k}",
        "del z{c}, w[{k}], (u, v.t)\nprint(d['e = f'])",
        "import numpy as np\nwith open('{s}') as h{c}, lock(k=1) as (p, q): line = h.read({k})",
        "rows = [x for x, (y, z) in items[{k}] if x != 'for q in r']\ncount_{c} += sum(i for i in rows)",
        "text = '''m = {k}\nn = 2''' ; pat = r'\\d+'  # o = 1\nfor i, j in text: s[i] = j",
        "size_{c}: int = {k}\n*head, tail = parts\nif (n := 3) >= tail: m = n == 4",
        "x{c} = 3rd + 0x1F + 1e5 + 007 + 2j # y = {k}",
        "a.b[{c}] = f(k={k}, *v); g = lambda u=1: u\nreturn [s\n, (t",
    ]
    shape = F.element_at(F.array(*map(code, shapes)), (F.col("o_orderkey") % 10 + 1).cast("int"))
    return o.select(F.col("o_orderkey").alias("id"), shape.alias("code"))


def sql_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, code)``: one SQL snippet per part, six shapes by ``p_partkey % 6`` (one cleans to nothing)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    key, size = _s("p_partkey"), _s("p_size")
    shapes = [
        F.concat(F.lit("SELECT p.p_name, COUNT(*) FROM part p WHERE p.p_size = "), size,
                 F.lit(" AND p.p_brand LIKE '"), F.col("p_brand"), F.lit("%' GROUP BY p.p_name")),
        F.concat(F.lit("UPDATE Inventory SET retailPrice = 0x1F, qty = 2.5 WHERE p_type = '"), F.col("p_type"),
                 F.lit("' AND size >= "), size, F.lit(" ORDER BY day, year")),
        F.concat(F.lit("SELECT t.id, MAX(o.total) FROM (SELECT * FROM stock s WHERE s.qty > "), key,
                 F.lit(") t JOIN orders o ON o.id = t.id WHERE o.note = \""), F.col("p_name"),
                 F.lit("\" UNION SELECT 1e5, ["), F.col("p_brand"), F.lit("]")),
        F.concat(F.lit("SELECT order.id, key.name, [Unit Price] FROM [Order Details] d WHERE id = ? AND size = "), size,
                 F.lit(" AND [Category] = c.category_name")),
        F.concat(F.lit("SELECT a FROM t WHERE b REGEXP '^ab+[0-9]*c?$' AND d LIKE '%"), F.col("p_brand"),
                 F.lit("@{x}%' AND e IN (SELECT 'it, all' FROM u)")),
        F.lit(":: @"),
    ]
    m = F.col("p_partkey") % 6
    code = F.when(m == 0, shapes[0])
    for i in range(1, 5):
        code = code.when(m == i, shapes[i])
    code = code.otherwise(shapes[5])
    return p.select(F.col("p_partkey").alias("id"), code.alias("code"))


def sql_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, code)``: one SQL text with nested brackets per part, six shapes by ``p_partkey % 6``."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    key, size = _s("p_partkey"), _s("p_size")
    shapes = [
        F.concat(F.lit("SELECT (SELECT max(a) FROM t WHERE b IN (SELECT c FROM u WHERE d = "), size, F.lit(")) FROM v")),
        F.concat(F.lit("SELECT '( select 1', \"(select\" FROM t -- (select "), key, F.lit("\nWHERE x = (y + "), size, F.lit(")")),
        F.concat(F.lit("INSERT INTO t (a, b) (SELECT c, (d + "), size, F.lit(") FROM u) ON CONFLICT (a) DO UPDATE SET b = (SELECT "), key, F.lit(")")),
        F.concat(F.lit("SELECT f((SELECT 1)), ((SELECT "), size, F.lit("), 'it''s (') /* (select */ FROM t")),
        F.concat(F.lit("SELECT a FROM t WHERE (b = (SELECT "), key, F.lit(" FROM u) AND (c = '"), F.col("p_brand"), F.lit("'")),
        F.concat(F.lit(") SELECT 1) FROM (SELECT ["), F.col("p_brand"), F.lit(" (select] FROM selected (x)) q WHERE (WITH w AS (SELECT 2) SELECT 3) > "), size),
    ]
    shape = F.element_at(F.array(*shapes), (F.col("p_partkey") % 6 + 1).cast("int"))
    return p.select(F.col("p_partkey").alias("id"), shape.alias("code"))


def contraction_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, text)``: one sentence with contractions per customer."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    text = F.concat(F.col("c_name"), F.lit(' can"t say it"s '), F.col("c_mktsegment"),
                    F.lit('. They"re sure I"m here, she"d say we"ll go; there"s '), _s("c_nationkey"),
                    F.lit(" boss\"s, It\"S fine, it's that's here's"))
    return c.select(F.col("c_custkey").alias("id"), text.alias("text"))


def prompt_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, code)``: one interactive-session snippet per order, one line per line item.

    The line kind follows ``(l_linenumber + l_partkey) % 6``; lines are ordered by line
    number, then text. A snippet has as many lines as its order has items.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                 "l_returnflag", "l_linestatus")
    n = _s("l_linenumber")
    m = (F.col("l_linenumber") + F.col("l_partkey")) % 6
    line = (F.when(m == 0, F.concat(F.lit(">>> qty = "), n))
            .when(m == 1, F.concat(F.lit("... total += "), _s("l_partkey")))
            .when(m == 2, F.concat(F.lit("In ["), n, F.lit("]: x = "), _s("l_suppkey")))
            .when(m == 3, F.concat(F.lit("Out["), n, F.lit("]: "), _s("l_partkey")))
            .when(m == 4, F.concat(F.lit("   ...: y = "), F.col("l_returnflag")))
            .otherwise(F.concat(F.lit("result "), F.col("l_linestatus"))))
    lines = li.select("l_orderkey", F.struct(F.col("l_linenumber"), line.alias("line")).alias("entry"))
    return lines.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.array_join(F.array_sort(F.collect_list("entry")).getField("line"), "\n").alias("code"))


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, value)``: one JSON line per customer, six shapes by ``c_custkey % 6``, four of them no records."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    k = _s("c_custkey")
    good = F.concat(F.lit('{"qid": {"question_id": "'), k, F.lit('", "cand": 1}, "lang": "sql", "query": "'), F.col("c_name"), F.lit('"}'))
    shapes = [
        good,
        F.substring(good, 1, 30),
        F.concat(F.lit('{"qid": {"question_id": "'), k, F.lit('", "cand": "many"}, "query": "x"}')),
        F.concat(F.lit('{"lang": "sql", "query": "'), F.col("c_mktsegment"), F.lit('"}')),
        F.lit("  "),
        F.concat(F.lit('{"more": [1], "query": null, "qid": {"cand": 2, "question_id": "'), k, F.lit('"}}')),
    ]
    return c.select(F.col("c_custkey").alias("id"), F.element_at(F.array(*shapes), (F.col("c_custkey") % 6 + 1).cast("int")).alias("value"))


def vector_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(value)``: one word2vec line of two numbers per part, five shapes by ``p_partkey % 5``, three of them no vectors."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    k, size = _s("p_partkey"), _s("p_size")
    shapes = [
        F.concat(F.lit("w"), k, F.lit(" "), size, F.lit(".5 -1")),
        F.concat(F.lit("w"), k, F.lit(" "), size),
        F.concat(F.lit("two words"), k, F.lit(" 0.25 "), size),
        F.concat(F.lit("w"), k, F.lit(" "), size, F.lit(" x1")),
        F.concat(size, F.lit(" "), size),
    ]
    return p.select(F.element_at(F.array(*shapes), (F.col("p_partkey") % 5 + 1).cast("int")).alias("value"))


def raw_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw question/context/code records from ``conversations``.

    Question id = ``conv_id``; every user turn is a candidate; the turns before and after it
    are the two contexts (``-10000`` when missing), its text is the query, and a short
    snippet in the conversation's language (``python`` for even ids, ``sql`` for odd) is
    the code. Neighbouring turns come from equi-joins on ``(conv_id, turn)``, which spread
    evenly even when one conversation is very long.
    """
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    prev = conv.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("ctx1"))
    nxt = conv.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("ctx2"))
    users = conv.filter(F.col("role") == "user")
    rows = users.join(prev, ["conv_id", "turn"], "left").join(nxt, ["conv_id", "turn"], "left")
    lang = F.when(F.col("conv_id") % 2 == 0, F.lit("python")).otherwise(F.lit("sql"))
    py = F.concat(F.lit("reply_"), _s("turn"), F.lit(" = '"), F.col("role"), F.lit("'\nfor w in words("),
                  _s("conv_id"), F.lit("):\n    print(w)"))
    sq = F.concat(F.lit("SELECT text FROM conversations c WHERE c.conv_id = "), _s("conv_id"),
                  F.lit(" AND turn > "), _s("turn"))
    return rows.select(
        F.struct(_s("conv_id").alias("question_id"), F.col("turn").cast("int").alias("cand")).alias("qid"),
        lang.alias("lang"),
        F.coalesce("ctx1", F.lit("-10000")).alias("ctx1"),
        F.coalesce("ctx2", F.lit("-10000")).alias("ctx2"),
        F.when(lang == "python", py).otherwise(sq).alias("code"),
        F.col("text").alias("query"),
    )


def word_vectors(vocab: DataFrame, embeddings: DataFrame) -> DataFrame:
    """``(word, vec_id, vec)``: four of five words of ``vocab`` (by word ascending) take the embedding of
    their rank modulo the number of embeddings; every fifth word has no vector."""
    ranked = dense_number(vocab.select("word").distinct(), "word", start=0, out="rank").filter(F.col("rank") % 5 != 4)
    emb = embeddings.select(F.col("vec_id").cast("int").alias("vec_id"), F.col("embedding").alias("vec"))
    number = embeddings.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    paired = ranked.withColumn("vec_id", (F.col("rank") % F.lit(max(number, 1))).cast("int"))
    return paired.join(emb, "vec_id", "inner").select("word", "vec_id", "vec")


def tag_tables(vocab: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``emissions``, ``transitions`` and ``lemmas`` by rules on the endings of a vocabulary's words.

    Classes are a, n, r and v. Words of one letter have no emission.
    """
    w = F.col("word")
    size = F.length("word")
    scores = {
        "a": F.when(w.endswith("e") | w.endswith("al"), F.lit(-8)),
        "n": -10 - size % 3,
        "r": F.when(w.endswith("ly"), F.lit(-3)),
        "v": F.when(w.endswith("ing") | w.endswith("ed"), F.lit(-6)).when(size % 2 == 0, F.lit(-11)),
    }
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), s.cast("long").alias("score")) for c, s in scores.items()]))
    emissions = vocab.filter(size > 1).select(w.alias("token"), each.alias("e")).select("token", "e.class", "e.score").filter("score IS NOT NULL")
    spark = vocab.sparkSession
    names = ["a", "n", "r", "v"]
    pairs = [(p, c, -(1 + (3 * i + 2 * k) % 7)) for i, p in enumerate([*names, None]) for k, c in enumerate(names)]
    transitions = spark.createDataFrame(pairs, "previous string, class string, score long")
    base = F.when(w.endswith("s") & (size > 3), F.struct(F.lit("n").alias("class"), F.expr("left(word, length(word) - 1)").alias("lemma")))
    base = (base.when(w.endswith("ing") & (size > 5), F.struct(F.lit("v").alias("class"), F.expr("left(word, length(word) - 3)").alias("lemma")))
            .when(w.endswith("on"), F.struct(F.lit(None).cast("string").alias("class"), F.expr("left(word, length(word) - 2)").alias("lemma"))))
    lemmas = vocab.select(w.alias("token"), base.alias("b")).filter("b IS NOT NULL").select("token", "b.class", "b.lemma")
    return emissions, transitions, lemmas


def document_vocab(spark: SparkSession, sf_dir: str, dialect: str = "python") -> DataFrame:
    """Vocabulary of the query tokens of ``documents``."""
    from corpusprep.functions.text import query_tokens

    docs = table(spark, sf_dir, "documents").select(query_tokens("text", dialect).alias("t"))
    return build_vocab(docs, fields=["t"])


def benchmark_vocab(spark: SparkSession, sf_dir: str, dialect: str = "python") -> DataFrame:
    """Vocabulary of the query tokens of ``benchmark``."""
    from corpusprep.functions.text import query_tokens

    bench = table(spark, sf_dir, "benchmark").select(query_tokens("text", dialect).alias("t"))
    return build_vocab(bench, fields=["t"])
