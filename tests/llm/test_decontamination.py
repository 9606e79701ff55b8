from collections import Counter
from math import log

from conftest import SF_SMALL
from pyspark.sql import functions as F

from corpusprep.llm import bm25_decontam as bm

from .fixtures import EDGES, documents

THRESHOLD = 0.5


def brute(docs, items, threshold=THRESHOLD, q=0.6, a=0.6):
    """Every passage against every item, without index, bounds or skipping."""
    items = [(i, t) for i, t in items if bm.words_of(t)]
    df = Counter(w for _, t in items for w in set(bm.words_of(t)))
    mean = sum(len(bm.words_of(t)) for _, t in items) / len(items)
    step, weights, out = max(len(bm.words_of(t)) for _, t in items), {}, {}
    for i, t in items:
        words = bm.words_of(t)
        norm = 1.2 * (0.25 + 0.75 * len(words) / mean)
        w = {x: log(1 + (len(items) - df[x] + 0.5) / (df[x] + 0.5)) * n * 2.2 / (n + norm) for x, n in Counter(words).items()}
        weights[i] = {x: v / sum(w.values()) for x, v in w.items()}
    parts = {i: bm.parts(t) for i, t in items}
    for doc, text in docs:
        words = bm.words_of(text or "")
        for at in range(0, max(len(words), 1), step):
            passage = words[at:at + 2 * step]
            have, pairs = set(passage), set(zip(passage, passage[1:]))
            for i, w in weights.items():
                score = sum(v for x, v in w.items() if x in have)
                asked, answered = (bm.share(p, pairs, have) for p in parts[i])
                if score >= threshold - 1e-9 and asked >= q and answered >= a:
                    best = (round(score, 9), asked, answered)
                    out[doc, i] = max(out.get((doc, i), best), best)
    return out


def inputs(spark):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text")
    texts = [r["text"] for r in items.collect()]
    words = texts[0].split()
    near = " ".join(w if i % 7 else "other" for i, w in enumerate(words))
    extra = EDGES + [texts[0], near, "lead " * 300 + texts[1] + " tail" * 100, " ".join(words[:len(words) // 2]), texts[2] + " " + texts[3]]
    docs = documents(spark, SF_SMALL, extra).withColumns({"item_id": F.lit(1), "score": F.lit(2)})
    return docs, items, texts


def test_pairs_equal_brute_force(spark):
    docs, items, _ = inputs(spark)
    more = items.unionByName(spark.createDataFrame([(900, None), (901, ""), (902, "What is it? Answer: forty two words"), (903, "one")], "item_id long, text string"))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"] or "") for r in more.collect()])
    for shard_chars in (1 << 24, 3_000):  # one index, several shards
        got = {(r["doc_id"], r["item_id"]): (round(r["score"], 9), r["question_overlap"], r["answer_overlap"])
               for r in bm.find_leaks(docs, more, THRESHOLD, shard_chars=shard_chars).collect()}
        assert got.keys() == want.keys()
        assert shard_chars < 1 << 24 or all(abs(got[k][0] - want[k][0]) < 1e-6 for k in want)


def test_wand_retrieves_all_above_the_threshold():
    items = [(i, " ".join(f"t{(i * k) % 23}" for k in range(1, 12))) for i in range(1, 120)]
    df = Counter(w for _, t in items for w in set(bm.words_of(t)))
    index = bm.Index(items, df, len(items), 11.0)
    for threshold in (0.1, 0.3, 0.6, 0.95):
        for i in range(0, 23, 2):
            terms = [t for t in (b"t%d" % ((i * k) % 23) for k in range(9)) if t in index.postings]
            terms = list(dict.fromkeys(terms))
            scores = Counter()
            for t in terms:
                for item, x in zip(*index.postings[t]):
                    scores[item] += x
            want = sorted(item for item, s in scores.items() if s >= threshold - 1e-9)
            assert [item for item, _ in index.retrieve(terms, threshold)] == want


def test_verbatim_items_are_found_and_removed(spark):
    docs, items, texts = inputs(spark)
    holding = {r["doc_id"] for r in docs.collect() if any(t in (r["text"] or "") for t in texts)}
    kept = bm.remove_leaks(docs, items)
    left = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == docs.columns and not holding & left
    assert bm.remove_leaks(docs, items.limit(0)).count() == docs.count()
    assert bm.find_leaks(docs.limit(0), items).collect() == []
    assert bm.remove_leaks(docs.unionByName(docs), items, broadcast_rows=0).count() == 2 * len(left)


def test_null_ids_and_shards_do_not_change_the_result(spark):
    docs, items, texts = inputs(spark)
    rows = [(None, texts[0]), (None, "a text of its own"), (None, None), (7_000, texts[1]), (7_000, "another text under that id")]
    some = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (1_000_000, 0):
        assert sorted(r["text"] or "" for r in bm.remove_leaks(some, items, broadcast_rows=limit).collect()) == [
            "", "a text of its own", "another text under that id"]
    one, many = ({(r["doc_id"], r["item_id"]): r[2:] for r in bm.find_leaks(docs, items, 0.3, shard_chars=n).collect()} for n in (1 << 24, 500))
    assert one.keys() == many.keys() and all(abs(x - y) < 1e-9 for k in one for x, y in zip(one[k], many[k]))
