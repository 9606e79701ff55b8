import json
import random
import tracemalloc
from array import array

import public_tokenizers
import pyarrow as pa
import sentencepiece
import tokenizers
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusprep.llm import merges, sp_backtrack, token_count

from .fixtures import EDGES, documents

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
SPEC = json.load(open(WORDS, encoding="utf-8"))
COUNTER = token_count.WholeTokenCounter(SPEC, token_count.prove_whole_tokens(SPEC))
LIBRARY = tokenizers.Tokenizer.from_file(WORDS)
ENCODER = sp_backtrack.BacktrackEncoder(*sp_backtrack.load_pieces(PIECES))
PROCESSOR = sentencepiece.SentencePieceProcessor(model_file=PIECES)
TEXTS = [t or "" for t in EDGES] + ["ΟΔΟΣ Σ İ", "don't I'LL we'Re it''s", "<|startoftext|>x<|ENDOFTEXT|><|endoftext|>", "é ﬁ™", "  ▁▁x ▁", " " * 999, "𝔘𝔫𝔦",
                                    "ab" * 20_000, "a b\x85c\xa0d", "<0x0A> </s> <unk>"]


def check(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids), repr(text)
    ids = PROCESSOR.encode(text)
    packed, decoded = ENCODER.encode(text)
    assert list(array("i", packed)) == ids and decoded == PROCESSOR.decode(ids), repr(text)


def test_edges():
    for text in TEXTS:
        check(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abt ▁\n\téßŒ日🙂<|>'.,0129Shein")) | st.characters(codec="utf-8", max_codepoint=0x2FFF, exclude_categories=["Cn", "Cs"]), max_size=24))
def test_random_texts(text):
    check(text)


def test_short_and_long_merging_agree():
    random.seed(2)
    for _ in range(200):
        word = "".join(random.choice("aeinst") for _ in range(random.randint(1, 40)))
        symbols = list(word)
        assert merges.merge(symbols, ENCODER._rank) == merges._merge_long(symbols, ENCODER._rank)


def test_backtracking_leaves_dead_ends():
    """Longest matches alone would give another result for some words: the checks of neighbours matter."""
    random.seed(3)
    differs = 0
    for _ in range(3000):
        word = sp_backtrack.MARK + "".join(random.choice("aeinstrohl") for _ in range(9))
        greedy, at = [], 0
        while at < len(word):
            n = max(n for n in range(1, 17) if word[at:at + n] in ENCODER.plain)
            greedy.append(word[at:at + n])
            at += n
        assert ENCODER._known(word) == ENCODER._remerge(word)
        differs += greedy != ENCODER._known(word)
    assert differs > 100


def test_spark_results(spark):
    docs = documents(spark, SF_SMALL, TEXTS).withColumnsRenamed({"lang": "ids"})  # a clashing name
    for r in sp_backtrack.encode_decode(docs, PIECES).collect():
        ids = PROCESSOR.encode(r["text"] or "")
        assert r["ids"] == ids and r["decoded"] == PROCESSOR.decode(ids)
    for r in token_count.count_tokens(docs, WORDS, limit=100).collect():
        n = len(LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"], r["n_bytes"]) == (n, n > 100, len((r["text"] or "").encode()))
    assert sp_backtrack.encode_decode(docs.limit(0), PIECES).count() == token_count.count_tokens(docs.limit(0), WORDS).count() == 0


def test_a_large_batch_is_not_held_whole():
    """Spark sends 10,000 rows at a time; their texts, ids and decoded texts must not stand in a worker all at once."""
    texts = pa.array(["one two three " * 100] * 10_000)
    ids = PROCESSOR.encode(texts[0].as_py())
    tracemalloc.start()
    n = 0
    for out in sp_backtrack.encoded(ENCODER, iter([texts, texts.slice(0, 0), texts.slice(0, 1)])):
        n += len(out)
        assert out[0].as_py() == {"ids": ids, "decoded": PROCESSOR.decode(ids)} and out[-1] == out[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 10_001 and peak < 6_000_000, peak


def test_the_cache_holds_ids_only():
    """A decoded text beside the ids of every cached chunk took more room than the ids."""
    ENCODER.encode("cache of ids")
    assert ENCODER.chunks["cache"] == array("i", PROCESSOR.encode("cache")).tobytes()
