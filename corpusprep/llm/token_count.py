"""Token counts by the whole-token shortcut.

Offline, every vocabulary string is merged on its own; those that end as one token are proven whole tokens. A
pre-token found in that set counts one without merging; only the rest is merged. The proof runs once on the driver and
is broadcast: its size is bounded by the vocabulary (about 49,000 short strings), not by the data.

Null text counts as empty (0 tokens), repeated rows are counted row by row, an empty table gives an empty table, and
columns of the input named like an output are replaced.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BoundedCache, text_or_empty
from .merges import merge

END = "</w>"
# White space of the Unicode property; str.split() would also split at the four information separators.
SEPARATORS = re.compile("[\x1c-\x1f]")
WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def prove_whole_tokens(spec: dict) -> set[str]:
    """The pre-tokens whose merges end in exactly one token of the vocabulary ``spec`` (a parsed tokenizer file)."""
    alphabet = byte_alphabet()
    back = {c: b for b, c in enumerate(alphabet)}
    ranks = _ranks(spec)
    proven = set()
    for token in spec["model"]["vocab"]:
        if not token.endswith(END) or any(c not in back for c in token[:-len(END)]):
            continue
        try:
            word = bytes(back[c] for c in token[:-len(END)]).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if word and _merged(word, alphabet, ranks) == 1:
            proven.add(word)
    return proven


def _ranks(spec: dict) -> dict[tuple[str, str], int]:
    pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"])
    return {p: i for i, p in enumerate(pairs)}


def _merged(word: str, alphabet: list[str], ranks: dict) -> int:
    symbols = [alphabet[b] for b in word.encode("utf-8")]
    symbols[-1] += END
    return len(merge(symbols, ranks.get))


class WholeTokenCounter:
    """Counts the tokens of a text; white-space delimited chunks are remembered in a bounded cache."""

    def __init__(self, spec: dict, proven: set[str]):
        self.proven, self.alphabet, self.ranks = proven, byte_alphabet(), _ranks(spec)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pretokens = regex.compile(pattern)
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")")
        self.marks = specials
        self.chunks = BoundedCache(self._chunk)
        self.words = BoundedCache(lambda w: _merged(w, self.alphabet, self.ranks))

    def count(self, text: str) -> int:
        words = text.split() if not SEPARATORS.search(text) else WHITE.split(text)
        return sum(map(self.chunks.__getitem__, words))

    def _chunk(self, chunk: str) -> int:
        if not any(m in chunk for m in self.marks):
            return self._plain(chunk)
        parts = self.special.split(chunk)  # odd places hold the special strings: one token each
        return len(parts) // 2 + sum(self._plain(p) for p in parts[::2] if p)

    def _plain(self, part: str) -> int:
        # character by character: a capital sigma at a word's end becomes the plain small sigma
        lowered = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
        return sum(1 if p in self.proven else self.words[p] for p in self.pretokens.findall(lowered))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048, text_col: str = "text") -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) to ``docs``.

    ``vocabulary`` is the path of a byte-level BPE file with word ends (read on the driver).
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    spec = {k: spec[k] for k in ("added_tokens", "pre_tokenizer", "model")}
    shared = docs.sparkSession.sparkContext.broadcast((spec, prove_whole_tokens(spec)))

    @F.arrow_udf(T.LongType())
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = WholeTokenCounter(*shared.value)
        for texts in batches:
            yield pa.array([counter.count(t) for t in texts.to_pylist()], pa.int64())

    text = text_or_empty(text_col)
    out = docs.withColumns({"n_bytes": F.octet_length(text).cast("long"), "n_tokens": n_tokens(text)})
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
