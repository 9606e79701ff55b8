"""Exact merge-type (BPE) SentencePiece encoding by backtracking, and its decoding.

A token sequence is the merge result exactly if every token re-merges to itself and every adjacent pair re-merges to
itself. The encoder therefore walks the text with the longest pieces that an Aho-Corasick automaton finds at each place,
checks each piece against its predecessor by re-merging the two, falls back to shorter pieces, and keeps a bitfield of
positions from which no encoding continues, so that no position fails twice. Runs of space marks, whose pieces all have
one score, and characters outside the vocabulary (byte pieces) are settled on their own.

No piece holds a space mark behind another character (checked when the model is loaded), so the text is cut before each
run of marks and the chunks are encoded independently; a bounded cache remembers the ids of frequent chunks, and the text
is decoded from the ids of the whole row. Null text is empty (no ids), repeated rows are encoded row by row, an empty
table gives an empty table, and columns of the input named like an output are replaced. The pieces and scores are broadcast; their number is the model's vocabulary, whatever the data.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BoundedCache, free_name, text_or_empty
from .merges import merge

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
SLICE = 256


class Model:
    """The pieces as they are broadcast, and one encoder for each Python process that reads them."""

    def __init__(self, model_file: str):
        self.pieces = load_pieces(model_file)
        self.made = None

    def __getstate__(self):
        return {"pieces": self.pieces, "made": None}

    def encoder(self) -> BacktrackEncoder:
        """The process's encoder; its caches outlast a task where Spark reuses the process."""
        if self.made is None:
            self.made = BacktrackEncoder(*self.pieces)
        return self.made


def load_pieces(model_file: str) -> tuple[dict[str, tuple[int, float]], list[str], int]:
    """(piece -> (id, score) of ordinary pieces, all pieces by id, id of byte 0) of a byte-fallback BPE model."""
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    names = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
    plain = {p: (i, sp.get_score(i)) for i, p in enumerate(names)
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    if any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and p.strip(MARK)) for p in plain):
        raise ValueError("pieces that run across a space mark are not supported")
    return plain, names, sp.piece_to_id("<0x00>")


class BacktrackEncoder:
    def __init__(self, plain: dict[str, tuple[int, float]], names: list[str], byte0: int):
        self.plain, self.names, self.byte0 = plain, names, byte0
        self.ids = {p: i for p, (i, _) in plain.items()}
        self.ranks = {p: -score for p, (_, score) in plain.items()}
        self.shorter = BoundedCache(self._prefix)
        self.chars = {p for p in plain if len(p) == 1}
        self.stable = BoundedCache(lambda p: self._remerge(p) == [p])
        self.fits = BoundedCache(lambda pair: self._remerge(pair[0] + pair[1]) == list(pair))
        self.automaton = ahocorasick.Automaton()
        for p in plain:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.chunks = BoundedCache(self._chunk)
        # What each id stands for; a byte beyond ASCII is the surrogate that Python writes as this byte.
        self.shown = [*names]
        self.shown[byte0:byte0 + 256] = [chr(b if b < 128 else 0xDC00 + b) for b in range(256)]

    def _rank(self, pair: tuple[str, str], default: float) -> float:
        return self.ranks.get(pair[0] + pair[1], default)

    def _remerge(self, text: str) -> list[str]:
        return merge(text, self._rank)

    def _prefix(self, piece: str) -> str:
        """The longest shorter piece that ``piece`` starts with; empty if there is none."""
        return next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.plain), "")

    def _known(self, text: str) -> list[str]:
        """Pieces of a text of vocabulary characters without a run of marks."""
        n = len(text)
        alive = bytearray(b"\x01" * (n + 1))  # 0: no encoding goes on from here
        out: list[str] = []
        pos = 0
        stable, fits, longest = self.stable, self.fits, self.automaton.iter_long
        # The longest pieces one behind the other, as far as they fit; mostly that is the whole text.
        last = ""
        for _, piece in longest(text):
            if not stable[piece] or (last and not fits[last, piece]):
                break
            out.append(piece)
            last = piece
        else:
            return out
        pos = sum(map(len, out))
        while True:
            while piece and not (alive[pos + len(piece)] and stable[piece] and (not out or fits[out[-1], piece])):
                piece = self.shorter[piece]
            if piece:
                out.append(piece)
                pos += len(piece)
                if pos == n:
                    return out
                piece = next(longest(text, pos))[1]
            else:
                alive[pos] = 0
                piece = out.pop()
                pos -= len(piece)

    def _chunk(self, chunk: str) -> bytes:
        """Ids, as packed 32-bit integers, of a chunk: marks, then characters that are no mark."""
        if not chunk.startswith(MARK):
            chunk = MARK + chunk  # the cache's key of the usual chunk leaves its one mark out
        body = chunk.lstrip(MARK)
        marks = len(chunk) - len(body)
        if marks == 1 and self.chars.issuperset(body):
            return array("i", [self.ids[p] for p in self._known(chunk)]).tobytes()
        pieces: list[str | int] = []
        known = MARK
        for c in body:
            if c in self.chars:
                known += c
                continue
            if known:
                pieces += self._known(known)
                known = ""
            pieces += [self.byte0 + b for b in c.encode("utf-8")]
        if known:
            pieces += self._known(known)
        if marks > 1:  # all pieces of marks come after every other merge
            rest = pieces[0] == MARK
            pieces[:rest] = self._remerge(MARK * (marks - 1 + rest))
        return array("i", [p if isinstance(p, int) else self.ids[p] for p in pieces]).tobytes()

    def decode(self, ids: bytes) -> str:
        """Text of packed ids: byte pieces joined as UTF-8, marks turned into spaces."""
        out = "".join(map(self.shown.__getitem__, array("i", ids))).replace(MARK, " ")
        return out if out.isascii() else out.encode("utf-8", "surrogateescape").decode("utf-8", "replace")

    def encode(self, text: str) -> tuple[bytes, str]:
        """(packed ids, decoded text); decoding drops the space that encoding puts in front."""
        if not text:
            return b"", ""
        words = text.split(" ")
        if MARK in text or "" in words:
            words = CHUNK.findall(MARK + text.replace(" ", MARK))
        ids = b"".join(map(self.chunks.__getitem__, words))
        return ids, self.decode(ids)[1:]


def encoded(encoder: BacktrackEncoder, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """(ids, decoded) of texts; a batch is taken in slices, so that few of its texts and results are Python objects at a time."""
    for whole in batches:
        for at in range(0, len(whole), SLICE):
            done = [encoder.encode(t) for t in whole.slice(at, SLICE).to_pylist()]
            offsets = pa.array([0, *accumulate(len(d[0]) // 4 for d in done)], pa.int32())
            flat = pa.Array.from_buffers(pa.int32(), offsets[-1].as_py(), [None, pa.py_buffer(b"".join([d[0] for d in done]))])
            kept = pa.field("element", pa.int32(), nullable=False)
            ids = pa.ListArray.from_arrays(offsets, flat, type=pa.list_(kept))
            yield pa.StructArray.from_arrays([ids, pa.array([d[1] for d in done], pa.string())], ["ids", "decoded"])


def encode_decode(docs: DataFrame, model_file: str, text_col: str = "text", ids_col: str = "ids",
                  decoded_col: str = "decoded") -> DataFrame:
    """Add the ids (array of int) and the text decoded from them to ``docs``; ``model_file`` is read on the driver."""
    shared = docs.sparkSession.sparkContext.broadcast(Model(model_file))
    kind = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from encoded(shared.value.encoder(), batches)

    own = free_name(docs, "encoded")
    out = docs.withColumn(own, run(text_or_empty(text_col)))
    return out.withColumns({ids_col: F.col(own)["ids"], decoded_col: F.col(own)["decoded"]}).drop(own)
