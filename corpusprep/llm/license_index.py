"""Licence scan with a positional rare-token index, in DataFrame functions only.

Each template (a licence statement) is indexed under its words of highest inverse document frequency, counted over all
files: a posting is (template, place of the word in it). A file's rare licence words are looked up; each hit at word
``q`` of a posting at place ``p`` proposes the template at word ``q - p``. The proposals of one file are intersected by
relative position: enough index words of the template must stand at their places, and its mandatory key phrase must
stand there word for word. The template library, and with it the index, is a small fixed list.

Words are runs of digits, ASCII letters (lower-cased) and characters above U+007F. Null text is empty, repeated rows are
scanned row by row, files without words have no label and score 0, an empty table gives an empty table, and input columns
named like an output are replaced. Nothing is shuffled but the word counts of the template words.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, free_name, text_or_empty

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str  # mandatory phrase, part of text
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        key, words = self.key.split(), self.words
        return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


# The phrases of the base rule, then common licence statements.
TEMPLATES = [
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl", "under the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "under the gnu affero general public license", "gnu affero general public license"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
             "permission to use copy modify and or distribute this software"),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
]


def words_of(text: Column) -> Column:
    """Words with A-Z lower-cased. ``lower`` serves unless a character outside ASCII would become an ASCII letter."""
    odd = F.contains(text, F.lit("K")) | F.contains(text, F.lit("İ"))
    lowered = F.when(odd, ascii_lower(text)).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, SEPARATOR), "")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _constant(value, kind: str) -> Column:
    """A nested constant; Catalyst folds it once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def rare_words(docs: DataFrame, templates: list[Template], per_template: int, text_col: str) -> list[list[str]]:
    """For each template its words of highest inverse document frequency over all files (ties: alphabetically)."""
    vocabulary = sorted({w for t in templates for w in t.words})
    found = docs.select(F.explode(F.array_intersect(words_of(text_or_empty(text_col)), _strings(vocabulary))).alias("w"))
    counted = docs.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    df = {r["w"]: r["count"] for r in found.groupBy("w").count().collect()}  # at most one row per template word
    idf = {w: log((counted + 1) / (df.get(w, 0) + 1)) for w in vocabulary}
    return [sorted(set(t.words), key=lambda w: (-idf[w], w))[:per_template] for t in templates]


def scan_licenses(docs: DataFrame, templates: list[Template] = TEMPLATES, per_template: int = 2, votes: float = 0.75,
                  text_col: str = "text") -> DataFrame:
    """Add ``n_words`` and ``found``, an array of (label, base, start, score), to ``docs``.

    ``start`` is the word (from 0) where the key phrase stands; ``score`` the share of the template's words at their
    places. A template needs the share ``votes`` of its index words at their places, and its key phrase.
    """
    index = rare_words(docs, templates, per_template, text_col)
    own = free_name(docs, "words")
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, (template, rare) in enumerate(zip(templates, index)):
        for p, w in enumerate(template.words):
            if w in rare:
                postings.setdefault(w, []).append((t, p))
    lookup = _constant({w: [{"t": t, "p": p} for t, p in ps] for w, ps in postings.items()},
                       "map<string,array<struct<t:bigint,p:bigint>>>")
    rare = _strings(sorted(postings))

    library = _constant([{
        "label": t.label, "base": t.base, "key_at": t.key_at, "key": t.key, "key_words": len(t.key.split()),
        "places": [{"p": p, "w": w, "indexed": w in chosen} for p, w in enumerate(t.words)],
        "need": 0 if t.base else ceil(votes * sum(w in chosen for w in t.words))} for t, chosen in zip(templates, index)],
        "array<struct<label:string,base:boolean,key_at:int,key:string,key_words:int,"
        "places:array<struct<p:int,w:string,indexed:boolean>>,need:int>>")

    def match(proposal: Column) -> Column:
        at = (F.shiftright(proposal, 8) - F.lit(64)).cast("int")
        t = F.element_at(library, (proposal.bitwiseAND(F.lit(255)) + 1).cast("int"))
        start = at + t["key_at"]
        in_place = F.filter(t["places"], lambda x: F.get(own, at + x["p"]) == x["w"])
        key_stands = (start >= 0) & (F.array_join(F.slice(own, F.greatest(start, F.lit(0)) + 1, t["key_words"]), " ") == t["key"])
        found = F.struct(t["label"].alias("label"), t["base"].alias("base"), start.cast("long").alias("start"),
                         (F.size(in_place) / F.size(t["places"])).alias("score"))
        return F.when(key_stands & (F.size(F.filter(in_place, lambda x: x["indexed"])) >= t["need"]), found)

    # A proposal packs (word + 64, template) into one integer, so that equal ones are dropped by hashing.
    hits = F.filter(F.transform(own, lambda w, i: F.struct(w.alias("w"), i.cast("long").alias("i"))),
                    lambda h: F.array_contains(rare, h["w"]))
    proposals = F.array_distinct(F.flatten(F.transform(hits, lambda h: F.transform(
        F.element_at(lookup, h["w"]), lambda q: F.shiftleft(h["i"] - q["p"] + F.lit(64), 8) + q["t"]))))
    nothing = F.array().cast("array<struct<label:string,base:boolean,start:bigint,score:double>>")
    found = F.when(F.arrays_overlap(own, rare), F.filter(F.transform(proposals, match), lambda m: m.isNotNull())).otherwise(nothing)
    return (docs.withColumn(own, words_of(text_or_empty(text_col)))
            .withColumns({"n_words": F.size(own).cast("long"), "found": found}).drop(own))
