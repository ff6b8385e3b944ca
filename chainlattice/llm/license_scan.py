"""License scan: phrases of whole words, and short notices found with edits.

A text is read as its words of ASCII letters (A-Z lower-cased), digits and all other than ASCII
characters, with one space between. Two searches go over it:

* phrases: places where a phrase's words stand consecutively;
* notices: passages that differ from a notice by at most a twelfth of its length in characters
  (put in, left out or changed). By the pigeonhole principle a notice cut into one piece more than
  it may have edits keeps a piece unchanged; one pass of an automaton finds the pieces of all
  notices. Around each piece, the regex library's bounded-error matching looks for the best
  passage, in a window of the notice's length and three times its edits at most. An edit destroys
  at most three of a notice's three-character sequences, so a window with fewer of them than all
  edits leave holds no passage and is not matched (this is exact: no passage is lost). Equal windows, as of
  passages that many documents share, are judged once in a batch of rows.

The score is 1 with a phrase, else 1 less the share of edits of the best notice, 0 without any.

Cases: null texts are empty ones: no words, no labels. Very long texts are read whole, their windows
one by one. Repeated rows are judged alike. Overlapping passages of one notice are one, that with
the fewest edits (the first of equals). Without rows, phrases or notices nothing is found. Input
columns named like a result column are replaced, all others are kept. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import slices, trimmed

#: Phrase and label.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: Label and the words of a public license's notice.
NOTICES = (
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "licensed under the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "made available under the terms of the eclipse public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("boost", "distributed under the boost software license version 1 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
)
#: One edit for so many characters of a notice.
SHARE = 12
#: Characters of the sequences that a window is counted by.
GRAM = 3
RESULT = {
    "n_words": "long",
    "places": "array<struct<label:string,first_word:int>>",
    "matches": "array<struct<label:string,errors:int,score:double,first_word:int,end_word:int,at:int,till:int>>",
    "score": "double",
}
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_RUN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class Found(NamedTuple):
    at: int
    till: int
    errors: int


def edits(notice: str) -> int:
    return len(notice) // SHARE


def pieces(notice: str) -> list[tuple[int, str]]:
    """The notice in one piece more than it may have edits: offset and piece."""
    n = edits(notice) + 1
    cuts = [len(notice) * i // n for i in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def grams(text: str) -> Counter[str]:
    return Counter(text[i : i + GRAM] for i in range(len(text) - GRAM + 1))


def normal(text: str | None) -> str:
    """The words of a text with one space between."""
    return b" ".join((text or "").encode("utf-8", "replace").translate(_WORD).split()).decode("utf-8")


class Notices:
    """The pieces of all notices in one automaton, and a pattern for each notice."""

    def __init__(self, notices: tuple[tuple[str, str], ...]):
        self.notices = notices
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, notice) in enumerate(notices):
            for offset, piece in pieces(notice):
                places.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n, literal_spaces=True)}){{e<={edits(n)}}}") for _, n in notices]
        self.grams = [(grams(n), len(n) - GRAM + 1 - GRAM * edits(n)) for _, n in notices]
        self.judged: dict[tuple[int, str], Found | None] = {}

    def windows(self, words: str) -> dict[int, list[tuple[int, int]]]:
        """For each notice the stretches of text that may hold it. Starts that pieces imply are taken together
        as long as they lie no further apart than the notice may have edits."""
        starts: dict[int, set[int]] = {}
        if len(self.automaton):
            for last, (size, where) in self.automaton.iter(words):
                for i, offset in where:
                    starts.setdefault(i, set()).add(last - size + 1 - offset)
        out: dict[int, list[tuple[int, int]]] = {}
        for i, own in starts.items():
            notice = self.notices[i][1]
            k, groups = edits(notice), []
            for s in sorted(own):
                if groups and s - groups[-1][0] <= k:
                    groups[-1][1] = s
                else:
                    groups.append([s, s])
            out[i] = [(max(0, a - k), min(len(words), b + len(notice) + k)) for a, b in groups]
        return out

    def best(self, i: int, window: str) -> Found | None:
        key = (i, window)
        if key not in self.judged:
            own, least = self.grams[i]
            m = self.patterns[i].search(window) if (own & grams(window)).total() >= least else None
            self.judged[key] = Found(m.start(), m.end(), sum(m.fuzzy_counts)) if m else None
        return self.judged[key]

    def matches(self, words: str) -> list[tuple[int, Found]]:
        """Notice and place of each passage, by place."""
        out = []
        for i, own in self.windows(words).items():
            kept: list[Found] = []
            for low, high in own:
                if m := self.best(i, words[low:high]):
                    m = Found(low + m.at, low + m.till, m.errors)
                    if not kept or m.at >= kept[-1].till:
                        kept.append(m)
                    elif m.errors < kept[-1].errors:
                        kept[-1] = m
            out += [(i, m) for m in kept]
        return sorted(out, key=lambda x: (x[1].at, x[0]))


def places(words: str, phrases: tuple[tuple[str, str], ...]) -> list[tuple[str, int]]:
    """(label, first word) of every place of every phrase, by word."""
    own, out = f" {words} ".encode(), []
    for phrase, label in phrases:
        sought, at, seen, word = f" {phrase} ".encode(), 0, 0, 0
        while (at := own.find(sought, at)) >= 0:
            word, seen = word + own.count(b" ", seen, at), at
            out.append((label, word))
            at += 1
    return sorted(out, key=lambda x: (x[1], x[0]))


def described(text: str, words: str, found: list[tuple[int, Found]], notices: tuple[tuple[str, str], ...]) -> list[tuple]:
    """The passages with score, words and code points of the text itself."""
    runs = [m.span() for m in _RUN.finditer(text)] if found else []
    out = []
    for i, m in found:
        first, end = words.count(" ", 0, m.at + (words[m.at] == " ")), words.count(" ", 0, m.till - (words[m.till - 1] == " ")) + 1
        label, notice = notices[i]
        out.append({"label": label, "errors": m.errors, "score": 1 - m.errors / len(notice), "first_word": first, "end_word": end, "at": runs[first][0], "till": runs[end - 1][1]})
    return out


def scan(docs: DataFrame, text: str = "text", notices: tuple[tuple[str, str], ...] = NOTICES, phrases: tuple[tuple[str, str], ...] = PHRASES) -> DataFrame:
    """docs with n_words, places (label and first word of each phrase found), matches (label, edits, score,
    words and code points of each notice found) and score."""
    kept = [c for c in docs.columns if c.lower() not in RESULT]
    rows = docs.withColumn("__text", F.col(text)).select(*kept, "__text")
    kinds = StructType(rows.select(*kept).schema.fields + StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in RESULT.items())).fields)
    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = Notices(notices)
        for batch in slices(batches):
            sought.judged.clear()
            out: dict[str, list] = {name: [] for name in RESULT}
            for t in batch.column(len(kept)).to_pylist():
                words = normal(t)
                near, exact = described(t or "", words, sought.matches(words), notices), places(words, phrases)
                out["n_words"].append(words.count(" ") + 1 if words else 0)
                out["places"].append([{"label": label, "first_word": word} for label, word in exact])
                out["matches"].append(near)
                out["score"].append(1.0 if exact else max((m["score"] for m in near), default=0.0))
            fresh = [pa.array(v, arrow.field(name).type) for name, v in out.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *fresh], schema=arrow)

    return rows.mapInArrow(trimmed(run), kinds)
