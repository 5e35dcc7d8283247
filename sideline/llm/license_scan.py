"""License scans by template-markup matching.

A template is wording with markup: ``<<beginOptional>>..<<endOptional>>`` may be absent, ``<<var;match=a b|c>>``
stands for one of the listed phrases, ``<<var;words=n>>`` for up to n words of any kind; all else is mandatory.
Each template is compiled into a token automaton; a place in a text is accepted when the automaton reaches its
end, so mandatory words must stand exactly, in order, without others between them. Single phrases are templates
without markup, scanned by the same automata.

Texts are matched whole. An automaton is started only at words that can begin it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from . import license_texts
from .common import small_batches, text_of

#: Fixed values of the contract: phrase and label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Short notices, then whole license texts (to their last condition and disclaimer): label and markup.
TEMPLATES = (
    ("mit-notice", "<<var;match=licensed|released|distributed|available|provided>> under<<beginOptional>> the terms of<<endOptional>> "
                   "the MIT License"),
    ("apache-2.0", "<<var;match=licensed|released|distributed|available|provided>> under<<beginOptional>> the terms of<<endOptional>> "
                   "the Apache License<<beginOptional>> (the \"License\")<<endOptional>>, Version 2.0"),
    ("gpl-2.0", "under<<beginOptional>> the terms of<<endOptional>> the<<beginOptional>> GNU<<endOptional>> General Public License"
                "<<beginOptional>> as published by the Free Software Foundation<<endOptional>><<beginOptional>>, either<<endOptional>> version 2"),
    ("gpl-3.0", "under<<beginOptional>> the terms of<<endOptional>> the<<beginOptional>> GNU<<endOptional>> General Public License"
                "<<beginOptional>> as published by the Free Software Foundation<<endOptional>><<beginOptional>>, either<<endOptional>> version 3"),
    ("lgpl", "under<<beginOptional>> the terms of<<endOptional>> the<<beginOptional>> GNU<<endOptional>> "
             "<<var;match=Lesser|Library>> General Public License"),
    ("cc-by-4.0", "licensed under<<beginOptional>> a<<endOptional>><<beginOptional>> Creative Commons<<endOptional>> "
                  "<<var;match=CC BY|Attribution>><<beginOptional>> International<<endOptional>> 4.0"),
    ("cc-by-sa-4.0", "licensed under<<beginOptional>> a<<endOptional>><<beginOptional>> Creative Commons<<endOptional>> "
                     "<<var;match=CC BY-SA|Attribution-ShareAlike>> 4.0"),
    ("cc-by-nc-4.0", "licensed under<<beginOptional>> a<<endOptional>><<beginOptional>> Creative Commons<<endOptional>> "
                     "<<var;match=CC BY-NC|Attribution-NonCommercial>> 4.0"),
    ("all-rights-reserved", "copyright<<beginOptional>> (c)<<endOptional>><<var;words=6>> all rights reserved"),
    ("mit-text", license_texts.MIT),
    ("bsd-2-clause", license_texts.BSD_2),
    ("bsd-3-clause", license_texts.BSD_3),
    ("bsd-4-clause", license_texts.BSD_4),
    ("bsd-3-clause-clear", license_texts.BSD_3_CLEAR),
    ("isc", license_texts.ISC),
    ("apache-2.0-text", license_texts.APACHE_2_0),
    ("gpl-2.0-text", license_texts.GPL_2_0),
    ("gpl-3.0-text", license_texts.GPL_3_0),
)

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_MARK = re.compile(r"<<(.*?)>>", re.S)


def words_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode().translate(_LOWER).split()


@dataclass
class Automaton:
    """States are numbers; ``moves[s]`` maps a word to next states, ``free[s]`` are moves on any word, ``jumps[s]``
    moves without a word."""

    label: str
    base: bool
    moves: list[dict[bytes, list[int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    jumps: list[list[int]] = field(default_factory=list)
    end: int = 0

    def state(self) -> int:
        self.moves.append({})
        self.free.append([])
        self.jumps.append([])
        return len(self.moves) - 1

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.jumps[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def first_words(self) -> set[bytes]:
        begin = self.closure([0])
        if self.end in begin or any(self.free[s] for s in begin):
            raise ValueError(f"template {self.label} can begin with any word")
        return {w for s in begin for w in self.moves[s]}

    def match(self, words: list[bytes], at: int) -> int | None:
        """End (exclusive) of the longest accepted stretch that starts at ``at``."""
        states, found = self.closure([0]), None
        while True:
            if self.end in states:
                found = at
            if at == len(words) or not states:
                return found
            word = words[at]
            states = self.closure({t for s in states for t in (*self.moves[s].get(word, ()), *self.free[s])})
            at += 1


def compile_template(label: str, markup: str, base: bool = False) -> Automaton:
    a = Automaton(label, base)
    at, opened = a.state(), []

    def phrase(start: int, text: str) -> int:
        for w in words_of(text):
            nxt = a.state()
            a.moves[start].setdefault(w, []).append(nxt)
            start = nxt
        return start

    for i, piece in enumerate(_MARK.split(markup)):
        if i % 2 == 0:
            at = phrase(at, piece)
        elif piece == "beginOptional":
            opened.append(at)
            nxt = a.state()
            a.jumps[at].append(nxt)
            at = nxt
        elif piece == "endOptional":
            if not opened:
                raise ValueError(f"template {label}: endOptional without beginOptional")
            a.jumps[opened.pop()].append(at)
        elif piece.startswith("var;match="):
            end = a.state()
            for choice in piece.removeprefix("var;match=").split("|"):
                a.jumps[phrase(at, choice)].append(end)
            at = end
        elif piece.startswith("var;words="):
            end = a.state()
            a.jumps[at].append(end)
            for _ in range(int(piece.removeprefix("var;words="))):
                nxt = a.state()
                a.free[at].append(nxt)
                a.jumps[nxt].append(end)
                at = nxt
            at = end
        else:
            raise ValueError(f"template {label}: unknown markup {piece}")
    if opened:
        raise ValueError(f"template {label}: beginOptional without endOptional")
    a.end = at
    return a


class Scanner:
    def __init__(self, base=BASE, templates=TEMPLATES):
        self.by_word: dict[bytes, list[Automaton]] = {}
        for a in (*(compile_template(label, phrase, True) for phrase, label in base),
                  *(compile_template(label, markup) for label, markup in templates)):
            for w in a.first_words():
                self.by_word.setdefault(w, []).append(a)
        self.starts = frozenset(self.by_word)

    def scan(self, text: str) -> tuple[int, list[tuple[str, bool, int, int]]]:
        """Number of words, and (label, base, first word, end word) of every accepted place."""
        words = words_of(text)
        found = []
        if not self.starts.isdisjoint(words):
            for i, w in enumerate(words):
                for a in self.by_word.get(w, ()):
                    if (end := a.match(words, i)) is not None:
                        found.append((a.label, a.base, i, end))
        return len(words), found


def scan(docs: DataFrame, base=BASE, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, places (array of label, base, start, end in words, end exclusive): one row per row.

    Every accepted place is listed, in the order of its start. NULL and empty texts have no words; repeated rows
    repeat; an empty table gives no rows; other columns are not read.
    """
    small_batches(docs)
    kind = pa.struct([("n_words", pa.int64()), ("places", pa.list_(pa.struct(
        [("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())])))])

    @arrow_udf("struct<n_words bigint, places array<struct<label string, base boolean, start bigint, end bigint>>>")
    def scanned(texts: pa.Array) -> pa.Array:
        scanner, rows = Scanner(base, templates), []
        for t in texts:
            n, found = scanner.scan(t.as_py() or "")
            rows.append({"n_words": n, "places": [dict(zip(("label", "base", "start", "end"), x, strict=True)) for x in found]})
        return pa.array(rows, kind)

    s = docs.select("doc_id", scanned(text_of()).alias("s"))
    return s.select("doc_id", "s.n_words", "s.places")


def summary(scanned: DataFrame) -> DataFrame:
    """Per document: n_base, first_word, last_word, base_labels, labels, score.

    score: 1 where a template of the method is accepted, 0.5 where only base phrases stand, else 0.
    """
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    joined = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    score = F.when(F.exists("places", lambda p: ~p["base"]), 1.0).when(F.size("places") > 0, 0.5).otherwise(0.0)
    return scanned.select("doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
                          F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                          joined(base).alias("base_labels"), joined(F.col("places")).alias("labels"), score.alias("score"))
