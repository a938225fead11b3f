"""License scans: exact phrases, and short notices found with a bounded number of edits.

A notice that may be found with k edits is cut into k + 1 parts; at least one of them
stands unchanged in every text within k edits. One automaton finds all parts of all
notices in one pass; only around a part found is the regex library's bounded-error
match tried, and it reports the span and the edits.

Texts are searched as their words with one space between, so punctuation and line
breaks do not matter; spans are places in the text itself, in code points. From left to
right, the first stretch within the edits allowed is taken, then the best match inside
it, and the search goes on after that; so a notice is not lost to a better one further
on. Of matches of different notices that overlap, the one with fewest edits stands, then
the longest, then the leftmost, then the first notice. Time grows with the length of the
text and the number of matches, never with their product.

Nulls count as empty texts, which have no words, no labels and score 0. Repeated rows
are searched each, an empty table gives no rows, and other columns are not read, whatever
their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from plainloom.llm.common import each_text, whole, with_columns

# Phrases that stand for a label where their words follow each other.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Short notices and the labels they stand for.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache",
    "this work is licensed under the gnu general public license version": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "mozilla public license version 2 0": "mpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by 4 0": "cc-by",
    "creative commons attribution": "cc-by",
    "all rights reserved": "reserved",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa",
    "licensed under cc by nd 4 0": "cc-by-nd",
    "creative commons zero v1 0 universal": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "redistributions of source code must retain the above copyright notice": "bsd",
    "use of this source code is governed by a bsd style license": "bsd",
    "distributed under the boost software license version 1 0": "boost",
    "eclipse public license version 2 0": "epl",
    "european union public licence version 1 2": "eupl",
    "licensed under the terms of the mit license": "mit",
}
#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 10
_WORDS = re.compile("[0-9a-z\x80-\U0010ffff]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def edits_allowed(notice: str) -> int:
    return len(notice) // CHARS_PER_EDIT


def seeds(notice: str, k: int) -> list[tuple[int, str]]:
    """(place, part) of k + 1 parts of nearly equal length."""
    cuts = [len(notice) * i // (k + 1) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@cache
def _searcher():
    automaton, patterns = ahocorasick.Automaton(), []
    at: dict[str, list[tuple[int, int]]] = {}
    for n, notice in enumerate(NOTICES):
        k = edits_allowed(notice)
        within = f"(?:{regex.escape(notice)}){{e<={k}}}"
        patterns.append((regex.compile(within), regex.compile(f"(?b){within}"), k, len(notice)))
        for place, part in seeds(notice, k):
            at.setdefault(part, []).append((n, place))
    for part, homes in at.items():
        automaton.add_word(part, (len(part), homes))
    automaton.make_automaton()
    return automaton, patterns


def normal_form(text: str) -> str:
    """The words of a text, A to Z in lower case, with one space between."""
    return " ".join(_WORDS.findall(text.translate(_LOWER) if not text.isascii() else text.lower()))


def fuzzy_notices(words: str) -> list[tuple[int, int, str, int]]:
    """(start, end, notice, edits) of the notices in a normal form, in characters."""
    automaton, patterns = _searcher()
    windows: dict[int, list[list[int]]] = {}
    for last, (length, homes) in automaton.iter(words):
        for n, place in homes:
            *_, k, size = patterns[n]
            start = last + 1 - length - place - k
            windows.setdefault(n, []).append([max(0, start), start + size + 2 * k])
    found = []
    for n, spans in windows.items():
        spans.sort()
        merged = [spans[0]]
        for a, b in spans[1:]:
            if a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        any_, best, *_ = patterns[n]
        for a, b in merged:
            at, stop = a, min(b, len(words))
            while rough := any_.search(words, at, stop):
                m = best.search(words, rough.start(), rough.end())
                found.append((m.start(), m.end(), n, sum(m.fuzzy_counts)))
                at = m.end()
    names, starts, kept = list(NOTICES), [], []  # kept ones do not overlap, so their starts and ends have one order
    for a, b, n, edits in sorted(found, key=lambda m: (m[3], m[0] - m[1], m[0], m[2])):
        place = bisect_left(starts, a)
        if (place == 0 or kept[place - 1][1] <= a) and (place == len(kept) or b <= kept[place][0]):
            starts.insert(place, a)
            kept.insert(place, (a, b, names[n], edits))
    return kept


def places_in(text: str, spans: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """Spans of a normal form as spans of the text."""
    own, normal, at = [], [], 0
    for word in _WORDS.finditer(text.translate(_LOWER)):
        own.append(word.start())
        normal.append(at)
        at += word.end() - word.start() + 1
    place = lambda x: own[(w := bisect_right(normal, x) - 1)] + x - normal[w]
    return [(place(a), place(b - 1) + 1, notice, edits) for a, b, notice, edits in spans]


def scan_text(text: str) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, spans of one text."""
    words = normal_form(text)
    padded = f" {words} "
    starts, base = [], set()
    for phrase, label in PHRASES.items():
        at, before, n = padded.find(f" {phrase} "), 0, 0
        while at >= 0:
            n += padded.count(" ", before, at)
            starts.append(n)
            base.add(label)
            before, at = at, padded.find(f" {phrase} ", at + 1)
    fuzzy = fuzzy_notices(words)
    fuzzy = places_in(text, fuzzy) if fuzzy else fuzzy
    near = max((1 - edits / len(notice) for _, _, notice, edits in fuzzy), default=0.0)
    labels = base | {NOTICES[notice] for _, _, notice, _ in fuzzy}
    spans = [{"start": a, "end": b, "notice": notice, "edits": edits} for a, b, notice, edits in fuzzy]
    return (
        words.count(" ") + 1 if words else 0,
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        1.0 if base else near,
        spans,
    )


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("notice", pa.string()), ("edits", pa.int64())])
_TYPES = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(_SPAN),
}


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and what ``scan_text`` finds; spans are places in the text, code points, end exclusive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in each_text(batches, "whole_text"):
            columns = list(zip(*map(scan_text, texts))) or [[] for _ in _TYPES]
            arrays = [pa.array(c, t) for c, t in zip(columns, _TYPES.values())]
            yield with_columns(batch, "whole_text", list(_TYPES), arrays)

    chosen = docs.select("doc_id", whole(text).alias("whole_text"))
    key = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(
        run,
        f"doc_id {key}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<start: long, end: long, notice: string, edits: long>>",
    )
