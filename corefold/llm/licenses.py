"""License notices in running text: exact base phrases, and a fuzzy search for short notices.

Fuzzy search: a notice that may have k errors is cut into k + 1 pieces, one of which must occur unchanged (the pigeonhole
principle). One automaton finds all pieces; around each hit, and around each alone, the regex library's bounded-error matching verifies the
notice, and reports the span and the number of edits. Then, of matches of a label that overlap, the best stay. The work is
linear in the text but for the sorting of its matches.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from . import textvec

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Short notices (lower case, words joined by one space) and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms": "bsd",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "released into the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
    "permission to use copy modify and or distribute this software": "isc",
    "all rights reserved": "reserved",
    "spdx license identifier": "spdx",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons zero": "cc0",
    "cc0 1 0 universal": "cc0",
    "dedicated to the public domain": "public-domain",
    "gnu free documentation license": "gfdl",
    "boost software license": "bsl-1.0",
    "artistic license 2 0": "artistic-2.0",
    "sil open font license": "ofl-1.1",
    "open database license": "odbl",
    "open data commons attribution license": "odc-by",
    "european union public licence": "eupl",
    "microsoft public license": "ms-pl",
    "python software foundation license": "psf",
    "server side public license": "sspl",
    "common development and distribution license": "cddl",
    "the bsd 2 clause license": "bsd",
    "the bsd 3 clause license": "bsd",
    "the zlib license": "zlib",
    "no part of this publication may be reproduced": "reserved",
    "unauthorized copying of this file": "proprietary",
    "confidential and proprietary": "proprietary",
    "for non commercial use only": "non-commercial",
    "without warranty of any kind": "as-is",
}
CHARS_PER_EDIT = 12

# All but ASCII digits, letters and what is beyond ASCII separates words; A-Z become lower case.
_CLEAN = bytearray(range(256))
for _c in range(128):
    _CLEAN[_c] = _c if 0x30 <= _c <= 0x39 or 0x61 <= _c <= 0x7A else _c + 32 if 0x41 <= _c <= 0x5A else 0x20
_CLEAN = bytes(_CLEAN)


@dataclass(frozen=True)
class Match:
    """A verified notice: words [first_word, end_word), characters [start, end) of the cleaned text."""

    label: str
    notice: str
    edits: int
    start: int
    end: int
    first_word: int
    end_word: int

    @property
    def score(self) -> float:
        return 1 - self.edits / len(self.notice)


def edits_for(notice: str) -> int:
    return len(notice) // CHARS_PER_EDIT


@cache
def _machine() -> tuple[ahocorasick.Automaton, dict[str, regex.Pattern]]:
    pieces: dict[str, list[tuple[str, int]]] = {}
    for notice in NOTICES:
        n = edits_for(notice) + 1
        cuts = [len(notice) * i // n for i in range(n + 1)]
        for a, b in zip(cuts, cuts[1:]):
            pieces.setdefault(notice[a:b], []).append((notice, a))
    found = ahocorasick.Automaton()
    for piece, where in pieces.items():
        found.add_word(piece, (len(piece), where))
    found.make_automaton()
    return found, {n: regex.compile(rf"(?b)(?<= )(?:{regex.escape(n)}){{e<={edits_for(n)}}}(?= )") for n in NOTICES}


def clean(text: str | None) -> tuple[str, int]:
    """The words joined by one space, with a space at either end, and their number."""
    found = (text or "").encode().translate(_CLEAN).split(b" ")
    found = [x for x in found if x] if b"" in found else found
    return (b" " + b" ".join(found) + b" ").decode(), len(found)


def _spaces(cleaned: str) -> np.ndarray:
    """Places of the spaces: word i stands between the spaces i and i + 1."""
    return np.flatnonzero(np.frombuffer(cleaned.encode("utf-32-le"), np.uint32) == 32)


def fuzzy(cleaned: str) -> list[Match]:
    """Verified notices by place: of overlapping matches of a label the best stays (fewest edits for its length, then the longest, then the first)."""
    automaton, patterns = _machine()
    spans = set()
    for end, (length, where) in automaton.iter(cleaned):
        for notice, offset in where:
            k = edits_for(notice)
            begin = end + 1 - length - offset
            spans.add((notice, max(0, begin - k - 1), min(len(cleaned), begin + len(notice) + k + 1)))
    places = set()
    for notice, begin, stop in spans:
        m = patterns[notice].search(cleaned, begin, stop)
        if m:
            places.add((notice, m.start(), m.end(), sum(m.fuzzy_counts)))
    if not places:
        return []
    spaces = _spaces(cleaned)
    found = []
    for notice, start, end, edits in places:
        first = int(np.searchsorted(spaces, start)) - 1
        found.append(Match(NOTICES[notice], notice, edits, start, end, first, first + cleaned[start:end].strip().count(" ") + 1))
    kept: dict[str, list[tuple[int, int]]] = {}
    best: list[Match] = []
    for m in sorted(found, key=lambda m: (-m.score, -len(m.notice), m.start, m.end, m.label)):
        taken = kept.setdefault(m.label, [])  # disjoint, in order
        at = bisect_left(taken, (m.end,))
        if at == 0 or taken[at - 1][1] <= m.start:
            insort(taken, (m.start, m.end))
            best.append(m)
    return sorted(best, key=lambda m: (m.start, m.label))


def base_places(cleaned: str) -> list[tuple[int, str]]:
    """(first word, label) of each place where a base phrase's words stand in a row."""
    out = []
    for phrase, label in BASE.items():
        at = cleaned.find(f" {phrase} ")
        while at >= 0:
            out.append((at, label))
            at = cleaned.find(f" {phrase} ", at + 1)
    if not out:
        return []
    words = np.searchsorted(_spaces(cleaned), np.array([at for at, _ in out])).tolist()
    return [(word, label) for word, (_, label) in zip(words, out)]


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``n_words, n_base, first_word, last_word, base_labels, labels, score, matches``; null texts count as empty, texts of any length
    are read whole, and each row stands for itself.

    ``score`` is 1 where a base phrase stands, else the best fuzzy match's share of unchanged characters, else 0. ``matches`` has each verified notice with its
    edits and its span in words.
    """
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
    matches = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("edits", pa.int32()), ("first_word", pa.int64()), ("end_word", pa.int64())]))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), matches]
    schema = docs.select(*keep).schema
    for name, kind in zip(names, ["bigint"] * 4 + ["string"] * 2 + ["double", "array<struct<label:string,notice:string,edits:int,first_word:bigint,end_word:bigint>>"]):
        schema = schema.add(name, DataType.fromDDL(kind))

    def one(value: str | None) -> tuple:
        cleaned, n = clean(value)
        base, fuzz = base_places(cleaned), fuzzy(cleaned)
        own = {label for _, label in base}
        starts = [at for at, _ in base]
        best = 1.0 if base else max((m.score for m in fuzz), default=0.0)
        spans = [{"label": m.label, "notice": m.notice, "edits": m.edits, "first_word": m.first_word, "end_word": m.end_word} for m in fuzz]
        return n, len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)), ",".join(sorted(own | {m.label for m in fuzz})), best, spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in textvec.chunks(batches):
            columns = list(zip(*[one(t.as_py()) for t in b.column(0)])) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=schema.names)

    return docs.select(F.col(text).cast("string").alias("__text"), *keep).mapInArrow(run, schema)
