"""License notices, exact and with small errors.

A text is reduced to its words (lower-cased ASCII, letters, digits and all
non-ASCII characters) joined by single spaces. Short exact phrases are
counted wherever their words stand consecutively. For fuzzy search a notice
with up to k errors is split into k + 1 pieces: by the pigeonhole principle
every match holds at least one piece unchanged, so exact search for the
pieces finds every candidate, and the ``regex`` library's bounded-error
matching verifies the window around it and reports the span.

Nulls and empties: a null text counts as empty and has no match; repeated
rows give repeated results; an empty table gives no rows. Other columns are
ignored. Of equally good matches the earlier one counts. A text is read a
bounded number of times, so the work grows with its length, and a row holds
the text, its words' places and its matches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from parapet.llm.shared import type_of
from parapet.llm.units import flat, slices

#: Exact phrases and their labels (fixed values).
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices searched with errors, and their labels.
NOTICES = {
    "general public license": "gpl",
    "all rights reserved": "reserved",
    "licensed under the apache license": "apache",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "this work is in the public domain": "public-domain",
}

_TABLE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
               for c in range(256))
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def errors_for(notice: str) -> int:
    """One error in twelve characters, at most three."""
    return min(3, len(notice) // 12)


def pieces(notice: str, errors: int) -> list[tuple[int, bytes]]:
    """(offset, piece): ``errors`` + 1 pieces of nearly equal length."""
    edges = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, notice[a:b].encode()) for a, b in zip(edges, edges[1:])]


@dataclass
class Notice:
    text: str
    label: str
    errors: int = 0
    seeds: list = field(default_factory=list)
    patterns: list = field(default_factory=list)        # of each number of errors

    def __post_init__(self):
        self.errors = errors_for(self.text)
        self.seeds = pieces(self.text, self.errors)
        # whole words only
        self.patterns = [regex.compile(rb"(?<= )(?:" + regex.escape(self.text.encode(), special_only=True)
                                       + rb"){e<=" + str(k).encode() + rb"}(?= )") for k in range(self.errors + 1)]


def windows(joined: bytes, notice: Notice) -> list[tuple[int, int]]:
    """Stretches of ``joined`` that may hold the notice: around every seed,
    overlapping ones merged."""
    spans = []
    for offset, seed in notice.seeds:
        at = joined.find(seed)
        while at >= 0:
            begin = at - offset - notice.errors - 1
            spans.append((max(0, begin), min(len(joined), begin + len(notice.text) + 2 * notice.errors + 2)))
            at = joined.find(seed, at + 1)
    spans.sort()
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def matches(patterns: list, joined: bytes, begin: int, end: int) -> list:
    """The best matches of a stretch, in order: those without error from left
    to right, then those with one error in what lies between, and so on. A
    better notice further on hides no earlier one, and each number of errors
    reads the stretch once."""
    out, free = [], [(begin, end)]
    for pattern in patterns:
        rest = []
        for a, b in free:
            for m in pattern.finditer(joined, a, b):
                out.append(m)
                rest.append((a, m.start()))
                a = m.end()
            rest.append((a, b))
        free = rest
    return sorted(out, key=lambda m: m.start())


class Scanner:
    def __init__(self, base: dict[str, str], notices: dict[str, str]):
        self.base = [(f" {p} ".encode(), label) for p, label in base.items()]
        self.notices = [Notice(t, label) for t, label in notices.items()]

    def exact(self, joined: bytes) -> list[tuple[int, int, str]]:
        """(begin, end, label) of every place of a base phrase; a place may
        share words with the next."""
        out = []
        for probe, label in self.base:
            at = joined.find(probe)
            while at >= 0:
                out.append((at + 1, at + len(probe) - 1, label))
                at = joined.find(probe, at + 1)
        return out

    def fuzzy(self, joined: bytes) -> list[tuple[int, int, str, float]]:
        """(begin, end, label, similarity) of every verified notice."""
        out = []
        for n in self.notices:
            for a, b in windows(joined, n):
                for m in matches(n.patterns, joined, a, b):
                    out.append((m.start(), m.end(), n.label, 1 - sum(m.fuzzy_counts) / len(n.text)))
        return out


def words_of(text: bytes) -> tuple[bytes, int]:
    """(the words joined by single spaces, with a space at both ends; how many)."""
    words = text.translate(_TABLE).split(b" ")
    words = [w for w in words if w]
    return b" " + b" ".join(words) + b" ", len(words)


_MATCHES = "array<struct<label:string,kind:string,first_word:bigint,end_word:bigint,begin:bigint,end:bigint,similarity:double>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] | None = None,
         notices: dict[str, str] | None = None) -> DataFrame:
    """(id, n_words, matches): every exact place (kind ``exact``) and every
    verified notice (``fuzzy``) with its words and its character span in the
    original text."""
    base, notices = BASE if base is None else base, NOTICES if notices is None else notices
    schema = f"`{id_col}` {type_of(docs, id_col)}, n_words bigint, matches {_MATCHES}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        kind = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("first_word", pa.int64()),
                                   ("end_word", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()),
                                   ("similarity", pa.float64())]))
        for rb in slices(batches):
            data, offsets = flat(rb.column(1))
            counts, found = [], []
            for i in range(rb.num_rows):
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                joined, n = words_of(text)
                spans = [(a, b, label, "exact", 1.0) for a, b, label in scanner.exact(joined)]
                spans += [(a, b, label, "fuzzy", s) for a, b, label, s in scanner.fuzzy(joined)]
                rows = []
                if spans:
                    spans.sort()
                    chars = (x for m in _WORD.finditer(text.translate(_LOWER).decode("utf-8")) for x in m.span())
                    at = np.fromiter(chars, np.int64, 2 * n).reshape(n, 2)
                    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
                    firsts = np.searchsorted(spaces, [x[0] for x in spans]) - 1
                    ends = np.searchsorted(spaces, [x[1] for x in spans])
                    for (a, b, label, how, s), first, end in zip(spans, firsts.tolist(), ends.tolist()):
                        rows.append({"label": label, "kind": how, "first_word": first, "end_word": end,
                                     "begin": int(at[first, 0]), "end": int(at[end - 1, 1]), "similarity": s})
                counts.append(n)
                found.append(rows)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(counts, pa.int64()), pa.array(found, kind)],
                                             [id_col, "n_words", "matches"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
