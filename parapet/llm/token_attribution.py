"""Token counts of the sections of documents by offset-mapped attribution.

A document is encoded once, whole. Byte-level vocabularies are lossless, so
the byte span of each token follows from the running sum of its tokens'
widths; section boundaries are character boundaries and are mapped to bytes.
The interval join of token spans and sections is two binary searches per
section in the sorted token starts.

A token that crosses a boundary is allocated by ``rule``:

* ``first``: to the section of its first byte (default);
* ``last``: to the section of its last byte;
* ``split``: to each section by its share of the token's bytes.

When the sections tile the text, their counts add up to the document's.

Nulls and empties: a null or empty text has no tokens and, by lines, one
empty section; a null sections array gives no rows; a null section bound
gives a null count. Repeated rows give repeated results. A long text is
encoded in windows of 4 MB; its tokens' places are held at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parapet.llm.shared import type_of

RULES = ("first", "last", "split")


def line_sections(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first byte, end byte) of each line; a line keeps its line
    feed, so lines tile the text. A text without any byte is one empty line."""
    feeds = np.flatnonzero(data == 0x0A) + 1
    doc_of = np.searchsorted(offsets, feeds, "left") - 1
    feeds = feeds[feeds < offsets[doc_of + 1]]          # a final line feed opens no line
    doc = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds, "right") - 1])
    begin = np.concatenate([offsets[:-1], feeds])
    order = np.lexsort((begin, doc))
    doc, begin = doc[order], begin[order]
    last = np.append(doc[1:] != doc[:-1], True)[:len(doc)]
    end = np.append(begin[1:], 0)[:len(doc)]
    end[last] = offsets[doc[last] + 1]
    return doc, begin, end


def attribute(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
              sections_col: str | None = None, rule: str = "first") -> DataFrame:
    """One row per section: (id, section, begin, end, n_tokens, n_crossing).

    ``sections_col``: array<struct<begin,end>> of character spans, in any
    order, overlapping or not (clipped to the text); without it the sections
    are the lines. ``begin`` and ``end`` count characters; ``n_crossing`` the
    tokens that lie only partly inside."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = "double" if rule == "split" else "bigint"
    schema = (f"`{id_col}` {type_of(docs, id_col)}, section int, begin bigint, end bigint, "
              f"n_tokens {kind}, n_crossing bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from parapet.llm.byte_bpe import load
        from parapet.llm.units import flat, slices
        tok = load(tokenizer_path)
        for rb in slices(batches):
            data, offsets = flat(rb.column(1))
            ids, token_offsets = tok.encode_column(rb.column(1))
            width = tok.widths[ids]
            end_at = np.cumsum(width)
            start_at = end_at - width
            # characters before each byte (and before the end)
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            known = None
            if sections_col is None:
                doc, begin, end = line_sections(data, offsets)
            else:
                spans = rb.column(2)
                sizes = np.array([0 if s is None else len(s) for s in spans.to_pylist()], np.int64)
                flat_spans = [(x["begin"], x["end"]) if x else (None, None) for s in spans.to_pylist() for x in s or ()]
                known = np.array([a is not None and b is not None for a, b in flat_spans], bool)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                first_byte = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
                a, b = (np.array([s[k] or 0 for s in flat_spans], np.int64) for k in (0, 1))
                base, upto = chars[offsets[doc]], chars[offsets[doc + 1]]
                begin = first_byte[np.clip(base + a, base, upto)]
                end = np.maximum(begin, first_byte[np.clip(base + b, base, upto)])
            # tokens that end after ``begin`` and start before ``end``; empty sections have none
            touch_lo = np.searchsorted(end_at, begin, "right")
            touch_hi = np.searchsorted(start_at, end, "left")
            in_lo = np.searchsorted(start_at, begin, "left")
            in_hi = np.searchsorted(end_at, end, "right")
            some = end > begin
            touching = np.where(some, touch_hi - touch_lo, 0)
            inside = np.where(some, np.maximum(in_hi - in_lo, 0), 0)
            if rule == "first":
                n = np.where(some, touch_hi - in_lo, 0)
            elif rule == "last":
                n = np.where(some, in_hi - touch_lo, 0)
            else:
                def mass(x: np.ndarray) -> np.ndarray:
                    i = np.searchsorted(end_at, x, "right")
                    j = np.minimum(i, max(len(ids) - 1, 0))
                    part = (x - start_at[j]) / np.maximum(width[j], 1) if len(ids) else 0.0
                    return np.where(i < len(ids), i + part, float(len(ids)))
                n = np.where(some, mass(end) - mass(begin), 0.0)
            per_doc = np.bincount(doc, minlength=len(offsets) - 1)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
            base = chars[offsets[doc]]
            missing = None if known is None else ~known
            yield pa.RecordBatch.from_arrays(
                [rb.column(0).take(pa.array(doc)), pa.array(number.astype(np.int32)),
                 pa.array(chars[begin] - base, mask=missing), pa.array(chars[end] - base, mask=missing),
                 pa.array(n, mask=missing), pa.array(touching - inside, mask=missing)],
                [id_col, "section", "begin", "end", "n_tokens", "n_crossing"])

    return docs.select(id_col, text_col, *([sections_col] if sections_col else [])).mapInArrow(run, schema)
