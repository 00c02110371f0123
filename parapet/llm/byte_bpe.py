"""Byte-level BPE ids of whole texts with the ``tokenizers`` library."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from parapet.llm.units import UnitEncoder, flat, table
from parapet.operators.bpe import byte_order

# A space that starts a unit must be followed by a byte that cannot begin
# white space: not ASCII control or space, and not a lead byte of U+0085,
# U+00A0, U+1680, U+2000-U+205F or U+3000.
_AFTER_SPACE = ~table([*range(0x21), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3])
_LETTER = table([*range(0x41, 0x5B), *range(0x61, 0x7B)])
# punctuation that ends a run of letters (the apostrophe may begin a contraction)
_PUNCT = table([c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"])
_SOLID = table(range(0x21, 0x7F))


def _cuts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unit starts for the public byte-level pattern: before a space that
    precedes a word, between letters and punctuation, and around a line feed
    that stands alone. Each of these is a boundary of the pattern's matches,
    and matching on from it equals matching from a fresh start."""
    cut = np.zeros(len(data), bool)
    if len(data) > 1:
        a, b = data[:-1], data[1:]
        cut[:-1] = (a == 0x20) & _AFTER_SPACE[b]
        cut[1:] |= _LETTER[a] & _PUNCT[b]
    if len(data) > 2:
        feed = (data[1:-1] == 0x0A) & _SOLID[data[:-2]] & _SOLID[data[2:]]
        # never next to a document's edge: the neighbour byte is another text's
        if len(starts):
            feed[np.clip(starts - 1, 0, len(feed) - 1)] = False
        if len(ends):
            feed[np.clip(ends - 2, 0, len(feed) - 1)] = False
        cut[1:-1] |= feed
        cut[2:] |= feed
    if len(ends):
        cut[ends - 1] &= ~(data[ends - 1] == 0x20)
    if len(starts):
        cut[starts] = True
    return cut


class ByteBpe:
    """Ids of whole texts, exactly as ``Tokenizer.encode(text,
    add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        # a task has one core: the library's own threads would only contend
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_unit = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                        and spec.get("normalizer") is None)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        vocab = self.tok.get_vocab(with_added_tokens=True)
        # bytes of each id: the byte-level alphabet writes one character per byte
        self.widths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.widths[i] = len(token.encode()) if token in self.added else len(token)
        order = byte_order()
        plain = sum(b < 256 and chr(b).isprintable() and b not in (0x20, 0xAD) for b in range(256))
        self.shown = {b: chr(b) for b in order[:plain]} | {b: chr(256 + i) for i, b in enumerate(order[plain:])}
        self.units = UnitEncoder(_cuts, self._many)

    def _many(self, units: list[bytes]) -> list[list[int]]:
        """Ids of units. A word of letters, with or without a space before it,
        is one match of the pattern: it goes straight to the library's model,
        written in the byte-level alphabet. Anything else is encoded whole."""
        out: list = [None] * len(units)
        model, rest = self.tok.model, []
        for i, u in enumerate(units):
            s = u.decode("utf-8")
            if (s[1:] if s[:1] == " " else s).isalpha():
                out[i] = [t.id for t in model.tokenize(u.decode("latin-1").translate(self.shown))]
            else:
                rest.append(i)
        if rest:
            got = self.tok.encode_batch_fast([units[i].decode("utf-8") for i in rest], add_special_tokens=False)
            for i, e in zip(rest, got):
                out[i] = e.ids
        return out

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets). Texts that hold an
        added token's string are encoded whole, all others by unit."""
        import pyarrow.compute as pc
        if column.null_count:
            column = column.fill_null("")
        whole = np.zeros(len(column), bool)
        if not self.by_unit:
            whole[:] = True
        elif self.added:
            has = pc.match_substring_regex(column, "|".join(re.escape(a) for a in self.added))
            whole = has.to_numpy(zero_copy_only=False).astype(bool)
        if not whole.any():
            return self.units.encode(*flat(column))
        plain = pc.if_else(pa.array(whole), pa.scalar("", column.type), column)
        ids, offs = self.units.encode(*flat(plain))
        parts, sizes = [], np.diff(offs)
        for i in range(len(column)):
            if whole[i]:
                got = np.asarray(self.tok.encode(column[i].as_py(), add_special_tokens=False).ids, np.uint32)
                sizes[i] = len(got)
                parts.append(got)
            else:
                parts.append(ids[offs[i]:offs[i + 1]])
        return (np.concatenate(parts) if parts else ids), np.concatenate([[0], np.cumsum(sizes)])


@lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """One tokenizer per worker process and file."""
    return ByteBpe(path)
