"""SentencePiece ids with spans in the original bytes, and back to text.

Normalisation follows the model's compiled character map: at each position
the longest prefix found in its trie is replaced, and every normalised byte
remembers the original byte it came from. Segmentation of the normalised
text is the library's (a copy of the model without normalisation), and the
pieces' spans are projected to the original through the alignment.

Models without a character map (identity) whose pieces never hold a space
mark after another character are encoded by distinct unit (``units``); any
other model, and texts that hold the space mark itself, take the general
path text by text. Both give the library's ids.

Nulls and empties: a null text counts as empty and has no pieces (only the
begin and end ids, if asked for). Repeated rows give repeated results; other
columns are ignored. By units a long text is encoded in windows of 4 MB; on
the general path it takes memory for an entry a byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parapet.llm.shared import type_of
from parapet.llm.units import UnitEncoder, flat, slices

MARK = "▁"      # the library's visible space (fixed value of the format)


# --- the model file: a protocol buffer of which few fields are needed -------

def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (b[i] & 0x7F) << shift
        shift += 7
        i += 1
        if b[i - 1] < 0x80:
            return value, i


def _fields(b: bytes) -> Iterator[tuple[int, object, bytes]]:
    """(field number, value, the field's own bytes)."""
    i = 0
    while i < len(b):
        at = i
        key, i = _varint(b, i)
        wire = key & 7
        if wire == 0:
            value, i = _varint(b, i)
        elif wire == 2:
            n, i = _varint(b, i)
            value, i = b[i:i + n], i + n
        else:
            n = 8 if wire == 1 else 4
            value, i = b[i:i + n], i + n
        yield key >> 3, value, b[at:i]


def without_normalisation(model: bytes) -> bytes:
    """The same model with an identity normaliser that adds and removes nothing."""
    bare = b"\x0a\x08identity\x18\x00\x20\x00\x28\x01"      # name, no dummy prefix, keep spaces, escape them
    kept = b"".join(raw for f, _, raw in _fields(model) if f != 3)
    return kept + b"\x1a" + bytes([len(bare)]) + bare


class CharacterMap:
    """Longest-prefix replacement through a compiled map: a size, a double
    array of 32-bit units and the zero-terminated replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.text = blob[4 + size:]

    def longest(self, b: bytes, i: int) -> tuple[bytes, int]:
        """(replacement, bytes consumed) at ``i``; one character maps to
        itself where the map has no prefix."""
        found, value = 0, 0
        units = self.units
        if units:
            at = (units[0] >> 10) << ((units[0] & 512) >> 6)
            for j in range(i, len(b)):
                at ^= b[j]
                if at >= len(units):
                    break
                unit = units[at]
                if unit & 0x800000FF != b[j]:
                    break
                at ^= (unit >> 10) << ((unit & 512) >> 6)
                if unit & 256:
                    found, value = j + 1 - i, units[at] & 0x7FFFFFFF
        if found:
            return self.text[value:self.text.index(b"\0", value)], found
        lead = b[i]
        n = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return b[i:i + n], n


class Normaliser:
    """Text to normalised text (plain spaces) with, for each normalised byte
    and the end, the original byte it came from."""

    def __init__(self, spec: bytes):
        got = {f: v for f, v, _ in _fields(spec)}
        self.map = CharacterMap(got.get(2, b""))
        self.prefix = bool(got.get(3, 1))
        self.squeeze = bool(got.get(4, 1))
        self.identity = not self.map.units and not self.squeeze

    def __call__(self, b: bytes) -> tuple[bytes, list[int]]:
        out, align = bytearray(), []
        i = 0
        if self.squeeze:
            while i < len(b):
                new, n = self.map.longest(b, i)
                if new.strip(b" "):
                    break
                i += n
        if i == len(b):
            return b"", [i]
        if self.prefix:
            out += b" "
            align.append(i)
        after_space = self.squeeze
        while i < len(b):
            new, n = self.map.longest(b, i)
            if after_space:
                new = new.lstrip(b" ")
            if new:
                out += new
                align += [i] * len(new)
                after_space = self.squeeze and new.endswith(b" ")
            i += n
        while self.squeeze and out.endswith(b" "):
            out.pop()
            i = align.pop()
        return bytes(out), [*align, i]


def _cuts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A unit starts at a space whose previous byte is neither a space nor
    the last byte of a space mark."""
    cut = np.zeros(len(data), bool)
    cut[1:] = (data[1:] == 0x20) & (data[:-1] != 0x20) & (data[:-1] != 0x81)
    if len(starts):
        cut[starts] = True
    return cut


class Codec:
    def __init__(self, path: str):
        import sentencepiece
        with open(path, "rb") as f:
            model = f.read()
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=without_normalisation(model))
        top = {f: v for f, v, _ in _fields(model) if f in (2, 3)}
        trainer = {f: v for f, v, _ in _fields(top.get(2, b""))}
        self.normalise = Normaliser(top.get(3, b""))
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        kinds = [{f: v for f, v, _ in _fields(v)}.get(3, 1) for f, v, _ in _fields(model) if f == 1]
        self.widths = np.array([1 if kind == 6 else len(p.replace(MARK, " ").encode())
                                for p, kind in zip(pieces, kinds)], np.int64)
        self.by_unit = (self.normalise.identity and self.normalise.prefix and trainer.get(3) == 2
                        and trainer.get(35) == 1 and not trainer.get(24) and 4 not in kinds
                        and not any(MARK in p.lstrip(MARK) for p in pieces))
        self.units = UnitEncoder(_cuts, lambda u: self.bare.encode([x.decode("utf-8") for x in u], num_threads=1))

    def encode_text(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first bytes, end bytes) of one text by the general path."""
        norm, align = self.normalise(text.encode("utf-8"))
        pieces = self.bare.encode(norm.decode("utf-8"), return_type="proto").pieces
        ids = np.array([p.id for p in pieces], np.uint32)
        # the library's spans are bytes of the normalised text
        where = np.asarray(align, np.int64)
        begin, end = (where[np.array([getattr(p, k) for p in pieces], np.int64)] for k in ("begin", "end"))
        return ids, begin, end

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets of the documents in them, first bytes, end bytes)."""
        import pyarrow.compute as pc
        if column.null_count:
            column = column.fill_null("")
        general = np.ones(len(column), bool)
        if self.by_unit:
            general = pc.match_substring(column, MARK).to_numpy(zero_copy_only=False).astype(bool)
            plain = pc.if_else(pa.array(general), pa.scalar("", column.type), column) if general.any() else column
            data, offs = flat(plain)
            some = np.diff(offs) > 0
            at = offs[:-1][some]
            marked = np.insert(data, at, 0x20)                       # the dummy prefix of each text
            ids, token_offs = self.units.encode(marked, offs + np.concatenate([[0], np.cumsum(some)]))
            width = self.widths[ids]
            end = np.cumsum(width)
            doc = np.repeat(np.arange(len(some)), np.diff(token_offs))
            base = (offs + np.concatenate([[0], np.cumsum(some)]))[doc]
            begin, end = np.maximum(end - width - base - 1, 0), end - base - 1
        if not general.any():
            return ids, token_offs, begin, end
        rows = []
        for i in range(len(column)):
            if general[i]:
                rows.append(self.encode_text(column[i].as_py()))
            else:
                s = slice(token_offs[i], token_offs[i + 1])
                rows.append((ids[s], begin[s], end[s]))
        sizes = [len(r[0]) for r in rows]
        joined = [np.concatenate([r[k] for r in rows]) for k in range(3)]
        return joined[0], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), joined[1], joined[2]


@lru_cache(maxsize=4)
def load(path: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           ends: bool = True) -> DataFrame:
    """(id, ids, begins, ends): ids with the begin and end id (``ends``), and
    each piece's span in the text's UTF-8 bytes (empty spans for those two)."""
    schema = f"`{id_col}` {type_of(docs, id_col)}, ids array<int>, begins array<bigint>, ends array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(model_path)
        for rb in slices(batches):
            ids, offs, begin, end = codec.encode_column(rb.column(1))
            length = np.diff(flat(rb.column(1))[1])
            out = [[], [], []]
            for i, (a, b) in enumerate(zip(offs[:-1], offs[1:])):
                head, tail = ([codec.sp.bos_id()], [codec.sp.eos_id()]) if ends else ([], [])
                out[0].append(head + ids[a:b].tolist() + tail)
                out[1].append([0] * len(head) + begin[a:b].tolist() + [int(length[i])] * len(tail))
                out[2].append([0] * len(head) + end[a:b].tolist() + [int(length[i])] * len(tail))
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(out[0], pa.list_(pa.int32())), pa.array(out[1], pa.list_(pa.int64())),
                 pa.array(out[2], pa.list_(pa.int64()))], [id_col, "ids", "begins", "ends"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) by the library's ``decode``; null ids give a null text."""
    schema = f"`{id_col}` {type_of(encoded, id_col)}, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(model_path)
        for rb in batches:
            texts = [None if x is None else codec.sp.decode(x) for x in rb.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    return encoded.select(id_col, ids_col).mapInArrow(run, schema)


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of each text's ids (with begin and end id) and of the text they
    decode to, and the bytes its pieces' spans cover: (id, n_tokens,
    ids_sha256, decoded_sha256, span_bytes). The ids stay in the worker."""
    schema = f"`{id_col}` {type_of(docs, id_col)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, span_bytes bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(model_path)
        head, tail = codec.sp.bos_id(), codec.sp.eos_id()
        for rb in slices(batches):
            ids, offs, begin, end = codec.encode_column(rb.column(1))
            n, id_sha, text_sha, covered = [], [], [], []
            for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
                own = np.empty(b - a + 2, "<u4")
                own[0], own[1:-1], own[-1] = head, ids[a:b], tail
                n.append(len(own))
                id_sha.append(hashlib.sha256(own).hexdigest())
                text_sha.append(hashlib.sha256(codec.sp.decode(own.tolist()).encode("utf-8")).hexdigest())
                covered.append(int((end[a:b] - begin[a:b]).sum()))
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(n, pa.int64()), pa.array(id_sha, pa.string()), pa.array(text_sha, pa.string()),
                 pa.array(covered, pa.int64())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "span_bytes"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
