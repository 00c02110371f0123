"""Encode each distinct unit of a text once (shared by the tokenizer operators).

A *unit* is a stretch of text whose tokens do not depend on its neighbours:
the vocabulary's own pre-tokenisation rules guarantee a token boundary at
both of its ends. Cutting is vectorised over the bytes of an Arrow batch,
Arrow's dictionary encoding finds the distinct units exactly, the library
encodes only those not seen before in this worker, and the ids of the batch
are gathered back. Ids are the library's own; only repeated work is saved.

Memory is bounded by ``WINDOW`` bytes of text at a time (plus the ids of the
batch) whatever the length of a document.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

WINDOW = 4 << 20            # bytes of text cut and encoded at a time
ASKED = 8192                # units given to the library at a time
CACHE_ENTRIES = 150_000     # distinct units a worker remembers in each of two generations
CACHE_UNIT_BYTES = 64       # longer units are encoded each time


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
                                  else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    _, offs, data = column.buffers()
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    kind = np.dtype(np.int64 if wide else np.int32)
    o = np.frombuffer(offs, kind, n + 1, column.offset * kind.itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0]:o[-1]], o - o[0]


def slices(batches: Iterable[pa.RecordBatch], column: int = 1) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``WINDOW`` bytes of text (or one row)."""
    for rb in batches:
        at = np.cumsum(np.diff(flat(rb.column(column))[1]))
        lo = 0
        while lo < rb.num_rows:
            hi = int(np.searchsorted(at, (at[lo - 1] if lo else 0) + WINDOW, "right"))
            hi = min(rb.num_rows, max(hi, lo + 1))
            yield rb.slice(lo, hi - lo)
            lo = hi


def table(values: Sequence[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


class UnitEncoder:
    """``cuts(data, starts, ends)`` marks the bytes at which a unit starts;
    ``encode_many(list of bytes)`` gives the ids of each."""

    def __init__(self, cuts: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
                 encode_many: Callable[[list[bytes]], list[Sequence[int]]]):
        self.cuts, self.encode_many = cuts, encode_many
        self.seen: dict[bytes, bytes] = {}      # units of late
        self.before: dict[bytes, bytes] = {}    # and of the generation before

    def _keep(self, unit: bytes, ids: bytes) -> None:
        if len(unit) <= CACHE_UNIT_BYTES:
            if len(self.seen) >= CACHE_ENTRIES:
                self.before, self.seen = self.seen, {}
            self.seen[unit] = ids

    def _ids_of(self, units: list[bytes]) -> list[bytes]:
        got = list(map(self.seen.get, units))
        missing = [i for i, g in enumerate(got) if g is None]
        new = []
        for i in missing:
            ids = self.before.get(units[i])
            if ids is None:
                new.append(i)
            else:
                got[i] = ids
                self._keep(units[i], ids)
        for k in range(0, len(new), ASKED):
            some = new[k:k + ASKED]
            for i, ids in zip(some, self.encode_many([units[i] for i in some])):
                got[i] = array("I", ids).tobytes()
                self._keep(units[i], got[i])
        return got

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents one after another, where each document's ids
        start: one entry more than documents)."""
        n = len(data)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        some = offsets[:-1] < offsets[1:]
        starts, ends = offsets[:-1][some], offsets[1:][some]
        parts, unit_starts, unit_counts = [], [], []
        lo = 0
        while lo < n:
            hi = min(n, lo + WINDOW)
            first, last = np.searchsorted(starts, lo), np.searchsorted(starts, hi)
            # the document that reaches over the window's edges is cut by the same rule
            cut = self.cuts(data[lo:hi], starts[first:last] - lo,
                            ends[(k := np.searchsorted(ends, lo, "right")):np.searchsorted(ends, hi, "right")] - lo)
            cut[0] = True
            at = np.flatnonzero(cut)
            if hi < n:
                if len(at) == 1:            # one unit longer than the window: take it whole
                    hi = int(self._next_cut(data, lo, hi, starts, ends))
                    at = np.zeros(1, np.int64)
                else:                       # the last unit may go on in the next window
                    hi, at = lo + int(at[-1]), at[:-1]
            window = data[lo:hi]
            edges = np.append(at, hi - lo)
            kind, store = (pa.large_binary(), np.int64) if hi - lo > 2**31 - 2 else (pa.binary(), np.int32)
            coded = pa.Array.from_buffers(kind, len(at), [
                None, pa.py_buffer(edges.astype(store)), pa.py_buffer(np.ascontiguousarray(window))]).dictionary_encode()
            values = self._ids_of(coded.dictionary.to_pylist())
            size = np.fromiter(map(len, values), np.int64, len(values)) // 4
            pool = np.frombuffer(b"".join(values), np.uint32)
            begin = np.cumsum(size) - size
            code = coded.indices.to_numpy(zero_copy_only=False)
            count = size[code]
            out_start = np.cumsum(count) - count
            take = np.repeat(begin[code] - out_start, count)
            take += np.arange(len(take))
            parts.append(pool[take])
            unit_starts.append(at + lo)
            unit_counts.append(count)
            lo = hi
        where, counts = np.concatenate(unit_starts), np.concatenate(unit_counts)
        before = np.concatenate([[0], np.cumsum(counts)])
        token_offsets = before[np.searchsorted(where, offsets)]
        return np.concatenate(parts), token_offsets

    def _next_cut(self, data, lo, hi, starts, ends) -> int:
        n, size = len(data), 2 * WINDOW
        while lo + size < n:
            upto = lo + size
            cut = self.cuts(data[lo:upto], starts[np.searchsorted(starts, lo):np.searchsorted(starts, upto)] - lo,
                            ends[np.searchsorted(ends, lo, "right"):np.searchsorted(ends, upto, "right")] - lo)
            cut[0] = False
            at = np.flatnonzero(cut)
            if len(at):
                return lo + int(at[0])
            size *= 2
        cut = self.cuts(data[lo:n], starts[np.searchsorted(starts, lo):] - lo,
                        ends[np.searchsorted(ends, lo, "right"):] - lo)
        cut[0] = False
        at = np.flatnonzero(cut)
        return lo + int(at[0]) if len(at) else n
