"""Best-fit packing of tokenised documents by a length histogram.

1. Every text is tokenised once, closed with the end id and cut into pieces
   of at most ``capacity`` tokens (only longer documents; the first piece
   takes the remainder). The pieces are written to the shared folder.
2. The driver sees one count per length (at most ``capacity`` rows) and
   places *counts* best-fit, longest first: bins of equal free space are one
   entry, so the plan has a bounded number of segments however many
   documents there are.
3. Each piece takes its planned slot by joining on its rank within its
   length. Ranks are counted in two levels, (length, salt) and a prefix
   sum over the salts, so a length that holds a third of all pieces is
   spread over as many tasks as there are shuffle partitions.

Nulls and empties: a null text counts as empty (one piece: the end id); a
null id is kept as null. Repeated rows are packed as often as they occur.
An empty table gives no pieces. Other columns are ignored, whatever their
names. A long text is encoded in windows of 4 MB and cut into full pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parapet.llm.shared import type_of, write_shared
from parapet.operators.ordinal import ordinal

CAPACITY = 2048
END_ID = 0


def plan(histogram: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: segments (length, first rank, pieces,
    pieces per bin, first sequence, offset). The pieces of a segment fill
    consecutive sequences, ``per bin`` in each, from ``offset`` on.

    A piece goes where it leaves the least free space; once a bin is the
    tightest for a length it stays so until that length fits no more."""
    free: list[int] = []                               # distinct free spaces, ascending
    bins: dict[int, list[tuple[int, int]]] = {}        # free space -> (first sequence, bins)
    sequences = 0
    out = []

    def put(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in bins:
                bins[space] = []
                insort(free, space)
            bins[space].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(free, length)
            if at < len(free):
                space = free[at]
                first, n = bins[space].pop()
                if not bins[space]:
                    del bins[space]
                    free.pop(at)
            else:
                space, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            per = space // length
            full = min(n, left // per)
            if full:
                out.append((length, rank, full * per, per, first, capacity - space))
                put(space - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            rest = n - full
            if rest and 0 < left:                      # fewer than ``per`` remain: one more bin
                out.append((length, rank, left, left, first + full, capacity - space))
                put(space - left * length, first + full, 1)
                left, rest, full = 0, rest - 1, full + 1
            put(space, first + full, rest)
    return out


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document."""
    schema = f"`{id_col}` {type_of(docs, id_col)}, piece int, start bigint, length bigint, ids_crc32 bigint" + (
        ", ids array<int>" if keep_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from parapet.llm.byte_bpe import load
        from parapet.llm.units import slices
        tok = load(tokenizer_path)
        for rb in slices(batches):
            ids, offs = tok.encode_column(rb.column(1))
            n = np.diff(offs) + 1
            begin = np.cumsum(n) - n
            full = np.full(int(n.sum()), end_id, np.uint32)
            full[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n - 1)] = ids
            first = np.where(n > capacity, (n - 1) % capacity + 1, n)
            count = 1 + (n - first) // capacity
            doc = np.repeat(np.arange(len(n)), count)
            no = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = np.where(no == 0, 0, first[doc] + (no - 1) * capacity)
            length = np.where(no == 0, first[doc], capacity)
            lo = begin[doc] + start
            crc = [zlib.crc32(full[a:b]) for a, b in zip(lo.tolist(), (lo + length).tolist())]
            cols = [rb.column(0).take(pa.array(doc)), pa.array(no.astype(np.int32)), pa.array(start),
                    pa.array(length), pa.array(crc, pa.int64())]
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            if keep_ids:        # pieces tile the batch's ids in order
                edges = np.append(lo, len(full)).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(full.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset`` in it."""
    spark = docs.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealt by place, not by value: copies of a row are spread too; the written table keeps it
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    cut = write_shared(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, keep_ids).withColumn("__salt", dealt), "packing")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = spark.createDataFrame(plan(counts, capacity),
                                  "length long, __from long, __n long, __per long, __seq long, __off long")
    ranked = ordinal(cut, ["length"], [id_col, "piece"], F.col("__salt"), "__rank")
    at = F.col("__rank") - F.col("__from")
    # the plan's size depends on the capacity alone, not on the documents
    return (ranked.join(F.broadcast(slots), "length")
            .filter((at >= 0) & (at < F.col("__n")))
            .select(id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else []),
                    (F.col("__seq") + F.floor(at / F.col("__per"))).cast("bigint").alias("sequence_id"),
                    (F.col("__off") + at % F.col("__per") * F.col("length")).cast("bigint").alias("offset")))
