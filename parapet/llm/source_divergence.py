"""How far the sources of a language differ in the words they use.

1. A document is tokenised by one ``bytes.translate`` (letters lowered,
   everything else of ASCII blanked) and one ``bytes.split``; a Counter per
   document gives its terms' frequencies. Tasks add the Counters of a
   (language, source) up in sparse tallies of bounded size, so what is
   shuffled is a row per tally and term, never a row per occurrence.
2. A language keeps the terms of at least ``min_docs`` of its documents. A
   group's smoothed share of a kept term is an integer in parts of 10^9, all
   arithmetic is on integers.
3. Two sources differ by the sum over all kept terms of (p-q)^2/(p+q),
   rounded down term by term. Terms that neither source uses contribute the
   same value each, so only terms in use are visited: cells of (block of
   sources, block of sources, share of the terms) hold a bounded number of
   rows each, and their partial sums are added.

Nulls and empties: a null language, source or text counts as empty; a group
without terms still has its pairs; a language without kept terms has pairs
of value 0 and no terms. Equal values rank by the UTF-8 order of the item.
Repeated rows count as often as they stand. An empty table gives no rows.
Other columns are ignored. Texts are read in windows, so a long one costs
the memory of its distinct terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parapet.llm.shared import write_shared
from parapet.llm.units import flat, slices

MIN_DOCS = 10
TOP_TERMS = 10
TALLY_ENTRIES = 400_000     # terms a task holds before it passes its tallies on
PIECE = 1 << 20             # bytes of text split at a time
BLOCK_SOURCES = 64          # sources of one side of a cell, on average
CELL_ROWS = 32_768          # rows of one cell, on average
CELL_PAIRS = 1 << 20        # (term, source, source) values computed at a time

_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def document_counts(text: bytes) -> Counter:
    """The frequency of each term of one text."""
    if len(text) <= PIECE:
        return Counter(text.translate(_TABLE).split())
    out: Counter = Counter()
    rest, lo = b"", 0
    while lo < len(text):
        piece = text[lo:lo + PIECE].translate(_TABLE)
        lo += len(piece)
        cut = piece.rfind(b" ") + 1 if lo < len(text) else len(piece)
        if cut:                                 # a term that reaches over the edge waits for its end
            out.update((rest + piece[:cut]).split())
            rest = piece[cut:]
        else:
            rest += piece
    out.update(rest.split())
    return out


def tally(batches: Iterator[pa.RecordBatch], limit: int = TALLY_ENTRIES) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> (lang, source, term, cnt, docs), a row per
    tally and term, and one with a null term per tally."""
    tallies: dict[tuple[str, str], tuple[dict, Counter]] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (total, docs) in tallies.items():
            n = len(total) + 1
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(lang, pa.string()), n), pa.repeat(pa.scalar(source, pa.string()), n),
                pa.array([None, *total], pa.binary()).cast(pa.string()), pa.array([0, *total.values()], pa.int64()),
                pa.array([0, *map(docs.__getitem__, total)], pa.int64())], ["lang", "source", "term", "cnt", "docs"])

    for rb in slices(batches, 2):
        data, offsets = flat(rb.column(2))
        for i, group in enumerate(zip(rb.column(0).to_pylist(), rb.column(1).to_pylist())):
            if group not in tallies:
                tallies[group] = ({}, Counter())
            total, docs = tallies[group]
            before = len(total)
            counts = document_counts(data[offsets[i]:offsets[i + 1]].tobytes())
            for term, n in counts.items():
                total[term] = total.get(term, 0) + n
            docs.update(counts.keys())
            held += len(total) - before
            if held > limit:
                yield from rows()
                tallies, held = {}, 0
    yield from rows()


def share(count: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (n + 2 v)), exact for any counts."""
    whole = "decimal(20,0)"
    return F.when(F.col("v") > 0, F.lit(1).cast("bigint") + F.call_function(
        "div", F.lit(1_000_000_000).cast("decimal(10,0)") * (count.cast(whole) + F.lit(2).cast("decimal(1,0)")).cast(whole),
        (F.col("n") + 2 * F.col("v")).cast(whole)))


def gap(p: Column, q: Column) -> Column:
    """floor((p-q)^2 / (p+q)); shares are at most 10^9 + 1, so longs hold it."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def cell_sums(key: tuple, table: pa.Table) -> pa.Table:
    """Of one cell: for each (source, other source) the sum over the cell's
    terms, less what they would add if neither source used them; the cell of
    share 0 adds that amount for every kept term."""
    lang, left, right, part = (k.as_py() for k in key)
    head = table.filter(pc.is_null(table["term"]))
    body = table.filter(pc.is_valid(table["term"]))
    names = head["source"].to_pylist()
    at = {s: i for i, s in enumerate(names)}
    z = head["p"].fill_null(0).to_numpy()
    own = head["own"].to_numpy()
    a, b = np.flatnonzero(own == left), np.flatnonzero(own == right)
    place = np.zeros((2, len(names)), np.int64)
    place[0, a], place[1, b] = np.arange(len(a)), np.arange(len(b))

    def gaps(p, q):
        return (p - q) ** 2 // np.maximum(p + q, 1)

    base = gaps(z[a][:, None], z[b][None, :])
    total = base * (int(head["v"][0].as_py()) if part == 0 and len(names) else 0)
    if body.num_rows:
        coded = body["term"].combine_chunks().dictionary_encode()
        term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        source = np.array([at[s] for s in body["source"].to_pylist()])
        p = body["p"].to_numpy()
        order = np.argsort(term, kind="stable")
        term, source, p = term[order], source[order], p[order]
        step = max(1, CELL_PAIRS // max(1, len(a) * len(b)))
        for lo in range(0, len(coded.dictionary), step):
            hi = min(lo + step, len(coded.dictionary))
            rows = slice(*np.searchsorted(term, [lo, hi]))
            t, s, v = term[rows] - lo, source[rows], p[rows]
            pa_, pb = np.tile(z[a], (hi - lo, 1)), np.tile(z[b], (hi - lo, 1))
            for side, block, to in ((0, left, pa_), (1, right, pb)):
                mine = own[s] == block
                to[t[mine], place[side, s[mine]]] = v[mine]
            total += gaps(pa_[:, :, None], pb[:, None, :]).sum(axis=0) - base * (hi - lo)
    i, j = np.nonzero(a[:, None] != b[None, :])
    one, two, value = a[i], b[j], total[i, j]
    if left != right:
        one, two, value = np.r_[one, two], np.r_[two, one], np.r_[value, value]
    name = np.array(names, object)
    return pa.table({"lang": pa.array([lang] * len(one), pa.string()), "source": pa.array(name[one].tolist(), pa.string()),
                     "item": pa.array(name[two].tolist(), pa.string()), "value": pa.array(value, pa.int64())})


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block: int = BLOCK_SOURCES,
          cell_rows: int = CELL_ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows give every other
    source of the language with its distance, ``term`` rows the kept terms
    that the source uses more than its language does, the first
    ``top_terms`` of them."""
    named = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(text_col).alias("text"))
    counts = write_shared(
        named.mapInArrow(lambda batches: tally(batches), "lang string, source string, term string, cnt long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("cnt").alias("cnt"), F.sum("docs").alias("docs")), "term-counts")
    # a (language, term) has at most one row a source
    same = Window.partitionBy("lang", "term")
    kept = write_shared(
        counts.filter("term is not null")
        .select("lang", "source", "term", "cnt", F.sum("docs").over(same).alias("docs"), F.sum("cnt").over(same).alias("lang_cnt"),
                (F.min("source").over(same) == F.col("source")).alias("head"))
        .filter(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    sizes = kept.groupBy("lang", "source").agg(F.sum("cnt").alias("n"), F.sum(F.col("head").cast("bigint")).alias("heads"),
                                               F.count(F.lit(1)).alias("rows"))
    of_source = counts.filter("term is null").select("lang", "source").join(sizes, ["lang", "source"], "left") \
        .na.fill(0, ["n", "heads", "rows"])
    # everything a cell needs to know of its language
    of_lang = of_source.groupBy("lang").agg(
        F.sum("heads").alias("v"), F.sum("n").alias("n_lang"),
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.sum("rows") / cell_rows)).cast("int").alias("parts"))
    groups = write_shared(of_source.select("lang", "source", "n").join(of_lang, "lang"), "source-sizes")

    used = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("cnt")))
    q = used.withColumn("n", F.col("n_lang")).withColumn("q", share(F.col("lang_cnt")))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = q.filter((F.col("cnt") > 0) & (F.col("p") > F.col("q"))) \
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value")) \
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)

    heads = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), share(F.lit(0)).alias("p"), "v", "blocks",
                          F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("share"))
    body = used.select("lang", "source", "term", "p", "v", "blocks",
                       F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("share"))
    dealt = heads.unionByName(body).withColumn("own", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = dealt.select("lang", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "share",
                         "own", "source", "term", "p", "v")
    pairs = cells.groupBy("lang", "left", "right", "share") \
        .applyInArrow(cell_sums, "lang string, source string, item string, value long") \
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")) \
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms)
