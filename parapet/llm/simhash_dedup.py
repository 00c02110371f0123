"""SimHash near-duplicates with pivot distance tables.

1. Fingerprints are voted on by the XXH64 of every word shingle and written
   once; equal fingerprints become one node with its number of documents.
2. Fingerprints within the radius agree on some table of kept bits, so each
   node is dealt out under one key per table. A key's nodes are compared in
   chunks: a key with more than ``CHUNK`` nodes is split into chunks and
   every pair of chunks is a group of its own, so no group is unbounded.
3. In a group, distances to fixed reference fingerprints (pivots) are
   tabulated first. By the triangle inequality a pair whose coordinates
   differ by more than the radius at any pivot cannot link and is discarded;
   survivors are verified on the fingerprints themselves. Of a large group
   only the links of a spanning forest leave the task: as many as nodes,
   never all pairs, and none that joins two classes is lost.
4. Components of the links, and the smallest id of each, go back to the
   documents by a join salted on frequent fingerprints.

Nulls and empties: a null text counts as empty; texts without a word have
fingerprint zero and link like any other. Rows equal in id and text are one
document; rows with a null id take part, and a component whose ids are all
null has a null component_id. An empty table gives no rows. Other columns
are ignored. Texts of any length are shingled whole, in one row's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parapet.llm import bits
from parapet.llm.components import components
from parapet.llm.shared import write_shared
from parapet.operators.skew import HOT_FRACTION, HOT_MIN, SALTS, salted_join

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
CHUNK = 4096            # nodes of one key compared as one side
SMALL = 32              # up to so many nodes, a group's pairs are tested at once
PIVOTS = 16


def text_key(text_col: str):
    """Tells apart different texts under one id."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, text_key, fp) of each document, copies (equal in id and text) once.

    The key is computed before the shingles are made, once a text. Votes are
    added up within a task first: copies cast the same votes, so each task's
    share of them has the document's fingerprint, however many there are."""
    text = bits.spaced(bits.ascii_lower(F.coalesce(F.col(text_col), F.lit(""))))
    keyed = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"), text.alias("words"))
    terms = keyed.select("id", "text_key", F.spark_partition_id().alias("task"),
                         F.explode_outer(bits.shingles(F.col("words"), words)).alias("term"))
    return bits.vote(terms, ["id", "text_key", "task"]).groupBy("id", "text_key").agg(F.min("fp").alias("fp"))


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints from a rule (splitmix64 of 1..n), alike in every task."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distance_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def close(fps: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs (a[i], b[i]) link: discard by pivots, then verify."""
    keep = np.arange(len(a))
    for p in range(table.shape[1]):
        keep = keep[np.abs(table[a[keep], p] - table[b[keep], p]) <= radius]
    return keep[np.bitwise_count(fps[a[keep]] ^ fps[b[keep]]) <= radius]


def forest(fps: np.ndarray, table: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that span the classes of one group, breadth first: each node is
    compared only with nodes not yet reached."""
    rest = np.arange(len(fps))
    out: list[tuple[int, int]] = []
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            hit = close(fps, table, np.full(len(rest), x), rest, radius)
            if len(hit):
                found = rest[hit]
                out += [(x, int(y)) for y in found]
                queue += found.tolist()
                rest = np.delete(rest, hit)
    return out


def link_groups(radius: int):
    """Arrow function over rows sorted by group (g0..g3, fp): links (a, b)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots()
        rest = None

        def links(rows: np.ndarray) -> pa.RecordBatch:
            group, fps = rows[:4], rows[4].view(np.uint64)
            new = np.append(True, (group[:, 1:] != group[:, :-1]).any(axis=0))
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(fps)))
            number = np.cumsum(new) - 1
            table = distance_table(fps, refs)
            a_all, b_all = [], []
            small = size[number] <= SMALL
            for s in range(1, SMALL):       # pairs of the small groups, one shift at a time
                a = np.flatnonzero(small[:-s] & (number[:-s] == number[s:])) if s < len(fps) else []
                if not len(a):
                    break
                hit = a[close(fps, table, a, a + s, radius)]
                a_all.append(fps[hit])
                b_all.append(fps[hit + s])
            for i in np.flatnonzero(size > SMALL):
                at = slice(start[i], start[i] + size[i])
                pairs = forest(fps[at], table[at], radius)
                a_all.append(fps[at][[x for x, _ in pairs]])
                b_all.append(fps[at][[y for _, y in pairs]])
            a, b = (np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64) for x in (a_all, b_all))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for rb in batches:
            if not rb.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in rb.columns])
            if rest is not None:
                rows = np.concatenate([rest, rows], axis=1)
            # the last group may go on in the next batch; a group has at most two chunks
            other = np.flatnonzero((rows[:4] != rows[:4, -1:]).any(axis=0))
            last = int(other[-1]) + 1 if len(other) else 0
            if last:
                yield links(rows[:, :last])
            rest = rows[:, last:]
        if rest is not None and rest.shape[1]:
            yield links(rest)
    return run


def links(nodes: DataFrame, radius: int = MAX_DISTANCE, chunk: int = CHUNK, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``nodes`` (fp) that span the
    classes of fingerprints within ``radius`` of each other."""
    kept = bits.masks(blocks or bits.blocks_for(nodes.count(), radius), radius)
    keyed = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("k"))
        for i, m in enumerate(kept)])).alias("e")).select("fp", "e.t", "e.k")
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    dealt = keyed.join(sizes, ["t", "k"]).select(
        "t", "k", "fp", chunks.alias("c"), F.pmod(F.xxhash64("fp"), chunks).cast("int").alias("own"))
    # chunk c meets every chunk once: rows go to the pairs (smaller, larger)
    paired = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("c") - 1))).select(
        F.col("t").cast("bigint").alias("g0"), F.col("k").alias("g1"),
        F.least("own", "o").cast("bigint").alias("g2"), F.greatest("own", "o").cast("bigint").alias("g3"), "fp")
    group = ["g0", "g1", "g2", "g3"]
    spread = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (paired.repartition(spread, *group).sortWithinPartitions(*group, "fp")
            .mapInArrow(link_groups(radius), "a long, b long").distinct())


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
            radius: int = MAX_DISTANCE) -> DataFrame:
    """(id, text_key, fp, component, first): ``component`` is the smallest id
    of the document's class, ``first`` marks the one document of each class
    with that id (of equal ids, the smallest text key; null ids come last)."""
    marks = write_shared(fingerprints(docs, id_col, text_col, words), "fingerprints")
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")
    nodes = write_shared(marks.groupBy("fp").agg(F.min(rank).alias("head"), F.count(F.lit(1)).alias("__n")), "nodes")
    parts = components(links(nodes.select("fp"), radius)).select(F.col("node").alias("fp"), "component")
    whole = nodes.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    heads = whole.groupBy("component").agg(F.min("head").alias("class_head"))
    # one component may hold a large share of the fingerprints
    of_fp = write_shared(salted_join(whole.select("fp", "component"), heads, "component").select("fp", "class_head"), "classes")
    out = salted_join(marks, of_fp, "fp", nodes.select("fp", "__n"))
    return out.select("id", "text_key", "fp", F.col("class_head.id").alias("component"),
                      (F.col("class_head") == rank).alias("first"))


def _fresh(columns: list[str], *stems: str) -> list[str]:
    """Names like ``stems`` that ``columns`` lacks (in any case of letters)."""
    taken = {c.lower() for c in columns}
    out = []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        out.append(stem)
    return out


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
               radius: int = MAX_DISTANCE, salts: int = SALTS, hot_fraction: float = HOT_FRACTION, hot_min: int = HOT_MIN) -> DataFrame:
    """The rows of ``docs`` (all columns, whatever their names) that are the
    first of their class; of rows equal in id and text the one whose other
    columns come first (as JSON) stays.

    Rows with many copies are spread over ``salts`` tasks, each of which
    keeps one, and one of these is kept."""
    key, row, salt, hot, kept_id, kept_key, number = _fresh(docs.columns, "__key", "__row", "__salt", "__hot", "__id", "__first", "__rn")

    # one 64-bit key of id and text joins and partitions; what it stands for is
    # compared in a form that adds no join key, so the text is shuffled once
    def row_key(i: Column, k: Column) -> Column:
        return F.xxhash64(i.isNull(), i, k)

    first = classes(docs, id_col, text_col, words, radius).filter("first") \
        .select(F.col("id").alias(kept_id), F.col("text_key").alias(kept_key), row_key(F.col("id"), F.col("text_key")).alias(row))
    copies = docs.select(row_key(F.col(id_col), text_key(text_col)).alias(row)).groupBy(row).agg(F.count(F.lit(1)).alias("n"))
    many = copies.filter(F.col("n") >= hot_min)
    total = docs.count() if many.take(1) else 0
    # at most 1 / hot_fraction keys
    many = write_shared(many.filter(F.col("n") >= max(hot_min, int(total * hot_fraction))).select(row, F.lit(True).alias(hot)), "copies")
    keyed = docs.withColumn(key, text_key(text_col)).withColumn(row, row_key(F.col(id_col), F.col(key)))
    tagged = keyed.join(F.broadcast(many), row, "left").withColumn(
        salt, F.when(F.col(hot), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    spread = first.join(F.broadcast(many), row, "left").withColumn(
        salt, F.explode(F.when(F.col(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))).drop(hot)
    same = (F.col(key).bitwiseXOR(F.col(kept_key)) == 0) & F.coalesce(
        F.col(id_col) == F.col(kept_id), F.col(id_col).isNull() & F.col(kept_id).isNull())
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    order = F.to_json(F.struct(*others)) if others else F.lit(0)

    def first_of(df: DataFrame, *by: str) -> DataFrame:
        one = Window.partitionBy(*by, key, id_col).orderBy(order)
        return df.withColumn(number, F.row_number().over(one)).filter(F.col(number) == 1).drop(number)

    kept = first_of(tagged.join(spread, [row, salt]).filter(same), row, salt)
    if many.take(1):
        kept = write_shared(kept.drop(kept_id, kept_key), "first-of-copies")
        kept = kept.filter(F.col(hot).isNull()).unionByName(first_of(kept.filter(F.col(hot)), row))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
