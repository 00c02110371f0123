"""Document fingerprints by SimHash, with built-in functions only.

Terms are word shingles of the lower-cased text; each votes +w or -w on
every bit of its XXH64, w being its length in characters, as often as it
occurs. ``within`` finds all fingerprints within a Hamming radius through
permuted block tables: one equi-join per choice of kept blocks.

``compare_edited`` also fingerprints each text with its second half replaced
by the start of the next document's. The next document is found without a
global sort: ids are dealt into range blocks at quantiles, the first
document of each block is copied to the end of the block before, and a
window in each block looks one row ahead. Text is shuffled once; voting and
the look at the next fingerprint reuse that partitioning.

Nulls and empties: a null text counts as empty; an empty text has
fingerprint zero. Null ids come last in the order; documents with equal ids
follow each other in the order of their texts. A single document follows
itself. An empty table gives no rows. Other columns are ignored. A text of
any length is shingled whole, in one row's memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parapet.llm import bits
from parapet.llm.shared import type_of

SHINGLE_WORDS = 3
RADIUS = 3
_NO_ID = -(1 << 63)


def terms(text: Column, words: int = SHINGLE_WORDS) -> Column:
    return bits.shingles(bits.spaced(F.lower(text)), words)


def fingerprints(docs: DataFrame, keys: list[str], text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(keys..., fp); rows equal in all keys are one document."""
    exploded = docs.select(*keys, F.explode_outer(terms(F.coalesce(F.col(text_col), F.lit("")), words)).alias("term"))
    return bits.vote(exploded, keys, "term", F.length("term"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - bits.distance(a, b) / F.lit(float(bits.BITS))


def within(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """(query, fp, distance) for all pairs of ``queries`` (query) and ``index``
    (fp, distinct) within ``radius`` bits. A pair is reported by the first
    table that holds it, so no shuffle removes repeats."""
    kept = bits.masks(blocks or bits.blocks_for(index.count(), radius), radius)

    def dealt(df: DataFrame, fp: str) -> DataFrame:
        return df.select(fp, F.explode(F.array(*[
            F.struct(F.lit(i).alias("t"), F.col(fp).bitwiseAND(F.lit(m).cast("bigint")).alias("k"))
            for i, m in enumerate(kept)])).alias("e")).select(fp, "e.t", "e.k")

    diff = F.col("query").bitwiseXOR(F.col("fp"))
    first = F.lit(len(kept))
    for i in reversed(range(len(kept))):
        first = F.when(diff.bitwiseAND(F.lit(kept[i]).cast("bigint")) == 0, F.lit(i)).otherwise(first)
    q, x = dealt(queries.distinct(), "query"), dealt(index, "fp")
    return (q.join(x, (q["t"] == x["t"]) & (q["k"] == x["k"]) & (F.bit_count(diff) <= radius) & (first == q["t"]))
            .select("query", "fp", F.bit_count(diff).alias("distance")))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """(block, pos, ghost, id, text, next_text): documents in descending order
    of id, the next one's text beside each; after the last comes the first.
    ``ghost`` rows are the copies that close a block."""
    spark = docs.sparkSession
    if type_of(docs, id_col) not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("ids must be integers")
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NO_ID).cast("bigint")).alias("k"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = d.agg(F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], max(10_000, 4 * n)).alias("m")).first()["m"] or []
    # blocks in descending order of id: 0 holds the largest
    marks = sorted(set(marks), reverse=True)
    block = (F.size(F.filter(F.lit(marks).cast("array<bigint>"), lambda b: b >= F.col("k"))) if marks else F.lit(0)).cast("int")
    heads = {r["b"]: r["head"] for r in d.select(block.alias("b"), "k").groupBy("b").agg(F.max("k").alias("head")).collect()}
    order = sorted(heads)
    # the block before each block that has rows; before the first comes the last
    before = [(heads[b], order[i - 1]) for i, b in enumerate(order)]
    ghost_in = F.lit(None).cast("int")
    if before:
        at = F.array_position(F.lit([h for h, _ in before]).cast("array<bigint>"), F.col("k"))
        ghost_in = F.when(at > 0, F.get(F.lit([b for _, b in before]).cast("array<int>"), (at - 1).cast("int")))
    copies = F.array_compact(F.array(
        F.struct(block.alias("block"), F.lit(0).alias("ghost")),
        F.when(ghost_in.isNotNull(), F.struct(ghost_in.alias("block"), F.lit(1).alias("ghost")))))
    placed = d.select("id", "k", "text", F.explode(copies).alias("p")).select("id", "k", "text", "p.block", "p.ghost")
    w = Window.partitionBy("block").orderBy("ghost", F.col("k").desc(), "text")
    return placed.select("block", F.row_number().over(w).alias("pos"), "ghost", "id", "text",
                         F.lead("text").over(w).alias("next_text"))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                   blocks: int | None = None) -> DataFrame:
    """(id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next)."""
    n = F.length("text").cast("bigint")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = with_next(docs, id_col, text_col, blocks).select("block", "pos", "ghost", "id", n.alias("n_chars"), "text",
                                                            edited.alias("edited"))
    keys = ["block", "pos", "ghost", "id", "n_chars", "edited_sha256", "which"]
    both = rows.withColumn("edited_sha256", F.sha2("edited", 256)).select(
        *keys[:-1], F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")),
                                      F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))).alias("v")) \
        .select(*keys[:-1], "v.which", "v.t")
    fps = fingerprints(both, keys, "t", words)
    one = fps.groupBy(*keys[:-1]).agg(F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"),
                                      F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fp"))
    w = Window.partitionBy("block").orderBy("pos")
    return (one.withColumn("next_fp", F.lead("fp").over(w)).filter("ghost = 0")
            .select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fp", "edited_fp",
                    likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                    likeness(F.col("fp"), F.col("next_fp")).alias("near_next")))
