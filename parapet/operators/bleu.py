"""Corpus BLEU as a grouped aggregation.

Per sentence and order n = 1..4: hypothesis and reference n-gram counts,
clipped matches ``sum(least(hc, rc))`` and totals ``sum(hc)``; summed per
group; then the closed-form score with exponential smoothing. Clipping is
per sentence, and a sentence is a row wherever no other row has its key: its
n-grams are counted in the row's own task, as numbers (an n-gram is its
(n-1)-gram's number and its last token's), and a thin row of sums leaves it.
No text or n-gram is shuffled. Sentences of several rows are found among the
thin rows; only theirs are gathered and counted again, and the rows of one
too large to gather are counted by a grouped aggregation of its n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parapet.operators.sizing import partitions_for
from parapet.session import cut_lineage

MAX_ORDER = 4
SLICE_TOKENS = 1 << 16      # tokens counted at a time (or one row): their tables stay in the cache
GATHER_TOKENS = 1 << 20     # tokens of a sentence of several rows that one row may hold


def tokenize_13a(text) -> Column:
    """The public ``13a`` (mteval-v13a) tokenisation as a regex chain."""
    # fixed values: the mteval-v13a rules, in order
    t = F.col(text) if isinstance(text, str) else text
    for old, new in (("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        t = F.replace(t, F.lit(old), F.lit(new))
    # the rule's class also names the space, which stays one space in the end
    t = F.regexp_replace(F.concat(F.lit(" "), t, F.lit(" ")), r"([\{-\~\[-\`!-\&\(-\+\:-\@\/])", " $1 ")
    t = F.regexp_replace(t, r"([^0-9])([\.,])", "$1 $2 ")
    t = F.regexp_replace(t, r"([\.,])([^0-9])", " $1 $2")
    t = F.regexp_replace(t, r"([0-9])(-)", "$1 $2 ")
    t = F.trim(F.regexp_replace(t, r"\s+", " "))
    # an expression named once is evaluated once
    return F.array_remove(F.split(t, " "), "")


def ngrams(tokens: Column, n: int) -> Column:
    """All n-grams of a token array as space-joined strings, in order.

    Tokens never contain a space, so on ``array_join(tokens, ' ')`` every
    token starts where no non-space precedes, and a look-ahead captures the
    next n tokens: one native regex pass per order instead of a lambda per
    gram. Empty tokens (double spaces) are kept, as in the array."""
    joined = F.array_join(tokens, " ")
    pattern = "(?<![^ ])(?=([^ ]*" + "(?: [^ ]*)" * (n - 1) + "))"
    grams = F.regexp_extract_all(joined, F.lit(pattern), 1)
    return F.when(F.size(tokens) == 0, F.array().cast("array<string>")).otherwise(grams)


def _gram_sets(hyp: Column, ref: Column, max_n: int) -> Column:
    """One struct per (order, side) holding that order's n-grams: two plain
    generators (this, then the grams) instead of one merged array."""
    return F.array(*[F.struct(F.lit(n).alias("__n"), F.lit(side).alias("__side"), ngrams(t, n).alias("__gs"))
                     for side, t in ((0, hyp), (1, ref)) for n in range(1, max_n + 1)])


def _places(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]:
    """Tokens of a column of lists of token lists, the part and the row each
    stands in, and the tokens of each row (null: no part but null)."""
    rows, parts = pc.list_parent_indices(column).to_numpy(zero_copy_only=False), pc.list_flatten(column)
    part = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    row = rows[part]
    known = np.bincount(rows[parts.is_valid().to_numpy(zero_copy_only=False)], minlength=len(column)) > 0
    size = np.bincount(row, minlength=len(column))
    return pc.list_flatten(parts), part, row, pa.array(size.astype(np.int64), mask=~known)


def _matches(hyp: pa.Array, ref: pa.Array, max_n: int) -> tuple[list[np.ndarray], pa.Array, pa.Array]:
    """Matches and totals of the orders 1 .. ``max_n`` by row, and lengths."""
    (ht, hp, hr, hl), (rt, rp, rr, rl) = _places(hyp), _places(ref)
    n_rows, n_hyp = len(hyp), len(ht)
    words = pa.concat_arrays([ht, rt]).dictionary_encode(null_encoding="encode")
    code, n_codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(words.dictionary) + 1
    part = np.concatenate([hp, rp + (hp[-1] + 1 if n_hyp else 0)]).astype(np.int64)
    row = np.concatenate([hr, rr]).astype(np.int64)
    at, gram, row_of = np.arange(len(code)), row, np.arange(n_rows)      # where a gram begins, its number, a number's row
    sums = []
    for n in range(1, max_n + 1):
        last = at + n - 1
        inside = np.flatnonzero(last < len(part))
        inside = inside[part[last[inside]] == part[at[inside]]]
        at = at[inside]
        found = pa.array(gram[inside] * n_codes + code[at + n - 1]).dictionary_encode()
        gram, keys = found.indices.to_numpy().astype(np.int64), found.dictionary.to_numpy()
        row_of = row_of[keys // n_codes]
        of_hyp = at < n_hyp
        hc, rc = (np.bincount(gram[side], minlength=len(keys)) for side in (of_hyp, ~of_hyp))
        sums += [np.bincount(row_of, np.minimum(hc, rc), n_rows).astype(np.int64), np.bincount(row[at[of_hyp]], minlength=n_rows)]
    return sums, hl, rl


def _sum_names(max_n: int) -> list[str]:
    return [f"{c}{n}" for n in range(1, max_n + 1) for c in "ct"]


def _row_stats(d: DataFrame, keys: Sequence[str], max_n: int) -> DataFrame:
    """(keys..., c1, t1 .., hyp_len, ref_len) of every row of ``d`` (keys...,
    __h, __r: lists of token lists), counted in place."""
    names = [*_sum_names(max_n), "hyp_len", "ref_len"]
    kinds = [f"`{k}` {d.schema[k].dataType.simpleString()}" for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            sizes = sum(np.bincount(_places(rb.column(c))[2], minlength=rb.num_rows) for c in ("__h", "__r"))
            ends, lo = np.cumsum(sizes), 0
            while lo < rb.num_rows:
                hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE_TOKENS, "right"))
                some = rb.slice(lo, max(hi, lo + 1) - lo)
                sums, hl, rl = _matches(some.column("__h"), some.column("__r"), max_n)
                yield pa.RecordBatch.from_arrays([*(some.column(k) for k in keys), *(pa.array(x, pa.int64()) for x in sums), hl, rl],
                                                 [*keys, *names])
                lo += some.num_rows

    return d.select(*keys, "__h", "__r").mapInArrow(run, ", ".join([*kinds, *(f"{c} bigint" for c in names)]))


def _gram_stats(d: DataFrame, keys: Sequence[str], hyp: Column, ref: Column, max_n: int, partitions: int | None) -> DataFrame:
    """The same per sentence, with rows of one sentence taken together: its
    n-grams are rows of a grouped aggregation."""
    d = d.select(*keys, hyp.alias("__h"), ref.alias("__r"))
    # an explicit count: AQE would size this shuffle by the tokens, but the
    # n-grams generated after it are several times larger
    d = d.repartition(partitions or partitions_for(d))
    lens = d.groupBy(*keys).agg(F.sum(F.size("__h")).alias("hyp_len"), F.sum(F.size("__r")).alias("ref_len"))
    sets = d.select(*keys, F.explode(_gram_sets(F.col("__h"), F.col("__r"), max_n)).alias("__p")) \
            .select(*keys, "__p.__n", "__p.__side", "__p.__gs")
    # the explode must not carry the gram array into every output row
    g = sets.select(*keys, "__n", "__side", F.explode("__gs").alias("__g"))
    counts = g.groupBy(*keys, "__n", "__g").agg(
        F.sum(1 - F.col("__side")).alias("__hc"), F.sum(F.col("__side")).alias("__rc"))
    agg = [F.sum(F.when(F.col("__n") == n, c)).alias(f"{name}{n}") for n in range(1, max_n + 1)
           for name, c in (("c", F.least("__hc", "__rc")), ("t", F.col("__hc")))]
    stats = counts.groupBy(*keys).agg(*agg)
    return _same_keys(lens, stats, keys, "left").select(*keys, *_sum_names(max_n), "hyp_len", "ref_len")


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A join on equal keys, nulls equal too; ``left``'s keys are kept."""
    right = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = None
    for k in keys:
        same = left[k].eqNullSafe(right[f"__k_{k}"])
        on = same if on is None else on & same
    out = left.join(right, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__k_{k}" for k in keys])


def sentence_stats(df: DataFrame, group: Sequence[str], sid: Sequence[str], hyp: Column, ref: Column,
                   max_n: int = MAX_ORDER, partitions: int | None = None) -> DataFrame:
    """(group..., sid..., c1, t1 .., hyp_len, ref_len) per sentence: matches
    and hypothesis totals of each order, and lengths."""
    keys = [*group, *sid]
    d = df.select(*keys, hyp.alias("__h"), ref.alias("__r"))
    stats = cut_lineage(_row_stats(d.select(*keys, F.array("__h").alias("__h"), F.array("__r").alias("__r")), keys, max_n))
    size = F.coalesce("hyp_len", F.lit(0)) + F.coalesce("ref_len", F.lit(0))
    again = stats.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), F.sum(size).alias("__size")).filter("__rows > 1")
    if not again.take(1):
        return stats
    again = cut_lineage(again)
    few, many = again.filter(F.col("__size") <= GATHER_TOKENS), again.filter(F.col("__size") > GATHER_TOKENS)
    gathered = _same_keys(d, few, keys, "left_semi").groupBy(*keys).agg(
        F.collect_list("__h").alias("__h"), F.collect_list("__r").alias("__r"))
    out = _same_keys(stats, again, keys, "left_anti").unionByName(_row_stats(gathered, keys, max_n))
    if many.take(1):
        out = out.unionByName(_gram_stats(_same_keys(d, many, keys, "left_semi"), keys, F.col("__h"), F.col("__r"), max_n, partitions))
    return out


def corpus_bleu(df: DataFrame, group: Sequence[str], sid: Sequence[str], hyp: Column, ref: Column,
                max_n: int = MAX_ORDER, partitions: int | None = None) -> DataFrame:
    """(group..., bleu, bp, hyp_len, ref_len, p1..p4) per group (A5)."""
    stats = sentence_stats(df, group, sid, hyp, ref, max_n, partitions)
    sums = [F.sum(c).cast("bigint").alias(c) for c in (*_sum_names(max_n), "hyp_len", "ref_len")]
    return stats.groupBy(*group).agg(*sums).select(*group, *bleu_columns(max_n), "hyp_len", "ref_len")


def bleu_columns(max_n: int = MAX_ORDER) -> list[Column]:
    """Score from columns c1..cN (matches), t1..tN (totals), hyp_len, ref_len.

    Exponential smoothing: the k-th order without matches counts as
    ``100 / (2**k * total)``; no matches at all, or an order without
    n-grams, scores 0."""
    c = [F.coalesce(F.col(f"c{n}"), F.lit(0)) for n in range(1, max_n + 1)]
    t = [F.coalesce(F.col(f"t{n}"), F.lit(0)) for n in range(1, max_n + 1)]
    zeros = F.lit(0)
    precisions = []
    for n in range(max_n):
        zeros = zeros + F.when(c[n] == 0, 1).otherwise(0)
        p = F.when(t[n] == 0, F.lit(0.0)) \
             .when(c[n] == 0, F.lit(100.0) / (F.pow(F.lit(2.0), zeros) * t[n])) \
             .otherwise(F.lit(100.0) * c[n] / t[n])
        precisions.append(p)
    hl, rl = F.col("hyp_len"), F.col("ref_len")
    bp = F.when(hl >= rl, F.lit(1.0)).when(hl == 0, F.lit(0.0)).otherwise(F.exp(1 - rl / hl))
    any_zero_p = F.greatest(*[F.when(p == 0, 1).otherwise(0) for p in precisions])
    mean_log = sum(F.log(F.when(p > 0, p).otherwise(F.lit(1.0))) for p in precisions) / max_n
    score = F.when((c[0] == 0) | (any_zero_p == 1), F.lit(0.0)).otherwise(bp * F.exp(mean_log))
    return [score.alias("bleu"), bp.alias("bp"),
            *[F.round(p, 6).alias(f"p{n + 1}") for n, p in enumerate(precisions)]]
