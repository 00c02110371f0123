"""Exact, reproducible sampling, splitting, shuffling and batching.

Order is defined by ``md5(seed:key)`` (engine- and partitioning-independent,
unlike ``rand``), ties broken by the key itself. An exact sample of n rows is
the set of rows at or below the n-th smallest (hash, key): the cutoff is
found from per-block counts over a hash prefix (at most 65,536 rows reach
the driver per refinement), after which sampling, the train/validation split
and its complement are plain filters - no join, no shuffle of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parapet.operators.ordinal import hash_prefix_block, ordinal
from parapet.operators.sizing import bounded_rows, lookup

PREFIX_DIGITS = 4            # 16**4 = 65,536 blocks per refinement
SMALL_ENOUGH = 50_000        # blocks up to this size are not refined further; the answer is the same either way
MAX_GROUPS = 10_000          # languages or directions that batches are cut in


def hash_key(seed: int | str, keys: Sequence[str]) -> Column:
    """Hex md5 of ``seed:key1:key2...`` (the shuffle / sample order)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def _order(h: Column, keys: Sequence[str]) -> Column:
    return F.struct(h.alias("h"), *[F.col(k) for k in keys])


def sample_cutoff(df: DataFrame, n: int, seed: int | str, keys: Sequence[str], with_total: bool = False):
    """The n-th smallest ``(hash, *keys)`` as a tuple, or None if ``df`` has
    at most ``n`` rows (then every row is in the sample). With
    ``with_total`` return (cutoff, row count): the count comes from the
    same pass."""
    if n <= 0:
        raise ValueError("n must be positive")
    d = df.select(hash_key(seed, keys).alias("__h"), *keys)
    need, depth, rows = n, 0, None
    while True:
        digits = PREFIX_DIGITS * (depth + 1)
        blk = F.substring("__h", 1, digits)
        counts = sorted((r[0], r[1]) for r in d.groupBy(blk.alias("b")).count().collect())
        total = sum(c for _, c in counts)
        if depth == 0:
            rows = total
            if total <= n:
                return (None, rows) if with_total else None
        if total < need:
            raise AssertionError("rows changed while sampling")
        acc = 0
        for b, c in counts:
            if acc + c >= need:
                break
            acc += c
        need -= acc
        d = d.filter(blk == b)
        if c <= SMALL_ENOUGH or digits >= 32:
            # only the need-th row of the block reaches the driver
            last = tuple(d.orderBy("__h", *keys).offset(need - 1).limit(1).collect()[0])
            return (last, rows) if with_total else last
        depth += 1


def in_sample(df: DataFrame, cutoff, seed: int | str, keys: Sequence[str]) -> Column:
    """Boolean column: the row is among the sampled ones."""
    if cutoff is None:
        return F.lit(True)
    h = hash_key(seed, keys)
    types = {f.name: f.dataType for f in df.schema.fields}
    bound = F.struct(F.lit(cutoff[0]).alias("h"),
                     *[F.lit(v).cast(types[k]).alias(k) for v, k in zip(cutoff[1:], keys)])
    return _order(h, keys) <= bound


def sample_exact(df: DataFrame, n: int, seed: int | str, keys: Sequence[str]) -> DataFrame:
    """Exactly ``min(n, count)`` rows without replacement."""
    return df.filter(in_sample(df, sample_cutoff(df, n, seed, keys), seed, keys))


def require(ok: bool, message: str) -> None:
    """Fail the job with ``message`` unless ``ok``."""
    if not ok:
        raise AssertionError(message)


def train_valid_split(df: DataFrame, n_valid: int, seed: int | str, keys: Sequence[str],
                      check_size: bool = True) -> DataFrame:
    """Train and validation in one DataFrame with a ``split`` column.

    Validation = the exact sample of ``n_valid`` rows; train = the rest. With
    ``check_size`` the corpus must hold more than twice ``n_valid`` lines."""
    cutoff, total = sample_cutoff(df, n_valid, seed, keys, with_total=True)
    if check_size:
        require(total > 2 * n_valid, "Not enough training lines provided")
    return df.withColumn("split", F.when(in_sample(df, cutoff, seed, keys), F.lit("valid"))
                                   .otherwise(F.lit("train")))


def split_by_ids(df: DataFrame, ids: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(train, valid) for an externally given id table: anti / semi join.
    AQE broadcasts ``ids`` when it is small and shuffles it otherwise."""
    return df.join(ids, on=list(key), how="left_anti"), df.join(ids, on=list(key), how="left_semi")


def shuffle_positions(df: DataFrame, seed: int | str, keys: Sequence[str], name: str = "pos") -> DataFrame:
    """Global random order as a dense position (W2), computed with the
    two-level scan over a hash-prefix block: no single-task sort."""
    h = hash_key(seed, keys)
    d = df.withColumn("__h", h)
    out = ordinal(d, [], ["__h", *keys], hash_prefix_block(F.col("__h"), PREFIX_DIGITS), name)
    return out.drop("__h")


def batch_ids(position: Column, batch_size: int) -> Column:
    """Consecutive fixed-size batches from a dense 0-based position."""
    return F.floor(position / F.lit(batch_size)).cast("bigint")


def drop_last(df: DataFrame, position: str, batch_size: int, by: Sequence[str] = ()) -> DataFrame:
    """Remove the final incomplete batch of each ``by`` group (W1 ``drop_last``).

    Only the last batch of a group can be short, so one count per group
    decides: keep positions below ``(count div n) * n``. Groups are few (their
    number is checked) and their counts become literals: no row moves."""
    if not by:
        n = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
        return df.filter(F.col(position) < n // batch_size * batch_size)
    key = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in by])
    counts = df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    full = {k: n // batch_size * batch_size for k, n in bounded_rows(counts, MAX_GROUPS)}
    return df.filter(F.col(position) < lookup(full)(key))
