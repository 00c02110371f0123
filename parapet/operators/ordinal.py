"""Positions and running sums without a single-partition window.

``row_number() over (order by ...)`` on corpus-size data runs in one task,
and ``partition by key`` puts a hot key (one language, one run) in one task.
Both are avoided with a two-level scan over a *block*: a coarse column that
is non-decreasing in the sort order (a document-id range, a file split, a
hash prefix). Within a block the window is bounded by the block's size;
across blocks only one row per block is scanned, and that table is small.

    offset(row) = sum(weight of earlier blocks of its group)
                + sum(weight of earlier rows of its block)
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = "__blk"
_W = "__w"


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def running_offset(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
                   block: Column, weight: Column | None = None,
                   name: str = "offset", totals: bool = False,
                   coarse: Callable[[Column], Column] | None = None):
    """Add ``name`` = exclusive running sum of ``weight`` (default 1) within
    ``by``, in ``order``. ``order`` must be unique within ``by`` and
    ``block`` must be non-decreasing along it. With ``totals`` also return
    (by..., total) per group.

    ``coarse`` maps a block to a coarser non-decreasing block: the prefix
    sum over the block totals is then itself a two-level scan, so no step
    scans more rows than there are coarse blocks (for orders without a
    grouping key, where the block table would otherwise be one task)."""
    weight = F.lit(1).cast("bigint") if weight is None else F.coalesce(weight.cast("bigint"), F.lit(0))
    btype = block_type(df, block)
    if not btype.startswith("struct"):
        block = F.coalesce(block, F.lit(0).cast(btype))
    # a non-null block: no inferred null filter splits the plan in two
    d = df.withColumn(_BLOCK, block).withColumn(_W, weight)
    keys = list(by) + [_BLOCK]

    in_block = Window.partitionBy(*keys).orderBy(*_cols(order)).rowsBetween(
        Window.unboundedPreceding, -1)
    d = d.withColumn("__local", F.coalesce(F.sum(_W).over(in_block), F.lit(0)))

    # block totals from the window's rows; other columns are pruned there, so
    # the plan computes them in a second, thin pass
    per_block = d.groupBy(*keys).agg(F.sum(_W).alias("__tot"))
    if coarse is None:
        across = Window.partitionBy(*by).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1) \
            if by else Window.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        starts = per_block.select(*keys, F.coalesce(F.sum("__tot").over(across), F.lit(0)).alias("__start"))
    else:
        pb = per_block.withColumnRenamed(_BLOCK, "__fine")
        starts = running_offset(pb, by, ["__fine"], coarse(F.col("__fine")), F.col("__tot"), "__bstart") \
            .select(*by, F.col("__fine").alias(_BLOCK), F.col("__bstart").alias("__start"))

    out = (d.join(starts, on=keys, how="inner")
            .withColumn(name, (F.col("__start") + F.col("__local")).cast("bigint"))
            .drop(_BLOCK, _W, "__local", "__start"))
    if not totals:
        return out
    return out, per_block.groupBy(*by).agg(F.sum("__tot").cast("bigint").alias("total"))


def block_type(df: DataFrame, block: Column) -> str:
    return df.select(block.alias("b")).schema["b"].dataType.simpleString()


def ordinal(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
            block: Column, name: str = "rn", base: int = 0) -> DataFrame:
    """Dense position (``base``-based) of each row within ``by`` in ``order``."""
    out = running_offset(df, by, order, block, None, "__off")
    return out.withColumn(name, (F.col("__off") + F.lit(base)).cast("bigint")).drop("__off")


def hash_prefix_block(h: Column, hex_digits: int = 4) -> Column:
    """Block for an order by a hex digest: its first digits (16**digits blocks)."""
    return F.conv(F.substring(h, 1, hex_digits), 16, 10).cast("int")
