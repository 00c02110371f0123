"""Parallel-corpus assembly: lines, concatenation, positional zip, tags, union.

Line files are aligned by position, so every step here keeps an explicit
integer position column and joins on it; nothing relies on the physical
order of rows or partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parapet.functions import text as T
from parapet.operators.ordinal import running_offset
from parapet.operators.sizing import bounded_rows, lookup

# Files (documents) per block in the two-level offset scan.
DEFAULT_FILES_PER_BLOCK = 4096
MAX_DIRECTIONS = 10_000


def lines_from_text(df: DataFrame, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per ``\\n``-separated line of ``text_col``: (*keep, line_no, line)."""
    return df.select(*keep, F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line")) \
             .withColumn("line_no", F.col("line_no").cast("bigint"))


def concat_files(lines: DataFrame, by: Sequence[str], file_col: str, block: Column | None = None,
                 name: str = "idx", totals: bool = False):
    """Concatenate the files of each ``by`` group in ``file_col`` order.

    ``name`` = lines of the earlier files of the group + ``line_no``. Offsets
    are computed on one row per file, so the scan never holds a whole group.
    ``block`` must be non-decreasing in ``file_col`` (default: a range of
    integer file ids). With ``totals`` also return (by..., total) lines."""
    if block is None:
        block = F.floor(F.col(file_col) / DEFAULT_FILES_PER_BLOCK)
    counts = lines.groupBy(*by, file_col).agg(F.count(F.lit(1)).alias("__n"))
    offsets, sizes = running_offset(counts, by, [file_col], block, F.col("__n"), "__file_off", totals=True)
    out = (lines.join(offsets.drop("__n"), on=[*by, file_col], how="inner")
                .withColumn(name, (F.col("__file_off") + F.col("line_no")).cast("bigint"))
                .drop("__file_off"))
    return (out, sizes) if totals else out


def zip_join(sl: DataFrame, tl: DataFrame, how: str = "inner", key: Sequence[str] = ("direction",),
             pad: str = "", sizes: DataFrame | None = None) -> DataFrame:
    """Positional join of source and target lines.

    ``sl``: (*key, idx, sl); ``tl``: (*key, idx, tl). ``inner`` stops at the
    shorter side; ``left`` keeps every source line and pads a missing target
    with ``pad``. If ``sl`` lacks the key column it is shared by all keys of
    ``tl``: one join on ``idx`` serves every direction, and for ``left`` the
    padding rows are the source lines at or past each direction's length
    (``sizes``: (key, n), computed from ``tl`` if not given) - no second
    join, and no shuffle when both sides are partitioned by ``idx``."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    key = [k for k in key if k in tl.columns]
    shared = [k for k in key if k not in sl.columns]
    if how == "left" and not shared:
        out = sl.join(tl, on=key + ["idx"], how="left").withColumn("tl", F.coalesce(F.col("tl"), F.lit(pad)))
        return out.select(*key, "idx", *[c for c in out.columns if c not in (*key, "idx")])
    out = sl.join(tl, on=[k for k in key if k in sl.columns] + ["idx"], how="inner")
    out = out.select(*key, "idx", *[c for c in out.columns if c not in (*key, "idx")])
    if how == "inner":
        return out
    if len(shared) != 1:
        raise ValueError("a shared source side supports one key column")
    k = shared[0]
    if sizes is None:
        sizes = tl.groupBy(k).agg((F.max("idx") + 1).alias("n"))
    bounds = bounded_rows(sizes.select(k, "n"), 10_000)
    pads = (sl.withColumn("__d", F.explode(F.array(*[F.struct(F.lit(r[0]).alias("k"), F.lit(r[1]).alias("n"))
                                                      for r in bounds])))
              .filter(F.col("idx") >= F.col("__d.n"))
              .select(F.col("__d.k").alias(k), "idx", *[c for c in sl.columns if c != "idx"])
              .withColumn("tl", F.lit(pad)))
    return out.unionByName(pads.select(*out.columns))


def zip_by_position(lines: DataFrame, src_lang: str, tgt_langs: Sequence[str], how: str = "inner",
                    pad: str = "", lang: str = "lang") -> DataFrame:
    """Zip one source language against several targets in one pass.

    ``lines``: (lang, idx, line). Every position gathers its lines of all
    languages in one ``groupBy(idx)`` (a group holds at most one line per
    language), and one row per direction is emitted: (direction, idx, sl,
    tl). One scan and one shuffle of the lines serve every direction; no
    self-join. ``inner`` needs both lines; ``left`` pads a missing target."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    g = lines.groupBy("idx").agg(F.map_from_entries(F.collect_list(F.struct(F.col(lang), F.col("line")))).alias("__m"))
    outs = F.array(*[F.struct(F.lit(f"{src_lang}{T.DIRECTION_SEP}{t}").alias("direction"),
                              F.col("__m")[t].alias("tl")) for t in tgt_langs])
    z = (g.filter(F.col("__m")[src_lang].isNotNull())
          .select("idx", F.col("__m")[src_lang].alias("sl"), F.explode(outs).alias("__o"))
          .select(F.col("__o.direction").alias("direction"), "idx", "sl", F.col("__o.tl").alias("tl")))
    if how == "inner":
        return z.filter(F.col("tl").isNotNull())
    return z.withColumn("tl", F.coalesce("tl", F.lit(pad)))


def distinct_values(df: DataFrame, col: str, max_values: int = 10_000) -> list:
    """Sorted distinct values of a low-cardinality column (directions,
    languages), refusing to bring more than ``max_values`` to the driver."""
    rows = df.select(col).distinct().limit(max_values + 1).collect()
    if len(rows) > max_values:
        raise ValueError(f"{col}: more than {max_values} distinct values")
    return sorted(r[0] for r in rows)


def tag_language(df: DataFrame, multi: bool | Column | None = None) -> DataFrame:
    """Prefix every source line with ``<tgt> `` when there are several
    directions (P3). ``multi`` defaults to a scalar subquery
    ``count(distinct direction) > 1``, evaluated once."""
    if multi is None:
        multi = df.select(F.count_distinct("direction")).scalar() > 1
    elif isinstance(multi, bool):
        multi = F.lit(multi)
    tgt = T.parse_direction(F.col("direction")).getField("tgt")
    return df.withColumn("sl", F.when(multi, F.concat(F.lit("<"), tgt, F.lit("> "), F.col("sl")))
                                .otherwise(F.col("sl")))


def union_directions(df: DataFrame, order: Sequence[str] | None = None,
                     sizes: DataFrame | None = None) -> DataFrame:
    """Concatenate per-direction corpora in direction order.

    Adds ``pair_id``: the line's position in the concatenation (lines of
    earlier directions + ``idx``). Direction order defaults to the sorted
    names; a list fixes it explicitly, and directions it does not name follow
    in sorted order (a null direction comes last). ``sizes`` (direction, n)
    can be given when known more cheaply than by counting ``df``."""
    if sizes is None:
        sizes = df.groupBy("direction").agg((F.max("idx") + 1).alias("n"))
    rows = bounded_rows(sizes.select("direction", "n"), MAX_DIRECTIONS)
    if order is not None:
        rows = sorted(rows, key=lambda r: order.index(r[0]) if r[0] in order else len(order))
    starts, total = {}, 0
    for direction, n in rows:
        starts[direction], total = total, total + n
    # a literal per direction: corpus rows are never shuffled on three or four values
    none = starts.pop(None, None)       # no key of a map
    start = F.when(F.col("direction").isNull(), F.lit(none)).otherwise(lookup(starts)(F.col("direction")))
    return df.withColumn("pair_id", (start + F.col("idx")).cast("bigint"))


def conversation_pairs(turns: DataFrame) -> DataFrame:
    """Each ``user`` turn with the following turn when it is the
    ``assistant``'s: (conv_id, turn, pair_id, sl, tl), ``pair_id`` being
    ``<conv_id>_<turn>``, which no other pair can have.

    A self equi-join on (conv_id, turn + 1): the join key includes the turn,
    so one long conversation does not land in one task."""
    u = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("sl"))
    a = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tl"))
    return (u.join(a, ["conv_id", "turn"], "inner")
             .withColumn("pair_id", F.concat_ws("_", "conv_id", "turn"))
             .select("conv_id", "turn", "pair_id", "sl", "tl"))
