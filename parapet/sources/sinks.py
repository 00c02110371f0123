"""Aligned text sinks.

Line files must stay aligned across sides. Rows are assigned to chunks by
their position (``pos div rows_per_file``) and hash-partitioned by (group,
chunk): every chunk lands whole in one task and one file, sorted by
position, and each side is written with the same assignment - so chunk k of
the source side lines up with chunk k of the target side, whatever the
cluster does. Chunk numbers are in the directory names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parapet.session import cut_lineage

ROWS_PER_FILE = 1_000_000


def write_aligned(df: DataFrame, out_dir: str, pos: str, columns: Sequence[str],
                  group: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE, placed: bool = False) -> None:
    """Write each of ``columns`` as text under ``out_dir/<column>/<group
    dirs>/chunk=<k>/``, in ``pos`` order, aligned across columns. ``placed``:
    the rows of a chunk are in one partition already, and stay there."""
    chunk = F.floor(F.col(pos) / rows_per_file).cast("bigint").alias("chunk")
    d = df.select(*group, chunk, pos, *columns)
    if not placed:
        d = d.repartition(*[F.col(g) for g in group], F.col("chunk"))
    d = cut_lineage(d.sortWithinPartitions(*group, "chunk", pos))      # numbered, shuffled and sorted once for all columns
    for c in columns:
        (d.select(*group, "chunk", F.col(c).alias("value"))
          .write.mode("overwrite").partitionBy(*group, "chunk").text(f"{out_dir.rstrip('/')}/{c}"))


def write_parallel(pairs: DataFrame, out_dir: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Train / validation line files (S6): ``sl`` and ``tl`` per split, in
    ``pair_id`` order. ``pairs``: (split, pair_id, sl, tl); positions within
    a split come from ``pair_id`` ranks."""
    from parapet.operators.ordinal import ordinal
    block = F.floor(F.col("pair_id") / rows_per_file)
    ranked = ordinal(pairs, ["split"], ["pair_id"], block, "pos")
    write_aligned(ranked, out_dir, "pos", ["sl", "tl"], ["split"], rows_per_file)


def write_eval(df: DataFrame, out_dir: str, rows_per_file: int = ROWS_PER_FILE, placed: bool = False) -> None:
    """source / reference / hypothesis text per (direction, dataset).
    ``df``: (direction, dataset, line_no, source, reference, hypothesis);
    ``placed`` as for :func:`write_aligned`."""
    write_aligned(df, out_dir, "line_no", ["source", "reference", "hypothesis"],
                  ["direction", "dataset"], rows_per_file, placed)


MAX_COPIES = 100_000


def _plain(path):
    """A file's address in one spelling: one slash after the scheme, nothing escaped."""
    decoded = F.url_decode(F.regexp_replace(path, "\\+", "%2B"))
    return F.regexp_replace(F.regexp_replace(decoded, "^(?:file:)?/+", "file:/"), "^([a-z0-9]+):/+", "$1:/")


def copy_files(spark, pairs: DataFrame, out_dir: str) -> None:
    """Copy the sampled file pairs (S8): every selected file's lines are
    written under ``out_dir/gold=<target name>/`` in line order. ``pairs``:
    (l_path, r_path, l_gold, r_gold), at most ``MAX_COPIES`` of them: the
    reader needs their list. Lines meet their target by the whole path."""
    from parapet.operators.sizing import checked_broadcast
    from parapet.sources.lines import read_lines
    sides = pairs.select(F.explode(F.array(F.struct(F.col("l_path").alias("path"), F.col("l_gold").alias("gold")),
                                           F.struct(F.col("r_path").alias("path"), F.col("r_gold").alias("gold")))).alias("s"))
    targets = sides.select("s.path", F.regexp_extract("s.gold", "([^/]*)$", 1).alias("gold")).distinct()
    paths = [r["path"] for r in targets.select("path").limit(2 * MAX_COPIES + 1).collect()]
    if len(paths) > 2 * MAX_COPIES:
        raise ValueError(f"more than {MAX_COPIES} file pairs to copy")
    if not paths:
        return
    named = checked_broadcast(targets.select(_plain(F.col("path")).alias("plain"), "gold"), 2 * MAX_COPIES)
    (read_lines(spark, sorted(paths)).withColumn("plain", _plain(F.col("file"))).join(named, "plain")
        .repartition("gold").sortWithinPartitions("gold", "line_no")
        .select("gold", F.col("line").alias("value"))
        .write.mode("overwrite").partitionBy("gold").text(out_dir))
