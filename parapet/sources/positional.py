"""Lookup of rows by position in a written table.

A table whose files are sorted by (group, position) is asked for a few
positions. A *manifest* holds the range of positions of each group in each
file: a row a file and group, made from the two thin columns and written
once. Only files whose range holds a wanted position are opened, and inside
a file the reader skips the pages whose position index does not hold it. The
files' ranges may overlap: that costs more files, never rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parapet.sources.cache import materialise_once

MAX_WANTED = 10_000
MAX_OR = 200            # conditions given to one scan


def sorted_files(df: DataFrame, group: str, pos: str) -> DataFrame:
    """``df`` with each partition, and so each file written from it, sorted
    by position: no row moves to another task."""
    return df.sortWithinPartitions(group, pos)


def manifest(table: DataFrame, group: str, pos: str) -> DataFrame:
    """(file, group, low, high, n) of a table read from files."""
    return table.select(F.col("_metadata.file_path").alias("file"), F.col(group).alias("group"), F.col(pos).alias("pos")) \
        .groupBy("file", "group").agg(F.min("pos").alias("low"), F.max("pos").alias("high"), F.count(F.lit(1)).alias("n"))


def manifest_once(spark: SparkSession, name: str, key: Sequence[object], table: DataFrame, group: str, pos: str) -> DataFrame:
    """The manifest of a published artefact, written once beside it."""
    return materialise_once(spark, f"{name}-manifest", [*key, sorted(table.inputFiles())[:1], group, pos],
                            lambda: manifest(table, group, pos))


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def files_of(ranges: DataFrame, wanted: Sequence[tuple[object, int]]) -> list[str]:
    """The files that may hold a wanted (group, position), in order."""
    found: set[str] = set()
    for i in range(0, len(wanted), MAX_OR):
        near = _any((F.col("group") == g) & (F.col("low") <= p) & (F.col("high") >= p) for g, p in wanted[i:i + MAX_OR])
        found |= {r["file"] for r in ranges.filter(near).select("file").distinct().collect()}
    return sorted(found)


def rows_at(table: DataFrame, ranges: DataFrame, wanted: Iterable[tuple[object, int]], group: str, pos: str) -> DataFrame:
    """The rows of ``table`` at the wanted (group, position) pairs, at most
    ``MAX_WANTED`` of them; a position that is not there has no row."""
    spark = table.sparkSession
    asked = sorted({(g, p) for g, p in wanted if g is not None and p is not None})
    if len(asked) > MAX_WANTED:
        raise ValueError(f"more than {MAX_WANTED} positions: join instead")
    files = files_of(ranges, asked) if asked else []
    if not files:
        return table.limit(0)
    part = spark.read.schema(table.schema).parquet(*files)
    out = [part.filter(_any((F.col(group) == g) & (F.col(pos) == p) for g, p in asked[i:i + MAX_OR]))
           for i in range(0, len(asked), MAX_OR)]
    return reduce(DataFrame.unionByName, out)
