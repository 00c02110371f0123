"""Partition counts that follow the data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION_BYTES = 32 << 20
UNKNOWN_BYTES = 1 << 60     # a table of unknown size claims to be larger than any


def partitions_for(df: DataFrame, bytes_per_partition: int = PARTITION_BYTES) -> int:
    """Partitions for a shuffle whose rows grow after it, so that AQE cannot
    size it: the bytes of everything the plan reads over
    ``bytes_per_partition``, and at least the session's shuffle partitions.
    The sizes are the optimiser's (file sizes, checkpoint sizes); nothing runs.
    Only leaves are summed: estimates above joins are products."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    total = sum(n for n in sizes if n < UNKNOWN_BYTES)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // bytes_per_partition))


def bounded_rows(df: DataFrame, max_rows: int) -> list[tuple]:
    """Collect a small table (directions, languages, a manifest), refusing
    more than ``max_rows`` rows; sorted."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows, found more")
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, x) for x in r])


def lookup(values: dict, kind: str = "bigint") -> Callable[[Column], Column]:
    """A column function from a small dict: the value of a key, null for any
    other. Rows are looked up in place: nothing is shuffled on the key."""
    if not values:
        return lambda key: F.lit(None).cast(kind)
    table = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast(kind))])
    return lambda key: table[key]


def checked_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``df`` as a broadcast side of at most ``max_rows`` rows, which are
    fetched once here and checked."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows to broadcast, found more")
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
