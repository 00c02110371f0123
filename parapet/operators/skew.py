"""Joins that stay balanced when one key holds a large share of the rows.

A key is hot when it carries at least ``hot_fraction`` of all fact rows (and
``hot_min`` rows): there are at most 1 / hot_fraction such keys, so their
set is small by construction and is broadcast to tag the fact rows. A hot
key's fact rows are spread over ``salts`` join keys by a hash of the row,
and only the hot keys' dimension rows are replicated to every salt. Every
fact row still meets exactly the dimension rows of its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_FRACTION = 1e-5
HOT_MIN = 1000
SALTS = 64


def salted_join(facts: DataFrame, dim: DataFrame, key: str, freq: DataFrame | None = None,
                salts: int | None = None, hot_fraction: float | None = None, hot_min: int | None = None,
                how: str = "inner") -> DataFrame:
    """``facts.join(dim, key, how)`` with hot keys salted. ``freq``: (key,
    __n) fact rows per key, if already known (else one aggregation)."""
    salts = SALTS if salts is None else salts
    total = None
    if freq is None:
        # the keys are shuffled once: their number is that of the rows
        freq, total = facts.groupBy(key).agg(F.count(F.lit(1)).alias("__n")), facts.count()
    hot = frequent(freq, key, hot_fraction, hot_min, total)
    row_hash = F.xxhash64(*[F.col(c) for c in facts.columns])
    tagged = facts.join(F.broadcast(hot), key, "left").withColumn(
        "__salt", F.when(F.col("__hot"), F.pmod(row_hash, F.lit(salts)).cast("int")).otherwise(F.lit(0)))
    d = dim.join(F.broadcast(hot), key, "left").withColumn(
        "__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                             .otherwise(F.array(F.lit(0)))))
    return tagged.drop("__hot").join(d.drop("__hot"), [key, "__salt"], how).drop("__salt")


def frequent(freq: DataFrame, key: str, hot_fraction: float | None = None, hot_min: int | None = None,
             total: int | None = None) -> DataFrame:
    """(key, __hot): the hot keys of ``freq`` (key, __n), whose ``__n`` sum up to ``total``."""
    hot_fraction = HOT_FRACTION if hot_fraction is None else hot_fraction
    hot_min = HOT_MIN if hot_min is None else hot_min
    if total is None:
        total = freq.agg(F.sum("__n")).first()[0] or 0
    threshold = max(hot_min, int(total * hot_fraction))
    return freq.filter(F.col("__n") >= threshold).select(key, F.lit(True).alias("__hot"))


def hot_keys(freq: DataFrame, key: str, hot_fraction: float | None = None,
             hot_min: int | None = None) -> Sequence[str]:
    """The hot keys themselves (for reports and tests)."""
    hot_fraction = HOT_FRACTION if hot_fraction is None else hot_fraction
    hot_min = HOT_MIN if hot_min is None else hot_min
    total = freq.agg(F.sum("__n")).first()[0] or 0
    threshold = max(hot_min, int(total * hot_fraction))
    return [r[0] for r in freq.filter(F.col("__n") >= threshold).select(key).collect()]
