"""Metric-log queries: epoch means, checkpoint selection, early stopping.

A log is (run, epoch, value). One run may hold a large share of all rows,
so nothing here puts a whole run into one task: running extremes use the
two-level scan, top-k uses ``row_number() <= k`` (Spark inserts a partial
per-partition group limit before the shuffle), and the early-stop test is a
join on (run, epoch).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PATIENCE = 5
EPOCHS_PER_BLOCK = 4096


def epoch_mean(df: DataFrame, run: str, epoch: str, value: str) -> DataFrame:
    """Unweighted mean of the per-batch values of each (run, epoch)."""
    return df.groupBy(run, epoch).agg(F.avg(value).alias("mean_value"))


def running_best(df: DataFrame, by: Sequence[str], order: str, value: str, mode: str = "min",
                 block: Column | None = None, name: str = "prev_best") -> DataFrame:
    """Best ``value`` strictly before each row within ``by`` (null at the
    first row); two-level so no window holds a whole run."""
    if mode not in ("min", "max"):
        raise ValueError("mode is 'min' or 'max'")
    agg = F.min if mode == "min" else F.max
    pick = F.least if mode == "min" else F.greatest
    block = F.floor(F.col(order) / EPOCHS_PER_BLOCK) if block is None else block
    d = df.withColumn("__b", block)
    keys = [*by, "__b"]
    within = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__in", agg(value).over(within))
    per_block = d.groupBy(*keys).agg(agg(value).alias("__bv"))
    across = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_block.select(*keys, agg("__bv").over(across).alias("__before"))
    return d.join(starts, keys).withColumn(name, pick("__before", "__in")).drop("__b", "__in", "__before")


def improvements(df: DataFrame, run: str, epoch: str, value: str, mode: str = "min") -> DataFrame:
    """Rows that strictly improve on every earlier value of their run."""
    r = running_best(df, [run], epoch, value, mode)
    better = F.col(value) < F.col("prev_best") if mode == "min" else F.col(value) > F.col("prev_best")
    return r.withColumn("improved", F.col("prev_best").isNull() | better)


def early_stop(df: DataFrame, run: str, epoch: str, value: str, mode: str = "min",
               patience: int = PATIENCE) -> DataFrame:
    """(run, stop_epoch, best_epoch, best_value).

    ``stop_epoch`` is the first evaluation after which the metric has not
    strictly improved for ``patience`` consecutive evaluations (null if the
    run never stops): the first epoch not covered by ``[i, i + patience)``
    of any improvement ``i``."""
    imp = improvements(df, run, epoch, value, mode)
    covered = (imp.filter("improved")
                  .select(run, F.explode(F.sequence(F.col(epoch), F.col(epoch) + patience - 1)).alias(epoch))
                  .distinct())
    stops = imp.select(run, epoch).join(covered, [run, epoch], "left_anti") \
               .groupBy(run).agg(F.min(epoch).alias("stop_epoch"))
    order = F.struct(F.col(value) if mode == "min" else -F.col(value), F.col(epoch))
    best = df.groupBy(run).agg(F.min(F.struct(order.alias("o"), F.col(epoch).alias("e"),
                                              F.col(value).alias("v"))).alias("b"))
    return best.select(run, F.col("b.e").alias("best_epoch"), F.col("b.v").alias("best_value")) \
               .join(stops, run, "left").select(run, "stop_epoch", "best_epoch", "best_value")


def best_checkpoints(df: DataFrame, run: str, epoch: str, value: str, top_k: int = 5, last_k: int = 3,
                     mode: str = "min") -> DataFrame:
    """(run, epoch, value, in_top_k, in_last_k, is_best) for every epoch kept
    by a rule (W6): the ``top_k`` best values (ties to the earlier epoch),
    the ``last_k`` latest epochs, and the single best."""
    key = F.col(value).asc() if mode == "min" else F.col(value).desc()
    top = Window.partitionBy(run).orderBy(key, F.col(epoch).asc())
    last = Window.partitionBy(run).orderBy(F.col(epoch).desc())
    t = df.withColumn("__r", F.row_number().over(top)).filter(F.col("__r") <= top_k) \
          .select(run, epoch, value, (F.col("__r") == 1).alias("is_best"), F.lit(True).alias("in_top_k"))
    l_ = df.withColumn("__r", F.row_number().over(last)).filter(F.col("__r") <= last_k) \
           .select(run, epoch, F.col(value).alias("__last"), F.lit(True).alias("in_last_k"))
    out = t.join(l_, [run, epoch], "full_outer")        # a null value would match no other
    return out.select(run, epoch, F.coalesce(value, "__last").alias(value),
                      F.coalesce("in_top_k", F.lit(False)).alias("in_top_k"),
                      F.coalesce("in_last_k", F.lit(False)).alias("in_last_k"),
                      F.coalesce("is_best", F.lit(False)).alias("is_best"))
