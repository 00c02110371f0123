"""Metric-log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from parapet.operators import metrics_log as ml
from parapet.plans import fixtures as fx
from parapet.plans.catalog import query
from parapet.plans.oracle import with_


@query("epoch_mean_loss", with_("metrics") + """
SELECT run, CAST(floor((epoch - 1) / 5) AS BIGINT) AS epoch, round(avg(value), 6) AS mean_value
FROM metrics GROUP BY run, floor((epoch - 1) / 5)
""")
def epoch_mean_loss(spark, sf):
    m = fx.metrics(spark, sf).withColumn("epoch", F.floor((F.col("epoch") - 1) / 5).cast("bigint"))
    return ml.epoch_mean(m, "run", "epoch", "value").withColumn("mean_value", F.round("mean_value", 6))


@query("best_checkpoints", with_("metrics") + """
SELECT run, epoch, value, coalesce(t.r <= 5, false) AS in_top_k, coalesce(l.r <= 3, false) AS in_last_k,
       coalesce(t.r = 1, false) AS is_best
FROM (SELECT run, epoch, value,
             row_number() OVER (PARTITION BY run ORDER BY value, epoch) AS r FROM metrics) t
FULL OUTER JOIN (SELECT run, epoch, value, row_number() OVER (PARTITION BY run ORDER BY epoch DESC) AS r
                 FROM metrics) l USING (run, epoch, value)
WHERE t.r <= 5 OR l.r <= 3
""")
def best_checkpoints(spark, sf):
    return ml.best_checkpoints(fx.metrics(spark, sf), "run", "epoch", "value")


@query("best_by_bleu", with_("metrics") + """
SELECT run, epoch, value FROM (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY value DESC, epoch) AS r FROM metrics) WHERE r = 1
""")
def best_by_bleu(spark, sf):
    b = ml.best_checkpoints(fx.metrics(spark, sf), "run", "epoch", "value", top_k=1, last_k=0, mode="max")
    return b.filter("is_best").select("run", "epoch", "value")


_STOP_SQL = """
SELECT b.run, s.stop_epoch, b.best_epoch, b.best_value FROM (
  SELECT run, epoch AS best_epoch, value AS best_value FROM (
    SELECT *, row_number() OVER (PARTITION BY run ORDER BY {order}, epoch) AS r FROM metrics) WHERE r = 1) b
LEFT JOIN (
  SELECT run, min(epoch) AS stop_epoch FROM (
    SELECT run, epoch, sum(imp) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS k
    FROM (SELECT run, epoch, CASE WHEN prev IS NULL OR value {cmp} prev THEN 1 ELSE 0 END AS imp FROM (
            SELECT *, {agg}(value) OVER (PARTITION BY run ORDER BY epoch
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
            FROM metrics)))
  WHERE k = 0 GROUP BY run) s ON s.run = b.run
"""


@query("early_stop", with_("metrics") + _STOP_SQL.format(order="value", cmp="<", agg="min"))
def early_stop(spark, sf):
    return ml.early_stop(fx.metrics(spark, sf), "run", "epoch", "value", "min")


@query("early_stop_max", with_("metrics") + _STOP_SQL.format(order="value DESC", cmp=">", agg="max"))
def early_stop_max(spark, sf):
    return ml.early_stop(fx.metrics(spark, sf), "run", "epoch", "value", "max")
