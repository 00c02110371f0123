"""Corpus preparation queries: lines, concatenation, zip, tags, union."""

from __future__ import annotations

from pyspark.sql import functions as F

from parapet.plans import fixtures as fx
from parapet.plans.catalog import query
from parapet.plans.oracle import with_


@query("corpus_by_direction", with_("tagged") + """
SELECT direction, CAST(count(*) AS BIGINT) AS n_pairs,
       CAST(sum(length(sl)) AS BIGINT) AS sl_chars, CAST(sum(length(tl)) AS BIGINT) AS tl_chars,
       CAST(min(pair_id) AS BIGINT) AS first_pair_id, CAST(max(pair_id) AS BIGINT) AS last_pair_id
FROM (SELECT *, row_number() OVER (ORDER BY direction, idx) - 1 AS pair_id FROM tagged)
GROUP BY direction
""")
def corpus_by_direction(spark, sf_dir):
    """Slice 0: lines -> concat -> zip -> tag -> union -> per-direction totals."""
    u = fx.prepared(spark, sf_dir, "inner")
    return u.groupBy("direction").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum(F.length("sl")).cast("bigint").alias("sl_chars"),
        F.sum(F.length("tl")).cast("bigint").alias("tl_chars"),
        F.min("pair_id").alias("first_pair_id"),
        F.max("pair_id").alias("last_pair_id"))
