"""Table-scorer and greedy-decoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from parapet.operators import decode
from parapet.plans import fixtures as fx
from parapet.plans.catalog import query
from parapet.plans.oracle import with_


@query("bigram_scores", with_("bigram_counts") + """
SELECT member, prev, next, c, round(c / sum(c) OVER (PARTITION BY member, prev), 9) AS p FROM bigram_counts
""")
def bigram_scores(spark, sf):
    s = decode.bigram_scores(fx.bigram_cells(spark, sf)[0], fx.BIGRAM_MEMBERS)
    return s.select("member", "prev", "next", "c", F.round("p", 9).alias("p"))


@query("best_next", with_("best_next") + "SELECT * FROM best_next")
def best_next(spark, sf):
    return decode.best_next(fx.bigram_cells(spark, sf, decode.near_best)[0], fx.N_MEMBERS)


KEYS = ["sid", "line_no"]


def _decoded(spark, sf):
    return decode.greedy_decode(fx.decode_starts(spark, sf), fx.scorer_paths(spark, sf), KEYS)


@query("greedy_decode", with_("starts", "paths", recursive=True) + """
SELECT s.sid, s.line_no, CAST(generate_subscripts(p.path, 1) AS BIGINT) AS step, unnest(p.path) AS token
FROM starts s JOIN paths p ON p.start = s.token
""")
def greedy_decode(spark, sf):
    return decode.decoded_steps(_decoded(spark, sf), KEYS)


@query("decoded_text", with_("starts", "paths", recursive=True) + """
SELECT s.sid, s.line_no, coalesce(array_to_string(list_filter(p.path, lambda t: t <> '</s>'), ' '), '') AS hypothesis,
       CAST(coalesce(len(p.path), 0) AS BIGINT) AS n_steps,
       CASE WHEN s.token IS NULL THEN 'empty' ELSE coalesce(p.stop, 'dead_end') END AS stop
FROM starts s LEFT JOIN paths p ON p.start = s.token
""")
def decoded_text(spark, sf):
    return decode.decoded_text(_decoded(spark, sf), keys=KEYS)
