"""Evaluation queries: manifest, eval sets, optional references,
translation of eval sets and the BLEU report (S4, S5, J4, E5, E6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parapet.operators import bleu, decode
from parapet.plans import fixtures as fx
from parapet.plans.catalog import query
from parapet.plans.oracle import bleu_sql, with_
from parapet.sources.evalsets import read_eval_sets, source_lines

KEYS = ["direction", "dataset", "line_no"]


@query("eval_manifest", with_("manifest") + "SELECT * FROM manifest")
def eval_manifest(spark, sf):
    return fx.manifest(spark, sf)


@query("eval_sets", with_("eval_sets") + "SELECT * FROM eval_sets")
def eval_sets(spark, sf):
    return read_eval_sets(fx.manifest(spark, sf), fx.eval_files(spark, sf))


@query("optional_reference", with_("eval_sets") + """
SELECT direction, dataset, CAST(count(*) AS BIGINT) AS n_lines, bool_and(ref IS NOT NULL) AS has_ref,
       CAST(sum(CASE WHEN ref = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_blank_ref
FROM eval_sets GROUP BY direction, dataset
""")
def optional_reference(spark, sf):
    e = read_eval_sets(fx.manifest(spark, sf), fx.eval_files(spark, sf))
    return e.groupBy("direction", "dataset").agg(
        F.count(F.lit(1)).alias("n_lines"), F.bool_and(F.col("ref").isNotNull()).alias("has_ref"),
        F.sum(F.when(F.col("ref") == "", 1).otherwise(0)).cast("bigint").alias("n_blank_ref"))


def _translations(spark, sf, chunk_rows=None):
    """E5: decode every source line of every eval set with the n-gram
    ensemble, one row per line; lines without words get an empty hypothesis.
    A source line is decoded once for the sets that share its file, and only
    its first word is sent for it."""
    m, files = fx.manifest(spark, sf), fx.eval_files(spark, sf)
    lines = ["file", "line_no"]       # a decoder's path is another thing
    starts = source_lines(m, files).select(F.col("path").alias("file"), "line_no", decode.first_token("line").alias("token"))
    # the sets' lines are some of all lines, which tell their frequent first words without being shuffled
    freq = decode.start_counts(fx.decode_starts(spark, sf))
    decoded = decode.decoded_text(decode.greedy_decode(starts, fx.scorer_paths(spark, sf), lines, freq), keys=lines)
    return read_eval_sets(m, files, beside=decoded.withColumnRenamed("file", "path"), chunk_rows=chunk_rows)


@query("translate_eval_sets", with_("translations", recursive=True) + """
SELECT direction, dataset, line_no, hypothesis, n_steps, stop FROM translations
""")
def translate_eval_sets(spark, sf):
    return _translations(spark, sf).select(*KEYS, "hypothesis", "n_steps", "stop")


@query("eval_report", with_("eval_hr", recursive=True) + bleu_sql("eval_hr", "evalset"))
def eval_report(spark, sf):
    t = _translations(spark, sf).filter(F.col("ref").isNotNull())
    hr = t.select(F.concat_ws("/", "direction", "dataset").alias("evalset"), F.col("line_no").alias("sid"),
                  decode.tokens("hypothesis").alias("hyp"), decode.tokens("ref").alias("ref"))
    return bleu.corpus_bleu(hr, ["evalset"], ["sid"], F.col("hyp"), F.col("ref"))
