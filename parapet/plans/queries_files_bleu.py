"""File-name queries (S3, A2, J2, W9, S8) and scoring queries (P5, A5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parapet.functions import text as T
from parapet.operators import bleu, files
from parapet.plans import fixtures as fx
from parapet.plans.catalog import query
from parapet.plans.oracle import bleu_sql, with_

SEED = 42
N_FILES = 100
OUT = "/sample"


@query("path_filter", with_("files") + """
SELECT path FROM files WHERE path LIKE '%Aligned%' AND regexp_extract(path, '\\.([^.]*)$', 1) = 'en'
""")
def path_filter(spark, sf):
    return files.filter_paths(fx.files(spark, sf, with_content=False), glob="*Aligned*", ext="en").select("path")


@query("distinct_langs", with_("files") + """
SELECT DISTINCT regexp_extract(path, '\\.([^.]*)$', 1) AS lang FROM files WHERE path LIKE '%Aligned%'
""")
def distinct_langs(spark, sf):
    return files.distinct_langs(files.filter_paths(fx.files(spark, sf, with_content=False), glob="*Aligned*"))


@query("stem_join", with_("files") + """
SELECT l.stem, l.path AS l_path, r.path AS r_path
FROM (SELECT path, regexp_extract(path, '^(.*)\\.[^./]*$', 1) AS stem FROM files
      WHERE path LIKE '%Aligned%' AND path LIKE '%.en') l
JOIN (SELECT path, regexp_extract(path, '^(.*)\\.[^./]*$', 1) AS stem FROM files
      WHERE path LIKE '%Aligned%' AND path LIKE '%.it') r USING (stem)
""")
def stem_join(spark, sf):
    m = files.filter_paths(fx.files(spark, sf, with_content=False), glob="*Aligned*")
    return files.stem_join(m, "en", "it")


@query("sample_files", with_("files") + f"""
SELECT stem, l_path, r_path,
       '{OUT}/' || regexp_replace(l_path, '\\.[^.]*$', '') || '_gold.en' AS l_gold,
       '{OUT}/' || regexp_replace(l_path, '\\.[^.]*$', '') || '_gold.it' AS r_gold
FROM (
  SELECT l.stem, l.path AS l_path, r.path AS r_path
  FROM (SELECT path, regexp_extract(path, '^(.*)\\.[^./]*$', 1) AS stem FROM files
        WHERE path LIKE '%Aligned%' AND path LIKE '%.en') l
  JOIN (SELECT path, regexp_extract(path, '^(.*)\\.[^./]*$', 1) AS stem FROM files
        WHERE path LIKE '%Aligned%' AND path LIKE '%.it') r USING (stem)
  ORDER BY md5('{SEED}:' || l.path), l.path LIMIT {N_FILES})
""")
def sample_files(spark, sf):
    m = files.filter_paths(fx.files(spark, sf, with_content=False), glob="*Aligned*")
    return files.sample_file_pairs(m, N_FILES, SEED, OUT)


@query("strip_text", with_("pairs") + """
SELECT pair_id, regexp_replace(sl, '^\\s+|\\s+$', '', 'g') AS pred,
       regexp_replace(tl, '^\\s+|\\s+$', '', 'g') AS ref, CAST(1 AS BIGINT) AS n_refs
FROM pairs
""")
def strip_text(spark, sf):
    p = fx.pairs(spark, sf)
    refs = T.as_reference(F.col("tl"))
    return p.select("pair_id", T.strip_text("sl").alias("pred"), refs.getItem(0).alias("ref"),
                    F.size(refs).cast("bigint").alias("n_refs"))


@query("corpus_bleu", with_("hyp_ref") + bleu_sql("hyp_ref", "lang"))
def corpus_bleu(spark, sf):
    hr = fx.hyp_ref(spark, sf)
    return bleu.corpus_bleu(hr, ["lang"], ["sid"], F.col("hyp"), F.col("ref"))


@query("corpus_bleu_13a", with_("hyp_ref_13a") + bleu_sql("hyp_ref_13a", "lang"))
def corpus_bleu_13a(spark, sf):
    """BLEU with the default 13a tokens, from the sentences' texts."""
    hr = fx.hyp_ref(spark, sf).select("lang", "sid", F.array_join("hyp", " ").alias("hyp"), F.array_join("ref", " ").alias("ref"))
    return bleu.corpus_bleu(hr, ["lang"], ["sid"], bleu.tokenize_13a("hyp"), bleu.tokenize_13a("ref"))
