"""The thin queries ``opN_<name>``: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parapet.llm import best_fit_packing, bits, document_fingerprints, hard_negatives, language_id, license_scan, quality_classifier, quality_rules, sentencepiece_codec, simhash_dedup, source_divergence, token_attribution, toxicity, warc
from parapet.llm.catalog import query
from parapet.llm.shared import write_shared

TOKENIZERS = None       # folder of the public vocabularies; None: the installed package's


def vocabulary(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers
    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op3_sentencepiece")
def op3(spark, sf_dir):
    return sentencepiece_codec.round_trip(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


@query("op9_token_counts")
def op9(spark, sf_dir):
    return token_attribution.attribute(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


@query("op10_best_fit_packing")
def op10(spark, sf_dir):
    return best_fit_packing.pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


@query("op5_simhash_dedup")
def op5(spark, sf_dir):
    return simhash_dedup.classes(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), bits.as_hex(F.col("fp")).alias("fingerprint"),
        F.col("component").alias("component_id"))


@query("op8_document_fingerprints")
def op8(spark, sf_dir):
    out = write_shared(document_fingerprints.compare_edited(documents(spark, sf_dir)), "fingerprints")
    # searched: every document whose id is divisible by 20, against all
    index = out.groupBy("fp").agg(F.count(F.lit(1)).alias("__n"))
    asked = out.filter("doc_id % 20 = 0").select(F.col("fp").alias("query"))
    found = document_fingerprints.within(asked, index.select("fp")).join(index, "fp")
    n_within = found.groupBy(F.col("query").alias("fp")).agg(F.sum("__n").alias("n_within"))
    searched = out.withColumn("__asked", F.coalesce(F.col("doc_id") % 20 == 0, F.lit(False)))
    rows = searched.filter("__asked").join(n_within, "fp", "left").unionByName(
        searched.filter("not __asked"), allowMissingColumns=True)
    return rows.select("doc_id", "n_chars", "edited_sha256", bits.as_hex(F.col("fp")).alias("fingerprint"),
                       bits.as_hex(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next", "n_within")


# The same counts and rules over lists in DuckDB.
_OP1_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS p, w FROM a WHERE len(w) >= 3),
h AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM h WHERE n > 1) GROUP BY 1),
s AS (SELECT a.doc_id, t, l, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) AS letters,
             length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS uppers
      FROM a LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols > n_words * {symbols} OR n_dup_lines > len(l) * {dup}
            OR uppers / greatest(letters, 1) > {upper} OR letters / greatest(word_chars, 1) < {letters}) AS kept
FROM b
""".format(symbols=quality_rules.MAX_SYMBOLS_PER_WORD, dup=quality_rules.MAX_DUP_LINE_SHARE,
           upper=quality_rules.MAX_UPPER_SHARE, letters=quality_rules.MIN_LETTER_SHARE)


@query("op1_quality_rules", _OP1_SQL)
def op1(spark, sf_dir):
    return quality_rules.judge(documents(spark, sf_dir))


@query("op2_language_id")
def op2(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(language_id.fold("doc_id", 5) != 0))
    return language_id.predict(docs, model).select(
        "doc_id", F.coalesce(language_id.fold("doc_id", 5) == 0, F.lit(True)).alias("held_out"), "lang_pred", "score")


@query("op6_license_scan")
def op6(spark, sf_dir):
    found = license_scan.scan(documents(spark, sf_dir))
    exact = F.filter("matches", lambda m: m["kind"] == "exact")
    starts = F.transform(exact, lambda m: m["first_word"])

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(exact).cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(exact).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["similarity"])), F.lit(0.0)).alias("score"))


@query("op7_quality_classifier")
def op7(spark, sf_dir):
    docs, fold = documents(spark, sf_dir).select("doc_id", "text"), language_id.fold("doc_id", 4)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    table = quality_classifier.feature_table(docs)      # the texts are read once
    model = quality_classifier.train_table(table, labels.filter(fold != 2))
    return quality_classifier.score_table(table, model).select(
        "doc_id", F.coalesce(fold == 2, F.lit(True)).alias("held_out"), "score", "predicted")


@query("op4_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM q)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM m""")
def op4(spark, sf_dir):
    manifest = warc.archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    found = warc.summary(warc.read_chunks(spark, manifest, with_bytes=False))
    return found.select(warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
                        "record_type", warc.page_of(F.col("refers_to")).alias("refers_to"))


_SHARE = "1 + (1000000000 * CAST({c} + 2 AS HUGEINT)) // ({n} + 2 * v)"
_GAP = "((p - q) * (p - q)) // (p + q)"
_OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {source_divergence.MIN_DOCS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
ln AS (SELECT lang, sum(n) AS n FROM gn GROUP BY lang),
lc AS (SELECT lang, term, sum(c) AS c FROM c GROUP BY lang, term),
full_ AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, {_SHARE.format(c="coalesce(c.c, 0)", n="gn.n")} AS p
          FROM g JOIN kept k USING (lang) JOIN v USING (lang) JOIN gn USING (lang, source)
          LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item,
                coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) FROM full_ x JOIN full_ y USING (lang, term)
                          WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
term AS (SELECT lang, source, item, {_GAP} AS value FROM (
           SELECT f.lang, f.source, f.term AS item, f.c, f.p, {_SHARE.format(c="lc.c", n="ln.n")} AS q
           FROM full_ f JOIN lc USING (lang, term) JOIN ln USING (lang) JOIN v USING (lang)) WHERE c > 0 AND p > q),
both_ AS (SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', item, value FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_)
WHERE part = 'pair' OR rank <= {source_divergence.TOP_TERMS}
"""


@query("op11_source_divergence", _OP11_SQL)
def op11(spark, sf_dir):
    return source_divergence.audit(documents(spark, sf_dir))


_OP12_SQL = f"""
WITH e AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(CAST({hard_negatives.SCALE} AS DOUBLE) * x)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, e.id, e.label = a.label AS same, CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
      FROM e a JOIN e ON a.id <> e.id WHERE a.id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {hard_negatives.POSITIVES}),
n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
       AND {hard_negatives.LOW} * positive_score <= 100 * score AND 100 * score <= {hard_negatives.HIGH} * positive_score)
SELECT * FROM n WHERE rank <= {hard_negatives.NEGATIVES}
"""


@query("op12_hard_negatives", _OP12_SQL)
def op12(spark, sf_dir):
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, label=shifted)


@query("op13_toxicity")
def op13(spark, sf_dir):
    docs, fold = documents(spark, sf_dir).select("doc_id", "text"), language_id.fold("doc_id", 3)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.filter(fold != 1))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(fold == 1, F.lit(True)).alias("held_out"), "score", "predicted")
