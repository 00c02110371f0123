"""Line reading, counting, splitting, sampling, shuffling and batching queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from parapet.functions import text as T
from parapet.operators import corpus, sampling
from parapet.plans import fixtures as fx
from parapet.plans.catalog import query
from parapet.plans.oracle import with_
from parapet.sources.positional import rows_at

SEED = 42
N_VALID = 3000          # validation pairs (the reference's CLI value)
N_SAMPLE = 100          # exact sample drawn from the conversation pairs
BATCH = 32              # loader batch size
MAP_BATCH = 512         # rows encoded together
CORPUS_BATCH = 10_000   # corpus lines read together


@query("read_lines", with_("lines") + "SELECT * FROM lines")
def read_lines(spark, sf):
    return fx.lines(spark, sf)


@query("concat_files", with_("ilines") + "SELECT lang, doc_id, line_no, idx FROM ilines")
def concat_files(spark, sf):
    return fx.indexed_lines(spark, sf).select("lang", "doc_id", "line_no", "idx")


@query("count_lines", with_("lines") + """
SELECT lang, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_files, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(sum(CASE WHEN line = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_empty
FROM lines GROUP BY lang
UNION ALL
SELECT '*', CAST(count(DISTINCT doc_id) AS BIGINT), CAST(count(*) AS BIGINT),
       CAST(sum(CASE WHEN line = '' THEN 1 ELSE 0 END) AS BIGINT) FROM lines
""")
def count_lines(spark, sf):
    lines = fx.lines(spark, sf)
    per_file = lines.groupBy("lang", "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("line") == "", 1).otherwise(0)).alias("e"))
    by_lang = per_file.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_lines"), F.sum("e").alias("n_empty"))
    total = by_lang.agg(F.lit("*").alias("lang"), F.sum("n_files").alias("n_files"),
                        F.sum("n_lines").alias("n_lines"), F.sum("n_empty").alias("n_empty"))
    return by_lang.unionByName(total).select(
        "lang", *[F.col(c).cast("bigint").alias(c) for c in ("n_files", "n_lines", "n_empty")])


@query("zip_inner", with_("zip") + "SELECT * FROM zip")
def zip_inner(spark, sf):
    return fx.zip_pairs(spark, sf, "inner")


@query("zip_left", with_("zip_left") + "SELECT * FROM zip_left")
def zip_left(spark, sf):
    return fx.zip_pairs(spark, sf, "left")


@query("tag_language", with_("tagged") + "SELECT * FROM tagged")
def tag_language(spark, sf):
    return corpus.tag_language(fx.zip_pairs(spark, sf, "inner"), multi=len(fx.target_langs(spark, sf)) > 1)


@query("union_directions", with_("tagged") + """
SELECT direction, idx, CAST(row_number() OVER (ORDER BY direction, idx) - 1 AS BIGINT) AS pair_id, sl, tl
FROM tagged
""")
def union_directions(spark, sf):
    return fx.prepared(spark, sf, "inner").select("direction", "idx", "pair_id", "sl", "tl")


@query("parse_direction", with_("zip") + """
SELECT direction, split_part(direction, '__', 1) AS src, split_part(direction, '__', 2) AS tgt,
       CAST(count(*) AS BIGINT) AS n_pairs
FROM zip GROUP BY direction
""")
def parse_direction(spark, sf):
    z = fx.zip_pairs(spark, sf, "inner")
    return z.groupBy("direction").agg(F.count(F.lit(1)).alias("n_pairs")) \
            .select("direction", T.parse_direction("direction").alias("d"), "n_pairs") \
            .select("direction", "d.src", "d.tgt", "n_pairs")


# per dataset (source), the list of its directions as configuration text,
# written with ',' for even and ';' for odd dataset numbers
_DIRS_TEXT_SQL = """
SELECT source,
       CASE WHEN CAST(substr(source, 4) AS INT) % 2 = 0 THEN array_to_string(dirs, ',')
            ELSE array_to_string(dirs, ';') END AS dirs_text
FROM (SELECT source, list_sort(list(DISTINCT 'en__' || lang)) AS dirs
      FROM documents WHERE lang <> 'en' GROUP BY source)
"""


def _dirs_text(spark, sf):
    docs = fx.table(spark, sf, "documents").filter(F.col("lang") != "en")
    sep = F.when(F.substring("source", 4, 10).cast("int") % 2 == 0, F.lit(",")).otherwise(F.lit(";"))
    per = docs.groupBy("source").agg(
        F.array_sort(F.collect_set(F.concat(F.lit("en__"), F.col("lang")))).alias("dirs"))
    # array_join takes a literal delimiter, so pick between the two joins
    return per.select("source", F.when(sep == ",", F.array_join("dirs", ","))
                                 .otherwise(F.array_join("dirs", ";")).alias("dirs_text"))


@query("parse_list", "WITH d AS (" + _DIRS_TEXT_SQL + """)
SELECT source, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS pos, unnest(parts) AS direction
FROM (SELECT source, regexp_split_to_array(dirs_text, '[,;]') AS parts FROM d)
""")
def parse_list(spark, sf):
    return _dirs_text(spark, sf).select(
        "source", F.posexplode(T.parse_list("dirs_text")).alias("pos", "direction")) \
        .withColumn("pos", F.col("pos").cast("bigint"))


@query("artifact_name", "WITH d AS (" + _DIRS_TEXT_SQL + """)
SELECT source, 'tokenizer-' || split_part(parts[1], '__', 1) || '__' ||
       array_to_string(list_transform(parts, lambda x: split_part(x, '__', 2)), '_') AS name,
       array_to_string(list_concat(
           CASE WHEN len(parts) > 1 THEN list_transform(parts, lambda x: '<' || split_part(x, '__', 2) || '>')
                ELSE [] END, ['<s>', '</s>', '<pad>']), ' ') AS specials
FROM (SELECT source, regexp_split_to_array(dirs_text, '[,;]') AS parts FROM d)
""")
def artifact_name(spark, sf):
    d = _dirs_text(spark, sf).select("source", T.parse_list("dirs_text").alias("dirs"))
    pd_ = F.transform("dirs", lambda x: T.parse_direction(x))
    tgts = F.transform(pd_, lambda s: s.getField("tgt"))
    src = pd_.getItem(0).getField("src")
    return d.select("source", T.artifact_name(src, tgts).alias("name"),
                    F.array_join(T.special_tokens(tgts), " ").alias("specials"))


@query("require_size", with_("zip_left") + f"""
SELECT direction, CAST(count(*) AS BIGINT) AS n_lines, count(*) > 2 * {N_VALID} AS ok
FROM zip_left GROUP BY direction
""")
def require_size(spark, sf):
    z = fx.zip_pairs(spark, sf, "left")
    return z.groupBy("direction").agg(F.count(F.lit(1)).alias("n_lines")) \
            .withColumn("ok", F.col("n_lines") > 2 * N_VALID)


@query("line_at", with_("zip") + """
SELECT z.direction, CAST(m.n AS BIGINT) AS n_lines,
       max(CASE WHEN z.idx = 0 THEN z.sl END) AS first_sl, max(CASE WHEN z.idx = 0 THEN z.tl END) AS first_tl,
       max(CASE WHEN z.idx = m.n - 1 THEN z.sl END) AS last_sl, max(CASE WHEN z.idx = m.n - 1 THEN z.tl END) AS last_tl
FROM zip z JOIN (SELECT direction, count(*) AS n FROM zip GROUP BY direction) m USING (direction)
WHERE z.idx = 0 OR z.idx = m.n - 1
GROUP BY z.direction, m.n
""")
def line_at(spark, sf):
    """Length of each direction (from the index) and its first and last pair,
    looked up by position: only the files that hold them are opened."""
    lengths = fx.line_totals(spark, sf)
    n_en, ends = lengths.get(fx.SOURCE_LANG, 0), []
    for t in fx.target_langs(spark, sf):
        n = min(n_en, lengths.get(t, 0))
        if n:
            ends += [(f"{fx.SOURCE_LANG}__{t}", n, f"{end}_{side}", lang, idx) for end, idx in (("first", 0), ("last", n - 1))
                     for side, lang in (("sl", fx.SOURCE_LANG), ("tl", t))]
    found = rows_at(fx.indexed_lines(spark, sf).select("lang", "idx", "line"), fx.line_ranges(spark, sf),
                    [(lang, idx) for *_, lang, idx in ends], "lang", "idx")
    # at most four rows a direction
    asked = spark.createDataFrame(ends, "direction string, n_lines long, what string, lang string, idx long")
    return asked.join(found, ["lang", "idx"]).groupBy("direction", "n_lines").agg(
        *[F.max(F.when(F.col("what") == w, F.col("line"))).alias(w) for w in ("first_sl", "first_tl", "last_sl", "last_tl")])


def _prepared(spark, sf):
    """Left-padded zip, tagged, union of directions: the corpus to split."""
    return fx.prepared_table(spark, sf, "left")


@query("split_sets", with_("corpus") + f"""
SELECT CASE WHEN pair_id IN (SELECT pair_id FROM corpus
                             ORDER BY md5('{SEED}:' || CAST(pair_id AS VARCHAR)), pair_id LIMIT {N_VALID})
            THEN 'valid' ELSE 'train' END AS split,
       pair_id, direction, sl, tl
FROM corpus
""")
def split_sets(spark, sf):
    c = _prepared(spark, sf)
    return sampling.train_valid_split(c, N_VALID, SEED, ["pair_id"]) \
                   .select("split", "pair_id", "direction", "sl", "tl")


@query("split_summary", with_("corpus") + f"""
SELECT split, direction, CAST(count(*) AS BIGINT) AS n_pairs
FROM (SELECT CASE WHEN pair_id IN (SELECT pair_id FROM corpus
                  ORDER BY md5('{SEED}:' || CAST(pair_id AS VARCHAR)), pair_id LIMIT {N_VALID})
             THEN 'valid' ELSE 'train' END AS split, direction FROM corpus)
GROUP BY split, direction
""")
def split_summary(spark, sf):
    c = _prepared(spark, sf)
    s = sampling.train_valid_split(c, N_VALID, SEED, ["pair_id"])
    return s.groupBy("split", "direction").agg(F.count(F.lit(1)).alias("n_pairs"))


@query("sample_exact", with_("pairs") + f"""
SELECT pair_id, sl, tl FROM pairs
ORDER BY md5('{SEED}:' || CAST(pair_id AS VARCHAR)), pair_id LIMIT {N_SAMPLE}
""")
def sample_exact(spark, sf):
    return sampling.sample_exact(fx.pairs(spark, sf), N_SAMPLE, SEED, ["pair_id"]) \
                   .select("pair_id", "sl", "tl")


@query("shuffle_order", with_("pairs") + f"""
SELECT pair_id, CAST(row_number() OVER (ORDER BY md5('{SEED}:' || CAST(pair_id AS VARCHAR)), pair_id) - 1
                     AS BIGINT) AS pos
FROM pairs
""")
def shuffle_order(spark, sf):
    return sampling.shuffle_positions(fx.pairs(spark, sf).select("pair_id"), SEED, ["pair_id"])


def _batch_sql(size: int, drop: bool) -> str:
    full = f"WHERE idx < (SELECT floor(count(*) / {size}) * {size} FROM ilines j WHERE j.lang = i.lang)" if drop else ""
    return with_("ilines") + f"""
SELECT lang, CAST(floor(idx / {size}) AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n_rows,
       min(idx) AS first_idx, max(idx) AS last_idx
FROM ilines i {full} GROUP BY lang, floor(idx / {size})
"""


def _batches(spark, sf, size: int, drop: bool):
    il = fx.indexed_lines(spark, sf)
    il = sampling.drop_last(il, "idx", size, by=["lang"]) if drop else il
    return il.groupBy("lang", sampling.batch_ids(F.col("idx"), size).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"))


@query("batch_rows", _batch_sql(BATCH, False))
def batch_rows(spark, sf):
    return _batches(spark, sf, BATCH, False)


@query("batch_rows_drop_last", _batch_sql(BATCH, True))
def batch_rows_drop_last(spark, sf):
    return _batches(spark, sf, BATCH, True)


@query("batch_rows_map", _batch_sql(MAP_BATCH, False))
def batch_rows_map(spark, sf):
    return _batches(spark, sf, MAP_BATCH, False)


@query("batch_rows_corpus", _batch_sql(CORPUS_BATCH, False))
def batch_rows_corpus(spark, sf):
    return _batches(spark, sf, CORPUS_BATCH, False)


@query("split_by_ids", with_("pairs") + f"""
SELECT CASE WHEN pair_id IN (SELECT pair_id FROM pairs
                             ORDER BY md5('{SEED}:' || CAST(pair_id AS VARCHAR)), pair_id LIMIT {N_SAMPLE})
            THEN 'valid' ELSE 'train' END AS split, pair_id
FROM pairs
""")
def split_by_ids(spark, sf):
    """J3 in its join form: a given id table (here the exact sample) splits
    the pairs by a left-semi and a left-anti join."""
    p = fx.pairs(spark, sf)
    ids = sampling.sample_exact(p, N_SAMPLE, SEED, ["pair_id"]).select("pair_id")
    train, valid = sampling.split_by_ids(p, ids, ["pair_id"])
    return train.select(F.lit("train").alias("split"), "pair_id") \
                .unionByName(valid.select(F.lit("valid").alias("split"), "pair_id"))
