"""Vocabulary queries: pre-tokens, word counts, BPE training, encoding,
decoding and model features (F1-F6, F9-F11, A3, A4, J5, W3, P6, P7, M7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parapet.functions import text as T
from parapet.operators import bpe, corpus, features as ft, sampling
from parapet.plans import fixtures as fx
from parapet.plans.catalog import query
from parapet.plans.oracle import GPT2_SQL, with_
from parapet.sources.cache import input_fingerprint, materialise_once

VOCAB_SIZE = 32_000     # the reference's
SEED, N_VALID = 42, 3000
BATCH = 32


def _train_lines(spark, sf):
    """Both sides of the train split of the prepared corpus."""
    c = fx.prepared_table(spark, sf, "left")
    tr = sampling.train_valid_split(c, N_VALID, SEED, ["pair_id"]).filter(F.col("split") == "train")
    return tr.select(F.col("sl").alias("line")).unionByName(tr.select(F.col("tl").alias("line")))


def _specials(spark, sf):
    z = fx.table(spark, sf, "documents").filter(F.col("lang") != fx.SOURCE_LANG)
    tgts = corpus.distinct_values(z, "lang")
    row = spark.range(1).select(T.special_tokens(F.array(*[F.lit(t) for t in tgts])).alias("s")).first()
    return list(row["s"])


def trained_model(spark, sf, vocab_size: int = VOCAB_SIZE) -> bpe.BpeModel:
    """Train once per input and parameters; later calls load the artefact."""
    docs = fx.table(spark, sf, "documents")
    specials = _specials(spark, sf)
    key = [input_fingerprint(docs), vocab_size, specials, SEED, N_VALID]

    def build_merges():
        m = bpe.learn_bpe(bpe.word_counts(_train_lines(spark, sf), "line"), vocab_size, specials)
        return m.merges_df(spark).withColumn("rounds", F.lit(m.rounds))

    merges = materialise_once(spark, "bpe-merges", key, build_merges).orderBy("rank").collect()
    model = bpe.new_model(specials)
    id_of = {tb: i for i, tb in enumerate(model.token_bytes) if tb}
    for r in merges:
        a, b = id_of[bytes.fromhex(r["left_hex"])], id_of[bytes.fromhex(r["right_hex"])]
        if r["id"] == len(model.token_bytes):
            model.token_bytes.append(model.token_bytes[a] + model.token_bytes[b])
            id_of[model.token_bytes[-1]] = r["id"]
        model.merges.append((a, b, r["id"]))
        model.rounds = r["rounds"]
    return model


@query("pretokenize", with_("gpt2_words") + "SELECT * FROM gpt2_words")
def pretokenize(spark, sf):
    return bpe.word_counts(fx.lines(spark, sf), "line")


@query("word_counts", with_("words") + "SELECT * FROM words")
def word_counts(spark, sf):
    return bpe.word_counts(fx.table(spark, sf, "documents").select("text"), "text", T.WORD_PATTERN)


@query("bpe_pair_counts", with_("gpt2_words") + """
SELECT substr(h, 2 * i - 1, 2) AS left_hex, substr(h, 2 * i + 1, 2) AS right_hex, CAST(sum(cnt) AS BIGINT) AS c
FROM (SELECT hex(encode(word)) AS h, cnt FROM gpt2_words) w,
     LATERAL (SELECT unnest(generate_series(1, len(w.h) // 2 - 1)) AS i)
GROUP BY 1, 2
""")
def bpe_pair_counts(spark, sf):
    """First-round pair counts of the trainer, shown as byte pairs."""
    words = bpe.word_counts(fx.lines(spark, sf), "line")
    pc = bpe.pair_counts(bpe.initial_symbols(words))
    return pc.select(F.col("a").alias("left_hex"), F.col("b").alias("right_hex"), F.col("c").cast("bigint"))


@query("bpe_merges")
def bpe_merges(spark, sf):
    return trained_model(spark, sf).merges_df(spark)


FIRST_MERGES = 8


def _first_merges_sql(k: int) -> str:
    """The first ``k`` merges over the distinct words, one after another: each
    step counts adjacent symbols, takes the best pair and rewrites the words."""
    order = "[" + ", ".join(f"'{b:02X}'" for b in bpe.byte_order()) + "]"
    rank = lambda c, r: f"coalesce(nullif(list_position({order}, {c}), 0), 256 + list_position(m{r}.made, {c}))"
    parts = [f"""
w0 AS (SELECT cnt, regexp_extract_all(hex(encode(word)), '..') AS s FROM train_words),
m0 AS (SELECT CAST([] AS VARCHAR[]) AS made, CAST([] AS VARCHAR[]) AS lefts, CAST([] AS VARCHAR[]) AS rights)"""]
    for i in range(k):
        # the merged pair becomes one element: words are joined, rewritten and split again
        parts.append(f"""
p{i} AS (
  SELECT a, b, sum(cnt) AS c FROM (
    SELECT cnt, unnest(s[1:len(s) - 1]) AS a, unnest(s[2:]) AS b FROM w{i} WHERE len(s) > 1) GROUP BY a, b),
t{i} AS (SELECT a, b FROM p{i}, m{i} ORDER BY c DESC, {rank('a', i)}, {rank('b', i)} LIMIT 1),
m{i + 1} AS (SELECT list_append(made, a || b) AS made, list_append(lefts, a) AS lefts, list_append(rights, b) AS rights
             FROM m{i}, t{i}),
w{i + 1} AS (
  SELECT cnt, string_split(trim(regexp_replace(
           replace(' ' || array_to_string(s, '  ') || ' ', ' ' || a || '  ' || b || ' ', ' ' || a || b || ' '),
           ' +', ' ', 'g')), ' ') AS s
  FROM w{i}, t{i})""")
    return ",".join(parts) + f"""
SELECT CAST(generate_subscripts(lefts, 1) - 1 AS INTEGER) AS rank, unnest(lefts) AS left_hex, unnest(rights) AS right_hex
FROM m{k}
"""


_TRAIN_WORDS_SQL = """, train_words AS (
  SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM (SELECT unnest({words}) AS word FROM (
    SELECT unnest([sl, tl]) AS line FROM corpus
    WHERE pair_id NOT IN (SELECT pair_id FROM corpus ORDER BY md5('{seed}:' || CAST(pair_id AS VARCHAR)), pair_id LIMIT {n})))
  GROUP BY word),""".format(words=GPT2_SQL.format(x="line"), seed=SEED, n=N_VALID)


@query("bpe_first_merges", with_("corpus") + _TRAIN_WORDS_SQL + _first_merges_sql(FIRST_MERGES))
def bpe_first_merges(spark, sf):
    """The head of the trained merge list, which SQL can follow step by step."""
    return trained_model(spark, sf).merges_df(spark).filter(F.col("rank") < FIRST_MERGES) \
        .select("rank", "left_hex", "right_hex")


@query("bpe_vocab")
def bpe_vocab(spark, sf):
    return trained_model(spark, sf).vocab_df(spark)


def _encoded_pairs(spark, sf, model):
    """Both sides as one column with a side tag: one dictionary, one job."""
    sides = fx.pairs(spark, sf).select("pair_id", F.explode(F.array(
        F.struct(F.lit("sl").alias("side"), F.col("sl").alias("text")),
        F.struct(F.lit("tl").alias("side"), F.col("tl").alias("text")))).alias("e")).select("pair_id", "e.side", "e.text")
    enc = ft.encode(sides, ["pair_id", "side"], "text", model)
    return enc.groupBy("pair_id").agg(F.max(F.when(F.col("side") == "sl", F.col("ids"))).alias("src_ids"),
                                      F.max(F.when(F.col("side") == "tl", F.col("ids"))).alias("tgt_ids"))


@query("encode_pairs")
def encode_pairs(spark, sf):
    model = trained_model(spark, sf)
    sp = {t: i for i, t in enumerate(model.specials)}
    f = ft.model_features(_encoded_pairs(spark, sf, model), "src_ids", "tgt_ids",
                          sp[T.BOS], sp[T.EOS], sp[T.PAD], pad_to_max=False)
    f = ft.select_features(f, ["pair_id"])
    return f.select("pair_id", F.size("input_ids").cast("bigint").alias("n_input"),
                    F.size("labels").cast("bigint").alias("n_labels"),
                    ft.ids_digest(F.col("input_ids")).alias("input_md5"),
                    ft.ids_digest(F.col("labels")).alias("labels_md5"))


def _prepared_sides(spark, sf):
    """(split, pair_id, side, direction, text): both sides of the prepared,
    tagged corpus as one column, train and validation."""
    both = sampling.train_valid_split(fx.prepared_table(spark, sf, "left"), N_VALID, SEED, ["pair_id"])
    side = F.explode(F.array(F.struct(F.lit("sl").alias("side"), F.col("sl").alias("text")),
                             F.struct(F.lit("tl").alias("side"), F.col("tl").alias("text"))))
    return both.select("split", "pair_id", "direction", side.alias("e")).select(
        "split", "pair_id", "direction", "e.side", "e.text")


def _encoded_corpus(spark, sf):
    """The prepared corpus in ids, encoded once per input: one job for both
    sides and both splits."""
    model = trained_model(spark, sf)
    keys = ["split", "pair_id", "direction", "side"]
    key = [fx.documents_key(spark, sf), VOCAB_SIZE, SEED, N_VALID]
    return model, keys, materialise_once(spark, "encoded-corpus", key, lambda: ft.encode(
        _prepared_sides(spark, sf), keys, "text", model))


@query("encode_corpus", with_("corpus") + f"""
SELECT CASE WHEN pair_id IN (SELECT pair_id FROM corpus ORDER BY md5('{SEED}:' || CAST(pair_id AS VARCHAR)), pair_id
                             LIMIT {N_VALID}) THEN 'valid' ELSE 'train' END AS split,
       pair_id, side, CAST(0 AS BIGINT) AS n_unknown,
       CASE WHEN side = 'sl' THEN '<' || split_part(direction, '__', 2) || '>' END AS tag,
       CAST(CASE WHEN side = 'sl' THEN 1 ELSE 0 END AS BIGINT) AS n_special,
       CAST(strlen(text) - CASE WHEN side = 'sl' THEN length(split_part(direction, '__', 2)) + 2 ELSE 0 END AS BIGINT) AS n_bytes
FROM (SELECT pair_id, direction, unnest(['sl', 'tl']) AS side, unnest([sl, tl]) AS text FROM corpus)
""")
def encode_corpus(spark, sf):
    """What must hold of every encoded line: a source line starts with its
    tag's own id, all other ids are of text, and their bytes are the text's."""
    model, keys, enc = _encoded_corpus(spark, sf)
    n = len(model.specials)
    # one constant-folded literal, not an expression an entry
    width = F.split(F.lit(",".join(str(len(tb)) for tb in model.token_bytes)), ",").cast("array<int>")
    special = F.create_map(*[F.lit(x) for i, t in enumerate(model.specials) for x in (i, t)])
    known = F.filter("ids", lambda i: (i >= 0) & (i < len(model.token_bytes)))
    return enc.select("split", "pair_id", "side", (F.size("ids") - F.size(known)).cast("bigint").alias("n_unknown"),
                      special[F.get("ids", F.lit(0))].alias("tag"),
                      F.size(F.filter("ids", lambda i: i < n)).cast("bigint").alias("n_special"),
                      F.aggregate("ids", F.lit(0).cast("bigint"), lambda s, i: s + F.get(width, i.cast("int"))).alias("n_bytes"))


@query("decode_corpus", with_("corpus") + """
SELECT pair_id, side, CASE WHEN side = 'sl' THEN substr(text, length(split_part(direction, '__', 2)) + 3) ELSE text END AS text
FROM (SELECT pair_id, direction, unnest(['sl', 'tl']) AS side, unnest([sl, tl]) AS text FROM corpus)
""")
def decode_corpus(spark, sf):
    """decode(encode(x)) = x for every line of the prepared corpus, without its tag."""
    model, keys, enc = _encoded_corpus(spark, sf)
    return ft.decode(enc.select("pair_id", "side", "ids"), ["pair_id", "side"], "ids", model.vocab_df(spark))


@query("decode_roundtrip", with_("pairs") + "SELECT pair_id, sl AS text FROM pairs")
def decode_roundtrip(spark, sf):
    """decode(encode(x)) = x: BPE over bytes loses nothing."""
    model = trained_model(spark, sf)
    enc = ft.encode(fx.pairs(spark, sf), ["pair_id"], "sl", model)
    return ft.decode(enc, ["pair_id"], "ids", model.vocab_df(spark))


@query("word_vocab", with_("word_vocab") + "SELECT * FROM word_vocab")
def word_vocab(spark, sf):
    return ft.word_vocab(bpe.word_counts(fx.table(spark, sf, "documents"), "text", T.WORD_PATTERN)) \
             .select("id", "word")


def _word_vocab_table(spark, sf):
    """The word vocabulary as an artefact: built once per input."""
    key = [fx.documents_key(spark, sf)]
    build = lambda: ft.word_vocab(bpe.word_counts(fx.table(spark, sf, "documents"), "text", T.WORD_PATTERN))
    return materialise_once(spark, "word-vocab-counted", key, build)


def _word_pairs(spark, sf):
    vocab = _word_vocab_table(spark, sf)
    p = fx.pairs(spark, sf).select("pair_id", T.to_translation("sl", "tl").alias("translation"))
    flat = p.select("pair_id", F.col("translation.sl").alias("sl"), F.col("translation.tl").alias("tl"))
    src = ft.word_ids(flat, ["pair_id"], "sl", vocab, unknown="null").withColumnRenamed("ids", "src_ids")
    tgt = ft.word_ids(flat, ["pair_id"], "tl", vocab, unknown="null").withColumnRenamed("ids", "tgt_ids")
    return src.join(tgt, "pair_id")


_WORD_FEATURES_SQL = with_("pair_ids") + """,
f AS (
  SELECT s.pair_id,
         list_concat([0], s.ids[1:510], [1]) AS input_ids,
         list_concat([0], t.ids[1:510], [1]) AS labels
  FROM pair_ids s JOIN pair_ids t ON t.pair_id = s.pair_id AND t.side = 'tl'
  WHERE s.side = 'sl'
)
"""


@query("word_features", _WORD_FEATURES_SQL + """
SELECT pair_id, CAST(len(input_ids) AS BIGINT) AS n_tokens,
       md5(array_to_string(list_resize(input_ids, 512, 2), ' ')) AS input_md5,
       CAST(list_sum(list_resize(list_transform(input_ids, lambda e: 1), 512, 0)) AS BIGINT) AS mask_sum,
       md5(array_to_string(list_resize(labels, 512, 2), ' ')) AS labels_md5
FROM f
""")
def word_features(spark, sf):
    f = ft.model_features(_word_pairs(spark, sf), "src_ids", "tgt_ids", 0, 1, 2, pad_to_max=True)
    n = F.aggregate("attention_mask", F.lit(0), lambda s, x: s + x)
    return f.select("pair_id", n.cast("bigint").alias("n_tokens"),
                    ft.ids_digest(F.col("input_ids")).alias("input_md5"), n.cast("bigint").alias("mask_sum"),
                    ft.ids_digest(F.col("labels")).alias("labels_md5"))


@query("pad_batch", _WORD_FEATURES_SQL + f""",
b AS (
  SELECT f.*, CAST(floor((row_number() OVER (ORDER BY md5('{SEED}:' || CAST(pair_id AS VARCHAR)), pair_id) - 1)
                         / {BATCH}) AS BIGINT) AS batch_id
  FROM f
),
p AS (
  SELECT *, max(len(input_ids)) OVER (PARTITION BY batch_id) AS l, max(len(labels)) OVER (PARTITION BY batch_id) AS m FROM b
)
SELECT pair_id, batch_id, CAST(l AS BIGINT) AS input_len, CAST(m AS BIGINT) AS labels_len,
       md5(array_to_string(list_resize(input_ids, l, 2), ' ')) AS input_md5,
       md5(array_to_string(list_resize(labels, m, -100), ' ')) AS labels_md5,
       md5(array_to_string(list_transform(list_resize(labels, m, -100),
                                          lambda x: CASE WHEN x = -100 THEN 2 ELSE x END), ' ')) AS restored_md5
FROM p
""")
def pad_batch(spark, sf):
    f = ft.model_features(_word_pairs(spark, sf), "src_ids", "tgt_ids", 0, 1, 2, pad_to_max=False)
    f = sampling.shuffle_positions(f, SEED, ["pair_id"])
    f = f.withColumn("batch_id", sampling.batch_ids(F.col("pos"), BATCH))
    padded = ft.pad_batch(f, "batch_id", 2)
    return padded.select("pair_id", "batch_id", F.size("input_ids").cast("bigint").alias("input_len"),
                         F.size("labels").cast("bigint").alias("labels_len"),
                         ft.ids_digest(F.col("input_ids")).alias("input_md5"),
                         ft.ids_digest(F.col("labels")).alias("labels_md5"),
                         ft.ids_digest(T.replace_sentinel("labels", 2)).alias("restored_md5"))
