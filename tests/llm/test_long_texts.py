"""Texts longer than a batch slice (4 MB) through every operator on texts."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from parapet.llm import (best_fit_packing, document_fingerprints, language_id, license_scan, quality_classifier, quality_rules, queries,
                         sentencepiece_codec, simhash_dedup, source_divergence, token_attribution, toxicity)

N = 4_300_000
PLAIN = "some plain words. " * (N // 18)


@pytest.fixture(scope="module")
def long_docs(spark):
    texts = [PLAIN, "x" * N, "\n" * N, "a▁b word " * (N // 40), PLAIN + "all rights reservd you idiot"]
    df = spark.createDataFrame([(i, t, "en", "src") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    return df.repartition(5).persist()


def rows(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_counts_rules_and_scans(long_docs):
    n = N // 18 * 3
    got = rows(quality_rules.judge(long_docs), "n_words", "word_chars", "n_dup_lines")
    assert got[0] == (n, N // 18 * 15, 0) and got[1] == (1, N, 0) and got[2] == (0, 0, 0)
    found = rows(license_scan.scan(long_docs), "n_words", "matches")
    assert found[0] == (n, []) and [(m["label"], m["first_word"]) for m in found[4][1]] == [("reserved", n)]


def test_models(spark, long_docs):
    labelled = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([("some plain words", "en"), ("des mots simples", "fr")] * 20)],
                                     "doc_id long, text string, lang string")
    got = rows(language_id.predict(long_docs, language_id.train(labelled)), "lang_pred", "score")
    assert got[0][0] == "en" and got[2] == ("und", 0.0) and all(0 <= s <= 1 for _, s in got.values())
    assert len(quality_classifier.score(long_docs, None).collect()) == 5
    x = np.zeros((40, len(toxicity.FEATURES)))
    x[::2, 2] = 1
    model = toxicity.fit(x, np.arange(40) % 2 == 0, (20.0, 20.0), {})
    assert [rows(toxicity.score(long_docs, model), "predicted")[i][0] for i in (0, 1, 2, 4)] == [0, 0, 0, 1]


def test_tokenizers(long_docs):
    piece, byte = queries.vocabulary("piece_bpe_32k.model"), queries.vocabulary("byte_bpe_50k.json")
    got = rows(sentencepiece_codec.round_trip(long_docs, piece), "decoded_sha256")
    assert got[1][0] == hashlib.sha256(b"x" * N).hexdigest()
    packed = best_fit_packing.pack(long_docs, byte).groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("length").alias("top"), F.max(F.col("start") + F.col("length")).alias("end"))
    for n, top, end in rows(packed, "n", "top", "end").values():
        assert n == end and top <= best_fit_packing.CAPACITY
    two = token_attribution.attribute(long_docs.filter("doc_id < 2"), byte)
    tokens = {r["doc_id"]: r["n"] for r in two.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    assert {i: n + 1 for i, n in tokens.items()} == {i: n for i, (n, *_) in rows(packed, "n").items() if i < 2}


def test_fingerprints_and_terms(long_docs):
    prints = rows(simhash_dedup.fingerprints(long_docs).withColumnRenamed("id", "doc_id"), "fp")
    near = rows(document_fingerprints.compare_edited(long_docs), "n_chars", "near_edited")
    assert prints[2] == (0,) and near[1][0] == N and len(near) == 5
    terms = {r["item"]: r["value"] for r in source_divergence.audit(long_docs.withColumn("source", F.col("doc_id").cast("string")), min_docs=1)
             .filter("part = 'term' and source = '0'").collect()}
    assert set(terms) == {"some", "plain", "words"}
