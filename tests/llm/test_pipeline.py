"""Every stage of the pipeline against brute force on its own input."""

import corpus_pipeline
from llm_cases import SF01, no_docs, odd_docs, vocab  # noqa: F401
from parapet.llm import byte_bpe, language_id
from test_rules_and_models import brute_kept
from test_simhash import brute_classes
from test_tokenizers import check_packing


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: [(x is None, x) for x in r])


def test_stages_by_brute_force(spark, vocab):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, SF01).cache()
    assert known.schema == docs.schema
    model = language_id.train(docs.filter(language_id.fold("doc_id", 5) != 0))
    sure = {r["doc_id"] for r in language_id.predict(docs, model).filter("lang_pred <> 'und' and score >= 0.5").collect()}
    assert rows(known) == [r for r in rows(docs) if r[0] in sure] and len(sure) > 950

    good = stages["quality_rules"](spark, known, SF01).cache()
    assert good.schema == docs.schema
    assert rows(good) == [r for r in rows(known) if brute_kept(r[1])[1]]

    first = stages["simhash_dedup"](spark, good, SF01).cache()
    assert first.columns == docs.columns
    pairs = [(r["doc_id"], r["text"]) for r in good.collect()]
    heads = {c for _, _, c in brute_classes(pairs)}
    assert rows(first) == [r for r in rows(good) if r[0] in heads]

    packed = stages["best_fit_packing"](spark, first, SF01)
    left = [(r["doc_id"], r["text"]) for r in first.collect()]
    check_packing(packed.collect(), left, byte_bpe.load(vocab("byte_bpe_50k.json")).tok, 2048)
    assert packed.count() == corpus_pipeline.run(spark, SF01).count()


def test_stages_take_odd_and_no_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for lang in ("en", None):
            d = docs.selectExpr("doc_id", "text", f"cast({repr(lang) if lang else 'null'} as string) as lang", "ids as source",
                                "length as n_chars", "1 as score", "'x' as lang_pred", "array(1) as rejected_by")
            for name, stage in corpus_pipeline.STAGES[:-1]:
                out = stage(spark, d, SF01)
                assert out.columns == d.columns, name
                assert out.count() <= d.count()
                if name == "simhash_dedup" and docs is odd_docs:
                    assert out.count() > 5
            corpus_pipeline.STAGES[-1][1](spark, d, SF01).count()
