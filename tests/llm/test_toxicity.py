"""Toxicity: held-out accuracy, features, trees and calibration."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm_cases import ODD, no_docs, odd_docs  # noqa: F401
from parapet.llm import queries, toxicity as tox
from parapet.llm.units import flat

SF1 = "/root/testdata/sf0.1"


def described(texts, stems=()):
    return tox.features(tox.Words(dict(stems)), *flat(pa.array(texts, pa.string())))


def test_held_out_accuracy(spark):
    out = queries.op13(spark, SF1)
    rows = out.join(spark.read.parquet(f"{SF1}/labels.parquet"), "doc_id").filter("held_out").collect()
    n = len(rows)
    clean = [r for r in rows if r["toxic"] == 0]
    caught = [r["predicted"] for r in rows if r["toxic"] == 1]
    assert sum(r["predicted"] == r["toxic"] for r in rows) / n > 0.97
    assert sum(r["predicted"] for r in clean) / len(clean) < 0.01 and sum(caught) / len(caught) > 0.85
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= tox.CUT) for r in rows)
    assert out.count() == spark.read.parquet(f"{SF1}/documents.parquet").count()


def test_features_of_known_texts():
    f = dict(zip(tox.FEATURES, described(["You IDIOT, you are an 1d10t!! sooo sad"])[0]))
    assert f["insult_density"] == 1 / 8 and f["undone_insults"] == np.log1p(1) and f["second_person_density"] == 2 / 8
    assert f["near_share"] == 1.0 and f["runs"] == 1 / 8 and f["drawn_out"] == 1 / 8 and f["exclamations"] == 2 / 8
    far = "idiot " + "a " * 20 + "you"
    assert dict(zip(tox.FEATURES, described([far])[0]))["near_share"] == 0
    assert not described([None, "", " \n"]).any()
    g = dict(zip(tox.FEATURES, described(["vequxx abc"], {"vequ": 3.0})[0]))
    assert g["strongest_stem"] == 3.0 and g["stem_density"] == 1.5


def test_features_do_not_depend_on_neighbours_or_windows(monkeypatch):
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["you", "idiot", "x", "1d!ot", "AAA!!", "é"]) for _ in range(rnd.randint(0, 60))) for _ in range(40)]
    texts += [t or "" for t in ODD]
    each = np.concatenate([described([t]) for t in texts])
    assert np.allclose(described(texts), each)
    assert [w for ws in tox.word_windows(("ab c" * 50).encode(), 7) for w in ws] == ("ab c" * 50).encode().split()
    words = [w for w in tox.word_windows(b"x" * 100, 7)]
    assert words == [[b"x" * 100]]
    monkeypatch.setattr(tox, "WINDOW", 50)          # only nearness may change, at the windows' edges
    few = [j for j, name in enumerate(tox.FEATURES) if not name.endswith("near") and name != "near_share"]
    assert np.allclose(described(texts)[:, few], each[:, few])


def test_trees_learn_an_interaction_and_isotonic_is_the_best_monotone_fit():
    rng = np.random.default_rng(2)
    x = rng.uniform(size=(2000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.3)).astype(int)
    model = tox.boost(x[:1500], y[:1500], np.ones(1500))
    assert ((model.margins(x[1500:]) > 0) == y[1500:]).mean() > 0.95
    m, t, w = rng.normal(size=60).round(1), rng.integers(0, 2, 60), rng.uniform(0.5, 2, 60)
    at, p = tox.isotonic(m, t, w)
    assert (np.diff(at) >= 0).all() and (np.diff(p) >= 0).all()
    for v in np.unique(m):          # max over earlier starts of min over later ends of weighted means
        lo, hi = np.unique(m[m <= v]), np.unique(m[m >= v])
        mean = lambda a, b: np.average(t[(m >= a) & (m <= b)], weights=w[(m >= a) & (m <= b)])
        assert np.isclose(np.interp(v, at, p), max(min(mean(a, b) for b in hi) for a in lo))


def test_odd_tables(spark, odd_docs, no_docs):  # noqa: F811
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(ODD))] + [(3, 0), (None, 1), (5, None), (7, 9)], "doc_id long, toxic int")
    model = tox.train(odd_docs, labels)
    out = tox.score(odd_docs, model)
    assert out.count() == odd_docs.count() and out.columns == ["doc_id", "score", "predicted"]
    by = {}
    for r in out.join(odd_docs.select("doc_id", "text").distinct(), "doc_id").collect():
        by.setdefault((r["doc_id"], r["text"]), set()).add(r["score"])
    assert all(len(v) == 1 for v in by.values())            # repeated rows, equal results
    assert tox.train(odd_docs, labels.filter("toxic = 1")) is None
    assert {r["score"] for r in tox.score(odd_docs, None).collect()} == {0.5}
    assert tox.score(no_docs, model).count() == 0 and tox.train(no_docs, labels) is None


def test_rows_of_one_id_are_drawn_one_by_one(spark):
    docs = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("you idiot").alias("text")) \
        .union(spark.range(2, 400).select(F.col("id"), F.lit("fine words")))
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 400)], "doc_id long, toxic int")
    rows, population = tox.sample(docs, labels, "doc_id", "text", "toxic", 200)
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    assert 100 < n[1] < 320 and 100 < n[0] < 320 and population == {0: 398, 1: 1}
    model = tox.train(docs, labels, per_label=200)
    got = {r["doc_id"]: r["predicted"] for r in tox.score(docs, model).distinct().collect()}
    assert got[1] == 1 and got[2] == 0
